"""DuckDB SQL of the queries that SQL can express in full."""

from __future__ import annotations

#: Words, pieces, n-grams by their joined words; cuts, containment and ranks as stated.
COLLOCATIONS = r"""
with pieces as (
  select coalesce(lang, 'und') lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) p
  from documents),
words as materialized (
  select lang, [x for x in string_split_regex(p, '[\x20\x09]+') if x <> ''] ws from pieces),
grams as materialized (
  select lang, n, g, count(*) f from (
    select lang, n, array_to_string(ws[i:i + n - 1], ' ') g from (
      select lang, ws, n, unnest(range(1, len(ws) - n + 2)) i
      from words, (select unnest([1, 2, 3, 4]) n)))
  group by lang, n, g),
cand as materialized (
  select lang, n, g, string_split(g, ' ') w, f a from grams where n > 1 and f >= 30),
cuts as (
  select c.lang, c.g, c.a, k, l.f l, r.f r,
         (2000000::hugeint * c.a) // (l.f + r.f) score
  from (select *, unnest(range(1, n)) k from cand) c
  join grams l on l.lang = c.lang and l.g = array_to_string(c.w[1:k], ' ')
  join grams r on r.lang = c.lang and r.g = array_to_string(c.w[k + 1:], ' ')),
low as (
  select * from cuts qualify row_number() over (partition by lang, g order by score, k) = 1),
inner_ as (
  select lang, array_to_string(w[i:i + m - 1], ' ') g, max(a) most
  from (select *, unnest(range(1, n - m + 2)) i
        from (select *, unnest(range(2, n)) m from cand where n > 2))
  group by 1, 2),
kept as (
  select low.*, row_number() over (partition by low.lang order by score desc, a desc, low.g) rank
  from low left join inner_ i on i.lang = low.lang and i.g = low.g
  where i.most is null or 100 * i.most < 80 * a),
total as (select lang, sum(f) n from grams where n = 1 group by lang)
select k.lang, cast(rank as integer) rank, g phrase, a, l, r, cast(t.n as bigint) n,
       cast(score as bigint) score
from kept k join total t on t.lang = k.lang where rank <= 2000"""


def _nearest(book: str) -> str:
    return f"""
  select v.vec_id, v.label, v.p, min(struct_pack(d := list_sum(
           [(v.a[i] - b.a[i]) * (v.a[i] - b.a[i]) for i in range(1, len(v.a) + 1)]),
           e := b.e)) m
  from parts v join {book} b on b.p = v.p group by v.vec_id, v.label, v.p"""


def _moved(book: str, found: str) -> str:
    return f"""
  select b.p, b.e, coalesce(s.a, b.a) a from {book} b left join (
    select p, e, list(floor_ order by i) a from (
      select p, e, i, (sum(y) - (sum(y) % count(*) + count(*)) % count(*)) // count(*) floor_
      from (select v.p, f.m.e e, unnest(v.a) y, generate_subscripts(v.a, 1) i
            from parts v join {found} f on f.vec_id = v.vec_id and f.p = v.p)
      group by p, e, i)
    group by p, e) s on s.p = b.p and s.e = b.e"""


#: Two rounds over 16 codebooks of 64 entries, every distance worked out.
VECTOR_CODES = f"""
with vecs as materialized (
  select vec_id, label, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] x
  from embeddings where embedding is not null
    and len([1 for x in embedding if x is null or not isfinite(x)]) = 0),
parts as materialized (
  select vec_id, label, p, x[p * len(x) // 16 + 1:(p + 1) * len(x) // 16] a
  from vecs, (select unnest(range(16)) p)),
b0 as materialized (
  select p, e, a from parts join (select vec_id, row_number() over (order by vec_id) - 1 e
                                  from vecs) using (vec_id) where e < 64),
f0 as materialized ({_nearest("b0")}),
b1 as materialized ({_moved("b0", "f0")}),
f1 as materialized ({_nearest("b1")}),
b2 as materialized ({_moved("b1", "f1")}),
f2 as materialized ({_nearest("b2")}),
codes as materialized (
  select vec_id, label, string_agg(printf('%02x', m.e), '' order by p) code,
         cast(sum(m.d) as bigint) error
  from f2 group by vec_id, label),
books as (select sha256(string_agg(y, ',' order by p, e, i)) sha from (
  select p, e, cast(unnest(a) as varchar) y, generate_subscripts(a, 1) i from b2))
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) label_error,
       sha codebooks_sha256
from codes, books"""

#: Every 100-byte window by its digest; all but the first of a digest cover their bytes.
SUBSTRINGS = """
with docs as materialized (
  select doc_id, hex(encode(coalesce(text, ''))) h,
         octet_length(encode(coalesce(text, ''))) n from documents),
blocks as (
  select doc_id, j, substr(h, 2 * j + 1, 2 * (200 + 99)) b
  from (select doc_id, h, unnest(range(0, n - 99, 200)) j from docs)),
windows as (
  select doc_id, j + i i, md5(substr(b, 2 * i + 1, 200)) w
  from (select doc_id, j, b, unnest(range(0, length(b) // 2 - 99)) i from blocks)),
later as (
  select doc_id, i from windows
  qualify row_number() over (partition by w order by doc_id, i) > 1),
runs as (
  select doc_id, min(i) lo, max(i) + 100 hi from (
    select doc_id, i, sum(fresh) over (partition by doc_id order by i) run from (
      select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 100
                             then 0 else 1 end fresh from later))
  group by doc_id, run),
cut as (
  select r.doc_id, sum(hi - lo) n_removed, count(*) n_spans,
         string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' order by lo) kept,
         max(hi) last
  from (select *, coalesce(lag(hi) over (partition by doc_id order by lo), 0) before from runs) r
  join docs d on d.doc_id = r.doc_id group by r.doc_id)
select d.doc_id, cast(n as bigint) n_bytes, cast(coalesce(n_removed, 0) as bigint) n_removed,
       cast(coalesce(n_spans, 0) as bigint) n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) kept_sha256
from docs d left join cut c on c.doc_id = d.doc_id"""

ORACLE = {"op6_substrings": SUBSTRINGS, "op11_collocations": COLLOCATIONS, "op12_vector_codes": VECTOR_CODES}
