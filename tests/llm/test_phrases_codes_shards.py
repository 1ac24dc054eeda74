"""Phrase collocations, vector codes and sharding against brute-force versions."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from odd import ODD

ENDS = ".,;:!?\n\x0b\x0c\r"


def phrase_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for e in ENDS:
        low = low.replace(e, "\n")
    return [[w for w in p.replace("\t", " ").split(" ") if w] for p in low.split("\n")]


def brute_phrases(rows, least=30, most=2000):
    count, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for p in phrase_words(text):
            total[lang] += len(p)
            for i in range(len(p)):
                for n in range(1, 5):
                    if i + n <= len(p):
                        count[lang, tuple(p[i:i + n])] += 1
    cand = {k: a for k, a in count.items() if len(k[1]) > 1 and a >= least}
    inside = defaultdict(int)
    for (lang, p), a in cand.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                key = lang, p[i:i + m]
                inside[key] = max(inside[key], a)
    out = defaultdict(list)
    for (lang, p), a in cand.items():
        if inside[lang, p] and 100 * inside[lang, p] >= 80 * a:
            continue
        s, k, l, r = min((2000000 * a // (count[lang, p[:k]] + count[lang, p[k:]]), k,
                          count[lang, p[:k]], count[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-s, -a, " ".join(p).encode(), l, r))
    return {(lang, i + 1, p.decode(), -a, l, r, total[lang], -s)
            for lang, x in out.items()
            for i, (s, a, p, l, r) in enumerate(sorted(x)[:most])}


def found_phrases(df):
    return [tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
            for r in df.collect()]


def test_collocations_equal_brute_force(spark, docs_of):
    from partflow.llm.collocations import collocations
    rng = random.Random(5)
    words = ["Und", "the", "of", "house", "É", "x y", "tree", "a", "b", "9", "und"]
    rows = []
    for i in range(120):
        lang = rng.choice(["en", "en", None, "de", "und"])
        t = ""
        for _ in range(rng.randrange(200)):
            t += rng.choice(words) if rng.random() < 0.8 else "the old house of"
            t += rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ;"])
        rows.append((i, t, lang, "a"))
    rows += [(500 + i, t, "odd", "a") for i, t in enumerate(ODD)]
    rows += [(None, "one two three four five six. " * 40, "en", None)] * 2
    docs = docs_of(rows)
    want = brute_phrases([(r[1], r[2]) for r in rows], least=5)
    got = found_phrases(collocations(docs, least=5))
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 200
    # Small blocks, few rows a language, and columns of clashing names.
    more = docs.selectExpr("*", "1 as word", "2 as id", "3 as n", "4 as block", "5 as phrase")
    want = brute_phrases([(r[1], r[2]) for r in rows], least=5, most=7)
    assert set(found_phrases(collocations(more, least=5, most=7, block_bytes=300))) == want


def test_collocations_of_nothing(spark, docs_of):
    from partflow.llm.collocations import collocations
    assert collocations(docs_of([None, "", " "])).collect() == []
    assert collocations(docs_of([]).limit(0)).collect() == []


@pytest.mark.parametrize("w", [8, 18, 22, 32])
def test_filters_lose_nothing(w):
    from partflow.llm import collocations as C
    rng = np.random.default_rng(w)
    for n in (2, 3, 4):
        top = min((1 << w) - 1, 50)
        ids = [np.concatenate([rng.integers(1, top, 3000), [(1 << w) - 1]]).astype(np.uint64)
               for _ in range(n)]
        want = Counter(zip(*[x.tolist() for x in ids]))
        half, bits = n * w // 2, 3
        cut = [np.array_split(x, 3) for x in ids]
        parts = defaultdict(list)
        for i in range(3):
            f = C.QuotientFilter.of(half, *C.permute(*C.packed([x[i] for x in cut], w), half))
            for s, p in f.cut(bits):
                p.count[:1] += 1000 * (i == 0 and s == 0)  # a counter over one byte
                parts[s].append(C.QuotientFilter.from_bytes(p.to_bytes(s, bits), half, s, bits))
        got, extra = Counter(), 0
        for s, fs in parts.items():
            m = C.QuotientFilter.merged(half, fs)
            assert (np.diff(m.hi.astype(object)) >= 0).all()
            for key, c in zip(zip(*[x.tolist() for x in C.unpacked(
                    *C.unpermute(m.hi, m.lo, half), n, w)]), m.count.tolist()):
                got[key] += c
        extra = sum(got.values()) - sum(want.values())
        assert extra in (0, 1000) and set(got) == set(want)
        assert sum(got[k] != want[k] for k in want) == (extra > 0)


def brute_codes(rows, parts=16, entries=64, rounds=2):
    from fractions import Fraction
    kept = []
    for key, v, label in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept.append((key, [(Fraction(x) * 256).__floor__() for x in v], label))
    if not kept:
        return []
    width = len(kept[0][1])
    at = [p * width // parts for p in range(parts + 1)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][a:b] for r in first] for a, b in zip(at, at[1:])]

    def near(x, book):
        return min((sum((p - q) ** 2 for p, q in zip(x, y)), i) for i, y in enumerate(book))
    for _ in range(rounds):
        for p, (a, b) in enumerate(zip(at, at[1:])):
            mine = defaultdict(list)
            for _, x, _ in kept:
                mine[near(x[a:b], books[p])[1]].append(x[a:b])
            books[p] = [[sum(c) // len(mine[j]) for c in zip(*mine[j])] if j in mine else y
                        for j, y in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(c) for b in books for y in b for c in y).encode()).hexdigest()
    out, by = [], Counter()
    for key, x, label in kept:
        found = [near(x[a:b], books[p]) for p, (a, b) in enumerate(zip(at, at[1:]))]
        out.append((key, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), label))
        by[label] += out[-1][2]
    return sorted(((k, c, e, by[l], sha) for k, c, e, l in out), key=str)


def run_codes(spark, rows, kind="array<float>"):
    from partflow.llm.common import prepare
    from partflow.llm.vector_codes import books_sha256, vector_codes
    df = prepare(spark).createDataFrame(
        [(k, v, lab, 1, "x") for k, v, lab in rows],
        f"vec_id bigint, embedding {kind}, label int, error int, code string")
    codes, books = vector_codes(df.repartition(5))
    return sorted(((r.vec_id, r.code, r.error, r.label_error, books_sha256(books))
                   for r in codes.collect()), key=str)


def test_vector_codes_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(0, .3, 48) if i % 9 else np.full(48, .25 * (i % 3)))
             .astype(np.float32).tolist(), None if i % 7 == 0 else i % 5 if i % 2 else 0)
            for i in range(300)]
    rows += [(3, rows[3][1], 1), (None, rows[5][1], 2), (None, None, 2), (900, None, 1),
             (901, [None] * 48, 1), (902, [float("nan")] * 48, 1),
             (903, [float("inf")] * 48, 1)]
    assert run_codes(spark, rows) == brute_codes(rows)


def test_vector_codes_of_few_odd_and_huge_vectors(spark):
    rows = [(i, [float(i % 3), -1.5 * i, 7.0], i % 2) for i in range(5)]  # fewer than parts
    assert run_codes(spark, rows) == brute_codes(rows)
    rows = [(i, [1e6 * (i % 4), -3e5 * i] * 8, None) for i in range(80)]
    assert run_codes(spark, rows, "array<double>") == brute_codes(rows)
    assert run_codes(spark, [(1, None, 1)]) == []
    assert [r[1:4] for r in run_codes(spark, [(1, [], 1)])] == [("00" * 16, 0, 0)]


def test_equal_average_search_is_exact():
    from partflow.llm.vector_codes import nearest
    rng = np.random.default_rng(1)
    for dim in (1, 3, 6):
        x, book = rng.integers(-4, 5, (500, dim)), rng.integers(-4, 5, (40, dim))
        d = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        code, far = nearest(x, book)
        assert (code == d.argmin(axis=1)).all() and (far == d.min(axis=1)).all()


def shards_of(docs, **how):
    from partflow.llm.sharding import shard_rows
    return shard_rows(docs, **how).collect()


def shard_docs(docs_of):
    rng = random.Random(2)
    rows = [(i, "w" * rng.randrange(200), "en", "a") for i in range(1500)]
    rows += [(7, "the same row", "en", "a")] * 800 + [(None, None, None, None)] * 40
    rows += [(9, t, "en", "a") for t in ODD] + [(5000, "long " * 4000, "en", "a")]
    return docs_of(rows), rows


def test_shards_of_equal_rows(spark, docs_of):
    docs, rows = shard_docs(docs_of)
    got = shards_of(docs.selectExpr("*", "1 as shard", "2 as p", "3 as size"))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t, *_ in rows)
    per = defaultdict(list)
    for r in got:
        per[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert sorted(per) == list(range(40))
    assert max(map(len, per.values())) - min(map(len, per.values())) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in per.values())
    again = shards_of(docs.repartition(3))
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_shards_walk_like_the_ring(spark, docs_of):
    """Row by row, round by round, against the definition; and few rows move."""
    from pyspark.sql import functions as F

    from partflow.llm import sharding as S
    docs, _ = shard_docs(docs_of)
    laid = sorted(S.laid_out(docs.select(
        F.col("doc_id").alias("k"), F.xxhash64(F.lit(42), F.coalesce("text", F.lit("")))
        .alias("digest"), F.lit(1).alias("size"), F.crc32("text").alias("crc")), 42)
        .select("place", "p", "i", "k", "crc").collect(), key=lambda r: (r.p, r.i))
    assert [r.place for r in laid] == sorted(r.place for r in laid)
    way = {r.place: r.way for r in S.ring(spark, 40).collect()}
    assert all(sorted(x) == list(range(40)) for x in way.values())
    n = len(laid)
    room, left, at = [n // 40 + (s < n % 40) for s in range(40)], list(range(n)), {}
    while left:
        full, rest = [x == 0 for x in room], []
        for i in left:
            s = next(x for x in way[laid[i].place] if not full[x])
            if room[s]:
                room[s] -= 1
                at[i] = s
            else:
                rest.append(i)
        left = rest
    want = Counter((laid[i].k, s) for i, s in at.items())
    got = shards_of(docs)
    assert Counter((r.doc_id, r.shard) for r in got) == want

    def moved(a, b):
        x, y = ({(r.doc_id, r.text_crc32): r.shard for r in z} for z in (a, b))
        return sum(x[k] != y[k] for k in x) / len(x)
    assert moved(got, shards_of(docs, shards=41)) < 0.35  # by remainder: 0.97


def test_shards_of_bytes_and_of_nothing(spark, docs_of):
    docs, _ = shard_docs(docs_of)
    got = shards_of(docs, shards=4, law="bytes")
    per = Counter()
    for r in got:
        per[r.shard] += r.size
    mean, most = sum(per.values()) / 4, max(r.size for r in got)
    assert all(x <= mean * 1.01 + 2 * most for x in per.values())
    assert shards_of(docs_of([]).limit(0)) == []
    one = shards_of(docs_of(["a"]))
    assert [(r.slot, r.size) for r in one] == [(0, 17)]
