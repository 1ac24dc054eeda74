"""Quality rules, personal data and mixing against brute force."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = list(zip(w, w[1:], w[2:]))
    often, cover = Counter(windows), set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            cover |= {i, i + 1, i + 2}
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(cover),
            len(w) < 50 or 100 * len(cover) > 50 * len(w))


def prose(rnd, n):
    words = [f"{rnd.choice('abcdefgh')}{rnd.choice(['an', 'ore', 'it', 'ulen'])}{i % 977}"
             for i in rnd.sample(range(10 ** 6), n)]
    return " ".join(words)


def test_quality_counts_and_outliers(docs_of):
    from partflow.llm.quality import quality, quality_documents
    rnd = random.Random(4)
    clean = [prose(rnd, rnd.randrange(60, 600)) for _ in range(300)]
    junk = [" ".join(w + "###$$$" for w in prose(rnd, 200).split()) for _ in range(12)]
    rows = [(i, t, "en", "a") for i, t in enumerate(ODD)]
    rows += [(100 + i, t, "en", "a" if i % 3 else None) for i, t in enumerate(clean)]
    rows += [(900 + i, t, "en", "a") for i, t in enumerate(junk)]
    rows += [(None, clean[0], None, "b"), (101, clean[1], "en", "a")]
    docs = docs_of(rows).repartition(4)
    got = quality(docs).collect()
    assert len(got) == len(rows)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed")
    have = Counter((r.doc_id, *(r[n] for n in names)) for r in got)
    assert have == Counter((k, *counts(t)) for k, t, _, _ in rows)
    kept = {r.doc_id: r.kept for r in got}
    assert not any(r.kept for r in got if r.base_failed)
    assert all(kept[100 + i] for i in range(len(clean)))
    assert not any(kept[900 + i] for i in range(len(junk)))
    stay = quality_documents(docs)
    assert stay.columns == docs.columns
    assert Counter(r.doc_id for r in stay.collect()) == Counter(
        r.doc_id for r in got if r.kept)


def test_quality_matches_numpy_mcd(docs_of):
    """The distances equal those of the same estimator in numpy."""
    from partflow.llm import quality as Q
    rnd = random.Random(9)
    texts = [prose(rnd, rnd.randrange(50, 400)) + " #" * rnd.randrange(8) for _ in range(161)]
    got = {r.doc_id: r for r in Q.quality(docs_of(texts)).collect()}
    names = list(Q.FLOOR)
    x = []
    for i, t in enumerate(texts):
        n, chars, sym, dup, rep, _ = counts(t)
        up = sum(c.isascii() and c.isupper() for c in t)
        x.append([np.log1p(n), np.log(chars / n), np.log1p(sym / n), np.log1p(10 * dup / n),
                  np.sqrt(rep / n), np.sqrt(up / chars), np.log1p(0.0)])
    x = np.array(x)
    floor = np.array([Q.FLOOR[k] for k in names])

    def fit(sub):
        c = (sub[:, :, None] * sub[:, None, :]).mean(0) - np.outer(sub.mean(0), sub.mean(0))
        return sub.mean(0), c + np.diag(floor ** 2)

    def d2(m, c):
        z = x - m
        return np.einsum("ij,jk,ik->i", z, np.linalg.inv(c), z)

    def low(v, share):                    # the value percentile_approx gives
        return np.sort(v)[int(np.ceil(share * len(v))) - 1]

    mid = np.array([low(c, 0.5) for c in x.T])
    mad = np.array([low(abs(c - m), 0.5) for c, m in zip(x.T, mid)])
    far = abs(x - mid) / (1.4826 * mad + floor)
    best = None
    for d in ((far ** 2).sum(1), far.max(1)):
        m, c = fit(x[d <= low(d, Q.KEEP)])
        for _ in range(Q.STEPS):
            d = d2(m, c)
            m, c = fit(x[d <= low(d, Q.KEEP)])
        det = np.linalg.slogdet(c)[1]
        if best is None or det < best[0] - 1e-12:
            best = (det, m, c)
    d = d2(*best[1:])
    m, c = fit(x[d * Q.MEDIAN <= Q.INNER * low(d, 0.5)])
    assert np.allclose([got[i].d2 for i in range(len(texts))], d2(m, c), rtol=1e-6)


def test_quality_empty_and_tiny(docs_of):
    from partflow.llm.quality import quality
    assert quality(docs_of([])).collect() == []
    got = quality(docs_of([prose(random.Random(1), 80)])).collect()
    assert [(r.n_words, r.kept) for r in got] == [(80, True)]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(s):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))
               for i, c in enumerate(reversed(s))) % 10 == 0


def base(t):
    t = t or ""
    out = [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(t)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[ -]", "", m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    for m in PHONE.finditer(t):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return ",".join(f"{k}:{a}:{e}" for a, _, e, k in sorted(out))


def pii_texts(n):
    rnd = random.Random(3)
    alphabet = "ab1234567890.@-+ ()_%\né4"
    wild = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(120))) for _ in range(n)]
    return wild + [
        "a@b.c_d@e.f a@b..c x@y.z.", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3",
        "4111 1111 1111 1111 and 4111-1111-1111-1112 4111  1111 1111 1111",
        "+1 (555) 123-4567 +12 3 +4512345678901234567 ++1 23456789", "é@x.y a@é.b " * 3,
        "9" * 400 + " " + "1 " * 300, ".1" * 200 + "@" + "x." * 200, "a" * 20_000 + "@b.c",
        "1 2 " * 20_000, "a@" + "b." * 3000 + "c", "+" * 500 + "1" * 12 + ")"]


def test_personal_data(docs_of):
    from partflow.llm.pii import personal_data
    texts = ODD + pii_texts(250)
    got = {r.doc_id: r for r in personal_data(docs_of(texts)).collect()}
    for i, t in enumerate(texts):
        want = base(t)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), t
        spans = [x for x in got[i].spans.split(",") if x]
        assert set(x for x in want.split(",") if x) <= set(spans)
        for kind in ("email", "ip", "card", "phone"):
            assert got[i][f"n_{kind}"] == sum(s.startswith(kind + ":") for s in spans)


def planted(n, seed):
    """Texts with personal data in base formats, among look-alikes that are none."""
    rnd = random.Random(seed)
    digits = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))
    out = []
    for i in range(n):
        card = "4" + digits(14)
        card += next(c for c in "0123456789" if luhn(card + c))
        out.append(" ".join([prose(rnd, 9), rnd.choice([
            f"call phone +1 ({digits(3)}) 555-{digits(4)} today",
            f"mail u{digits(2)}@mail{i % 9}.example.com now", f"card {card} paid",
            f"order {digits(2)}.{digits(4)}.{digits(3)} came", f"key = {digits(12)}ab",
            f"number {digits(16)} was lost", f"host {i % 256}.1.2.3 up"]), prose(rnd, 9)]))
    return out


def test_personal_data_adds_other_formats_and_no_look_alikes(docs_of):
    """The trees learn from masked base spans: formats that the base rules can't see are added,
    order numbers, keys and numbers that fail Luhn's check aren't."""
    from partflow.llm.pii import personal_data
    rnd = random.Random(8)
    more = [f"{prose(rnd, 9)} {x} {prose(rnd, 9)}" for x in (
        "call phone (222) 555-1234 today", "mail u77 [at] mail3.example.com now",
        "card 4111.1111.1111.1111 paid")]
    got = {r.doc_id: r for r in personal_data(docs_of(planted(1200, 8) + more)).collect()}
    assert [(got[1200 + i].n_email, got[1200 + i].n_card, got[1200 + i].n_phone)
            for i in range(3)] == [(0, 0, 1), (1, 0, 0), (0, 1, 0)]
    for i, t in enumerate(planted(1200, 8)):
        assert got[i].spans == base(t), t


def test_personal_data_of_the_given_tables(spark):
    """All of it is in base formats there: nothing is added, to look-alikes neither."""
    from partflow.llm.common import prepare
    from partflow.llm.pii import fit, spans
    docs = prepare(spark).read.parquet("/root/testdata/sf0.01/documents.parquet")
    model, limits = fit(docs)
    assert model is not None and set(limits) == {"email", "ip", "card", "phone"}
    added = spans(docs.select("text"), model, limits).where(F.size("_spans") > F.size("_base"))
    assert added.count() <= 2


def test_personal_data_scores_cover_all_documents(docs_of, monkeypatch):
    """A kind too rare in the trees' sample has its least score from the whole table."""
    from partflow.llm import pii
    docs = docs_of(planted(400, 5))
    monkeypatch.setattr(pii, "TRAIN_DOCS", 60)
    model, limits = pii.fit(docs)
    assert model is not None and {"card", "phone", "email", "ip"} <= set(limits)


def test_personal_data_in_chunks(docs_of, monkeypatch):
    """Arrays cut into small chunks give what whole ones give, added spans and redaction too; a
    text of thousands of matches ends."""
    from partflow.llm import pii
    texts = planted(500, 11)
    texts += [" ".join(texts[i:i + 25]) for i in range(0, 500, 25)]
    texts += [" ".join(f"{x} call (222) 555-{i % 10000:04d} now" for i in range(40))
              for x in ("phone", "tel +1 (333) 555-0000")]
    docs = docs_of(texts)
    fitted = pii.fit(docs)
    monkeypatch.setattr(pii, "fit", lambda *_: fitted)

    def both():
        return (sorted(map(repr, pii.personal_data(docs).collect())),
                sorted((r.doc_id, r.text) for r in pii.redacted(docs).collect()))
    whole = both()
    monkeypatch.setattr(pii, "CHUNK", 3)
    assert both() == whole
    monkeypatch.undo()
    monkeypatch.setattr(pii, "fit", lambda *_: fitted)
    long = " ".join(f"+1 (222) 555-{i % 10000:04d} \xe9" for i in range(8000))
    got = pii.personal_data(docs_of([long])).first()
    assert got.n_phone == 8000 and got.spans == base(long)


def test_redacted(docs_of):
    from partflow.llm.pii import redacted
    texts = [None, "", "no data", "mail a@b.cc now, é +1 (222) 555-1234.", "1.2.3.4x@y.zz"]
    got = {r.doc_id: r.text for r in redacted(docs_of(texts)).collect()}
    assert [got[i] for i in range(5)] == [
        None, "", "no data", "mail [EMAIL] now, é [PHONE].", "[EMAIL]"]


#: Names that operators use inside.
CLASHES = ("t", "k", "own", "_own", "row", "_base", "_spans", "_wide", "kept", "d2", "n_words",
           "both", "g", "x0", "size", "taken", "copies", "ids", "spans", "n_email", "fp",
           "component_id", "ord", "mark", "score", "_digit", "_k", "_n", "n_tokens", "anchor")


def test_columns_with_clashing_names(docs_of):
    from partflow.llm import byte_bpe, mixing, pii, quality, simhash, substrings, token_counts
    from partflow.llm.toxicity import toxicity
    P = pytest.importorskip("public_tokenizers")
    rnd = random.Random(3)
    docs = docs_of([prose(rnd, 70) + " a@b.cc" for _ in range(6)] + [None])
    docs = docs.withColumns({c: F.lit("clash") for c in CLASHES})
    for f in (quality.quality_documents, simhash.first_of_each, pii.redacted,
              mixing.mixed_documents):
        out = f(docs)
        assert out.columns == docs.columns
        assert {r["kept"] for r in out.collect()} <= {"clash"}
    assert quality.quality(docs).where("kept").count() == 6
    assert sum(r.n_email for r in pii.personal_data(docs).collect()) == 6
    ranks = P.path("byte_bpe_50k.tiktoken")
    for df in (mixing.mix(docs), byte_bpe.encode_corpus(docs, ranks, P.PATTERN),
               substrings.repeated_substrings(docs), simhash.near_duplicates(docs),
               token_counts.token_counts(docs, P.path("byte_bpe_50k.json")),
               toxicity(docs, {}, -5.0)):
        assert df.count() == 7


def test_personal_data_empty(docs_of):
    from partflow.llm.pii import personal_data
    assert personal_data(docs_of([])).collect() == []


def goals(sizes):
    """Targets by the contract: sizes per source in order -> targets."""
    total, weights = sum(sizes), [i % 3 + 1 for i in range(len(sizes))]
    full = set()
    while True:
        rest = total - sum(3 * sizes[i] for i in full)
        w = sum(weights[i] for i in range(len(sizes)) if i not in full)
        target = [3.0 * sizes[i] if i in full else rest * weights[i] / w
                  for i in range(len(sizes))]
        over = {i for i in range(len(sizes)) if i not in full and target[i] > 3 * sizes[i]}
        if not over:
            return target
        full |= over


def test_mix(docs_of):
    from partflow.llm.mixing import mix, mixed_documents
    rnd = random.Random(6)
    rows, names = [], ["b", "a", "é", "Z", None, "", "tiny", "zero"]
    for i in range(1500):
        s = names[min(int(rnd.expovariate(0.6)), 5)]
        rows.append((i, "w " * int(rnd.lognormvariate(3, 1.2)), "en", s))
    rows += [(5000, "one two", "en", "tiny"), (5001, None, "en", "zero"), (None, "x y", "en", "a"),
             (7, rows[7][1], "en", rows[7][3])]
    docs = docs_of(rows).repartition(4)
    got = mix(docs).collect()
    assert len(got) == len(rows)
    order = sorted({r[3] for r in rows if r[3] is not None}, key=lambda s: s.encode()) + [None]
    size = {s: sum(len((r[1] or "").split()) for r in rows if r[3] == s) for s in order}
    want = dict(zip(order, goals([size[s] for s in order])))
    for s in order:
        own = [r for r in got if r.source == s]
        assert own[0].source_size == size[s]
        assert own[0].target == pytest.approx(want[s])
        assert sum(r.size for r in own) == size[s]
        assert abs(sum(r.taken for r in own) - want[s]) <= max([1, *(r.size for r in own)])
    assert all(0 <= r.copies <= 3 and r.taken == r.copies * r.size for r in got)
    again = mix(docs.repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter(
        {k: v for k, v in sum((Counter({r.doc_id: r.copies}) for r in got), Counter()).items()})
    assert mix(docs_of([])).collect() == []


def test_mix_tree_of_buckets(docs_of, monkeypatch):
    from partflow.llm import mixing as M
    monkeypatch.setattr(M, "BUCKET", 20)
    monkeypatch.setattr(M, "FAN", 4)
    rnd = random.Random(1)
    rows = [(i, "w " * rnd.randrange(1, 60), "en", rnd.choice("aab")) for i in range(2500)]
    got = M.mix(docs_of(rows)).collect()
    assert len(got) == len(rows)
    for s in "ab":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) < 60


def test_mixed_documents_of_repeated_and_null_keys(docs_of, monkeypatch):
    """Rows alike in key, or in all, over sources of their own; some of them hot."""
    from partflow.llm import mixing as M
    monkeypatch.setattr(M, "HOT", 20)
    rnd = random.Random(4)
    rows = [(rnd.choice([None, 1, i]), "w " * rnd.choice([3, 9, 40]), "en", rnd.choice("aabc"))
            for i in range(900)]
    rows += [(1, "w " * 40, "en", "c")] * 700 + [(None, None, "en", None)] * 30
    rows += [(9, "a b c", "de", "b")] * 7
    docs = docs_of(rows).repartition(3)
    plan = M.mix(docs).collect()
    out = M.mixed_documents(docs.selectExpr("*", "1 as id1", "2 as _n", "3 as row"))
    assert out.columns == [*docs.columns, "id1", "_n", "row"]
    got = Counter((r.doc_id, r.source, len((r.text or "").split())) for r in out.collect())
    want = Counter()
    for r in plan:
        want[r.doc_id, r.source, r.size] += r.copies
    assert got == +want
    for s in {r.source for r in plan}:
        own = [r for r in plan if r.source == s]
        words = sum(n * size for (_, x, size), n in got.items() if x == s)
        assert abs(words - own[0].target) <= 40
        assert all(r.copies in (int(r.target / r.source_size), int(r.target / r.source_size) + 1)
                   for r in own if r.source_size)


def test_settle_keeps_mass_and_expectation():
    from partflow.llm.mixing import settle
    size = sorted([900, 300, 120, 80, 50, 30, 20, 11, 10, 10, 5, 3, 2, 1], reverse=True)
    for share in (0.02, 0.37, 0.5, 0.93):
        mean = np.zeros(len(size))
        for seed in range(4000):
            part = [share] * len(size)
            settle(part, size, random.Random(seed))
            mass = sum(p * n for p, n in zip(part, size))
            assert mass == pytest.approx(share * sum(size))
            assert sum(1e-9 < p < 1 - 1e-9 for p in part) <= 1
            mean += part
        assert np.allclose(mean / 4000, share, atol=0.04)
