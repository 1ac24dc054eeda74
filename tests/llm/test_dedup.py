"""SimHash near-dedup and substring dedup against brute force."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from odd import ODD


def simhash(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, distance):
    group = list(range(len(fps)))
    for i, a in enumerate(fps):
        for j, b in enumerate(fps[:i]):
            if bin(a ^ b).count("1") <= distance and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def near_copies(seed, n):
    rnd = random.Random(seed)
    base = [[f"w{rnd.randrange(400)}" for _ in range(120)] for _ in range(6)]
    out = []
    for _ in range(n):
        words = list(rnd.choice(base))
        for _ in range(rnd.randrange(3)):
            words[rnd.randrange(120)] = f"v{rnd.randrange(9)}"
        out.append(" ".join(words))
    return out


def test_near_duplicates(docs_of):
    from partflow.llm.simhash import near_duplicates
    texts = ODD + near_copies(1, 120)
    got = {r.doc_id: r for r in near_duplicates(docs_of(texts).repartition(4)).collect()}
    fps = [simhash(t) for t in texts]
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{x:016x}" for x in fps]
    group = components(fps, 3)
    assert [got[i].component_id for i in range(len(texts))] == [group.index(g) for g in group]
    assert len(set(group)) < len(group) - 50


def test_covering_finds_every_close_pair():
    from partflow.llm.simhash import replicas
    rnd = np.random.default_rng(5)
    a = rnd.integers(0, 1 << 63, 400, np.uint64) * np.uint64(2) + np.uint64(1)
    b = a.copy()
    for i in range(len(b)):
        for bit in rnd.choice(64, i % 4, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    i, anchor, home = replicas(a, 1)
    j, other, _ = replicas(b, 1)
    own = {(x, y) for x, y, h in zip(i.tolist(), anchor.tolist(), home) if h}
    held = set(zip(j.tolist(), other.tolist()))
    assert {x for x, _ in own & held} == set(range(len(a)))


def test_links_are_a_chain_and_parts_split(spark, docs_of, monkeypatch):
    """A long chain of fingerprints (each 3 bits from the next) is one component; an anchor
    with more homes than a part holds is split."""
    from partflow.llm import simhash as S
    monkeypatch.setattr(S, "PART", 4)
    rnd = random.Random(2)
    chain, x = [], 0
    for _ in range(60):
        for bit in rnd.sample(range(64), 3):
            x ^= 1 << bit
        chain.append(x)
    dense = [0xABCD << 40 | i for i in range(64)]
    fps = list(dict.fromkeys(chain + dense))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    found = {r.node: r.root for r in S.components(S.links(df, 3)).collect()}
    group = components(fps, 3)
    want = {}
    for s, g in zip(signed, group):
        want.setdefault(g, []).append(s)
    for members in want.values():
        if len(members) > 1:
            assert {found.get(m, m) for m in members} == {min(members)}
        else:
            assert members[0] not in found


def test_near_duplicates_null_keys_and_first_of_each(docs_of):
    from partflow.llm.simhash import first_of_each, near_duplicates
    t = "some words that make a text of a certain length to hash"
    rows = [(9, t, "en", "a"), (4, t, "en", "b"), (4, t, "en", "b"), (None, t, "en", "a"),
            (7, "quite another text with other words in it altogether", "en", "a"),
            (None, "third text that stands alone and has no key either way", "en", "a")]
    got = sorted(((r.doc_id, r.component_id) for r in near_duplicates(docs_of(rows)).collect()),
                 key=str)
    assert got == sorted([(9, 4), (4, 4), (4, 4), (None, 4), (7, 7), (None, None)], key=str)
    kept = first_of_each(docs_of(rows)).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["4", "7", "None", "None"]
    assert near_duplicates(docs_of([])).collect() == []


def test_one_of_each_goes_by_text_not_by_key(spark, docs_of):
    import corpus_pipeline
    rnd = random.Random(4)
    apart = [" ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(60)) for _ in range(40)]
    rows = [(5, t, "en", "a") for t in apart[:20]]               # one id, many texts
    rows += [(None, t, "en", "a") for t in apart[20:30]] * 3     # null ids, repeated
    rows += [(None, apart[0], "en", "b"), (3, apart[1], None, "a"), (3, apart[1], "a", None)]
    rows += [(None, apart[30], "en", "a"), (8, apart[30], "en", "a"), (6, apart[30], "en", "a")]
    rows += [(5, apart[31], "en", "a")] * 4

    def kept(n):
        docs = docs_of(rnd.sample(rows, len(rows))).repartition(n)
        return corpus_pipeline.dedup_stage(spark, docs, "").collect()
    got = kept(4)
    want = {t: 5 for t in (*apart[:20], apart[31])} | {t: None for t in apart[20:30]}
    want |= {apart[1]: 3, apart[30]: 6}
    assert len(got) == len(want) and {r.text: r.doc_id for r in got} == want
    assert sorted(map(str, kept(3))) == sorted(map(str, got))
    assert corpus_pipeline.dedup_stage(spark, docs_of([]), "").collect() == []


def removed_bytes(rows, length):
    """rows: (key, text) with unique keys -> {key: (bytes, removed, spans, digest)}."""
    seen, out = set(), {}
    for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        cover, until = bytearray(len(b)), -1
        for i in range(len(b)):
            if i + length <= len(b):
                w = b[i:i + length]
                if w in seen:
                    until = i + length
                seen.add(w)
            cover[i] = i < until
        left = bytes(x for x, c in zip(b, cover) if not c)
        spans = sum(1 for i, c in enumerate(cover) if c and not (i and cover[i - 1]))
        out[k] = (len(b), sum(cover), spans, hashlib.sha256(left).hexdigest())
    return out


def check_substrings(docs_of, rows, **how):
    from partflow.llm.substrings import repeated_substrings
    df = docs_of([(k, t, "en", "a") for k, t in rows]).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in repeated_substrings(df, **how).collect()}
    assert got == removed_bytes(rows, how.get("length", 100))


def passages(seed, n):
    rnd = random.Random(seed)
    stock = ["".join(rnd.choice("abcdefgh éß\n") for _ in range(rnd.randrange(60, 400)))
             for _ in range(8)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randrange(1, 5)):
            x = rnd.choice(stock)
            a = rnd.randrange(len(x) // 2)
            parts.append(x[a:a + rnd.randrange(20, 400)])
            parts.append("".join(rnd.choice("xyz") for _ in range(rnd.randrange(40))))
        out.append("".join(parts))
    return out


def test_substrings(docs_of):
    texts = ODD + ["ab" * 300, "abc" * 200, "a" * 99, "a" * 100, "a" * 101] + passages(1, 80)
    check_substrings(docs_of, list(enumerate(texts)))


def test_substrings_null_key_and_order(docs_of):
    p = "".join(chr(97 + i * 7 % 26) for i in range(150)) + "tail"
    check_substrings(docs_of, [(5, "one " + p), (None, "two " + p), (2, p + " three"), (-3, p)])
    check_substrings(docs_of, [])


def test_substrings_small_chunks(docs_of, monkeypatch):
    """Texts longer than a piece, pointers merged often, wide buckets."""
    from partflow.llm import substrings as S
    monkeypatch.setattr(S, "CHUNK", 64)
    monkeypatch.setattr(S, "POINTERS", 50)
    monkeypatch.setattr(S, "WIDE", 3)
    monkeypatch.setattr(S, "WINDOWS", 200)
    texts = passages(3, 12) + ["".join(passages(4, 6))] * 2
    check_substrings(docs_of, list(enumerate(texts)))
    monkeypatch.undo()
    big = "".join(random.Random(7).choice("abcdefghij ") for _ in range(70_000))
    check_substrings(docs_of, [(1, big), (2, "x" + big)])


def test_substrings_keep_text(docs_of):
    from partflow.llm.substrings import repeated_substrings
    t = "".join(chr(97 + i * 11 % 26) for i in range(26)) * 5
    got = {r.doc_id: bytes(r.kept) for r in repeated_substrings(
        docs_of([t + "x", "y" + t + "z", "short"]), length=100, keep_text=True).collect()}
    assert got[1] == b"yz" and got[2] == b"short" and got[0].startswith(t[:26].encode())


def test_substrings_repeated_rows(docs_of):
    from partflow.llm.substrings import repeated_substrings
    t = "".join(chr(97 + i * 11 % 26) for i in range(300))
    rows = [(1, t, "en", "a"), (1, t, "en", "a"), (2, t, "en", "a")]
    got = sorted((r.doc_id, r.n_removed) for r in repeated_substrings(docs_of(rows)).collect())
    # A row alike in key and text is the same document.
    one = removed_bytes([(1, t), (2, t)], 100)
    assert got == [(1, one[1][1]), (1, one[1][1]), (2, one[2][1])]


def test_substrings_places_travel_small():
    """A pointer's document costs few bytes where keys are unique; any digest and key comes back."""
    import numpy as np
    from partflow.llm import substrings as S
    n = np.arange(4000)
    zero = np.zeros(len(n), np.int64)
    places = (n * 3 + (1 << 40), zero, zero, n % 500, n % 60)
    packed = S._pack_places(*places)
    assert sum(map(len, packed)) < 8 * len(n)
    for x, y in zip(S._unpack_places(packed), places):
        assert (x == y).all()
    odd = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, (3, 4000))
    odd[0, :5] = -(1 << 63)
    for x, y in zip(S._unpack_places(S._pack_places(*odd, n, n)), (*odd, n, n)):
        assert (x == y).all()


def test_substrings_store_no_text(docs_of, monkeypatch):
    from partflow.llm import substrings as S
    stored, store = [], S.store

    def seen(df, name):
        stored.append(df.schema.simpleString())
        return store(df, name)
    monkeypatch.setattr(S, "store", seen)
    check_substrings(docs_of, list(enumerate(passages(5, 30))))
    assert stored and not any("binary" in x or "string" in x for x in stored)


@pytest.mark.parametrize("few", [0, 100])
def test_substrings_digests_of_repeated_keys(docs_of, monkeypatch, few):
    """Only keys of several rows carry digests, all keys where those are many."""
    from partflow.llm import substrings as S
    monkeypatch.setattr(S, "FEW_KEYS", few)
    p = "".join(random.Random(2).choices("abcdefgh", k=150))
    df = docs_of([(k, t, "en", "a") for k, t in
                  ((None, "0" + p), (-(1 << 63), "1" + p), (4, "2" + p), (7, "3" + p),
                   (7, "4" + p), (9, None))])
    rows = {bytes(r.t): (r.mark != 0, r.more != 0) for r in S.named(df, "doc_id", "text").collect()}
    assert rows[b"0" + p.encode()] == rows[b"3" + p.encode()] == (True, True)
    assert rows[b"2" + p.encode()] == ((False, False) if few else (True, True))
    got = sorted(r.n_removed for r in S.repeated_substrings(df).collect())
    assert got == [0, 0, 150, 150, 150, 150]


@pytest.mark.parametrize("key", [None, 5])
def test_substrings_many_texts_under_one_key(docs_of, key):
    """Pairs of texts share a passage: one of each pair loses it, and no other byte goes."""
    from partflow.llm.substrings import repeated_substrings
    rnd = random.Random(9)

    def some(k):
        return "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=k))
    pairs = []
    for i in range(1500):
        shared, own = some(120 + i % 60), [some(100 + i % 90), some(100 + i % 70)]
        pairs.append([(a + x + shared + y, a + x + y) for a, x, y in zip(own, "01", "23")])
    rows = [(key, whole, "en", "a") for pair in pairs for whole, _ in pair]
    rows += [(9, t, "en", "a") for _, t, *_ in rows[:1]]
    got = Counter(bytes(r.kept).decode() for r in repeated_substrings(
        docs_of(rows).repartition(4), keep_text=True).collect())
    assert got.pop("") == 1                                # the repeat under another key
    assert sum(got.values()) == 2 * len(pairs)
    for (a, a_cut), (b, b_cut) in pairs:
        assert (got[a], got[a_cut], got[b], got[b_cut]) in ((1, 0, 0, 1), (0, 1, 1, 0))
