"""SimHash near-dedup by anchor-point covering.

Fingerprints of 64 bits are linked when they differ in at most ``distance`` bits. The word
of 64 bits is cut into two halves; two linked fingerprints differ in at most
``distance // 2`` bits of one of them. On a half the anchors are the words of the covering
code "Hamming(31, 26) and one free bit": every half lies within its covering radius of 1 of
exactly one anchor, its home. A fingerprint is replicated to every anchor that is the home
of a half within ``distance // 2`` bits of its own, that is to every anchor within covering
radius plus threshold. So for each linked pair there is an anchor that is home of the one
and holds the other; fingerprints are compared per anchor, homes against all.

Only distinct fingerprints take part, so copies cost nothing. An anchor with many
fingerprints is split: its homes are dealt over several parts, and each part compares its
homes with all fingerprints of the anchor in blocks. A comparison reports a spanning forest
of what it found, never all pairs. Components then are found by contracting the links
(large star, small star), with each round written to the shared folder.

Null and empty texts have fingerprint 0, linked like any other. A null key takes part in
linking but names no component; a component without any key has a null component id.
Repeated rows each get their row.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import WORD, parallelism, store, text_of, texts

#: Fingerprints an anchor's part compares at most as homes.
PART = 4096

UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of ``text`` (see the query's contract)."""
    import xxhash
    words = _words(text.encode().translate(UPPER))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    h = np.fromiter([digest(view[a:b], seed) for a, b in
                     zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())],
                    np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 65536):
        bits = np.unpackbits(h[i:i + 65536].astype(">u8").view(np.uint8).reshape(-1, 8),
                             axis=1)
        ones += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big")


_words = re.compile(WORD.encode()).findall


def fingerprints(docs: DataFrame, key: str | Column, text: str | Column, shingle: int,
                 seed: int, **also: Column) -> DataFrame:
    """k, fp (as a signed long) and the longs ``also`` for every row."""
    names = ["k", "fp", *also]

    def rows(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle, seed) for t in texts(b.column(1))],
                          np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(fp.view(np.int64), pa.int64()), *b.columns[2:]],
                names=names)

    k = F.col(key) if isinstance(key, str) else key
    return (docs.select(k.cast("bigint").alias("k"), text_of(text).alias("t"),
                        *[c.alias(x) for x, c in also.items()])
            .mapInArrow(rows, ", ".join(f"{x} bigint" for x in names)))


# -- the covering code on 32 bits: bits 0..30 a Hamming(31, 26) word, bit 31 free ----------

def _syndromes(half: np.ndarray) -> np.ndarray:
    """The position (1..31) of the bit to flip for the nearest code word, 0 for none."""
    s = np.zeros(len(half), np.uint32)
    for bit in range(31):
        s ^= ((half >> np.uint32(bit)) & np.uint32(1)) * np.uint32(bit + 1)
    return s


def homes(half: np.ndarray) -> np.ndarray:
    """The anchor within the covering radius of each half."""
    s = _syndromes(half)
    flip = np.where(s > 0, np.uint32(1) << (np.maximum(s, 1) - np.uint32(1)), 0)
    return half ^ flip.astype(np.uint32)


def flips(radius: int) -> np.ndarray:
    """All 32-bit masks of at most ``radius`` bits."""
    masks = {0}
    for _ in range(radius):
        masks |= {m | 1 << b for m in masks for b in range(32)}
    return np.array(sorted(masks), np.uint32)


def replicas(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into ``fp``, anchor, is home) for all anchors of both halves. An anchor is
    half number << 32 | code word."""
    masks = flips(radius)
    index, anchor, home = [], [], []
    for number in range(2):
        half = (fp >> np.uint64(32 * number)).astype(np.uint32)
        near = homes((half[:, None] ^ masks[None, :]).ravel()).reshape(len(half), -1)
        own = near[:, 0]                                   # mask 0 comes first
        rest = np.sort(near, axis=1)
        new = np.ones(rest.shape, bool)
        new[:, 1:] = rest[:, 1:] != rest[:, :-1]
        at, col = np.nonzero(new)
        word = rest[at, col]
        index.append(at)
        anchor.append(word.astype(np.int64) | (number << 32))
        home.append(word == own[at])
    return np.concatenate(index), np.concatenate(anchor), np.concatenate(home)


def forest(own: np.ndarray, others: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links between ``own`` and ``others`` (which begins with ``own``) within ``distance``
    bits, as a spanning forest: each of ``own`` is compared with all others at once, and one
    link is reported for each group that it joins anew."""
    group = np.arange(len(others))
    out = []
    for i, x in enumerate(own):
        hit = np.flatnonzero(np.bitwise_count(others ^ x) <= distance)
        found, first = np.unique(group[hit], return_index=True)
        mine = group[i]
        out += [(int(x), int(others[hit[f]])) for g, f in zip(found, first) if g != mine]
        if len(found) > 1:
            to = np.arange(len(others))
            to[found] = found[0]
            group = to[group]
    return out


def links(distinct: DataFrame, distance: int) -> DataFrame:
    """a, b: linked fingerprints (signed longs) that connect what is linked."""
    n = parallelism(distinct.sparkSession)
    radius = distance // 2

    def replicate(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(fp), 4096):
                part = fp[i:i + 4096]
                at, anchor, home = replicas(part, radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(part[at].view(np.int64)), pa.array(home)],
                    names=["anchor", "fp", "home"])

    def compare(batches):
        """Rows come sorted by (anchor, part, home first); homes of one part are held, the
        others stream past them."""
        def done(own, rest):
            got = forest(np.array(own, np.uint64), np.array(own + rest, np.uint64), distance)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array([x[i] for x in got], np.uint64).view(np.int64))
                 for i in (0, 1)], names=["a", "b"])
        key, own, rest = None, [], []
        for b in batches:
            anchors, parts = b.column(0).to_pylist(), b.column(1).to_pylist()
            fps = b.column(2).to_numpy(zero_copy_only=False).view(np.uint64).tolist()
            for k, f, h in zip(zip(anchors, parts), fps, b.column(3).to_pylist()):
                if k != key:
                    if own and own + rest != own[:1]:
                        yield done(own, rest)
                    key, own, rest = k, [], []
                if h:
                    own.append(f)
                elif own:
                    rest.append(f)
                    if len(rest) >= 1 << 18:
                        yield done(own, rest)
                        rest = []
        if own and own + rest != own[:1]:
            yield done(own, rest)

    rows = store(distinct.select("fp").mapInArrow(
        replicate, "anchor bigint, fp bigint, home boolean"), "simhash-anchors")
    # Anchors with no home or only one fingerprint compare nothing.
    sizes = (rows.groupBy("anchor")
             .agg(F.count("*").alias("n"), F.sum(F.col("home").cast("int")).alias("homes"))
             .where("n > 1 and homes > 0")
             .select("anchor", F.ceil(F.col("homes") / PART).cast("int").alias("parts")))
    dealt = rows.join(sizes, "anchor")
    # A home row also is an "other" for the homes of the other parts.
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = dealt.select(
        "anchor", "fp", "home", own.alias("own"),
        F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0)))
                  .otherwise(F.sequence(F.lit(0), F.col("parts") - 1))).alias("part"))
    dealt = dealt.select("anchor", "part", "fp",
                         (F.col("home") & (F.col("own") == F.col("part"))).alias("home"))
    return (dealt.repartition(n, "anchor", "part")
            .sortWithinPartitions("anchor", "part", F.desc("home"))
            .mapInArrow(compare, "a bigint, b bigint"))


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of every node on an edge but the roots
    themselves, by rounds of large star and small star until nothing changes. Each round is
    written and reread."""
    now = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                             F.least("a", "b").alias("b")).distinct(),
                "cc-links")
    while True:
        # Large star: a node's larger neighbours take its smallest neighbour.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(least, "a").where("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = store(large, "cc-large")
        # Small star: a node and its smaller neighbours take the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = store(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .unionByName(least.select("a", F.col("m").alias("b"))).distinct(),
                      "cc-small")
        changed = (now.exceptAll(small).limit(1).count()
                   or small.exceptAll(now).limit(1).count())
        now = small
        if not changed:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    shingle: int = 3, distance: int = 3, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: key, fingerprint, component_id."""
    kind = docs.schema[key].dataType.simpleString()
    fps = store(fingerprints(docs, key, text, shingle, seed), "simhash-fp")
    distinct = store(fps.groupBy("fp").agg(F.min("k").alias("k")), "simhash-distinct")
    found = components(links(distinct, distance))
    # The smallest key of a component, over its distinct fingerprints.
    member = distinct.join(found, distinct.fp == found.node, "left").select(
        "fp", "k", F.coalesce("root", "fp").alias("root"))
    root = member.groupBy("root").agg(F.min("k").alias("component_id"))
    named = member.select("fp", "root").join(root, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        F.col("k").cast(kind).alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component_id").cast(kind).alias("component_id"))


def first_of_each(docs: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """``docs`` without all but the document with the smallest key of each component. Where
    several rows carry that key, one of them stays; rows with a null key, which name no
    document, all stay."""
    kept = (near_duplicates(docs, key, **how).where(F.col(key) == F.col("component_id"))
            .select(key).distinct())
    return (docs.where(F.col(key).isNotNull()).join(kept, key, "left_semi")
            .dropDuplicates([key]).unionByName(docs.where(F.col(key).isNull())))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                distance: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each component, whatever keys its rows carry: the one with
    the smallest key, a null key last. Of rows alike in key the smallest digest stays, so
    only rows alike in every column are left to chance."""
    row = [x for c in docs.columns for x in (F.col(c).isNull(), F.col(c))]
    rows = store(docs.select(F.struct(*docs.columns).alias("own"),
                             F.xxhash64(*row).alias("digest"),
                             F.monotonically_increasing_id().alias("row")), "simhash-rows")
    own = F.col("own")
    fps = store(fingerprints(rows, own[key], own[text], shingle, seed,
                             digest=F.col("digest"), row=F.col("row")), "simhash-fp")
    # The row that stays of each fingerprint, then of each component; both sums meet
    # map-side first, so a group of copies is no one task's work.
    first = F.min(F.struct(F.col("k").isNull().alias("none"), "k", "digest", "row"))
    distinct = store(fps.groupBy("fp").agg(first.alias("p")), "simhash-distinct")
    found = components(links(distinct, distance))
    kept = (distinct.join(found, distinct.fp == found.node, "left")
            .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("p").alias("p"))
            .select(F.col("p.row").alias("row")))
    return rows.join(kept, "row", "left_semi").select("own.*")
