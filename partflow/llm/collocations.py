"""Phrase collocations from counting quotient filters of packed word-id n-grams.

1. Texts become pieces and words; each map task keeps blocks of one language: the block's
   distinct words with their counts, dealt to buckets by hash, and the sequence of their
   numbers. Word counts are summed by Spark. Words under the least frequency can be in no
   candidate; the others get dense ids (bucket by bucket) and meet the blocks' words again by
   bucket, so a word travels once per block and no dictionary is broadcast.
2. An n-gram of ids is packed into ``n * w`` bits (``w`` bits hold every id) and sent through an
   invertible permutation (a Feistel network). The upper bits are its quotient, the rest its
   full remainder, so nothing is lost and counts are exact. A filter keeps, in sorted order,
   run lengths per quotient, remainders and counters. Each task counts its blocks in filters
   and cuts them by quotient into shards; a shard merges its sorted filters and keeps n-grams
   that reach the least frequency, undoing the permutation.
3. Pairs are counted first. A map of fixed size (``MAP_BITS``) marks the frequent ones; triples
   and quadruples with a pair that isn't marked can't reach the least frequency and aren't
   counted. A mark set by chance only costs work, so the result doesn't depend on the size.
4. Cuts, scores, containment and ranks are joins and aggregates over the n-grams that are
   frequent. The first rows of a language are chosen within salted groups first.

Null texts count as empty, a null language is ``und``; repeated rows count each time; an empty
table gives no rows. Columns beside text and language aren't read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partflow.llm.byte_bpe import pack, pack_ranks, unpack, unpack_ranks
from partflow.llm.common import parallelism, store, text_of

#: Longest phrase, bits of the map of frequent pairs (4 MB), n-grams counted at a time.
LONGEST, MAP_BITS, AT_ONCE = 4, 25, 3_000_000
#: Salted groups of a language in the choice of its first rows.
SALTS = 64

#: Piece ends become line ends, A-Z become a-z (bytes; both fixed by the contract).
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(10 if c in _ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256))
_STOP = b"."  # can't be a word: it ends pieces


def tokens(text: str) -> list[bytes]:
    """The text's words in order, with ``_STOP`` between pieces."""
    return text.encode().translate(_TABLE).replace(b"\n", b" . ").split()


BLOCKS = ("block string, lang string, bucket int, words array<string>, counts array<int>, "
          "places binary, seq binary")
_BLOCKS = pa.schema([("block", pa.string()), ("lang", pa.string()), ("bucket", pa.int32()),
                     ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())),
                     ("places", pa.binary()), ("seq", pa.binary())])


def block_rows(buckets: int, block_bytes: int):
    """Per block a row with its sequence of word numbers (bucket -1; number 0 ends a piece) and
    a row per bucket with the block's distinct words and their counts."""
    def rows(batches):
        from pyspark import TaskContext
        task, number = TaskContext.get().partitionId(), 0
        open_: dict[str, list] = {}  # lang -> [numbers of words, parts of the sequence, bytes]

        def flush(lang):
            nonlocal number
            seen, seq, _ = open_.pop(lang)
            flat = np.concatenate(seq)
            count = np.bincount(flat, minlength=len(seen))
            # The stop keeps number 0; words are numbered anew, the commonest first.
            by = np.concatenate([[0], 1 + np.argsort(-count[1:], kind="stable")]).astype(int)
            rank = np.empty(len(by), np.uint32)
            rank[by] = np.arange(len(by), dtype=np.uint32)
            words = list(seen)
            block, number = f"{task}-{number}", number + 1
            at = np.fromiter((zlib.crc32(words[i]) % buckets for i in by[1:].tolist()),
                             np.int64, len(by) - 1)
            order = np.argsort(at, kind="stable")
            starts = np.searchsorted(at[order], np.arange(buckets + 1)).tolist()
            out = [[block, lang, -1, None, None, pack((order + 1).astype(np.uint32)),
                    pack_ranks(rank[flat])]]
            for b, (a, e) in enumerate(zip(starts, starts[1:])):
                if a < e:
                    mine = by[order[a:e] + 1].tolist()
                    out.append([block, lang, b, [words[i].decode() for i in mine],
                                count[mine].tolist(), None, None])
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), _BLOCKS.types)], schema=_BLOCKS)

        size = 0
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held = open_.setdefault(lang, [{_STOP: 0}, [], 0])
                put, seen = held[0].setdefault, held[0]
                # A stop after each text: phrases don't cross documents.
                found = tokens(text)
                held[1].append(np.array([put(w, len(seen)) for w in found] + [0], np.uint32))
                held[2] += len(text)
                size += len(text)
                if size >= block_bytes:
                    largest = max(open_, key=lambda x: open_[x][2])
                    size -= open_[largest][2]
                    yield flush(largest)
        for lang in list(open_):
            yield flush(lang)
    return rows


def identify(batches):
    """Rows of a bucket: first its dictionary (word, id), then the blocks' words, which get
    their ids (0: under the least frequency)."""
    out = pa.schema([("block", pa.string()), ("bucket", pa.int32()), ("ids", pa.binary())])
    bucket, known = None, {}
    for b in batches:
        got = []
        for r in b.to_pylist():
            if r["bucket"] != bucket:
                bucket, known = r["bucket"], {}
            if r["block"] is None:
                known.setdefault(r["lang"], {})[r["words"][0]] = r["id"]
                continue
            of = known.get(r["lang"], {}).get
            got.append([r["block"], bucket, pack(np.array([of(w, 0) for w in r["words"]],
                                                         np.uint32))])
        if got:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*got), out.types)], schema=out)


def sequences(batches):
    """Blocks arrive whole: the words' ids by bucket, then the sequence, which leaves as ids
    (0: the end of a piece, or a word that is in no candidate)."""
    out = pa.schema([("block", pa.string()), ("seq", pa.binary())])
    block, parts = None, []
    for b in batches:
        for r in b.to_pylist():
            if r["block"] != block:
                block, parts = r["block"], []
            if r["seq"] is None:
                parts.append(unpack(r["ids"]))
                continue
            places = unpack(r["places"])
            ids = np.zeros(len(places) + 1, np.uint32)
            if parts:
                ids[places] = np.concatenate(parts)
            seq = ids[unpack_ranks(r["seq"])]
            keep = np.flatnonzero((seq > 0) | np.concatenate([[True], seq[:-1] > 0]))
            parts = []
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([pack(seq[keep])], pa.binary())], schema=out)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit mixing of whole numbers."""
    x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


#: Keys of the permutation's rounds.
ROUNDS = (0x51, 0xA7, 0x1C3, 0x2E9)


def permute(hi: np.ndarray, lo: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """The permutation of numbers of two halves of ``half`` bits each."""
    mask = np.uint64((1 << half) - 1)
    for k in ROUNDS:
        hi, lo = lo, hi ^ (_mix(lo, k) & mask)
    return hi, lo


def unpermute(hi: np.ndarray, lo: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << half) - 1)
    for k in reversed(ROUNDS):
        hi, lo = lo ^ (_mix(hi, k) & mask), hi
    return hi, lo


def packed(ids: list[np.ndarray], w: int) -> tuple[np.ndarray, np.ndarray]:
    """n-grams as numbers of ``n * w`` bits (``w`` even), in two halves."""
    n, w_ = len(ids), np.uint64(w)
    if n == 3:
        h = np.uint64(w // 2)
        return ((ids[0] << h) | (ids[1] >> h),
                ((ids[1] & np.uint64((1 << (w // 2)) - 1)) << w_) | ids[2])
    if n == 2:
        return ids[0], ids[1]
    return (ids[0] << w_) | ids[1], (ids[2] << w_) | ids[3]


def unpacked(hi: np.ndarray, lo: np.ndarray, n: int, w: int) -> list[np.ndarray]:
    w_, mask = np.uint64(w), np.uint64((1 << w) - 1)
    if n == 3:
        h = np.uint64(w // 2)
        return [hi >> h, ((hi & np.uint64((1 << (w // 2)) - 1)) << h) | (lo >> w_), lo & mask]
    if n == 2:
        return [hi, lo]
    return [hi >> w_, hi & mask, lo >> w_, lo & mask]


class QuotientFilter:
    """A counting quotient filter of numbers in two halves of ``half`` bits: sorted by their
    permuted value, ``hi`` and ``lo`` with ``count``. As bytes: the length of each quotient's
    run, the remainders (all bits below the quotient), the counters."""

    def __init__(self, half: int, hi=None, lo=None, count=None):
        self.half = half
        none = np.zeros(0, np.uint64)
        self.hi = none if hi is None else hi
        self.lo = none if lo is None else lo
        self.count = np.zeros(0, np.int64) if count is None else count

    @classmethod
    def of(cls, half: int, hi: np.ndarray, lo: np.ndarray, count=None) -> "QuotientFilter":
        """Sorts permuted values and adds up the counts of equal ones."""
        h = np.uint64(half)
        if 2 * half <= 64:
            key = (hi << h) | lo
            if count is None:
                key.sort()
            else:
                order = np.argsort(key, kind="stable")
                key, count = key[order], count[order]
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])
                                 if len(key) else np.zeros(0, bool))
            hi, lo = key[new] >> h, key[new] & np.uint64((1 << half) - 1)
        else:
            order = np.lexsort((lo, hi))
            hi, lo = hi[order], lo[order]
            count = None if count is None else count[order]
            new = np.flatnonzero(np.concatenate(
                [[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])])
                if len(hi) else np.zeros(0, bool))
            key, hi, lo = hi, hi[new], lo[new]
        if count is None:
            sums = np.diff(np.append(new, len(key)))
        else:
            sums = np.add.reduceat(count, new) if len(new) else count[:0]
        return cls(half, hi, lo, sums.astype(np.int64))

    @classmethod
    def merged(cls, half: int, filters: list["QuotientFilter"]) -> "QuotientFilter":
        if len(filters) == 1:
            return filters[0]
        return cls.of(half, *[np.concatenate([getattr(f, x) for f in filters])
                              for x in ("hi", "lo", "count")])

    def cut(self, bits: int) -> list[tuple[int, "QuotientFilter"]]:
        """The filter by the upper ``bits`` bits: (shard, its part), empty ones left out."""
        shard = (self.hi >> np.uint64(self.half - bits)).astype(np.int64)
        at = np.searchsorted(shard, np.arange((1 << bits) + 1)).tolist()
        return [(s, QuotientFilter(self.half, self.hi[a:e], self.lo[a:e], self.count[a:e]))
                for s, (a, e) in enumerate(zip(at, at[1:])) if a < e]

    def __len__(self) -> int:
        return len(self.hi)

    def to_bytes(self, shard: int, bits: int) -> bytes:
        import zstandard
        # About one number a quotient.
        q = min(self.half, bits + max(0, len(self).bit_length() - 1))
        rest = self.half - q
        own = (self.hi >> np.uint64(rest)).astype(np.int64) - (shard << (q - bits))
        runs = np.bincount(own, minlength=1 << (q - bits))
        planes = b"".join(_plane(x, n) for x, n in
                          ((self.hi & np.uint64((1 << rest) - 1), rest), (self.lo, self.half)))
        return b"".join([bytes([q]), *[len(x).to_bytes(8, "little") + x for x in (
            pack_ranks(runs.astype(np.uint32)), planes,
            zstandard.ZstdCompressor(level=1).compress(_varints(self.count)))]])

    @classmethod
    def from_bytes(cls, raw: bytes, half: int, shard: int, bits: int) -> "QuotientFilter":
        import zstandard
        q, at, parts = raw[0], 1, []
        for _ in range(3):
            n = int.from_bytes(raw[at:at + 8], "little")
            parts.append(raw[at + 8:at + 8 + n])
            at += 8 + n
        runs = unpack_ranks(parts[0])
        own = np.repeat(np.arange(len(runs), dtype=np.uint64), runs)
        rest, n = half - q, len(own)
        low, end = _unplane(parts[1], 0, rest, n)
        lo, _ = _unplane(parts[1], end, half, n)
        hi = ((own + np.uint64(shard << (q - bits))) << np.uint64(rest)) | low
        return cls(half, hi, lo, _whole(zstandard.ZstdDecompressor().decompress(parts[2]), n))


def _plane(x: np.ndarray, bits: int) -> bytes:
    """The lower ``bits`` bits of 64-bit numbers, in as many bytes as these take."""
    n = -(-bits // 8)
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def _unplane(raw: bytes, at: int, bits: int, n: int) -> tuple[np.ndarray, int]:
    width = -(-bits // 8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(n, width)
    return out.view("<u8").ravel().astype(np.uint64), at + n * width


def _varints(count: np.ndarray) -> bytes:
    """Counters: one byte, or 255 and eight more at the end."""
    return (np.minimum(count, 255).astype(np.uint8).tobytes()
            + count[count >= 255].astype("<i8").tobytes())


def _whole(raw: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, "<i8", -1, n) if len(raw) > n else 0
    return out


def marked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The place of a pair of ids in the map of frequent pairs."""
    return _mix((a << np.uint64(32)) | b, 0x77) >> np.uint64(64 - MAP_BITS)


FILTERS = "n int, shard int, filter binary"


def count_filters(lengths: tuple[int, ...], w: int, bits: int, map_: bytes | None):
    """Map side: counts the blocks' n-grams of the given lengths; rows (n, shard, filter)."""
    out = pa.schema([("n", pa.int32()), ("shard", pa.int32()), ("filter", pa.binary())])

    def rows(batches):
        held, size = [], 0
        on = (None if map_ is None
              else np.unpackbits(np.frombuffer(map_, np.uint8), bitorder="little"))

        def grams(n):
            got = []
            for seq in held:
                if len(seq) < n:
                    continue
                ids = [seq[i:len(seq) - n + 1 + i] for i in range(n)]
                ok = ids[0] > 0
                for x in ids[1:]:
                    ok &= x > 0
                if n > 2:
                    for x, y in zip(ids, ids[1:]):
                        at = np.flatnonzero(ok)
                        ok[at[on[marked(x[at], y[at])] == 0]] = False
                got.append([x[ok] for x in ids])
            return [np.concatenate(x) for x in zip(*got)] if got else None

        def flush():
            got = []
            for n in lengths:
                ids = grams(n)
                if ids is None or not len(ids[0]):
                    continue
                half = n * w // 2
                full = QuotientFilter.of(half, *permute(*packed(ids, w), half))
                got += [[n, s, f.to_bytes(s, bits)] for s, f in full.cut(bits)]
            held.clear()
            if got:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*got), out.types)], schema=out)

        for b in batches:
            for raw in b.column(0).to_pylist():
                held.append(unpack(raw).astype(np.uint64))
                size += len(held[-1])
                if size >= AT_ONCE:
                    size = 0
                    yield from flush()
        if held:
            yield from flush()
    return rows


GRAMS = "n int, w1 bigint, w2 bigint, w3 bigint, w4 bigint, f bigint"


def merge_filters(w: int, bits: int, least: int):
    """Merges the filters of each (n, shard), which arrive together, and undoes the permutation
    for what reaches ``least``. What waits to be merged is bounded by what is merged already."""
    out = pa.schema([("n", pa.int32()), *((f"w{i}", pa.int64()) for i in (1, 2, 3, 4)),
                     ("f", pa.int64())])

    def rows(batches):
        key, full, wait, size = None, None, [], 0

        def settle():
            nonlocal full, wait, size
            if wait:
                full = QuotientFilter.merged(key[0] * w // 2, ([full] if full else []) + wait)
            wait, size = [], 0

        def done():
            settle()
            n = key[0]
            keep = full.count >= least
            ids = unpacked(*unpermute(full.hi[keep], full.lo[keep], full.half), n, w)
            m = int(keep.sum())
            ids += [np.zeros(m, np.int64)] * (LONGEST - n)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, n, np.int32)), *[pa.array(x.astype(np.int64)) for x in ids],
                 pa.array(full.count[keep])], schema=out)

        for b in batches:
            for r in b.to_pylist():
                if (r["n"], r["shard"]) != key:
                    if key:
                        yield done()
                    key, full, wait, size = (r["n"], r["shard"]), None, [], 0
                wait.append(QuotientFilter.from_bytes(r["filter"], key[0] * w // 2,
                                                      r["shard"], bits))
                size += len(wait[-1])
                if size > max(1_000_000, len(full) if full else 0):
                    settle()
        if key:
            yield done()
    return rows


def frequent_grams(seqs: DataFrame, lengths: tuple[int, ...], w: int, least: int,
                   map_: bytes | None = None) -> DataFrame:
    """n-grams of the given lengths that occur at least ``least`` times."""
    n = parallelism(seqs.sparkSession)
    bits = min(max(n - 1, 1).bit_length(), 16, w)
    return store(seqs.select("seq").mapInArrow(count_filters(lengths, w, bits, map_), FILTERS)
                 .repartition(n, "n", "shard").sortWithinPartitions("n", "shard")
                 .mapInArrow(merge_filters(w, bits, least), GRAMS), "phrase-grams")


def pair_map(pairs: DataFrame) -> bytes:
    """The map of frequent pairs: 2^MAP_BITS bits, whatever their number. Spark sets the bits
    of each 64-bit word; the driver lays the words next to each other."""
    def places(batches):
        for b in batches:
            at = marked(*[np.asarray(b.column(i)).astype(np.uint64) for i in (0, 1)])
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> np.uint64(6)).astype(np.int64)),
                 pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))],
                names=["at", "bit"])
    words = (pairs.select("w1", "w2").mapInArrow(places, "at bigint, bit bigint")
             .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(1 << (MAP_BITS - 6), "<i8")
    out[np.asarray(words.column("at"))] = np.asarray(words.column("bits"))
    return out.tobytes()


def word_ids(counts: DataFrame, buckets: int, least: int) -> DataFrame:
    """``lang, word, f, bucket, id`` of words with ``f >= least``. Ids count from 1 and are
    dense but for the difference between buckets; words are dealt to these by hash."""
    by = Window.partitionBy("bucket").orderBy(F.desc("f"), "lang", "word")
    return (counts.where(F.col("f") >= least)
            .withColumn("bucket", (F.crc32("word") % buckets).cast("int"))
            .withColumn("id", ((F.row_number().over(by) - 1) * F.lit(buckets).cast("long")
                               + F.col("bucket") + 1)))


def id_sequences(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """``block, seq``: the blocks' sequences in ids."""
    n = parallelism(blocks.sparkSession)
    known = words.select(F.lit(None).cast("string").alias("block"), "lang", "bucket",
                         F.array("word").alias("words"), "id", F.lit(0).alias("last"))
    asked = blocks.where("bucket >= 0").select(
        "block", "lang", "bucket", "words", F.lit(None).cast("bigint").alias("id"),
        F.lit(1).alias("last"))
    ids = (known.unionByName(asked).repartition(n, "bucket")
           .sortWithinPartitions("bucket", "last")
           .mapInArrow(identify, "block string, bucket int, ids binary"))
    none = [F.lit(None).cast("binary").alias(x) for x in ("places", "seq")]
    both = ids.select("block", "bucket", "ids", *none, F.lit(0).alias("last")).unionByName(
        blocks.where("bucket < 0").select("block", "bucket", F.lit(None).cast("binary")
                                          .alias("ids"), "places", "seq", F.lit(1).alias("last")))
    return store(both.repartition(n, "block").sortWithinPartitions("block", "last", "bucket")
                 .mapInArrow(sequences, "block string, seq binary"), "phrase-seqs")




def scored(grams: DataFrame, words: DataFrame, scale: int) -> DataFrame:
    """``g`` (ids), ``a``, and of the cut that scores lowest ``score``, ``k``, ``l``, ``r``."""
    counts = (grams.select(F.slice(F.array("w1", "w2", "w3", "w4"), F.lit(1), F.col("n"))
                           .alias("g"), "f")
              .unionByName(words.select(F.array("id").alias("g"), "f")))
    cuts = (grams.select(F.slice(F.array("w1", "w2", "w3", "w4"), F.lit(1), F.col("n"))
                         .alias("g"), F.col("f").alias("a"), "n")
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
            .withColumn("first", F.slice("g", F.lit(1), F.col("k")))
            .withColumn("rest", F.slice("g", F.col("k") + 1, F.col("n") - F.col("k"))))
    both = (cuts.join(counts.select(F.col("g").alias("first"), F.col("f").alias("l")), "first")
            .join(counts.select(F.col("g").alias("rest"), F.col("f").alias("r")), "rest"))
    score = F.expr(f"(cast(a as decimal(28,0)) * {scale}) div "
                   "(cast(l as decimal(28,0)) + cast(r as decimal(28,0)))")
    low = (both.withColumn("score", score).groupBy("g", "a")
           .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    return low.select("g", "a", "cut.score", "cut.l", "cut.r")


def contained(grams: DataFrame) -> DataFrame:
    """``g``, ``most``: the highest count of a longer n-gram that holds ``g``."""
    g = F.slice(F.array("w1", "w2", "w3", "w4"), F.lit(1), F.col("n"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("n") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("n") - m + 1), lambda i: F.slice(g, i, m))))
    return (grams.where("n > 2").select("f", F.explode(inner).alias("g"))
            .groupBy("g").agg(F.max("f").alias("most")))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30,
                 most: int = 2000, scale: int = 2_000_000, inside: int = 80,
                 block_bytes: int = 8_000_000) -> DataFrame:
    """The first ``most`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    buckets = parallelism(spark)
    blocks = store(docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                               text_of(text).alias("t"))
                   .mapInArrow(block_rows(buckets, block_bytes), BLOCKS), "phrase-blocks")
    counts = store(blocks.where("bucket >= 0").select(
        "lang", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("c"))))
        .toDF("lang", "word", "c").groupBy("lang", "word").agg(F.sum("c").alias("f")),
        "phrase-counts")
    total = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = store(word_ids(counts, buckets, least), "phrase-words")
    seqs = id_sequences(blocks, words)
    top = words.agg(F.max("id")).first()[0] or 1
    w = max(8, top.bit_length() + top.bit_length() % 2)
    if w > 32:
        raise ValueError("over 2^32 frequent words")
    pairs = frequent_grams(seqs, (2,), w, least)
    longer = frequent_grams(seqs, (3, 4), w, least, pair_map(pairs))
    grams = pairs.unionByName(longer)
    kept = (scored(grams, words, scale).join(contained(grams), "g", "left")
            .where(F.col("most").isNull()
                   | (F.lit(100).cast("decimal(3,0)") * F.col("most").cast("decimal(20,0)")
                      < F.lit(inside).cast("decimal(3,0)") * F.col("a").cast("decimal(20,0)"))))
    named = (kept.select("g", "a", "l", "r", "score", F.posexplode("g").alias("at", "id"))
             .join(words.select("id", "word", "lang"), "id")
             .groupBy("g", "a", "l", "r", "score", "lang")
             .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("ws"))
             .select("lang", F.concat_ws(" ", "ws.word").alias("phrase"), "a", "l", "r", "score"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = named.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= most)
    first = some.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    return first.join(total, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
