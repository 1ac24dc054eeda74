"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

1. Each map task splits its texts into pre-tokens. The texts of a task form blocks; a
   block keeps its distinct words and, as positions, the sequence of word numbers. Only the
   distinct words of a block travel on, so a word costs one entry per block however often it
   occurs, and no hot word exists. They are packed by word hash, one row per (block, bucket).
2. Rows meet by bucket, so that a word is in one bucket only and is encoded once; its ids go
   back to the blocks that hold it, in the order in which the block sent its words.
3. Words' ids join their block's sequence and the documents are reassembled by position.
   Decoding looks the ids up in the token-byte table (bounded by the vocabulary).

Null texts count as empty: no tokens, and the digests of the empty string. Repeated rows
each get their row; a null key stays null. Columns beside key and text aren't read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import parallelism, store, text_of, texts

#: Texts whose characters all lie below this code point take Python's own regular
#: expressions, with the pattern's letter and number classes written out by rule.
LATIN = 0x250


def _classes() -> tuple[str, str, str]:
    letters, numbers = [], []
    for c in map(chr, range(LATIN)):
        kind = unicodedata.category(c)[0]
        (letters if kind == "L" else numbers if kind == "N" else []).append(c)
    return "".join(letters), "".join(numbers), "\t-\r \x85\xa0"


def splitter(pattern: str):
    """text -> its pre-tokens by ``pattern``."""
    import regex
    full = regex.compile(pattern)
    letters, numbers, spaces = _classes()
    own = re.compile(pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
                     .replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
                     .replace(r"\S", f"[^{spaces}]").replace(r"\s", f"[{spaces}]"))
    other = re.compile(f"[^\\x00-{chr(LATIN - 1)}]")

    def split(text: str) -> list[str]:
        return (full if other.search(text) else own).findall(text)
    return split


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def pack(a: np.ndarray) -> bytes:
    """Whole numbers below 2^32 by byte planes, compressed."""
    import zstandard
    planes = np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack(b: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def pack_ranks(a: np.ndarray) -> bytes:
    """Frequency ranks: one byte each, the rarer ones (255 and on) go on in byte planes."""
    import zstandard
    small = zstandard.ZstdCompressor(level=3).compress(
        np.minimum(a, 255).astype(np.uint8).tobytes())
    return len(small).to_bytes(8, "little") + small + pack(a[a >= 255] - 255)


def unpack_ranks(b: bytes) -> np.ndarray:
    import zstandard
    n = int.from_bytes(b[:8], "little")
    a = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[8:8 + n]),
                      np.uint8).astype(np.uint32)
    a[a == 255] += unpack(b[8 + n:])
    return a


def _blob(words: list[bytes]) -> tuple[bytes, bytes]:
    """Sorted words, each without the prefix it shares with the one before."""
    import zstandard
    rest, shared, last = [], bytearray(), b""
    for w in words:
        n, most = 0, min(len(w), len(last), 255)
        while n < most and w[n] == last[n]:
            n += 1
        shared.append(n)
        rest.append(w[n:])
        last = w
    return (zstandard.ZstdCompressor(level=3).compress(bytes(shared) + b"".join(rest)),
            pack(np.fromiter(map(len, rest), np.uint32, len(rest))))


def _pieces(data: bytes, sizes: bytes) -> list[bytes]:
    import zstandard
    raw, n = zstandard.ZstdDecompressor().decompress(data), unpack(sizes)
    ends = (np.cumsum(n, dtype=np.int64) + len(n)).tolist()
    out, last = [], b""
    for shared, a, e in zip(raw, [len(n), *ends], ends):
        last = last[:shared] + raw[a:e]
        out.append(last)
    return out


PACKED = ("block string, bucket int, words binary, sizes binary, places binary, "
          "keys binary, nulls binary, lens binary, seq binary")
_PACKED = pa.schema([("block", pa.string()), ("bucket", pa.int32()),
                     *((x, pa.binary()) for x in ("words", "sizes", "places", "keys",
                                                   "nulls", "lens", "seq"))])


def block_rows(pattern: str, buckets: int, block_chars: int):
    """Map side: per block one row with the documents' keys and word sequences (bucket -1)
    and one row per bucket with the block's distinct words."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        split, task, number = splitter(pattern), TaskContext.get().partitionId(), 0
        seen: dict[str, int] = {}
        keys, lens, seq, size = [], [], [], 0

        def flush():
            nonlocal number, seen, keys, lens, seq, size
            block = f"{task}-{number}"
            flat = np.concatenate(seq) if seq else np.zeros(0, np.uint32)
            # Words are numbered anew by frequency, the commonest first.
            by = np.argsort(-np.bincount(flat, minlength=len(seen)), kind="stable")
            rank = np.empty(len(by), np.uint32)
            rank[by] = np.arange(len(by), dtype=np.uint32)
            words = list(seen)
            raw = [words[i].encode() for i in by.tolist()]
            at = np.fromiter((zlib.crc32(w) % buckets for w in raw), np.int64, len(raw))
            order = np.argsort(at, kind="stable")
            starts = np.searchsorted(at[order], np.arange(buckets + 1))
            mine = [sorted(order[starts[b]:starts[b + 1]].tolist(), key=raw.__getitem__)
                    for b in range(buckets)]
            yield [block, -1, None, None, pack(np.array([i for x in mine for i in x])),
                   np.array([k or 0 for k in keys], "<i8").tobytes(),
                   np.array([k is None for k in keys], np.uint8).tobytes(),
                   pack(np.array(lens, np.uint32)),
                   pack_ranks(rank[flat])]
            for b, x in enumerate(mine):
                if x:
                    yield [block, b, *_blob([raw[i] for i in x]), None, None, None, None, None]
            number += 1
            seen, keys, lens, seq, size = {}, [], [], [], 0

        def batch(rs):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rs), _PACKED.types)], schema=_PACKED)

        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), texts(b.column(1))):
                put = seen.setdefault
                words = split(t)
                keys.append(k)
                lens.append(len(words))
                seq.append(np.array([put(w, len(seen)) for w in words], np.uint32))
                size += len(t)
                if size >= block_chars:
                    yield batch(list(flush()))
        if keys:
            yield batch(list(flush()))
    return rows


def encode_words(path: str, pattern: str):
    """Encode every distinct word of a bucket once. Rows arrive sorted by bucket."""
    out = pa.schema([("block", pa.string()), ("bucket", pa.int32()), ("ids", pa.binary()),
                     ("counts", pa.binary())])

    def rows(batches):
        import tiktoken
        ranks = load_ranks(path)
        enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                special_tokens={})
        known: dict[bytes, list[int]] = {}
        bucket = None
        for b in batches:
            got = []
            for r in b.to_pylist():
                if r["bucket"] != bucket:
                    known, bucket = {}, r["bucket"]
                ids = []
                for w in _pieces(r["words"], r["sizes"]):
                    x = known.get(w)
                    if x is None:
                        one = ranks.get(w)
                        x = known[w] = [one] if one is not None else enc.encode_ordinary(w.decode())
                    ids.append(x)
                got.append([r["block"], r["bucket"],
                            pack(np.array([i for x in ids for i in x], np.uint32)),
                            pack(np.fromiter(map(len, ids), np.uint32, len(ids)))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*got), out.types)], schema=out)
    return rows


def reassemble(path: str, keep_ids: bool):
    """Blocks arrive whole and in order: first the words' ids, then the sequence."""
    fields = [("k", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
              ("decoded_sha256", pa.string())]
    out = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if keep_ids else []))

    def batch(got):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*got), out.types)], schema=out)

    def rows(batches):
        table = {v: k for k, v in load_ranks(path).items()}
        block, parts = None, []
        for b in batches:
            for r in b.to_pylist():
                if r["block"] != block:
                    block, parts = r["block"], []
                if r["seq"] is None:
                    parts.append((r["ids"], r["counts"]))
                    continue
                # The words' numbers, in order of buckets and of words within them.
                places = unpack(r["places"]).tolist()
                n = len(places)
                ids_of: list[list[int]] = [[]] * n
                at = iter(places)
                for i, c in parts:
                    ids, ends = unpack(i).tolist(), np.cumsum(unpack(c), dtype=np.int64).tolist()
                    for a, e in zip([0, *ends], ends):
                        ids_of[next(at)] = ids[a:e]
                parts = []
                said = [b" ".join([b"%d" % x for x in y]) for y in ids_of]
                raw = [b"".join([table[x] for x in y]) for y in ids_of]
                count = np.fromiter(map(len, ids_of), np.int64, n)
                seq = unpack_ranks(r["seq"])
                keys = np.frombuffer(r["keys"], "<i8").tolist()
                nulls = np.frombuffer(r["nulls"], np.uint8).tolist()
                ends = np.cumsum(unpack(r["lens"]), dtype=np.int64).tolist()
                got = []
                for k, null, a, e in zip(keys, nulls, [0, *ends], ends):
                    at = seq[a:e]
                    own = at.tolist()
                    got.append([None if null else k, int(count[at].sum()) if own else 0,
                                hashlib.sha256(b" ".join([said[i] for i in own])).hexdigest(),
                                hashlib.sha256(b"".join([raw[i] for i in own])).hexdigest(),
                                *([[x for i in own for x in ids_of[i]]] if keep_ids else [])])
                    if len(got) == 200:
                        yield batch(got)
                        got = []
                if got:
                    yield batch(got)
    return rows


def encode_corpus(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id",
                  text: str = "text", keep_ids: bool = False,
                  block_chars: int = 32_000_000) -> DataFrame:
    """One row per row of ``docs``: key, n_tokens, the digests of its ids and of the decoded
    bytes, and with ``keep_ids`` the ids themselves. ``block_chars`` bounds what one block
    holds in a task's memory."""
    spark = docs.sparkSession
    n = parallelism(spark)
    kind = docs.schema[key].dataType.simpleString()
    rows = store(docs.select(F.col(key).cast("bigint").alias("k"), text_of(text).alias("t"))
                 .mapInArrow(block_rows(pattern, n, block_chars), PACKED), "bpe-blocks")
    words = (rows.where("bucket >= 0").select("block", "bucket", "words", "sizes")
             .repartition(n, "bucket").sortWithinPartitions("bucket")
             .mapInArrow(encode_words(ranks, pattern),
                         "block string, bucket int, ids binary, counts binary"))
    own = ("places", "keys", "nulls", "lens", "seq")
    none = [F.lit(None).cast("binary").alias(x) for x in own]
    empty = [F.lit(None).cast("binary").alias(x) for x in ("ids", "counts")]
    both = words.select("*", *none, F.lit(0).alias("last")).unionByName(
        rows.where("bucket < 0").select("block", "bucket", *empty, *own,
                                        F.lit(1).alias("last")))
    out = (both.repartition(n, "block").sortWithinPartitions("block", "last", "bucket")
           .mapInArrow(reassemble(ranks, keep_ids),
                       "k bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
                       + (", ids array<int>" if keep_ids else "")))
    return out.select(F.col("k").cast(kind).alias(key), *out.columns[1:])
