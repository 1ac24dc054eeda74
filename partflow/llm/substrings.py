"""Exact-substring dedup by bucket-pointer refinement.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier (smaller
key, or same document and earlier start). Bucket identifiers of 1, 2, 4, ... bytes are
built by doubling: the identifier of a position is refined by that of a later offset, and
each level is reused by the next, up to ``length`` bytes.

Sorting every position would move many times the corpus. Instead a position stands for the
windows around it:

1. The initial buckets hold q-grams of ``Q`` bytes. In each window of ``length`` bytes the
   leftmost smallest q-gram is its anchor, a choice that depends on the window's bytes alone.
   So equal windows have anchors in the same bucket, and only anchors (about one position in
   35) are pointers in buckets. Neighbouring windows with the same anchor form a run.
2. Buckets are refined by the identifiers of later offsets that complete the run. Pointers
   still in one bucket have equal runs: all but the first are covered. A bucket with one
   pointer, or with equal runs only, is settled.
3. The first pointers of the buckets that step 2 split are refined once more, window by
   window, by the identifiers (128 bits) of whole windows; whatever has an earlier equal
   window is covered. The bytes of a run meet by bucket; buckets of more than ``WIDE`` runs
   are dealt out by window instead, packed as pointers are, so that none is one task's work.

Equal runs of one map task meet there already, so a group of copies costs one pointer per
task. Pointers travel packed, a row per task and bucket range. Covered intervals join their
documents by key at the end; texts travel compressed, once to their open runs and once to all
that covers them, and are never stored.

Null texts count as empty. Rows alike in key and text are one document: each gets that
document's result. Rows alike in key but not in text are ordered and told apart by a 128-bit
digest of the text, in two halves (``mark``, ``more``; zero where a key has one row, so that
pointers there travel without them). A null key sorts first. Repeated texts under different keys
are covered by the first.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.byte_bpe import pack, unpack
from partflow.llm.common import parallelism, store, text_of

#: Bytes of an initial bucket's q-gram (a power of two).
Q = 32
#: Bytes of text worked on at once, and pointers gathered before equal ones are merged.
CHUNK, POINTERS = 1 << 20, 1 << 20
#: What names a document: its key, null as the least long, and the halves of the digest.
DOC = ("ord", "mark", "more")
#: Runs of a bucket beyond which its windows are dealt out one by one, and windows compared
#: at once.
WIDE, WINDOWS = 2048, 1 << 18

#: Keys of several rows that are broadcast at most; beyond, all documents keep their digest.
FEW_KEYS = 100_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _table(seed: int) -> np.ndarray:
    """An identifier for each byte."""
    return np.random.default_rng(seed).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + \
        np.uint64(1)


def _refine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The identifier of a position from its own and that of a later offset."""
    x = a * _ODD
    x += b
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def identifiers(data: np.ndarray, length: int, seed: int = 1,
                also: int = 0) -> tuple[np.ndarray, np.ndarray | None]:
    """Identifiers of all strings of ``length`` bytes, by doubling; with ``also`` those of
    that power of two of bytes."""
    now, size, kept = _table(seed)[data], 1, None
    if also == 1:
        kept = now
    while size * 2 <= length:
        now = _refine(now[:-size], now[size:]) if len(now) > size else now[:0]
        size *= 2
        if size == also:
            kept = now
    if size < length:
        rest = length - size
        now = _refine(now[:-rest], now[rest:]) if len(now) > rest else now[:0]
    return now, kept


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    return np.minimum(v[:len(v) - (width - size)], v[width - size:]) if size < width else v


def runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int):
    """For the documents data[start:end], all of ``length`` bytes or more: (document number,
    first window, windows, bucket, run identifier) of every run."""
    whole, gram = identifiers(data, length, also=Q)
    at = np.arange(len(gram), dtype=np.uint64)
    low = np.uint64(24)
    anchor = _sliding_min((gram >> low << low) | at, length - Q + 1)
    anchor = (anchor & np.uint64((1 << 24) - 1)).astype(np.int64)
    inside = np.zeros(len(anchor) + 1, np.int8)
    inside[starts] += 1
    np.add.at(inside, ends - length + 1, -1)
    valid = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int32))
    p = anchor[valid]
    first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
    last = np.concatenate([first[1:], [len(p)]]) - 1
    a, b, p = valid[first], valid[last], p[first]
    shape = ((b - a) << 8 | (p - a)).astype(np.uint64)
    run = _refine(_refine(whole[a], whole[b]), shape)
    return np.searchsorted(starts, a, side="right") - 1, a, b - a + 1, gram[p], run


def _groups(texts: list[bytes], most: int):
    part, size = [], 0
    for i, t in enumerate(texts):
        if size + len(t) > most and part:
            yield part
            part, size = [], 0
        part.append(i)
        size += len(t)
    if part:
        yield part


def text_pieces(text: bytes, length: int):
    """The document in pieces that overlap so that every window lies whole in one of them. A
    run is cut in two at most; its parts are runs of their own."""
    step = CHUNK * 8
    for at in range(0, max(1, len(text) - length + 1), step):
        yield at, text[at:at + step + length - 1]


PACKED = "bucket int, kind int, data binary"
_PACKED = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])


def _bytes(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _parts(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at:at + 8], "little")
        out.append(data[at + 8:at + 8 + n])
        at += 8 + n
    return out


def _halves(v: np.ndarray) -> list[bytes]:
    """64-bit numbers, packed by halves."""
    return [pack(v >> np.uint64(32)), pack(v & np.uint64(0xFFFFFFFF))]


def _joined(high: bytes, low: bytes) -> np.ndarray:
    return (unpack(high).astype(np.uint64) << np.uint64(32)) | unpack(low)


def _pack_places(ord_, mark, more, start, size) -> list[bytes]:
    """Documents as a table, keys by their differences, and each row's number in it."""
    doc = np.stack([ord_, mark, more], axis=1)
    table, number = np.unique(doc, axis=0, return_inverse=True)
    key, *digest = np.ascontiguousarray(table.T).view(np.uint64)
    key = np.concatenate([key[:1], key[1:] - key[:-1]])
    return [*(h for v in (key, *digest) for h in _halves(v)), pack(number.ravel()),
            pack(start), pack(size)]


def _unpack_places(parts: list[bytes]) -> tuple[np.ndarray, ...]:
    key, mark, more = (_joined(*parts[i:i + 2]) for i in (0, 2, 4))
    number, start, size = (unpack(x).astype(np.int64) for x in parts[6:])
    return (*(v.view(np.int64)[number] for v in (np.cumsum(key, dtype=np.uint64), mark, more)),
            start, size)


def _first_of(keys: list[np.ndarray], pointer: list[np.ndarray]):
    """Rows in order of keys and pointer; group numbers; whether a row's pointer is the least
    of its group (equal pointers are one place)."""
    order = np.lexsort([*reversed(pointer), *reversed(keys)])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    group = np.cumsum(new) - 1
    lead = order[np.flatnonzero(new)][group]
    first = np.ones(len(order), bool)
    for q in pointer:
        first &= q[order] == q[lead]
    return order, group, first


def merged(ord_, mark, more, start, end):
    """Covered [start, end) of documents, sorted and joined where they touch."""
    order = np.lexsort((start, more, mark, ord_))
    ord_, mark, more, start, end = (x[order] for x in (ord_, mark, more, start, end))
    if not len(ord_):
        return ord_, mark, more, start, end
    doc = np.concatenate([[True], (ord_[1:] != ord_[:-1]) | (mark[1:] != mark[:-1])
                          | (more[1:] != more[:-1])])
    # The furthest end so far within a document, on one axis.
    base = (np.cumsum(doc) - 1) * (1 << 33)
    far = np.maximum.accumulate(end + base)
    new = np.flatnonzero(np.concatenate([[True], (start + base)[1:] > far[:-1]]))
    last = np.concatenate([new[1:], [len(start)]]) - 1
    return ord_[new], mark[new], more[new], start[new], far[last] - base[new]


def _dealt(held: list[tuple[np.ndarray, ...]], length: int, buckets: int):
    """Packed rows of (ord, mark, more, start, windows, bucket, identifier): the first pointer of
    each (bucket, identifier) (kind 0, by bucket range), and what the others cover (kind 1)."""
    ord_, mark, more, a, size, g, c = (np.concatenate(x) for x in zip(*held))
    order, _, first = _first_of([g, c], [ord_, mark, more, a])
    keep, later = order[first], order[~first]
    to = (g[keep] >> np.uint64(40)).astype(np.int64) % buckets
    by = np.argsort(to, kind="stable")          # stays in order of g within a range
    cut = np.searchsorted(to[by], np.arange(buckets + 1))
    out = []
    for b in range(buckets):
        x = keep[by[cut[b]:cut[b + 1]]]
        if len(x):
            out.append((b, 0, _bytes(*_halves(g[x]), *_halves(c[x]), *_pack_places(
                ord_[x], mark[x], more[x], a[x], size[x]))))
    if len(later):
        got = _sizes(*merged(ord_[later], mark[later], more[later], a[later],
                             a[later] + size[later] + length - 1))
        out.append((int(got[0][0]) % buckets, 1, _bytes(*_pack_places(*got))))
    for x in range(0, len(out), 64):
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(zip(*out[x:x + 64]), _PACKED.types)],
            schema=_PACKED)


def pointers(length: int, buckets: int):
    """Map side: the first pointer of each (bucket, run) of the task (kind 0, packed by bucket
    range), and what the others cover (kind 1)."""
    def rows(batches):
        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for batch in batches:
            keys = np.array(batch.column(0).to_pylist(), np.int64)
            marks = np.array(batch.column(1).to_pylist(), np.int64)
            mores = np.array(batch.column(2).to_pylist(), np.int64)
            data = [x or b"" for x in batch.column(3).to_pylist()]
            pieces = [(i, at, x) for i, t in enumerate(data) if len(t) >= length
                      for at, x in text_pieces(t, length)]
            for group in _groups([x for _, _, x in pieces], CHUNK):
                own = [pieces[i] for i in group]
                ends = np.cumsum([len(x) for _, _, x in own])
                starts = np.concatenate([[0], ends[:-1]])
                doc, a, size, g, c = runs(np.frombuffer(b"".join(x for _, _, x in own),
                                                        np.uint8), starts, ends, length)
                i = np.array([x for x, _, _ in own])[doc]
                off = np.array([x for _, x, _ in own])[doc]
                held.append((keys[i], marks[i], mores[i], a - starts[doc] + off, size, g, c))
                n += len(a)
                if n >= POINTERS:
                    yield from _dealt(held, length, buckets)
                    held, n = [], 0
        if held:
            yield from _dealt(held, length, buckets)
    return rows


FOUND = ("ord bigint, mark bigint, more bigint, a bigint, n bigint, g bigint, "
         "wide boolean")
_FOUND = pa.schema([*((x, pa.int64()) for x in (*DOC, "a", "n", "g")), ("wide", pa.bool_())])


def _found(ord_, mark, more, a, n, g=None, wide=None):
    """Rows of covered intervals (g null) or of open runs."""
    none = [None] * len(a)
    for x in range(0, len(a), 20_000):
        y = slice(x, x + 20_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v[y], t) for v, t in zip(
                (ord_, mark, more, a, n, none if g is None else g.view(np.int64),
                 none if wide is None else wide), _FOUND.types)], schema=_FOUND)


def refine_runs(length: int, windows: bool = False):
    """Reduce side: all pointers of a bucket range. Later pointers of equal runs are covered;
    the first ones of a bucket with several runs stay open (``windows``: runs are single windows,
    nothing stays open)."""
    def rows(batches):
        bucket, held = None, []

        def flush():
            g, c = (np.concatenate([_joined(*p[i:i + 2]) for p in held]) for i in (0, 2))
            ord_, mark, more, a, size = (np.concatenate(x) for x in
                                         zip(*(_unpack_places(p[4:]) for p in held)))
            order, run, first = _first_of([g, c], [ord_, mark, more, a])
            own = g[order]
            at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            last = np.concatenate([at[1:], [len(own)]]) - 1
            count = np.repeat(run[last] - run[at] + 1, last - at + 1)
            x = order[~first]
            yield from _found(*_sizes(*merged(ord_[x], mark[x], more[x], a[x],
                                              a[x] + size[x] + length - 1)))
            x = first & (count > (len(count) if windows else 1))
            y = order[x]
            yield from _found(ord_[y], mark[y], more[y], a[y], size[y], g[y],
                              count[x] > WIDE)

        for b in batches:
            for to, kind, data in zip(*(b.column(i).to_pylist() for i in range(3))):
                if kind == 1:
                    yield from _found(*_unpack_places(_parts(data)))
                    continue
                if to != bucket and held:
                    yield from flush()
                    held = []
                bucket = to
                held.append(_parts(data))
        if held:
            yield from flush()
    return rows


def _sizes(ord_, mark, more, start, end):
    return ord_, mark, more, start, end - start


def compressed(batches):
    """Texts compressed, with their size and digest."""
    import zstandard
    pack_text = zstandard.ZstdCompressor(level=3).compress
    out = pa.schema([*((x, pa.int64()) for x in ("k", *DOC, "n_bytes")),
                     ("kept_sha256", pa.string()), ("t", pa.binary())])
    for b in batches:
        data = [x or b"" for x in b.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:4], pa.array(map(len, data), pa.int64()),
             pa.array([hashlib.sha256(x).hexdigest() for x in data], pa.string()),
             pa.array(map(pack_text, data), pa.binary())], schema=out)


def _open_runs(batch):
    """The document (key and digest), text, open runs of each document."""
    import zstandard
    unpack_text = zstandard.ZstdDecompressor().decompress
    for *doc, t, runs_ in zip(*(batch.column(i).to_pylist() for i in range(5))):
        yield doc, unpack_text(t), sorted({(x["a"], x["n"], x["g"]) for x in runs_})


def run_bytes(length: int):
    """The bytes of open runs, to meet by bucket."""
    out = pa.schema([*((x, pa.int64()) for x in ("g", *DOC, "a", "n")), ("t", pa.binary())])

    def rows(batches):
        for b in batches:
            got = [(g, *doc, a, n, text[a:a + n + length - 1])
                   for doc, text, found in _open_runs(b) for a, n, g in found]
            for x in range(0, len(got), 20_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*got[x:x + 20_000]), out.types)],
                    schema=out)
    return rows


def refine_windows(length: int):
    """Rows come sorted by bucket: compare all windows of the runs of a bucket."""
    def rows(batches):
        held, n, bucket = [], 0, None

        def flush():
            ord_, mark, more, a, size = (np.array(x, np.int64)
                                         for x in list(zip(*held))[1:6])
            data = np.frombuffer(b"".join(x[6] for x in held), np.uint8)
            start = np.concatenate([[0], np.cumsum(size + length - 1)[:-1]])
            run = np.repeat(np.arange(len(size)), size)
            off = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
            at = start[run] + off
            keys = [identifiers(data, length, seed)[0][at] for seed in (1, 2)]
            order, _, first = _first_of(keys, [ord_[run], mark[run], more[run], a[run] + off])
            x = order[~first]
            s, y = a[run[x]] + off[x], run[x]
            return _found(*_sizes(*merged(ord_[y], mark[y], more[y], s, s + length)))

        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(7))):
                if n >= WINDOWS and r[0] != bucket:
                    yield from flush()
                    held, n = [], 0
                bucket = r[0]
                held.append(r)
                n += r[5]
        if held:
            yield from flush()
    return rows


def window_pointers(length: int, buckets: int):
    """For open runs of wide buckets: ``pointers`` to single windows, by their identifiers."""
    def rows(batches):
        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for b in batches:
            for doc, text, found in _open_runs(b):
                data = np.frombuffer(text, np.uint8)
                at = np.unique(np.concatenate([np.arange(a, a + m) for a, m, _ in found]))
                w = [identifiers(data, length, seed)[0][at] for seed in (1, 2)]
                held.append((*(np.full(len(at), d, np.int64) for d in doc), at,
                             np.ones(len(at), np.int64), *w))
                n += len(at)
                if n >= POINTERS:
                    yield from _dealt(held, length, buckets)
                    held, n = [], 0
        if held:
            yield from _dealt(held, length, buckets)
    return rows


def finish(keep_text: bool):
    """Documents that nothing covers keep their digest; the others are cut."""
    out = pa.schema([("k", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                     ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                     *([("kept", pa.binary())] if keep_text else [])])

    def rows(batches):
        import zstandard
        unpack_text = zstandard.ZstdDecompressor().decompress
        for b in batches:
            got = []
            for k, n, sha, t, sure, late in zip(*(b.column(i).to_pylist() for i in range(6))):
                if not sure and not late:
                    got.append([k, n, 0, 0, sha, *([unpack_text(t)] if keep_text else [])])
                    continue
                text = unpack_text(t)
                each = np.array([(x["a"], x["a"] + x["n"]) for x in [*(sure or ()),
                                                                     *(late or ())]],
                                np.int64).reshape(-1, 2)
                zero = np.zeros(len(each), np.int64)
                *_, a, e = merged(zero, zero, zero, each[:, 0], each[:, 1])
                a, e = a.tolist(), e.tolist()
                left = b"".join(text[x:y] for x, y in zip([0, *e], [*a, len(text)]))
                got.append([k, n, n - len(left), len(a),
                            hashlib.sha256(left).hexdigest(), *([left] if keep_text else [])])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in
                                              zip(zip(*got), out.types)], schema=out)
    return rows


def named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """k, what names the document (``DOC``) and its bytes t of every row of ``docs``."""
    data = text_of(text).cast("binary")
    rows = docs.select(F.col(key).cast("bigint").alias("k"), data.alias("t")).withColumn(
        "ord", F.coalesce("k", F.lit(-(1 << 63))))
    again = rows.groupBy("ord").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("ord")
    keys = again.limit(FEW_KEYS + 1).count()
    some = F.lit(keys > FEW_KEYS)
    if 0 < keys <= FEW_KEYS:
        rows = rows.join(F.broadcast(again.withColumn("_again", F.lit(True))), "ord", "left")
        some = F.col("_again").isNotNull()
    none = F.lit(0).cast("long")
    return rows.select("k", "ord", F.when(some, F.xxhash64("t")).otherwise(none).alias("mark"),
                       F.when(some, F.xxhash64(F.col("k").isNull(), F.col("t")))
                       .otherwise(none).alias("more"), "t")


def repeated_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text",
                        length: int = 100, keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_removed, n_spans, kept_sha256, and with
    ``keep_text`` the bytes that stay."""
    kind = docs.schema[key].dataType.simpleString()
    n = parallelism(docs.sparkSession)
    rows = named(docs, key, text)
    # Steps 1 and 2: buckets of q-grams, split by runs.
    found = (rows.select(*DOC, "t").mapInArrow(pointers(length, 4 * n), PACKED)
             .repartition(n, "bucket").sortWithinPartitions("bucket", "kind")
             .mapInArrow(refine_runs(length), FOUND))
    place = F.struct("a", "n")
    lists = found.groupBy(*DOC).agg(
        F.collect_list(F.when(F.col("g").isNull(), place)).alias("sure"),
        F.collect_list(F.when(F.col("g").isNotNull() & ~F.col("wide"),
                              F.struct("a", "n", "g"))).alias("open"),
        F.collect_list(F.when(F.col("wide"), F.struct("a", "n", "g"))).alias("spread"))
    lists = store(lists, "substring-runs")  # read by step 3 and at the end
    texts = rows.mapInArrow(compressed, "k bigint, ord bigint, mark bigint, more bigint, "
                                        "n_bytes bigint, kept_sha256 string, t binary")
    # Step 3: what step 2 left open, window by window.
    joined = texts.select(*DOC, "t").join(
        lists.where("size(open) > 0 or size(spread) > 0").select(*DOC, "open", "spread"), [*DOC])
    late = (joined.where("size(open) > 0").select(*DOC, "t", "open")
            .mapInArrow(run_bytes(length), "g bigint, ord bigint, mark bigint, more bigint, "
                                           "a bigint, n bigint, t binary")
            .repartition(n, "g").sortWithinPartitions("g")
            .mapInArrow(refine_windows(length), FOUND).select(*DOC, "a", "n"))
    spread = (joined.where("size(spread) > 0").select(*DOC, "t", "spread")
              .mapInArrow(window_pointers(length, 4 * n), PACKED)
              .repartition(n, "bucket").sortWithinPartitions("bucket", "kind")
              .mapInArrow(refine_runs(length, windows=True), FOUND).select(*DOC, "a", "n"))
    late = late.unionByName(spread).groupBy(*DOC).agg(
        F.collect_list(place).alias("late"))
    covered = lists.select(*DOC, "sure").join(late, [*DOC], "left")
    out = (texts.join(covered, [*DOC], "left")
           .select("k", "n_bytes", "kept_sha256", "t", "sure", "late")
           .mapInArrow(finish(keep_text), "k bigint, n_bytes bigint, n_removed bigint, "
                                          "n_spans bigint, kept_sha256 string"
                                          + (", kept binary" if keep_text else "")))
    return out.select(F.col("k").cast(kind).alias(key), *out.columns[1:])
