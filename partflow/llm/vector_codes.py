"""Vector code compression by product quantisation with equal-average search.

Vectors become whole numbers (``floor(scale * x)``) and are cut into ``parts`` consecutive
parts, each with its own codebook. The nearest entry of a part is found by equal-average
search: entries are sorted by the sum of their components; starting from the part's own sum the
search goes outward, the entry with the nearer sum first, and stops when the squared gap of
sums, divided by the dimension, strictly exceeds the best squared distance so far (by
Cauchy-Schwarz no entry further out can be nearer, and one that ties is still looked at). All
vectors of a batch advance together. Distances are whole numbers, so results are exact; where
components are so large that 64 bits could overflow, Python integers take over (an error past
64 bits, the type of the result, is refused with an error).

Codebooks start from the vectors with the smallest keys and are refined by rounds of assignment
and componentwise floor of the mean. A task sends one partial sum per part, entry and component
(a fixed number), Spark adds them, and the driver holds the codebooks only.

Rows with a null vector or with null or non-finite components take no part. Null keys come last
in the choice of first entries; equal keys are ordered by their vectors. Empty vectors get code
0 in every part and error 0. Vectors of different lengths are refused with an error. With fewer
vectors than entries the codebooks are as short.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import store

#: Components up to this size can't overflow 64 bits in squares, sums and their products.
SAFE = 1 << 20


def whole_numbers(column: pa.Array, scale: int) -> np.ndarray:
    """Vectors of equal length as a matrix of ``floor(scale * x)``."""
    n = len(column)
    lengths = np.diff(np.asarray(column.offsets))
    if n and (lengths != lengths[0]).any():
        raise ValueError("vectors differ in length")
    width = int(lengths[0]) if n else 0
    flat = np.asarray(column.flatten(), np.float64)
    big = np.floor(flat * scale)
    if flat.size and not np.abs(big).max() < SAFE:
        from fractions import Fraction
        exact = [(Fraction(x) * scale).__floor__() for x in flat.tolist()]
        return np.array(exact, object).reshape(n, width)
    return big.astype(np.int64).reshape(n, width)


def cuts(width: int, parts: int) -> list[int]:
    return [p * width // parts for p in range(parts + 1)]


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the index of the nearest row of ``book`` (ties: the lower) and the
    squared distance, by equal-average search."""
    n, dim, size = len(x), x.shape[1], len(book)
    if not dim:
        return np.zeros(n, np.int64), np.zeros(n, x.dtype)
    sums = book.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    s, entries, own = sums[order], book[order], x.sum(axis=1)
    right = np.searchsorted(s, own)
    left = right - 1
    best = np.full(n, -1, object if x.dtype == object else np.int64)
    code = np.full(n, size, np.int64)
    live = np.arange(n)
    while len(live):
        lo, hi, mine = left[live], right[live], own[live]
        below = np.where(lo >= 0, mine - s[np.maximum(lo, 0)], -1)
        above = np.where(hi < size, s[np.minimum(hi, size - 1)] - mine, -1)
        down = (below >= 0) & ((above < 0) | (below <= above))
        gap = np.where(down, below, above)
        so_far = best[live]
        on = (gap >= 0) & ((so_far < 0) | (gap * gap <= so_far * dim))
        live, at, down = live[on], np.where(down, lo, hi)[on], down[on]
        d = x[live] - entries[at]
        dist = (d * d).sum(axis=1)
        idx, b = order[at], best[live]
        win = (b < 0) | (dist < b) | ((dist == b) & (idx < code[live]))
        best[live[win]], code[live[win]] = dist[win], idx[win]
        left[live[down]] -= 1
        right[live[~down]] += 1
    return code, best


def assign(x: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes (a column per part) and distances of whole vectors."""
    at = cuts(x.shape[1], len(books))
    if x.shape[1] != sum(b.shape[1] for b in books):
        raise ValueError("vectors differ in length")
    found = [nearest(x[:, a:b], book) for a, b, book in zip(at, at[1:], books)]
    return (np.stack([c for c, _ in found], axis=1),
            np.stack([d for _, d in found], axis=1))


def gathered(batches, most: int = 16_000):
    """The batches in fewer, longer ones: the search runs once per batch and step."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


PARTIAL = "part int, entry int, at int, total decimal(38,0), rows bigint"


def partial_sums(books: list[np.ndarray], scale: int):
    """Per task, sums and counts of every part's entry: at most one row per component of the
    codebooks."""
    def rows(batches):
        total: dict = {}
        for b in gathered(batches):
            x = whole_numbers(b.column(0), scale)
            codes, _ = assign(x, books)
            at = cuts(x.shape[1], len(books))
            for p, (a, e) in enumerate(zip(at, at[1:])):
                order = np.argsort(codes[:, p], kind="stable")
                held, starts, counts = np.unique(codes[order, p], return_index=True,
                                                 return_counts=True)
                sums = np.add.reduceat(x[order, a:e], starts, axis=0)
                for j, n, row in zip(held.tolist(), counts.tolist(), sums.tolist()):
                    for i, y in enumerate(row):
                        old = total.get((p, j, i), (0, 0))
                        total[p, j, i] = (old[0] + y, old[1] + n)
        if total:
            from decimal import Decimal
            cols = list(zip(*[(*k, Decimal(v[0]), v[1]) for k, v in total.items()]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(),
                                                       pa.decimal128(38, 0), pa.int64()))],
                names=["part", "entry", "at", "total", "rows"])
    return rows


def first_books(kept: DataFrame, parts: int, entries: int, scale: int) -> list[np.ndarray]:
    """The codebooks of the vectors with the smallest keys: at most ``entries`` rows."""
    rows = kept.orderBy(F.col("k").asc_nulls_last(), "v").limit(entries).toArrow()
    if not rows.num_rows:
        return [np.zeros((0, 0), np.int64)] * parts
    x = whole_numbers(rows.column("v").combine_chunks(), scale)
    at = cuts(x.shape[1], parts)
    return [x[:, a:b].copy() for a, b in zip(at, at[1:])]


def refined(kept: DataFrame, books: list[np.ndarray], scale: int) -> list[np.ndarray]:
    """One round: entries become the componentwise floor of the mean of their parts."""
    sums = (kept.select("v").mapInArrow(partial_sums(books, scale), PARTIAL)
            .groupBy("part", "entry", "at").agg(F.sum("total").alias("total"),
                                                F.sum("rows").alias("rows")))
    books = [b.copy() for b in books]
    for r in sums.collect():  # at most one row per component of the codebooks
        value = int(r["total"]) // r["rows"]
        if abs(value) >= SAFE and books[r["part"]].dtype != object:
            books[r["part"]] = books[r["part"]].astype(object)
        books[r["part"]][r["entry"], r["at"]] = value
    return books


def encoded(kept: DataFrame, books: list[np.ndarray], scale: int) -> DataFrame:
    """``kept`` (k, v, ...) with ``code`` and ``error``, without the vector."""
    rest = [f for f in kept.schema if f.name != "v"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest]
                       + ["code string", "error bigint"])

    def rows(batches):
        for b in gathered(batches):
            x = whole_numbers(b.column(b.schema.get_field_index("v")), scale)
            codes, far = assign(x, books)
            digits, step = codes.astype(np.uint8).tobytes().hex(), 2 * len(books)
            code = [digits[i:i + step] for i in range(0, len(digits), step)]
            error = [int(e) for e in far.sum(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(f.name)) for f in rest]
                + [pa.array(code, pa.string()), pa.array(error, pa.int64())],
                names=[f.name for f in rest] + ["code", "error"])
    return kept.select(*[f.name for f in rest], "v").mapInArrow(rows, schema)


def finite(vector: Column) -> Column:
    """The vector is there and holds finite numbers only."""
    return F.coalesce(~F.exists(vector, lambda x: x.isNull() | F.isnan(x)
                                | (F.abs(x) == F.lit(float("inf")))), F.lit(False))


def books_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel().tolist())
                          .encode()).hexdigest()


def group_totals(rows: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """``rows`` with ``name`` = the sum of ``value`` over the rows of the same ``group`` (nulls
    together). Groups with over a thousandth of all rows, of which there are under 1,000, are
    broadcast; the others' totals are joined by a shuffle in which no group is large."""
    total = store(rows.groupBy(group).agg(F.sum(value).alias(name), F.count("*").alias("_n")),
                  "group-totals")
    n = total.agg(F.sum("_n")).first()[0] or 0
    much = F.col("_n") * 1000 > n

    def side(t: DataFrame) -> DataFrame:
        return t.select(F.col(group).alias("_g"), F.col(name).alias(f"_{name}"))
    same = F.col(group).eqNullSafe(F.col("_g"))
    hot = rows.join(F.broadcast(side(total.where(much))), same, "left")
    done = hot.where(f"_{name} is not null").withColumnRenamed(f"_{name}", name).drop("_g")
    rest = hot.where(f"_{name} is null").drop("_g", f"_{name}")
    calm = rest.join(side(total.where(~much)), same).withColumnRenamed(f"_{name}", name)
    return done.unionByName(calm.drop("_g"))


def vector_codes(rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
                 label: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2,
                 scale: int = 256) -> tuple[DataFrame, list[np.ndarray]]:
    """Key, code, error and label_error per vector, and the codebooks."""
    kept = (rows.where(finite(F.col(vector)))
            .select(F.col(key).alias("k"), F.col(label).alias("label"),
                    F.col(vector).cast("array<double>").alias("v")))
    books = first_books(kept, parts, entries, scale)
    for _ in range(rounds):
        books = refined(kept, books, scale)
    codes = store(encoded(kept, books, scale), "vector-codes")
    return (group_totals(codes, "label", "error", "label_error")
            .select(F.col("k").alias(key), "code", "error", "label_error"), books)
