"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is a share of all words; each of its documents is taken ``target / size``
times in expectation. The whole part of that number is taken outright. The fractions are
rounded pairwise: two fractional documents exchange mass (fraction times size) at random, so
that one of them becomes 0 or 1 while the sum of their masses and both expectations stay.

The pairing is a reduction tree. Documents are dealt to buckets of about ``BUCKET`` documents
within their source; each bucket is folded pair by pair from its largest document to its
smallest and leaves at most one fractional document, its residual. Residuals of ``FAN`` buckets
meet on the next level, until one is left per source, which is rounded by its own probability.
So a source's words miss its target by less than one document, and a hot source is folded by
many tasks. Every level is written to the shared folder; the random numbers come from hashes of
seed, source and bucket, so reruns and recomputed tasks agree.

Rows are known by a 128-bit digest of key, source and text. Repeated rows are counted first and
travel as counts, ``SHARE`` at a time, so that a row that holds a third of the table fills many
buckets; each of them is rounded by itself.

Null texts have size 0. A null source is a source of its own (last in order). Documents of
size 0 take part with no mass.
"""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow.llm.common import SPACE_CHARS, SPACES, parallelism, store, text_of

#: Documents of a bucket, about; repeats of a row that go to one bucket together; buckets whose
#: residuals meet in one; rows are hot in a table of which they are more than one in ``HOT``.
BUCKET, SHARE, FAN, HOT = 1_000, 50, 256, 1_000


def word_count(text: Column) -> Column:
    """Number of maximal runs without white space."""
    bare = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACES))).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank``, counting from 0 by source (code points, null last), without
    one task sorting them all: sorted ranges are written and each range's rows are counted.
    The list of ranges (as many as shuffle partitions) is all that the driver sees."""
    spark = sources.sparkSession
    order = [F.col("source").isNull(), F.col("source")]
    rows = store(sources.repartitionByRange(parallelism(spark), *order)
                 .sortWithinPartitions(*order)
                 .withColumn("at", F.monotonically_increasing_id()), "mix-ranges")
    rows = rows.withColumn("range", F.shiftright("at", 33).cast("int"))
    first, before = 0, []
    for r in rows.groupBy("range").count().orderBy("range").collect():
        before.append((r["range"], first))
        first += r["count"]
    if not before:
        return rows.select("source", "source_size", "n", F.lit(0).cast("long").alias("rank"))
    offsets = spark.createDataFrame(before, "range int, first long")
    return rows.join(F.broadcast(offsets), "range").select(
        "source", "source_size", "n",
        (F.col("first") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("rank"))


def shares(sources: DataFrame, weights: list[float], cap: float) -> DataFrame:
    """``sources`` with weight and target. All sizes are shared by weight; where a target
    passes ``cap`` times its source's size it stops there, and the level at which the others
    share the rest is raised until none passes. Only that level is on the driver."""
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          (F.col("rank") % len(weights) + 1).cast("int")).cast("double")
    rows = store(sources.withColumn("weight", weight)
                 .withColumn("most", F.lit(float(cap)) * F.col("source_size")), "mix-shares")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        over = F.lit(level) * F.col("weight") > F.col("most")
        got = rows.agg(F.sum(F.when(over, F.col("most"))).alias("full"),
                       F.sum(F.when(~over, F.col("weight"))).alias("w")).first()
        now = (total - (got["full"] or 0.0)) / got["w"] if got["w"] else level
        if now <= level:
            break
        level = now
    return rows.withColumn("target", F.least(F.lit(level) * F.col("weight"), F.col("most")))


def pivot(a: float, u: float, b: float, v: float, x: float) -> tuple[float, float]:
    """Move mass between fractions ``a`` (size ``u``) and ``b`` (size ``v``) by the uniform
    number ``x`` until one is 0 or 1. Keeps a * u + b * v and both expectations."""
    to_a, to_b = min((1 - a) * u, b * v), min(a * u, (1 - b) * v)
    if x * (to_a + to_b) < to_b:
        return ((1.0, b - to_a / v) if (1 - a) * u < b * v else (a + to_a / u, 0.0))
    return ((0.0, b + to_b / v) if a * u < (1 - b) * v else (a - to_b / u, 1.0))


ROW = ("k bigint, sid bigint, size bigint, id1 bigint, id2 bigint, rows bigint, "
       "whole bigint, part double, bucket bigint, done boolean")
_ROW = pa.schema([("k", pa.int64()), ("sid", pa.int64()), ("size", pa.int64()),
                  ("id1", pa.int64()), ("id2", pa.int64()), ("rows", pa.int64()),
                  ("whole", pa.int64()), ("part", pa.float64()), ("bucket", pa.int64()),
                  ("done", pa.bool_())])

#: Fractions this near to 0 or 1 count as integral.
EPS = 1e-9


def fractional(x: float) -> bool:
    return EPS < x < 1 - EPS


def settle(part: list[float], size: list[int], draw: random.Random) -> None:
    """Round the fractions ``part`` pair by pair, in order, until one at most is left: the one
    that a pair leaves fractional meets the next."""
    held = None
    for i, x in enumerate(part):
        if not fractional(x):
            continue
        if held is None:
            held = i
            continue
        part[held], part[i] = pivot(part[held], size[held], x, size[i], draw.random())
        if not fractional(part[held]):
            part[held] = float(round(part[held]))
            held = i if fractional(part[i]) else None


def fold(seed: int, level: int, last: bool):
    """Round the fractions of each (sid, bucket), whose rows arrive together and in order.
    The residual of a bucket goes on, or on the last level is rounded by its probability."""
    def rows(batches):
        key, held = None, []

        def done():
            draw = random.Random(f"{seed}/{level}/{key}")
            part, size = [r["part"] for r in held], [r["size"] for r in held]
            for i, n in enumerate(size):
                if n <= 0 and fractional(part[i]):
                    part[i] = 1.0 if draw.random() < part[i] else 0.0
            settle(part, size, draw)
            out = []
            for r, x in zip(held, part):
                if last and fractional(x):
                    x = 1.0 if draw.random() < x else 0.0
                whole = not fractional(x)
                out.append({**r, "done": whole, "part": float(round(x)) if whole else x})
            return pa.RecordBatch.from_pylist(out, schema=_ROW)

        for b in batches:
            for r in b.to_pylist():
                if (r["sid"], r["bucket"]) != key:
                    if held:
                        yield done()
                    key, held = (r["sid"], r["bucket"]), []
                held += [{**r, "rows": 1}] * r["rows"]
        if held:
            yield done()
    return rows


def identity(key: str, source: str, text: str) -> list[Column]:
    """128 bits that name a row by key, source and text, nulls told apart."""
    parts = [x for c in (key, source, text) for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(seed), *parts).alias(f"id{seed}") for seed in (1, 2)]


def plan(docs: DataFrame, key: str, source: str, text: str, weights: tuple[float, ...],
         cap: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """One row per row of ``docs``: k, sid, size, id1, id2, copies; and the sources' table."""
    spark = docs.sparkSession
    sized = store(docs.select(F.col(key).cast("bigint").alias("k"),
                              F.col(source).alias("source"),
                              word_count(text_of(text)).alias("size"),
                              *identity(key, source, text)), "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                          F.count("*").alias("n"))
    goal = store(shares(ranked(sources), list(weights), cap), "mix-targets")
    names = goal.select(F.col("source").alias("name"), F.col("rank").alias("sid"),
                        "source_size", "n", "target")
    ratio = F.when(F.col("source_size") > 0,
                   F.least(F.lit(float(cap)), F.col("target") / F.col("source_size"))
                   ).otherwise(0.0)
    # Repeated rows leave in shares, the last one smaller.
    one = (sized.groupBy("source", "k", "size", "id1", "id2").agg(F.count("*").alias("all"))
           .withColumn("share", F.explode(F.sequence(
               F.lit(0).cast("long"), F.floor((F.col("all") - 1) / SHARE)))))
    rows = (one.join(names, F.col("source").eqNullSafe(F.col("name")))
            .withColumn("ratio", ratio)
            .select("k", "sid", "size", "id1", "id2",
                    F.least(F.lit(SHARE).cast("long"), F.col("all") - F.col("share") * SHARE)
                    .alias("rows"),
                    F.floor("ratio").alias("whole"),
                    (F.col("ratio") - F.floor("ratio")).alias("part"),
                    F.pmod(F.xxhash64(F.lit(seed), "id1", "id2", "share"),
                           F.ceil(F.col("n") / BUCKET)).alias("bucket"),
                    F.lit(False).alias("done")))
    most = goal.agg(F.max("n")).first()[0] or 0
    width, level, parts = max(1, -(-most // BUCKET)), 0, []
    while True:
        last = width == 1
        done = store(rows.repartition(parallelism(spark), "sid", "bucket")
                     .sortWithinPartitions("sid", "bucket", F.desc("size"), "k", "id1", "id2",
                                           "rows")
                     .mapInArrow(fold(seed, level, last), ROW), f"mix-level{level}")
        parts.append(done.where("done"))
        if last:
            break
        rows = done.where("not done").withColumn("bucket",
                                                 F.floor(F.col("bucket") / FAN))
        width, level = -(-width // FAN), level + 1
    whole = parts[0]
    for x in parts[1:]:
        whole = whole.unionByName(x)
    return (whole.select("k", "sid", "size", "id1", "id2",
                         (F.col("whole") + F.col("part").cast("long")).alias("copies")), names)


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
        weights: tuple[float, ...] = (1, 2, 3), cap: float = 3, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: key, source, size, source_size, target, copies, taken.
    Sources, in order, weigh ``weights``, repeating; no document is taken more than ``cap``
    times (a whole number)."""
    kind = docs.schema[key].dataType.simpleString()
    rows, names = plan(docs, key, source, text, weights, cap, seed)
    return (rows.join(names, "sid")
            .select(F.col("k").cast(kind).alias(key), F.col("name").alias(source), "size",
                    "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source",
                    text: str = "text", weights: tuple[float, ...] = (1, 2, 3), cap: float = 3,
                    seed: int = 42) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Rows meet their copies by digest; texts are exchanged once. Rows alike in key, source and
    text share their copies as evenly as whole numbers allow: where there are few of them, by
    their number among each other. Rows of which one in ``HOT`` or more is alike (fewer digests
    than ``HOT``) aren't exchanged at all: their copies are broadcast, each takes the whole
    share, and what remains is added to one of them."""
    rows, _ = plan(docs, key, source, text, weights, cap, seed)
    each = store(rows.groupBy("id1", "id2").agg(F.sum("copies").alias("_copies"),
                                                F.count("*").alias("_n")), "mix-copies")
    every = each.agg(F.sum("_n")).first()[0] or 0
    hot = F.col("_n") * HOT > every
    own = docs.select(F.struct(*docs.columns).alias("row"), *identity(key, source, text))
    at = own.join(F.broadcast(each.where(hot)), ["id1", "id2"], "left")
    share, rest = F.floor(F.col("_copies") / F.col("_n")), F.col("_copies") % F.col("_n")

    many = at.where("_n is not null")
    more = (many.where(rest > 0).groupBy("id1", "id2")
            .agg(F.first("row").alias("row"), F.first(rest).alias("_take")))
    few = (at.where("_n is null").select("id1", "id2", "row")
           .join(each.where(~hot), ["id1", "id2"]))
    number = F.row_number().over(Window.partitionBy("id1", "id2").orderBy("_n"))
    took = (many.select("row", share.alias("_take"))
            .unionByName(more.select("row", "_take"))
            .unionByName(few.select("row", (share + (number <= rest).cast("long"))
                                    .alias("_take"))))
    return (took.where("_take > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_take"))))
            .select("row.*"))
