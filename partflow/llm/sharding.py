"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``RING`` places. Every shard owns ``nodes`` of them (its virtual nodes); a row
stands at the place that a hash of its key and text names and belongs to the shard whose node
comes next clockwise. A shard takes no more than its capacity: rows that find it full go on
clockwise to the next shard with room. With capacities that add up to the whole load and differ
by one row at most, balance is certain; only what overflows moves when shards or rows change.

All rows of a place share their way around the ring, so the walk is settled on the table of
places (at most ``RING`` rows, whatever the input): in each round every place offers the rows
it has left to the nearest shard with room, a shard serves its places in ring order, and a place
it can't serve whole keeps the rest for the next round. Each round but the last fills a shard,
so there are at most as many rounds as shards; the driver holds one number per shard.

Rows are laid out along the ring once (sorted ranges of the hash and a row id, written), so that
equal rows, or a key with a third of all rows, spread over many tasks: a row's place in the
order is its range's first number plus its position there. The walk's pieces are intervals of
that order, and a row's shard is a lookup in its place's few pieces.

Laws: ``rows`` gives every shard the same number of rows, but for one; ``bytes`` gives it about
the same number of bytes (capacity: the mean, raised by ``slack``, plus one largest row).

Null texts have no bytes; null keys and repeated rows are rows like any other; an empty table
gives an empty result; columns other than key and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partflow.llm.common import parallelism, store, text_of

#: Places of the ring (2^15: the top 15 bits of a hash), and virtual nodes of a shard.
RING, NODES = 1 << 15, 128


def place(h: Column) -> Column:
    """The ring place of a 64-bit hash; order of places is order of unsigned hashes."""
    return (F.shiftright(h, 49) + F.lit(RING // 2)).cast("int")


def ring(spark: SparkSession, shards: int, nodes: int = NODES, seed: int = 42) -> DataFrame:
    """``place, way``: for every place the shards in the order in which a clockwise walk meets
    them. A node's place depends on its shard's number and its own alone, so that a further
    shard only adds nodes. ``RING`` rows."""
    owned = (spark.range(shards * nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        F.floor(F.col("id") / shards).alias("node"))
        .select("shard", place(F.xxhash64(F.lit(seed), "shard", "node")).alias("at"))
        .distinct())
    places = spark.range(RING).select(F.col("id").cast("int").alias("place"))
    # Per shard, the next of its nodes at or after each place, once around.
    marks = (places.select("place", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
                           .alias("shard"))
             .join(owned.withColumnRenamed("at", "place").withColumn("node", F.col("place")),
                   ["shard", "place"], "left"))
    # Walking down from the last place, the node seen last is the next one clockwise; past the
    # last node it is the shard's first, once around.
    down = (Window.partitionBy("shard").orderBy(F.desc("place"))
            .rowsBetween(Window.unboundedPreceding, 0))
    far = F.coalesce(F.last("node", ignorenulls=True).over(down),
                     F.min("node").over(Window.partitionBy("shard")) + RING)
    return (marks.select("place", "shard", (far - F.col("place")).alias("far"))
            .groupBy("place").agg(F.array_sort(F.collect_list(F.struct("far", "shard")))
                                  .alias("w"))
            .select("place", F.col("w.shard").alias("way")))


def laid_out(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` (k, digest, size, crc) with ``p``, ``i``: range and position along the ring,
    and ``place``. Written, so that every later step sees the same layout."""
    n = parallelism(rows.sparkSession)
    known = store(rows.withColumn("h", F.xxhash64(F.lit(seed), "k", "digest"))
                  .withColumn("id", F.monotonically_increasing_id()), "ring-rows")
    order = [place(F.col("h")), "h", "id"]
    out = store(known.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .withColumn("at", F.monotonically_increasing_id()), "ring-order")
    return out.select("k", "size", "crc", place(F.col("h")).alias("place"),
                      F.shiftright("at", 33).alias("p"),
                      F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("i"))


def _before(df: DataFrame, of: str, order: list[str], *by: str) -> DataFrame:
    """``df``, a small table, with ``first`` = the sum of ``of`` over the rows before."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("first", F.coalesce(F.sum(of).over(w), F.lit(0)))


def walk(places: DataFrame, ways: DataFrame, room: list[int]) -> DataFrame:
    """``place, lo, hi, shard``: which interval of each place's load (``first`` up to ``first +
    load``) goes to which shard, given the shards' ``room``."""
    room, done = list(room), []
    left = store(places.join(ways, "place")
                 .select("place", "way", F.col("first").alias("lo"),
                         (F.col("first") + F.col("load")).alias("hi")), "ring-walk")
    while any(x > 0 for x in room):
        free = F.array(*[F.lit(x > 0) for x in room])
        has = F.array(*[F.lit(x).cast("long") for x in room])
        shard = F.element_at(F.filter("way", lambda s: F.element_at(free, s + 1)), 1)
        offer = Window.partitionBy("shard").orderBy("place")
        ahead = F.coalesce(F.sum(F.col("hi") - F.col("lo")).over(
            offer.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        take = F.least(F.greatest(F.element_at(has, F.col("shard") + 1) - F.col("ahead"),
                                  F.lit(0)), F.col("hi") - F.col("lo"))
        got = store(left.withColumn("shard", shard).withColumn("ahead", ahead)
                    .withColumn("cut", F.col("lo") + take).drop("ahead"), "ring-walk")
        done.append(got.where("cut > lo").select("place", "lo", F.col("cut").alias("hi"),
                                                 "shard"))
        taken = got.groupBy("shard").agg(F.sum(F.col("cut") - F.col("lo")).alias("took"),
                                         F.sum(F.col("hi") - F.col("cut")).alias("rest"))
        rest = 0
        for r in taken.collect():  # one row per shard
            room[r["shard"]] -= r["took"]
            rest += r["rest"]
        if not rest:
            break
        left = got.where("cut < hi").select("place", "way", F.col("cut").alias("lo"), "hi")
    if not done:
        return left.limit(0).select("place", "lo", "hi", F.lit(0).alias("shard"))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def shard_rows(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text",
               law: str = "rows", slack: float = 0.01, nodes: int = NODES,
               seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: key, size (UTF-8 bytes of the text plus 16), text_crc32, law,
    shard, slot (numbers from 0 within the shard, without gaps, in ring order), grown_shard
    (null: loads decide here, so a further shard takes rows from its neighbours' overflow as
    well)."""
    spark = docs.sparkSession
    t = text_of(text)
    rows = laid_out(docs.select(
        F.col(key).alias("k"), F.xxhash64(F.lit(seed), t).alias("digest"),
        (F.octet_length(t) + 16).cast("long").alias("size"), F.crc32(t).alias("crc")), seed)
    load = F.lit(1).cast("long") if law == "rows" else F.col("size")
    local = Window.partitionBy("p").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, and one per place and range it lies in.
    ranges = _before(rows.groupBy("p").agg(F.sum(load).alias("load")), "load", ["p"])
    places = _before(rows.groupBy("place").agg(F.sum(load).alias("load")), "load", ["place"])
    got = rows.agg(F.count("*").alias("n"), F.sum(load).alias("all"),
                   F.max("size").alias("most")).first()
    n, every = got["n"], got["all"] or 0
    if law == "rows":
        room = [n // shards + (s < n % shards) for s in range(shards)]
    else:
        room = [int(every / shards * (1 + slack)) + (got["most"] or 0)] * shards
    pieces = (walk(places, ring(spark, shards, nodes, seed), room)
              .groupBy("place").agg(F.collect_list(F.struct("lo", "hi", "shard")).alias("cuts")))
    at = F.col("first") + F.coalesce(F.sum(load).over(local), F.lit(0))
    mine = F.filter("cuts", lambda c: (c["lo"] <= F.col("at")) & (F.col("at") < c["hi"]))
    # At most RING rows, each with at most as many pieces as shards.
    dealt = store(rows.join(ranges.select("p", "first"), "p").withColumn("at", at)
                  .join(F.broadcast(pieces), "place")
                  .select("k", "size", "crc", "p", "i",
                          F.element_at(mine, 1)["shard"].alias("shard")), "ring-dealt")
    starts = _before(dealt.groupBy("shard", "p").agg(F.count("*").alias("n")), "n", ["p"],
                     "shard").select("shard", "p", "first")
    own = F.row_number().over(Window.partitionBy("p", "shard").orderBy("i"))
    return (dealt.withColumn("own", own).join(starts, ["p", "shard"])
            .select(F.col("k").alias(key), "size", F.col("crc").alias("text_crc32"),
                    F.lit(law).alias("law"), "shard",
                    (F.col("first") + F.col("own") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
