"""JN7 form 2 on streams: lookups at an external service that wait in state.

A car's lookups (one per part kind) are rows of the state table: the id, the price once there is
one, tries so far, when the next try is due and until when the lookup may go on. Each micro-batch
asks the service once for every distinct id that is due, with a bounded number of calls at a
time; what stays without an answer is due again ``delay`` later, until it has been tried
``retries`` times more or its time is over. So no task sleeps between tries, a slow service holds
nothing but the cars that wait for it, and waits survive a restart with the state. The clock is
the newest ``ts`` that has come (rows without a car only move it on, as a trigger does).

A car leaves once all its lookups are settled, priced as form 1 prices it; a car's lookups meet
in one grouping per micro-batch, which both tells whether it waits on and prices it. Tables are versioned
and become visible by a manifest per micro-batch (``streaming/incremental.Versions``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.operators.pricing import BUCKET_PRICES, _lookups, _settle, asker
from partflow.session import state_partitions
from partflow.streaming.incremental import Versions

#: State of a lookup next to the car key, the car (on its first lookup), kind and id.
WAITS = "price double, tries int, due timestamp, until timestamp"


@dataclass
class Lookups:
    """Prices for a stream of cars. ``cars``: type of a car, ``car_key`` among its columns;
    ``ids``: part kind -> id column; ``fetch(ids, prices, tries)`` answers with {id: price}
    from the bucket's ``prices`` of ``table`` (id, price), in place of a remote service."""
    spark: SparkSession
    path: str
    cars: T.StructType
    car_key: list[str]
    ids: dict[str, Column]
    fetch: Callable[[list[str], dict[str, float], int], dict[str, float]]
    table: DataFrame
    retries: int
    delay: str
    timeout: str
    capacity: int = 5
    call_s: float = 30.0

    def __post_init__(self):
        self.versions = Versions(self.spark, self.path)
        self.prices = self.table.select(F.col("id").cast("string").alias("id"),
                                        F.col("price").cast("double").alias("price"))
        self.buckets = -(-max(1, self.prices.count()) // BUCKET_PRICES)

    def _asked(self, due: DataFrame) -> DataFrame:
        """``id, tries, found``: one try for every distinct id, by hash bucket of the price
        table."""
        fetch, how = self.fetch, (self.capacity, self.call_s, 0, 0.0, 256)
        bucket = F.pmod(F.xxhash64("id"), F.lit(self.buckets)).alias("b")

        def of_bucket(own: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            known, out = dict(zip(held["id"], held["price"])), []
            for n, part in own.groupby("tries"):
                got = asker(lambda x, n=int(n): fetch(x, known, n), *how)(part["id"].tolist())
                out += [(i, int(n), float(p)) for i, p in got.items()]
            return pd.DataFrame(out, columns=["id", "tries", "found"])
        return (due.select("id", "tries").distinct().groupBy(bucket)
                .cogroup(self.prices.groupBy(bucket))
                .applyInPandas(of_bucket, "id string, tries int, found double"))

    def per_batch(self, batch: DataFrame, batch_id: int) -> None:
        v = self.versions
        last = v.before(batch_id)
        if last is not None and last["batch_id"] == batch_id:
            return  # a replay of a batch that is done
        batch = batch.persist()
        newest = batch.agg(F.unix_micros(F.max("ts")).alias("t")).first()["t"]
        since = None if last is None else last["horizon"]
        clock = max((x for x in (since, newest) if x is not None), default=None)
        now = F.timestamp_micros(F.lit(clock).cast("long"))
        cars = batch.where("car is not null").select("car.*").withColumn("total_price",
                                                                         F.lit(0.0))
        rows = _lookups(cars, self.car_key, self.ids).select(
            "*", F.lit(None).cast("double").alias("price"), F.lit(0).alias("tries"),
            now.alias("due"), (now + F.expr(f"INTERVAL {self.timeout}")).alias("until"))
        if last is not None:
            rows = rows.unionByName(self.spark.read.schema(rows.schema).parquet(
                v.folder("state", last["batch_id"])))
        rows = rows.persist()
        is_due = F.col("price").isNull() & F.col("id").isNotNull() & (F.col("due") <= now)
        got = self._asked(rows.where(is_due))
        tried = rows.join(got, ["id", "tries"], "left").withColumn("_due", is_due)
        tried = (tried.withColumn("price", F.when(F.col("_due"), F.col("found"))
                                  .otherwise(F.col("price")))
                 .withColumn("tries", F.col("tries") + F.col("_due").cast("int"))
                 .withColumn("due", F.when(F.col("_due"), now + F.expr(f"INTERVAL {self.delay}"))
                             .otherwise(F.col("due"))).select(*rows.columns))
        open_ = (F.col("price").isNull() & F.col("id").isNotNull()
                 & (F.col("tries") <= self.retries) & (F.col("until") > now))
        per_car = self._per_car(tried, open_).persist()
        v.write("out", batch_id, self._settled(per_car.where("not _open")))
        v.write("state", batch_id, self._waiting(per_car.where("_open")).select(*rows.columns))
        v.commit(batch_id, clock, 0, 1)
        for x in (per_car, rows, batch):
            x.unpersist()

    def _per_car(self, tried: DataFrame, open_: Column) -> DataFrame:
        """One row per car, grouped once: its record, its lookups and whether one is open."""
        own = [c for c in tried.columns if c not in (*self.car_key, "_car")]
        return tried.groupBy(*self.car_key).agg(
            F.first("_car", ignorenulls=True).alias("_car"),
            F.collect_list(F.struct(*own)).alias("_lookups"),
            F.max(F.coalesce(open_, F.lit(False))).alias("_open"))

    def _settled(self, cars: DataFrame) -> DataFrame:
        """What ``pricing._fold`` gives, from a car's own lookups; then as form 1 settles it."""
        def of(k):
            return F.filter("_lookups", lambda x: x["kind"] == k)
        found = [F.array_max(F.transform(of(k), lambda x: x["price"])).alias(f"_p_{k}")
                 for k in self.ids]
        failed = [F.when(F.exists(of(k), lambda x: x["id"].isNotNull() & x["price"].isNull()), 1)
                  .alias(f"_f_{k}") for k in self.ids]
        return _settle(cars.select(*self.car_key, "_car.*", *found, *failed), self.ids,
                       "total_price")

    def _waiting(self, cars: DataFrame) -> DataFrame:
        """Back to a row per lookup, the car on its first one."""
        return cars.select(*self.car_key, "_car", F.inline("_lookups")).withColumn(
            "_car", F.when(F.col("kind") == next(iter(self.ids)), F.col("_car")))

    def run(self, source: DataFrame, checkpoint: str) -> None:
        """Take what the streaming ``source`` (ts, car) has, and stop."""
        with state_partitions(self.spark):
            q = (source.writeStream.foreachBatch(self.per_batch)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()

    def outputs(self) -> DataFrame:
        """Priced cars of batches that are done."""
        kinds = [T.StructField(f"{k.lower()}_price", T.DoubleType()) for k in self.ids]
        own = [f for f in self.cars.fields if f.name not in ("situation", "total_price")]
        return self.versions.read("out", T.StructType([
            *own, T.StructField("situation", T.StringType()),
            T.StructField("total_price", T.DoubleType()), *kinds]))
