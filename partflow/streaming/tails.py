"""AG2 on streams: the newest ``n`` values of a key at every arrival.

Per micro-batch the key's last rows so far, a table of at most n - 1 rows per key, join the new
ones and one keyed scan over time buckets (``operators/latest.last_n``) looks back, so that a key
with many arrivals is spread over many tasks. Outputs, last rows and late rows of a batch become
visible by its manifest (``streaming/incremental.Versions``)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.operators.latest import last_n
from partflow.session import state_partitions
from partflow.streaming.incremental import Versions


@dataclass
class LastRows:
    """Over a stream of rows ``key, ts, seq, v`` (``v`` of type ``value``) in the order of ``ts``
    and ``seq`` from one micro-batch to the next. Rows before the newest ``ts`` of earlier batches
    are late: they go to the table ``late`` and the manifest counts them."""
    spark: SparkSession
    path: str
    n: int
    value: T.DataType

    def __post_init__(self):
        self.versions = Versions(self.spark, self.path)
        self.rows = T.StructType([
            T.StructField("key", T.StringType()), T.StructField("ts", T.TimestampType()),
            T.StructField("seq", T.LongType()), T.StructField("v", self.value)])

    def per_batch(self, batch: DataFrame, batch_id: int) -> None:
        v = self.versions
        last = v.before(batch_id)
        if last is not None and last["batch_id"] == batch_id:
            return  # a replay of a batch that is done
        newest = batch.agg(F.unix_micros(F.max("ts")).alias("t")).first()["t"]
        since = None if last is None else last["horizon"]
        both, n_late = batch.select(*self.rows.names, F.lit(True).alias("_new")), 0
        if since is not None:
            behind = F.coalesce(F.col("ts") < F.timestamp_micros(F.lit(since)), F.lit(False))
            late = batch.where(behind)
            n_late = late.count()
            if n_late:
                v.write("late", batch_id, late)
            both = both.where(~behind)
        if last is not None:
            both = both.unionByName(self.spark.read.schema(self.rows).parquet(
                v.folder("state", last["batch_id"])).withColumn("_new", F.lit(False)))
        out = last_n(both, "key", "v", self.n)
        v.write("out", batch_id, out.where("_new").select(
            "key", "ts", "seq", F.col(f"last_{self.n}").alias("vals")))
        newer = Window.partitionBy("key").orderBy(F.desc("ts"), F.desc("seq"))
        v.write("state", batch_id, both.withColumn("_r", F.row_number().over(newer)).where(
            F.col("_r") < self.n).select(*self.rows.names))
        v.commit(batch_id, max((x for x in (since, newest) if x is not None), default=None),
                 n_late, 1)

    def run(self, source: DataFrame, checkpoint: str) -> None:
        """Take what the streaming ``source`` has, and stop."""
        with state_partitions(self.spark):
            q = (source.writeStream.foreachBatch(self.per_batch)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()

    def outputs(self) -> DataFrame:
        return self.versions.read("out", T.StructType([
            *self.rows.fields[:3], T.StructField("vals", T.ArrayType(self.value))]))
