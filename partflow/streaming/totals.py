"""AG1 on streams, one running total per input, by prefix sums.

Per micro-batch the rows of a key are numbered in arrival order within buckets of the order
(``operators/keyed``: a hot key spreads over many tasks) and the key's total so far, from earlier
buckets and from a table of one typed row per key, is added. Rows may hold an array of keys: they
travel as they are, no row per key. Totals are mergeable: the next table is the sum of the
last one and the batch's counts, so nothing is kept per input. Outputs and totals of a batch
become visible by its manifest (``streaming/incremental.Versions``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.operators.keyed import bucket_counts, running_rank_of_items
from partflow.session import state_partitions
from partflow.streaming.incremental import Versions


@dataclass
class RunningTotals:
    """Running totals of ``key`` over a stream whose rows come in ``order`` from one micro-batch
    to the next; ``bucket`` never decreases along ``order``. With ``items``, an array column, its
    elements are the keys, and outputs have their place ``pos`` (from 1)."""
    spark: SparkSession
    path: str
    key: str
    order: Sequence[str]
    bucket: Column
    items: Column | None = None

    def __post_init__(self):
        self.versions = Versions(self.spark, self.path)

    def per_batch(self, batch: DataFrame, batch_id: int) -> None:
        v, key = self.versions, self.key
        last = v.before(batch_id)
        if last is not None and last["batch_id"] == batch_id:
            return  # a replay of a batch that is done
        lines, items = batch, self.items
        if items is None:
            lines, items = batch.withColumnRenamed(key, "_own"), F.array("_own")
        here = bucket_counts(lines, items, key, self.bucket).persist()
        own = here.select(key, "n")
        old = None if last is None else self.spark.read.schema(own.schema).parquet(
            v.folder("totals", last["batch_id"]))
        ranked = running_rank_of_items(lines, items, key, self.order, self.bucket, name="n",
                                       counts=here, so_far=old)
        v.write("out", batch_id, ranked if self.items is not None else ranked.drop("pos"))
        every = own if old is None else old.unionByName(own)
        v.write("totals", batch_id, every.groupBy(key).agg(F.sum("n").alias("n")))
        v.commit(batch_id, None, 0, 1)
        here.unpersist()

    def run(self, source: DataFrame, checkpoint: str) -> None:
        """Take what the streaming ``source`` has, and stop."""
        with state_partitions(self.spark):
            q = (source.writeStream.foreachBatch(self.per_batch)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()

    def outputs(self, schema: str) -> DataFrame:
        return self.versions.read("out", schema)
