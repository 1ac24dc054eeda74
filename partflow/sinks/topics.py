"""Sinks (SNK1-SNK5): record encoding and writing to a topic, a file "topic" or the
console.

A topic message is ``(key binary, value)``. The value is JSON text by default; Avro
(``to_avro``) is used when the spark-avro package is on the classpath. Kafka is used
when its connector is on the classpath; file topics (a folder of Parquet files with
``key, value, ts, seq``) work everywhere and are what the tests use. Writes are
idempotent per batch: the file sink's batch log gives exactly-once in streaming, and
batch writes replace their target folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.functions.scalars import key_bytes


def encode(df: DataFrame, key: str | Column | None, record: Column, fmt: str = "json",
           keep=("ts", "seq"), schema_id: int | None = None) -> DataFrame:
    """``(key, value[, ts, seq])`` with the record encoded as JSON text, Avro bytes or,
    for ``text``, a string column as is (job C's ``word:::n`` lines). ``key=None``
    writes null keys (the text topics have none). ``schema_id`` puts the registry's 5-byte
    header (a zero byte and the id) before Avro bytes, as ``decode`` takes it off."""
    if fmt == "text":
        value = record.cast("string")
    elif fmt == "json":
        value = F.to_json(record)
    elif fmt == "avro":  # needs the spark-avro package
        from pyspark.sql.avro.functions import to_avro
        value = to_avro(record)
        if schema_id is not None:
            value = F.concat(F.lit(b"\0" + schema_id.to_bytes(4, "big")), value)
    else:
        raise ValueError(fmt)
    extra = [c for c in keep if c in df.columns]
    k = F.lit(None).cast("binary") if key is None else key_bytes(key)
    return df.select(k.alias("key"), value.alias("value"), *extra)


def write_file_topic(encoded: DataFrame, path: str) -> None:
    """Batch write of a file topic (replaces the folder: re-running is idempotent)."""
    encoded.write.mode("overwrite").parquet(path)


def fixed_partition(encoded: DataFrame, key: str, partitions: int, tasks: int | None = None
                    ) -> DataFrame:
    """SNK5: adds ``partition``, which a Kafka write obeys: each sink task writes one partition
    only, task number modulo ``partitions``. Rows are dealt to ``tasks`` by key and sorted, so
    the messages of a key are in one partition, in their order."""
    n = tasks or int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [c for c in ("ts", "seq") if c in encoded.columns]
    return (encoded.repartition(n, key).sortWithinPartitions(key, *order)
            .withColumn("partition", F.spark_partition_id() % partitions))


def kafka_writer(encoded: DataFrame, brokers: str, topic: str):
    """A Kafka batch writer (at-least-once; see README on exactly-once)."""
    cols = [c for c in ("key", "value", "partition") if c in encoded.columns]
    return (encoded.select(*cols).write.format("kafka").option("kafka.bootstrap.servers", brokers)
            .option("topic", topic))
