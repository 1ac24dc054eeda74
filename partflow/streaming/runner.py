"""Running the machines as Structured Streaming queries.

Input is a *topic frame*: ``key string, side string, ts timestamp, seq long, value
string`` (JSON payload), read from Kafka or from a file topic. The query is

    readStream -> withWatermark(ts, 0) -> groupBy(key)
      -> transformWithState(MachineProcessor, EventTime) -> writeStream

with the output ``key, ts_us, value`` (emit time in microseconds). Sinks: a Parquet file sink (exactly-once through
its batch log) or ``foreachBatch``; the checkpoint holds source offsets and the RocksDB
state, so a restarted query resumes where it stopped.

For the registered ``stream_*`` queries the driver's tables are fed as a file topic cut
into time slices: each slice is written by all tasks in parallel into its own folder,
then the query runs with ``availableNow`` from the same checkpoint, the way a scheduled
incremental job runs (every slice is one micro-batch, strictly later than the one
before, so no row is ever behind the watermark; every slice after the first is also a
restart from the checkpoint). A closing row under a sentinel key, later than every
deadline, rides in the last slice: the watermark then passes every timer, and the
no-data batch that follows settles all waits.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.session import materialize, scratch_path, state_partitions
from partflow.streaming.machines import Machine
from partflow.streaming.processor import OUTPUT_SCHEMA, MachineProcessor

SENTINEL = "~end~"
TOPIC_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("side", T.StringType()),
    T.StructField("ts", T.TimestampType()), T.StructField("seq", T.LongType()),
    T.StructField("value", T.StringType()),
])


def topic_frame(df: DataFrame, key: str, side: str | F.Column, seq: str | None = None,
                payload: list[str] | None = None) -> DataFrame:
    """Shape a table as a topic frame; the payload columns go into a JSON value."""
    payload = payload or [c for c in df.columns if c != key]
    side_col = F.lit(side) if isinstance(side, str) else side
    seq_col = F.col(seq).cast("long") if seq else F.lit(0).cast("long")
    return df.select(F.col(key).cast("string").alias("key"), side_col.alias("side"),
                     F.col("ts").cast("timestamp").alias("ts"), seq_col.alias("seq"),
                     F.to_json(F.struct(*payload)).alias("value"))


def _bounds(frame: DataFrame, slices: int) -> list[int]:
    ms = F.unix_millis("ts")
    return sorted(set(int(b) for b in frame.select(ms.alias("m"))
                      .approxQuantile("m", [i / slices for i in range(1, slices)], 0.01)))


def time_slices(spark: SparkSession, frame: DataFrame, slices: int, horizon_ms: int,
                stored: bool = True) -> list[DataFrame]:
    """The topic frame, written once (where ``stored``) and cut at whole-millisecond borders
    (approximate quantiles: a handful of numbers on the driver); the last slice carries the
    closing sentinel row."""
    if stored:
        frame = materialize(frame, "topic-frame")
    ms = F.unix_millis("ts")
    edges = [None, *_bounds(frame, slices), None]
    out = []
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = frame
        if lo is not None:
            part = part.filter(ms >= lo)
        if hi is not None:
            part = part.filter(ms < hi)
        out.append(part)
    last = frame.agg(F.max(ms)).first()[0] or 0
    end = spark.createDataFrame(
        [(SENTINEL, SENTINEL, None, 0, "{}")],
        "key string, side string, ts timestamp, seq long, value string"
    ).withColumn("ts", F.timestamp_millis(F.lit(last + horizon_ms)))
    out[-1] = out[-1].unionByName(end)
    return out


def run_sliced(spark: SparkSession, frame: DataFrame, machine: Machine, name: str,
               slices: int, horizon_ms: int) -> DataFrame:
    """Feed ``frame`` slice by slice (one ``availableNow`` run each, same checkpoint and
    sink) and return the sink as a batch DataFrame."""
    topic = scratch_path(spark, f"{name}-topic")
    checkpoint, out = scratch_path(spark, f"{name}-ckpt"), scratch_path(spark, f"{name}-out")
    for i, part in enumerate(time_slices(spark, frame, slices, horizon_ms)):
        part.write.parquet(f"{topic}/slice-{i:05d}")
        _run(spark, f"{topic}/slice-*", machine, checkpoint, out, files_per_batch=None)
    return read_output(spark, out)


def write_time_sliced(spark: SparkSession, frame: DataFrame, path: str, slices: int,
                      horizon_ms: int) -> None:
    """Test fixtures: a small topic frame written up front as one file per time slice
    (read with one file per micro-batch by ``run_to_end``)."""
    for part in time_slices(spark, frame, slices, horizon_ms):
        part.coalesce(1).write.mode("append").parquet(path)


def machine_stream(source: DataFrame, machine: Machine, time_mode: str = "EventTime",
                   ttl_ms: int | None = None, lateness: str = "0 seconds") -> DataFrame:
    """The stateful stage on a streaming topic frame. In event time the watermark
    trails the newest arrival by ``lateness`` (0 for in-order topics), and Spark leaves out
    rows behind it: ``reject_late`` after a run fails it if there were any. Arrival times
    must lie after the epoch (the first watermark). A job that must take rows in any order
    uses processing time, which has no watermark."""
    src = source.withColumn("ts_us", F.unix_micros("ts"))
    if time_mode == "EventTime":
        src = src.withWatermark("ts", lateness)
    return (src.groupBy("key")
            .transformWithState(MachineProcessor(machine, time_mode, ttl_ms), OUTPUT_SCHEMA,
                                "Append", time_mode))


def reject_late(query) -> None:
    """Fail loudly where the watermark left rows out: a late row is never dropped in silence."""
    late = sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress
               for op in json.loads(p.json if hasattr(p, "json") else json.dumps(p)
                                    )["stateOperators"])
    if late:
        raise RuntimeError(f"{late} rows arrived behind the watermark; give the stream a "
                           "larger lateness, or sort its input")


def run_to_end(spark: SparkSession, topic_path: str, machine: Machine,
               name: str = "machine", checkpoint: str | None = None,
               out: str | None = None) -> DataFrame:
    """Run the stage over a file topic with ``availableNow`` into a Parquet sink and
    return the sink as a batch DataFrame (sentinel rows removed, ``ts`` restored)."""
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    out = out or scratch_path(spark, f"{name}-out")
    _run(spark, topic_path, machine, checkpoint, out, files_per_batch=1)
    return read_output(spark, out)


def _run(spark, topic_path, machine, checkpoint, out, files_per_batch):
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # The run's progress is kept whole: ``reject_late`` reads every micro-batch's.
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "100000")
    with state_partitions(spark):
        q = (machine_stream(reader.parquet(topic_path), machine).writeStream.format("parquet")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True)
             .start(out))
    q.awaitTermination()
    reject_late(q)


def read_output(spark: SparkSession, out: str) -> DataFrame:
    return (spark.read.schema(OUTPUT_SCHEMA).parquet(out)
            .filter(F.col("key") != SENTINEL)
            .withColumn("ts", F.timestamp_micros("ts_us").cast("timestamp_ntz")))
