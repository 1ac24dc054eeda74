"""T5 (stream = batch over different file splits), T7 (restart after a failure) and
T8 (random arrival sequences with repeated parts per key, Spark against the
event-queue model in tests/model.py)."""

import json
import os
import time
import random

import pytest
from pyspark.sql import functions as F

from partflow.plans import streams as ST
from partflow.plans.catalog import QUERIES
from partflow.session import scratch_path
from partflow.streaming import runner as R
from partflow.streaming.machines import Assembly, WaitJoin

from data_dirs import SF001
from model import simulate


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stream_equals_batch_for_two_splits(spark, monkeypatch):
    batch = _rows(QUERIES["body_engine_wait_join"](spark, SF001))
    for slices in (2, 7):
        monkeypatch.setattr(ST, "SLICES", slices)
        stream = QUERIES["stream_body_engine_wait_join"](spark, SF001)
        assert _rows(stream.select(*QUERIES["body_engine_wait_join"](spark, SF001).columns)) \
            == batch


class FailOnce(WaitJoin):
    """A machine that crashes the query the first time it sees a chosen key."""

    def __init__(self, marker, key_seq, *a):
        super().__init__(*a)
        self.marker, self.key_seq = marker, key_seq

    def instant(self, st, items, t, rows):
        if any(r[1] == self.key_seq for r in rows) and os.path.exists(self.marker):
            os.remove(self.marker)
            raise RuntimeError("simulated crash")
        return super().instant(st, items, t, rows)


def test_restart_from_checkpoint_after_failure(spark):
    from partflow.sources import fixtures as fx
    parts = fx.car_parts(spark, SF001)
    frame = R.topic_frame(parts["body"], "sku", "body", seq="sku", payload=["id"]).unionByName(
        R.topic_frame(parts["engine"], "sku", "engine", seq="sku", payload=["id"]))
    topic = scratch_path(spark, "t7-topic")
    R.write_time_sliced(spark, frame, topic, 5, ST.CAR_WAIT_MS + 1)
    plain = R.run_to_end(spark, topic, WaitJoin("full", ST.CAR_WAIT_US, "body", "engine"))
    # a sku seen in the middle of the stream
    victim = parts["engine"].orderBy("ts").select("sku").collect()[
        parts["engine"].count() // 2][0]
    marker = scratch_path(spark, "t7-marker")
    open(marker, "w").close()
    ckpt, out = scratch_path(spark, "t7-ckpt"), scratch_path(spark, "t7-out")
    m = FailOnce(marker, victim, "full", ST.CAR_WAIT_US, "body", "engine")
    with pytest.raises(Exception):
        R.run_to_end(spark, topic, m, checkpoint=ckpt, out=out)
    assert not os.path.exists(marker)
    resumed = R.run_to_end(spark, topic, m, checkpoint=ckpt, out=out)
    assert _rows(resumed) == _rows(plain)


def _random_key(rng, T):
    arr, seq = [], 0
    for side, k in (("body", rng.randint(0, 3)), ("engine", rng.randint(0, 3)),
                    ("remote", rng.randint(0, 2)), ("wheel", rng.randint(0, 7))):
        for _ in range(k):
            arr.append((rng.randint(0, 4 * T), seq, side, f"{side}{seq}"))
            seq += 1
    # a few exact ties with deadlines and with each other
    if arr and rng.random() < 0.5:
        t0 = arr[0][0]
        arr = [(t0 + T if i % 3 == 1 else a[0], *a[1:]) for i, a in enumerate(arr)]
    return arr


@pytest.mark.parametrize("policy", ["code", "documented"])
def test_model_check_random_sequences(spark, policy):
    rng = random.Random(7 if policy == "code" else 11)
    T = 10 * 1_000_000
    keys = {f"k{i}": _random_key(rng, T) for i in range(300)}
    rows = [(k, side, t, seq, json.dumps({"id": pid}))
            for k, arr in keys.items() for t, seq, side, pid in arr]
    df = (spark.createDataFrame(rows, "key string, side string, t long, seq long, value string")
          .select("key", "side", F.timestamp_micros(F.col("t") + 1_700_000_000_000_000)
                  .alias("ts"), "seq", "value"))
    topic = scratch_path(spark, "t8-topic")
    R.write_time_sliced(spark, df, topic, 3, 4 * T // 1000 + 1)
    want = []
    for k, arr in keys.items():
        for t, o in simulate(arr, T, 4, policy):
            want.append((k, t, _norm(o)))
    from partflow.operators.sequential import run_machine
    stream = R.run_to_end(spark, topic, Assembly(T, 4, policy), "t8")
    batch = run_machine(df, Assembly(T, 4, policy), partitions=4)
    for out in (stream, batch):
        got = [(r["key"], r["ts_us"] - 1_700_000_000_000_000, _norm(json.loads(r["value"])))
               for r in out.collect()]
        assert sorted(got) == sorted(want)


def _norm(o):
    def idv(x):
        return None if x is None else (x["id"] if isinstance(x, dict) else x)
    return (idv(o.get("body")), idv(o.get("engine")), idv(o.get("remote")),
            tuple(idv(w) for w in o.get("wheels") or []), o["situation"])


def test_processing_time_mode(spark):
    """ProcessingTime: arrival order is the topic order (seq); a first-per-key stage
    flags the same rows as in event time."""
    from partflow.streaming.machines import First
    e = spark.read.parquet(f"{SF001}/events.parquet")
    frame = R.topic_frame(e, "user_id", "body", seq="event_id", payload=["event_type"])
    topic = scratch_path(spark, "pt-topic")
    frame.coalesce(1).write.parquet(topic)
    out = scratch_path(spark, "pt-out")
    src = spark.readStream.schema(R.TOPIC_SCHEMA).parquet(topic)
    # processing-time stages always ask for another batch (wall-clock timers), so an
    # availableNow run never ends: run until every input row has its output, then stop.
    import time
    q = (R.machine_stream(src, First(), "ProcessingTime").writeStream.format("parquet")
         .option("checkpointLocation", scratch_path(spark, "pt-ckpt"))
         .trigger(processingTime="1 second").start(out))
    n, deadline = e.count(), time.time() + 90
    try:
        while time.time() < deadline:
            time.sleep(2)
            if os.path.exists(os.path.join(out, "_spark_metadata")) and \
                    spark.read.schema(R.OUTPUT_SCHEMA).parquet(out).count() >= n:
                break
    finally:
        q.stop()
    got = R.read_output(spark, out).select(
        F.get_json_object("value", "$.seq").cast("long").alias("event_id"),
        F.get_json_object("value", "$.first").cast("boolean").alias("is_first"))
    want = QUERIES["first_per_key"](spark, SF001).select("event_id", "is_first")
    assert _rows(got) == _rows(want)


def test_job_a_from_encoded_topics_routes_every_car(spark):
    """Job A from four encoded part topics (strict decode, keyed by part.sku) to the two
    sinks: counts per sink and situation equal pricing and routing the cars of the
    stream assembly in batch (T6 on the streaming form)."""
    from partflow.operators.routing import route, route_counts
    from partflow.plans import assembly as A
    from partflow.sources import fixtures as fx
    got = {(r.sink, r.situation): r.n for r in QUERIES["stream_route_counts"](spark, SF001).collect()}
    topic = scratch_path(spark, "ja-topic")
    parts = fx.car_parts(spark, SF001)
    R.write_time_sliced(spark, ST.assembly_frame(spark, SF001), topic, 3, ST.ASM_HORIZON_MS)
    cars = ST.assembled_cars(R.run_to_end(spark, topic, Assembly(ST.CAR_WAIT_US, 4, "code")))
    want = {(r.sink, r.situation): r.n for r in route_counts(
        route(cars, A.price(cars, parts["prices"], "code"))).collect()}
    assert got == want and sum(got.values()) == cars.count()


def test_every_sku_closed_form_equals_ordered_form(spark):
    """Two-car skus: the DataFrame closed form, the sorted-scan machine form and the
    streaming form give the same cars, wheels included."""
    from partflow.operators.sequential import run_machine
    from partflow.plans import assembly as A
    from partflow.sources import fixtures as fx
    closed = A.flat(A.assemble(fx.car_parts(spark, SF001), "code"))
    ordered = A.flat(ST.assembled_cars(run_machine(ST.assembly_frame(spark, SF001),
                                                   Assembly(ST.CAR_WAIT_US, 4, "code"))))
    assert _rows(closed) == _rows(ordered)
    assert closed.groupBy("sku").count().filter("count = 2").count() > 0


def test_foreach_batch_sinks_survive_a_crash_between_writes(spark):
    """SNK6 pattern: each micro-batch writes its two sink slices under its batch id with
    overwrite. A crash after the first write of a batch, then a restart from the
    checkpoint, replays that batch and leaves both sinks as an unbroken run does."""
    from partflow.sources import fixtures as fx
    parts = fx.car_parts(spark, SF001)
    frame = R.topic_frame(parts["body"], "sku", "body", "seq", payload=["id"]).unionByName(
        R.topic_frame(parts["engine"], "sku", "engine", "seq", payload=["id"]))
    topic = scratch_path(spark, "fb-topic")
    R.write_time_sliced(spark, frame, topic, 4, ST.CAR_WAIT_MS + 1)

    def run(base, marker=None):
        def per_batch(batch, batch_id):
            cars = batch.filter(F.col("key") != R.SENTINEL).withColumn(
                "both", F.get_json_object("value", "$.body").isNotNull()
                & F.get_json_object("value", "$.engine").isNotNull())
            cars.filter("both").select("key", "ts_us").write.mode("overwrite").parquet(
                f"{base}/paired/batch_id={batch_id}")
            if marker and batch_id == 2 and os.path.exists(marker):
                os.remove(marker)
                raise RuntimeError("simulated crash between sink writes")
            cars.filter("not both").select("key", "ts_us").write.mode("overwrite").parquet(
                f"{base}/alone/batch_id={batch_id}")

        src = (spark.readStream.schema(R.TOPIC_SCHEMA).option("maxFilesPerTrigger", 1)
               .parquet(topic))
        stage = R.machine_stream(src, WaitJoin("full", ST.CAR_WAIT_US, "body", "engine"))
        q = (stage.writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()

    def sinks(base):
        return [_rows(spark.read.schema("key string, ts_us long").parquet(f"{base}/{s}"))
                for s in ("paired", "alone")]

    clean = scratch_path(spark, "fb-clean")
    run(clean)
    crashed, marker = scratch_path(spark, "fb-crash"), scratch_path(spark, "fb-marker")
    open(marker, "w").close()
    with pytest.raises(Exception):
        run(crashed, marker)
    run(crashed)  # restart from the same checkpoint
    assert sinks(crashed) == sinks(clean)
    assert sum(len(x) for x in sinks(clean)) > 0


def test_state_partitions_follow_parallelism_not_batch_setting(spark):
    """A stateful query started while the session says 200 shuffle partitions still
    gets the cluster's parallelism as its state partitions (fixed in the checkpoint)."""
    import glob
    from partflow.streaming.machines import First
    e = spark.read.parquet(f"{SF001}/events.parquet").limit(50)
    frame = R.topic_frame(e, "user_id", "body", seq="event_id", payload=["event_type"])
    topic = scratch_path(spark, "sp-topic")
    R.write_time_sliced(spark, frame, topic, 2, 1)
    ckpt = scratch_path(spark, "sp-ckpt")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        R.run_to_end(spark, topic, First(), "sp", checkpoint=ckpt)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    meta = open(sorted(glob.glob(f"{ckpt}/offsets/[0-9]*"))[0]).read()
    n = spark.sparkContext.defaultParallelism
    assert f'"spark.sql.shuffle.partitions":"{n}"' in meta
    assert spark.conf.get("spark.sql.shuffle.partitions") == old


def test_late_row_is_never_dropped_in_silence(spark):
    """A row behind the watermark fails the run and says how many there were."""
    from partflow.streaming.machines import First
    topic = scratch_path(spark, "late-topic")
    for i, sec in enumerate((100, 200, 50)):
        (spark.createDataFrame([("k", "body", sec, 0, "{}")],
                               "key string, side string, s long, seq long, value string")
         .select("key", "side", F.timestamp_seconds("s").alias("ts"), "seq", "value")
         .coalesce(1).write.mode("append").parquet(topic))
        time.sleep(1.1)  # files are read in order of their modification time
    with pytest.raises(RuntimeError, match="1 rows arrived behind the watermark"):
        R.run_to_end(spark, topic, First(), "late")
