"""T5, T7, T8 for the streams that fold micro-batches: random sequences against the model, a crash
between the writes of two sinks, late rows, state of an older version, replays."""

import random

import pytest
from pyspark.sql import functions as F

from partflow.operators.folds import Wait
from partflow.session import scratch_path
from partflow.streaming import incremental as I
from partflow.streaming.totals import RunningTotals

from test_folds import EPOCH, T, model_cars, random_parts

PART = {k: "id string" for k in ("body", "engine", "remote", "wheel")}
END = 10_000


def assembly():
    return I.AssemblyJob("10 seconds", 4, {k: I.payload_type(t) for k, t in PART.items()})


def topic_rows(spark, rows):
    """(key, side, second, seq, value) as a topic frame."""
    return spark.createDataFrame(rows, "key string, side string, s long, seq long, value string"
                                 ).select("key", "side", F.timestamp_seconds(
                                     F.col("s") + EPOCH).alias("ts"), "seq", "value")


def feed(spark, stream, slices, kinds, base, closing=True):
    """Each slice is a micro-batch of its own; the last one is past every deadline."""
    from partflow.streaming.runner import SENTINEL, TOPIC_SCHEMA
    if closing:
        slices = [*slices, [(SENTINEL, SENTINEL, END, 0, "{}")]]
    for part in slices:
        topic_rows(spark, part).coalesce(1).write.mode("append").parquet(f"{base}/topic")
        source = spark.readStream.schema(TOPIC_SCHEMA).parquet(f"{base}/topic")
        stream.run(I.typed(source, kinds), f"{base}/ckpt")


def part_slices(arrivals, n):
    rows = sorted(((k, side, t, seq, f'{{"id":"{pid}"}}') for k, arr in arrivals.items()
                   for t, seq, side, pid in arr), key=lambda r: r[2])
    cuts = [rows[len(rows) * i // n][2] for i in range(1, n)]
    edges = [-1, *cuts, END]
    out = [[r for r in rows if a <= r[2] < b] for a, b in zip(edges, edges[1:])]
    random.Random(0).shuffle(out[0])  # order within a micro-batch says nothing
    return out


def got_cars(df):
    return sorted(((r.key, int(r.ts.timestamp()) - EPOCH, r.body and r.body.id,
                    r.engine and r.engine.id, r.remote and r.remote.id,
                    tuple(w.id for w in r.wheels), len(r.wheels)) for r in df.collect()),
                  key=repr)


def test_assembly_in_micro_batches_equals_the_model(spark):
    arrivals, _ = random_parts(spark, 21, keys=150)
    for n in (1, 4):
        base = scratch_path(spark, "inc")
        stream = I.Incremental(spark, assembly(), f"{base}/tables")
        feed(spark, stream, part_slices(arrivals, n), PART, base)
        assert got_cars(stream.outputs()) == model_cars(arrivals)
        assert stream.late().count() == 0


def test_out_of_order_rows_within_the_lateness(spark):
    """Rows up to the lateness behind are taken in their order."""
    arrivals, _ = random_parts(spark, 22, keys=60)
    rows = [r for part in part_slices(arrivals, 1) for r in part]
    rng = random.Random(1)
    rows.sort(key=lambda r: r[2] + rng.randrange(8))
    slices = [rows[i::1][j:j + len(rows) // 5 + 1]
              for i in (0,) for j in range(0, len(rows), len(rows) // 5 + 1)]
    base = scratch_path(spark, "inc")
    stream = I.Incremental(spark, assembly(), f"{base}/tables", lateness="9 seconds")
    feed(spark, stream, slices, PART, base)
    assert got_cars(stream.outputs()) == model_cars(arrivals)


def test_crash_between_two_sinks_shows_neither(spark):
    """Both sinks of a batch, its outputs and its state become visible together."""
    arrivals, _ = random_parts(spark, 23, keys=60)
    slices = part_slices(arrivals, 3)

    def run(base, fail):
        stream = I.Incremental(spark, assembly(), f"{base}/tables")

        def publish(outs, batch_id):
            cars = outs.select("key", "seq", F.size("wheels").alias("n"))
            stream.versions.write("some", batch_id, cars.where("n > 0"))
            if fail and batch_id == 1:
                fail.pop()
                raise RuntimeError("simulated crash between two sinks")
            stream.versions.write("none", batch_id, cars.where("n = 0"))
        stream.publish = publish
        return stream

    def sinks(stream):
        return [sorted(map(tuple, stream.versions.read(x, "key string, seq long, n int")
                           .collect())) for x in ("some", "none")]

    clean = run(scratch_path(spark, "clean"), [])
    feed(spark, clean, slices, PART, clean.path)
    base = scratch_path(spark, "crash")
    broken = run(base, [1])
    feed(spark, broken, slices[:1], PART, base, closing=False)
    first = sinks(broken)
    with pytest.raises(Exception):
        feed(spark, broken, slices[1:2], PART, base, closing=False)
    assert sinks(broken) == first  # half a batch is written, and none of it is seen
    resumed = run(base, [])
    feed(spark, resumed, slices[2:], PART, base)
    assert sinks(resumed) == sinks(clean) and sum(map(len, sinks(clean))) > 100
    assert got_cars(resumed.outputs()) == model_cars(arrivals)


def wait_job(left="id string"):
    return I.WaitJob(Wait("full", "10 seconds"), "l", I.payload_type(left), "r",
                     I.payload_type("id string"))


def test_late_rows_are_kept_and_counted(spark):
    base = scratch_path(spark, "late")
    stream = I.Incremental(spark, wait_job(), f"{base}/tables")
    kinds = {"l": "id string", "r": "id string"}
    feed(spark, stream, [[("a", "l", 100, 0, '{"id":"1"}'), ("b", "l", 120, 0, '{"id":"2"}')],
                         [("a", "r", 105, 0, '{"id":"late"}'), ("b", "r", 121, 0, '{"id":"3"}')]],
         kinds, base)
    late = stream.late().collect()
    assert [(r.key, r.side) for r in late] == [("a", "r")] and '"late"' in late[0].value
    assert {r.late for r in stream.versions.manifests().collect()} == {0, 1}
    got = {(r.key, int(r.ts.timestamp()) - EPOCH, r.l and r.l.id, r.r and r.r.id)
           for r in stream.outputs().collect()}
    assert got == {("a", 110, "1", None), ("b", 121, "2", "3")}


def test_restart_from_the_state_of_an_older_version(spark):
    """A later version's left rows have a further field: null in rows that waited before."""
    base = scratch_path(spark, "older")
    old = I.Incremental(spark, wait_job(), f"{base}/tables")
    feed(spark, old, [[("a", "l", 100, 0, '{"id":"1"}'), ("b", "l", 101, 0, '{"id":"2"}')]],
         {"l": "id string", "r": "id string"}, base, closing=False)
    new = I.Incremental(spark, wait_job("id string, color string"), f"{base}/tables", version=2)
    feed(spark, new, [[("a", "r", 104, 0, '{"id":"3"}'),
                       ("c", "l", 105, 0, '{"id":"4","color":"red"}')]],
         {"l": "id string, color string", "r": "id string"}, base)
    got = {(r.key, r.l.id, r.l.color, r.r and r.r.id) for r in new.outputs().collect()}
    assert got == {("a", "1", None, "3"), ("b", "2", None, None), ("c", "4", "red", None)}
    assert {r.version for r in new.versions.manifests().collect()} == {1, 2}


def test_running_totals_survive_replays(spark):
    """A batch that is run again changes nothing; one that failed before its manifest is done
    anew; a key with most rows is numbered over buckets."""
    v = RunningTotals(spark, scratch_path(spark, "totals"), "w", ("d", "p"),
                      F.floor(F.col("d") / 3))
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", "x", "y", None]), d, p)
            for d in range(60) for p in range(5)]
    batches = [spark.createDataFrame(rows[a:a + 100], "w string, d int, p int")
               for a in (0, 100, 200)]
    v.per_batch(batches[0], 0)
    v.versions.write("totals", 1, batches[0].groupBy("w").agg(F.lit(7).cast("long").alias("n")))
    v.per_batch(batches[1], 1)  # the attempt above has no manifest
    v.per_batch(batches[1], 1)
    v.per_batch(batches[2], 2)
    seen, want = {}, set()
    for w, d, p in rows:
        seen[w] = seen.get(w, 0) + 1
        want.add((w, d, p, seen[w]))
    assert {(r.w, r.d, r.p, r.n) for r in v.outputs("w string, d int, p int, n long").collect()
            } == want


def test_state_holds_changes_and_is_written_whole_now_and_then(spark):
    """A micro-batch writes the keys that it touches: by an arrival, or because they are due. A
    settled key is marked; the batch that compacts leaves such keys out."""
    base = scratch_path(spark, "changes")
    kinds = {"l": "id string", "r": "id string"}
    job = I.WaitJob(Wait("left", "10 seconds", keep="1 minute"), "l", I.payload_type("id string"),
                    "r", I.payload_type("id string"))
    stream = I.Incremental(spark, job, f"{base}/tables", compact=3)
    value = '{"id":"%s"}'
    waiting = [(f"k{i}", "r", 100, i, value % f"r{i}") for i in range(5)]
    feed(spark, stream, [
        [*waiting, ("due", "l", 100, 9, value % "d"), (None, "r", 101, 9, value % "n")],
        [("k0", "l", 105, 0, value % "a"), ("other", "l", 115, 1, value % "o")],
        [("k1", "l", 116, 0, value % "b"), (None, "l", 117, 0, value % "m")],
        [("k2", "l", 118, 0, value % "c"), ("k0", "l", 119, 1, value % "e")]],
        kinds, base, closing=False)

    def state(batch):
        rows = spark.read.parquet(f"{base}/tables/state/batch_id={batch}").collect()
        return {r.key for r in rows if not r.gone}, {r.key for r in rows if r.gone}
    # Rows at the horizon (the newest arrival) wait in the state until it has passed them.
    assert state(0) == ({*(f"k{i}" for i in range(5)), "due", None}, set())
    assert state(1) == ({"other", None}, {"k0", "due"})
    assert state(2) == ({"other", None}, {"k1"})
    assert state(3) == ({"k0", "k3", "k4", "other"}, set())
    bases = {r.batch_id: r.base for r in stream.versions.manifests().collect()}
    assert bases == {0: 0, 1: 0, 2: 0, 3: 3}
    feed(spark, stream, [], kinds, base)
    got = {(r.key, r.l.id, r.r and r.r.id) for r in stream.outputs().collect()}
    assert got == {("k0", "a", "r0"), ("due", "d", None), ("other", "o", None),
                   ("k1", "b", "r1"), (None, "m", "n"), ("k2", "c", "r2"), ("k0", "e", None)}
    # The closing row has no payload; right rows that nobody took have expired.
    assert state(4) == (set(), {"k0", "k3", "k4", "other"})
