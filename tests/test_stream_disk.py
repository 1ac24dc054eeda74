"""What a stream of folds keeps on disk: passes over slots of keys, no superseded state, no topic
twice or longer than it is needed, no shuffle files of queries that are done."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from partflow.plans import streams as ST
from partflow.plans.catalog import QUERIES
from partflow.session import brief_shuffles, scratch_path
from partflow.streaming import incremental as I
from partflow.streaming import runner as R

from data_dirs import SF001
from test_folds import model_cars, random_parts
from test_incremental import PART, assembly, feed, got_cars, part_slices


def counted(monkeypatch, stream):
    """The calls of the stream's passes, by batch."""
    calls, one = [], stream._one_pass

    def seen(*a):
        calls.append(a[-1])
        return one(*a)
    monkeypatch.setattr(stream, "_one_pass", seen)
    return calls


def test_passes_over_slots_give_the_same_cars(spark, monkeypatch):
    """Many passes per micro-batch, their number changing from one to the next, and a crash in the
    second pass: each car once, in the outputs and in a sink."""
    arrivals, _ = random_parts(spark, 41, keys=120)
    slices = part_slices(arrivals, 3)
    base, broken = scratch_path(spark, "passes"), [1]
    monkeypatch.setattr(I, "cores", lambda _: 1)

    def start(rows):
        monkeypatch.setattr(I, "PASS_ROWS", rows)
        stream = I.Incremental(spark, assembly(), f"{base}/tables", tidy=True)

        def publish(outs, batch_id):
            if broken and batch_id == 1 and stream.versions.adding:
                broken.pop()
                raise RuntimeError("simulated crash in the second pass")
            stream.versions.write("sink", batch_id, outs.select("key", "seq"))
        stream.publish = publish
        return stream, counted(monkeypatch, stream)

    first, calls = start(1_000_000)
    feed(spark, first, slices[:1], PART, base, closing=False)
    assert calls == [0]
    second, calls = start(100)
    with pytest.raises(Exception):
        feed(spark, second, slices[1:2], PART, base, closing=False)
    assert calls == [1, 1]
    third, calls = start(170)  # other passes than those that failed
    feed(spark, third, slices[2:], PART, base)
    assert calls.count(1) > 2 and calls.count(2) > 2
    assert got_cars(third.outputs()) == model_cars(arrivals)
    assert third.versions.read("sink", "key string, seq long").count() == \
        third.outputs().count() > 100


def test_state_without_slots_is_dealt_to_passes(spark, monkeypatch):
    """State of an older version has no slot: its rows go to the pass of their key; null keys too."""
    keys = [*map(str, range(40)), None]
    old = spark.createDataFrame([(k, None) for k in keys], "key string, slot int")
    new = old.withColumn("slot", I.slot_of("key"))
    for rows in (old, new):
        got = [[r.key for r in I.in_slots(rows, I.SLOTS * i // 3, I.SLOTS * (i + 1) // 3).collect()]
               for i in range(3)]
        assert sorted(sum(got, []), key=str) == sorted(keys, key=str)
        assert all(got)


def test_large_state_is_written_whole_and_replaced(spark, monkeypatch):
    """Where most state is touched and the keys are many, a micro-batch writes it whole and the
    state before goes."""
    monkeypatch.setattr(I, "FEW_KEYS", 0)
    arrivals, _ = random_parts(spark, 42, keys=80)
    base = scratch_path(spark, "whole")
    stream = I.Incremental(spark, assembly(), f"{base}/tables", tidy=True)
    feed(spark, stream, part_slices(arrivals, 3), PART, base)
    assert got_cars(stream.outputs()) == model_cars(arrivals)
    held = [spark.read.parquet(f"{base}/tables/state/batch_id={b}").count() for b in range(3)]
    assert held[:2] == [0, 0]
    assert {r.base == r.batch_id for r in stream.versions.manifests().collect()} >= {True}


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size())
            if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_their_query(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")

    def written():
        before = shuffle_files(spark)
        rows.groupBy("k").agg(F.collect_list("id")).write.parquet(scratch_path(spark, "sh"))
        return shuffle_files(spark) - before
    assert written()
    with brief_shuffles(spark):
        assert not written()
    assert written()  # as before


def bytes_below(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True))


@pytest.mark.parametrize("policy", ["code", "documented"])
def test_routing_keeps_its_sinks_and_little_else(spark, monkeypatch, policy):
    """after the run there are the sinks; of the topics the last slice; no cars besides
    those in the sinks. Priced cars are computed once for both sinks."""
    base = scratch_path(spark, "routed")
    monkeypatch.setattr(ST, "scratch_path", lambda *_: base)
    priced, price = [], ST.A.price
    monkeypatch.setattr(ST.A, "price", lambda *a, **k: priced.append(1) or price(*a, **k))
    tables = ST.route_job(spark, SF001, policy)
    batches = [r.batch_id for r in tables.manifests().collect()]
    assert len(priced) == len(batches) == ST.SLICES
    for kind in ("body", "engine", "remote", "wheel"):
        parts = glob.glob(f"{base}/topic/{kind}/slice-*/part-*")
        assert {os.path.basename(os.path.dirname(p)) for p in parts} == {
            f"slice-{ST.SLICES - 1:05d}"}
    assert not os.path.exists(f"{base}/tables/out")
    assert all(spark.read.parquet(p).isEmpty() for p in glob.glob(f"{base}/tables/work/*"))
    assert sum(df.count() for df in ST.sinks(tables).values()) == \
        QUERIES["assemble_code"](spark, SF001).count()


def test_assembly_from_the_tables_keeps_no_second_topic(spark, monkeypatch):
    """the topic is cut from the tables, slice by slice; a slice goes once it is taken."""
    stored, topics = [], []
    monkeypatch.setattr(R, "materialize", lambda df, name: stored.append(name) or df)

    def path(_, name, own=I.scratch_path):
        topics.append(own(spark, name))
        return topics[-1]
    monkeypatch.setattr(I, "scratch_path", path)
    got = QUERIES["stream_assemble_documented"](spark, SF001)
    want = QUERIES["assemble_documented"](spark, SF001)
    assert not stored
    slices = [bytes_below(p) for p in sorted(glob.glob(f"{topics[0]}/slice-*"))]
    assert slices[:-1] == [0] * (ST.SLICES - 1) and slices[-1] > 0
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
