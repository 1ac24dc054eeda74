"""T8 for the batch folds: random arrival sequences with repeated parts against the event-queue
model, whole keys, keys cut at quiet gaps, and segments too long for a fold; a key with a third
of all rows; plans without Python."""

import random

import pytest
from pyspark.sql import functions as F

from partflow.operators import folds
from partflow.operators.waitjoins import patch_join, wait_join_full, wait_join_left
from partflow.plans import assembly as A
from partflow.plans.catalog import QUERIES

from data_dirs import SF001
from model import simulate
from test_stream import _random_key

T = 10
EPOCH = 1_700_000_000


def random_parts(spark, seed, keys=200, span=4):
    """Arrivals per key in whole seconds, and the four part tables."""
    rng = random.Random(seed)
    arrivals = {f"k{i}": [(t * span // 4, *rest) for t, *rest in _random_key(rng, T)]
                for i in range(keys)}
    rows = [(k, side, pid, seq, t) for k, arr in arrivals.items() for t, seq, side, pid in arr]
    df = spark.createDataFrame(rows, "sku string, side string, id string, seq long, t long")
    df = df.withColumn("ts", F.timestamp_seconds(F.col("t") + EPOCH).cast("timestamp_ntz"))
    return arrivals, {k: df.where(F.col("side") == k).select("sku", "id", "ts", "seq")
                      for k in ("body", "engine", "remote", "wheel")}


def cars_of(df):
    out = []
    for r in df.collect():
        out.append((r.sku, int((r.ts.replace(tzinfo=None) - __import__("datetime").datetime(
            1970, 1, 1)).total_seconds()) - EPOCH, r.body and r.body.id, r.engine and r.engine.id,
            r.remote and r.remote.id, tuple(w.id for w in r.wheels), r.n_wheels))
    return sorted(out, key=repr)


def model_cars(arrivals):
    return sorted(((k, t, o["body"], o["engine"], o["remote"], tuple(o["wheels"]),
                    len(o["wheels"])) for k, arr in arrivals.items()
                   for t, o in simulate(arr, T)), key=repr)


@pytest.mark.parametrize("most", [None, 4])
def test_folds_equal_the_model(spark, monkeypatch, most):
    """``most=4``: most keys are cut at quiet gaps, and longer segments go row by row."""
    arrivals, parts = random_parts(spark, 3 if most else 5, span=12 if most else 4)
    want = model_cars(arrivals)
    if most:
        monkeypatch.setattr(folds, "MOST", most)
    assert cars_of(A.cars_per_sku(parts, "10 seconds")) == want
    assert cars_of(A.in_steps(parts, "10 seconds")) == want


def test_segments_of_a_hot_key(spark, monkeypatch):
    """A key with over a third of all rows falls into many short segments, and its result is
    that of one fold over the whole key."""
    rng = random.Random(8)
    rows = [("hot", 40 * i + rng.randrange(12), "LR"[rng.random() < 0.5], i)
            for i in range(2500) for _ in range(rng.randrange(3))]
    rows += [(f"k{i % 900}", rng.randrange(400), "LR"[i % 2], i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, s long, side string, seq long").distinct()
    df = df.withColumn("ts", F.timestamp_seconds(F.col("s") + EPOCH).cast("timestamp_ntz"))
    left = df.where("side = 'L'").select("k", "ts", "seq")
    right = df.where("side = 'R'").select("k", "ts", "seq")

    def full():
        return wait_join_full(left, right, "k", "10 seconds")

    def outer():
        return wait_join_left(left, right, "k", "10 seconds")

    monkeypatch.setattr(folds, "MOST", 10**6)
    want = [sorted(map(repr, j().collect())) for j in (full, outer)]
    monkeypatch.setattr(folds, "MOST", 200)
    got = [sorted(map(repr, j().collect())) for j in (full, outer)]
    assert got == want
    for mode in ("full", "left", "collect"):
        wait = folds.Wait(mode, "10 seconds", 4)
        events, _, _ = folds._sides(left, right, "k", wait, ("ts",))
        cut = folds.segments(events.where("k = 'hot'"), "k", wait)
        n = [r["count"] for r in cut.groupBy("_seg").count().collect()]
        assert sum(n) > len(rows) / 4 and len(n) > 400 and max(n) < 60


def test_patch_join_without_limit_in_segments(spark, monkeypatch):
    """Cars and parts wait for ever; the newest of a side waits; a pair is consumed."""
    rng = random.Random(2)
    arr = {f"k{i}": [(t, rng.choice("cp")) for t in range(rng.randrange(14))] for i in range(60)}
    wheel = "struct<part:struct<sku:string,partName:string,price:double,productName:string>>"
    rows = [(k, t, s) for k, x in arr.items() for t, s in x]
    df = spark.createDataFrame(rows, "sku string, seq long, s string").withColumn(
        "ts", F.timestamp_seconds(F.col("seq") + EPOCH))
    none = F.lit(None).cast(wheel)
    cars = df.where("s = 'c'").select(
        "sku", "ts", "seq", none.alias("body"), none.alias("engine"),
        none.alias("remoteControl"), F.array(F.struct(F.struct(
            F.lit("s").alias("sku"), F.lit("WHEEL").alias("partName"), F.lit(0.0).alias("price"),
            F.col("seq").cast("string").alias("productName")).alias("part"))).alias("wheels"))
    parts = df.where("s = 'p'").select("sku", "ts", "seq", F.struct(
        F.lit("s").alias("sku"), F.lit("WHEEL").alias("partName"),
        F.col("seq").cast("double").alias("price"), F.lit("").alias("productName")).alias("part"))
    want = set()
    for k, x in arr.items():
        wait = None
        for t, s in x:
            if wait and wait[1] != s:
                c, p = (wait[0], t) if s == "p" else (t, wait[0])
                want.add((k, t + EPOCH, str(c), float(p)))
                wait = None
            else:
                wait = (t, s)
    for most in (1000, 3):
        monkeypatch.setattr(folds, "MOST", most)
        got = {(r.sku, int(r.ts.timestamp()), r.wheels[0].part.productName,
                r.wheels[0].part.price) for r in patch_join(cars, parts, "sku").collect()}
        assert got == want


@pytest.mark.parametrize("name", ["body_engine_repeated", "priced_wait_join_repeated",
                                  "assemble_ordered_code", "assemble_documented",
                                  "part_patch_join"])
def test_no_python_in_the_plan(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_missing_price_fails_the_car(spark):
    """FAILED_GET_PRICE and MISSING_BODY, which the given tables don't have on every path."""
    ts = F.lit("2024-01-01").cast("timestamp_ntz")
    parts = {k: spark.range(3).select("id", F.col("id").alias("sku"), ts.alias("ts"),
                                      F.lit(0).cast("long").alias("seq"))
             for k in ("body", "engine", "remote")}
    parts["wheel"] = spark.range(12).select(
        "id", (F.col("id") % 3).alias("sku"), ts.alias("ts"), F.col("id").alias("seq"))
    parts["body"] = parts["body"].where("id > 0")
    prices = spark.createDataFrame([(1, 2.005)], "id long, price double")
    got = {r.sku: (r.situation, r.total_price)
           for r in A.price(A.assemble(parts, "code"), prices, "code").collect()}
    assert got == {0: ("MISSING_BODY", 0.0), 1: ("COMPLETE", 2.0), 2: ("FAILED_GET_PRICE", -1.0)}


def brute_left(rows, wait, keep):
    """(key -> [(t, side)] in order) by hand: JN2 whose right rows expire."""
    out = []
    for k, arr in rows.items():
        left = right = None

        def fire(at):
            nonlocal left, right
            if left and left[0] + wait <= at:
                wd = left[0] + wait
                ok = right is not None and right + keep > wd
                out.append((k, wd, left[1], right if ok else None))
                left = right = None
        for t, s in sorted(arr, key=lambda x: (x[0], x[1] == "L")):
            fire(t)
            if s == "R":
                right = t
            elif right is not None and right + keep > t:
                out.append((k, t, t, right))
                right = None
            else:
                left = (left[0], t) if left else (t, t)
        fire(10**9)
    return sorted(map(repr, out))


@pytest.mark.parametrize("most", [10_000, 3])
def test_right_rows_expire(spark, monkeypatch, most):
    """ST4 in event time: folds, segments and the machine, against brute force."""
    monkeypatch.setattr(folds, "MOST", most)
    rng = random.Random(6)
    rows = {f"k{i}": sorted({(rng.randrange(120), rng.choice("LR")) for _ in range(9)})
            for i in range(150)}
    df = spark.createDataFrame([(k, s, t) for k, x in rows.items() for t, s in x],
                               "k string, s string, id long").withColumn(
        "ts", F.timestamp_seconds(F.col("id") + EPOCH))
    left, right = (df.where(F.col("s") == s).drop("s") for s in "LR")
    got = wait_join_left(left, right, "k", "10 seconds", "r", keep="17 seconds")
    assert sorted(repr((r.k, int(r.ts.timestamp()) - EPOCH, r.id, r.r and r.r.id))
                  for r in got.collect()) == brute_left(rows, 10, 17)


def test_each_sink_task_writes_one_partition(spark):
    """SNK5: order and keys kept, and no task's rows in two partitions."""
    from partflow.sinks.topics import encode, fixed_partition
    df = spark.range(400).select((F.col("id") % 37).cast("string").alias("k"), "id",
                                 F.timestamp_seconds("id").alias("ts"), F.col("id").alias("seq"))
    out = fixed_partition(encode(df, "k", F.struct("id")), "key", 3, tasks=7).withColumn(
        "task", F.spark_partition_id()).collect()
    assert len({(r.task, r.partition) for r in out}) == len({r.task for r in out}) <= 7
    assert {r.partition for r in out} == {0, 1, 2}
    by = {}
    for r in out:
        by.setdefault((r.partition, r.key), []).append(r.seq)
    assert len(by) == 37 and all(x == sorted(x) for x in by.values())
