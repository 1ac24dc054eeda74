"""T2 on the batch closed forms (FIXTURES.md §3 hand cases) and T6 conservation."""

import datetime as dt

from pyspark.sql import functions as F

from partflow.operators.routing import route
from partflow.operators.waitjoins import (collect_join, patch_join, priced_wait_join,
                                          wait_join_full, wait_join_left)
from partflow.plans import assembly as A
from partflow.plans.catalog import QUERIES
from partflow.sources import fixtures as fx

from data_dirs import SF01

T0 = dt.datetime(2024, 1, 1)


def at(sec):
    return T0 + dt.timedelta(seconds=sec)


def side(spark, rows):
    return spark.createDataFrame([(k, at(t), i) for k, t, i in rows],
                                 "k string, ts timestamp, id string")


def test_full_wait_join_cases(spark):
    b = side(spark, [("a", 0, "b"), ("c", 0, "b")])
    e = side(spark, [("a", 4.999, "e"), ("c", 5, "e")])
    got = {(r.k, r.ts, r.body and r.body.id, r.engine and r.engine.id)
           for r in wait_join_full(b, e, "k", "5 seconds", "body", "engine").collect()}
    assert got == {("a", at(4.999), "b", "e"), ("c", at(5), "b", None),
                   ("c", at(10), None, "e")}


def test_left_wait_join_remote_early_during_late(spark):
    cars = spark.createDataFrame([(k, at(10)) for k in "xyz"], "k string, ts timestamp")
    rc = side(spark, [("x", 8, "r"), ("y", 12, "r"), ("z", 16, "r")])
    got = {(r.k, r.ts, r.remote and r.remote.id)
           for r in wait_join_left(cars, rc, "k", "5 seconds", "remote").collect()}
    assert got == {("x", at(10), "r"), ("y", at(15), "r"), ("z", at(15), None)}


def test_collect_join_cases(spark):
    cars = spark.createDataFrame([("four", at(5)), ("five", at(6)), ("two", at(3)),
                                  ("none", at(3))], "k string, ts timestamp")
    rows = ([("four", t, f"w{t}") for t in (1, 2, 3, 4)] +
            [("five", t, f"w{t}") for t in (1, 2, 3, 4, 5)] +
            [("two", t, f"w{t}") for t in (1, 2)])
    got = {(r.k, r.ts, r.n_wheels)
           for r in collect_join(cars, side(spark, rows), "k", "5 seconds", 4,
                                 "wheels").collect()}
    assert got == {("four", at(5), 4), ("five", at(11), 5), ("two", at(8), 2),
                   ("none", at(8), 0)}


def test_priced_wait_join(spark):
    u = spark.createDataFrame([("a", at(0), 1.0), ("b", at(0), 1.0), ("c", at(10), 1.0)],
                              "k string, ts timestamp, value double")
    p = spark.createDataFrame([("a", at(3), 2.0), ("c", at(9), 2.0)],
                              "k string, ts timestamp, value double")
    got = {(r.k, r.ts, r.situation, r.record.value)
           for r in priced_wait_join(u, p, "k", "5 seconds").collect()}
    assert got == {("a", at(5), "COMPLETE", 2.0), ("b", at(5), "AWAITING_PRICE", 1.0),
                   ("c", at(10), "COMPLETE", 2.0)}


def test_patch_join_sets_wheel_price(spark):
    parts = fx.car_parts(spark, SF01)
    cars = A.to_record(A.assemble(parts, "code").filter(F.col("n_wheels") == 4))
    out = patch_join(cars, A.wheel_price_parts(parts), "sku").collect()
    assert out
    for r in out:
        prices = {w.part.price for w in r.wheels}
        assert len(prices) == 1 and prices.pop() > 0


def test_route_conservation(spark):
    """T6: every car that JN1 forms is routed to one sink or was replaced while it waited."""
    parts = fx.car_parts(spark, SF01)
    formed = A.body_engine(parts).count()
    replaced = QUERIES["replaced_cars"](spark, SF01).agg(F.sum("replaced")).first()[0]
    asm = A.assemble(parts, "code")
    assert asm.count() == formed - replaced > 15_000
    routed = route(asm, A.price(asm, parts["prices"], "code"))
    keys = routed["complete"].select(*A.car_key(asm)).unionByName(
        routed["incomplete"].select(*A.car_key(asm)))
    assert keys.count() == keys.distinct().count() == formed - replaced
    counts = {(r.sink, r.situation): r.n for r in QUERIES["route_counts"](spark, SF01).collect()}
    assert sum(counts.values()) == formed - replaced


def test_full_wait_join_repeated_rows(spark):
    """A newer row replaces a waiting one and keeps its deadline; a match consumes both."""
    b = side(spark, [("a", 0, "A"), ("a", 30, "B"), ("r", 0, "A"), ("r", 3, "B"),
                     (None, 0, "n")])
    e = side(spark, [("a", 1, "e"), ("r", 9, "e"), ("one", 2, "e")])
    got = {(r.k, r.ts, r.body and r.body.id, r.engine and r.engine.id)
           for r in wait_join_full(b, e, "k", "5 seconds", "body", "engine").collect()}
    assert got == {("a", at(1), "A", "e"), ("a", at(35), "B", None), ("r", at(5), "B", None),
                   ("r", at(14), None, "e"), ("one", at(7), None, "e"),
                   (None, at(5), "n", None)}


def test_left_wait_join_repeated_rows(spark):
    """Two cars and three remotes of one key: three remotes, the last one stored wins; no
    pair is made twice."""
    cars = spark.createDataFrame([("x", at(10), "c1"), ("x", at(20), "c2"), ("y", at(1), "c")],
                                 "k string, ts timestamp, car string")
    rc = side(spark, [("x", 7, "r1"), ("x", 8, "r2"), ("x", 12, "r3"), ("y", 3, "r")])
    got = {(r.k, r.ts, r.car, r.remote and r.remote.id)
           for r in wait_join_left(cars, rc, "k", "5 seconds", "remote").collect()}
    assert got == {("x", at(10), "c1", "r2"), ("x", at(20), "c2", "r3"), ("y", at(6), "c", "r")}


def test_collect_join_repeated_cars(spark):
    """The second car of a key finds only what came after the first one left; four lines and
    a fifth make a car wait."""
    cars = spark.createDataFrame([("x", at(5), 1), ("x", at(20), 2), ("z", at(6), 3)],
                                 "k string, ts timestamp, car int")
    rows = [("x", t, f"w{t}") for t in (1, 2, 3, 4, 21)] + [("z", t, "w") for t in range(1, 6)]
    got = {(r.k, r.ts, r.car, r.n_wheels, len(r.wheels))
           for r in collect_join(cars, side(spark, rows), "k", "5 seconds", 4,
                                 "wheels").collect()}
    assert got == {("x", at(5), 1, 4, 4), ("x", at(25), 2, 1, 1), ("z", at(11), 3, 5, 5)}


def test_no_pairwise_join_on_repeated_keys(spark):
    """1,000 rows a side on one key: as many matches as rows, not a million."""
    b = side(spark, [("hot", i, f"b{i}") for i in range(1000)])
    e = side(spark, [("hot", i + 0.5, f"e{i}") for i in range(1000)])
    out = wait_join_full(b, e, "k", "5 seconds", "body", "engine")
    assert out.count() == 1000
    assert out.filter("body is null or engine is null").count() == 0
