"""The skew-safe keyed scans equal the plain per-key windows, on the events table with
one key made to hold over a third of all rows (every user_id divisible by 3 mapped to
key 0) and on tiny buckets so that keys span many of them."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from partflow.operators import keyed

from data_dirs import SF01


def _events(spark):
    e = spark.read.parquet(f"{SF01}/events.parquet")
    key = F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    return e.select(key.alias("k"), "ts", F.col("event_id").alias("seq"),
                    F.when(F.col("event_type") == "view", F.col("value")).alias("v"))


def _same(a, b, cols):
    x = a.select(*cols).exceptAll(b.select(*cols)).count()
    y = b.select(*cols).exceptAll(a.select(*cols)).count()
    assert (x, y) == (0, 0)


def test_hot_key_holds_a_third(spark):
    e = _events(spark)
    assert e.filter("k = 0").count() * 3 > e.count()


def test_running_rank(spark):
    e = _events(spark)
    w = Window.partitionBy("k").orderBy("ts", "seq")
    want = e.withColumn("rank", F.row_number().over(w).cast("long"))
    got = keyed.running_rank(e, "k", ["ts", "seq"], keyed.time_bucket("ts", 600))
    _same(got, want, ["k", "seq", "rank"])


def test_last_non_null(spark):
    e = _events(spark)
    w = Window.partitionBy("k").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = e.withColumn("lv", F.last("v", ignorenulls=True).over(w))
    got = keyed.last_non_null(e, "k", ["ts", "seq"], keyed.time_bucket("ts", 600), {"v": "lv"})
    _same(got, want, ["k", "seq", "lv"])


def test_last_n(spark):
    e = _events(spark).withColumn("x", F.col("seq") * 2)
    w = Window.partitionBy("k").orderBy("ts", "seq")
    want = (e.withColumn("prev_1", F.lag("x", 1).over(w)).withColumn("prev_2", F.lag("x", 2).over(w))
            .withColumn("prev_count", F.least(F.row_number().over(w), F.lit(3)).cast("long")))
    got = keyed.last_n(e, "k", ["ts", "seq"], keyed.time_bucket("ts", 300), 3, "x")
    _same(got, want, ["k", "seq", "prev_1", "prev_2", "prev_count"])


def test_first_per_key(spark):
    e = _events(spark)
    w = Window.partitionBy("k").orderBy("ts", "seq")
    want = e.withColumn("is_first", F.row_number().over(w) == 1)
    got = keyed.first_per_key(e, "k", ["ts", "seq"])
    _same(got, want, ["k", "seq", "is_first"])


def test_null_keys_and_times_are_kept(spark):
    """A null key or a null time is a group like any other: no row is dropped, and the
    results equal the plain windows (nulls first in the order)."""
    rows = [(None, 1, 1.0), (None, 2, None), ("a", None, 3.0), ("a", 5, None), ("a", 7, 4.0),
            ("b", 1, None), (None, None, 5.0)]
    e = (spark.createDataFrame(rows, "k string, t long, v double")
         .withColumn("ts", F.timestamp_seconds("t"))
         .withColumn("seq", F.monotonically_increasing_id()).drop("t").cache())
    w = Window.partitionBy("k").orderBy("ts", "seq")
    b = keyed.time_bucket("ts", 2)
    _same(keyed.running_rank(e, "k", ["ts", "seq"], b),
          e.withColumn("rank", F.row_number().over(w).cast("long")), ["k", "seq", "rank"])
    lw = w.rowsBetween(Window.unboundedPreceding, 0)
    _same(keyed.last_non_null(e, "k", ["ts", "seq"], b, {"v": "lv"}),
          e.withColumn("lv", F.last("v", ignorenulls=True).over(lw)), ["k", "seq", "lv"])
    x = e.withColumn("x", F.col("seq") * 2)
    _same(keyed.last_n(x, "k", ["ts", "seq"], b, 3, "x"),
          x.withColumn("prev_1", F.lag("x", 1).over(w)).withColumn("prev_2", F.lag("x", 2).over(w))
          .withColumn("prev_count", F.least(F.row_number().over(w), F.lit(3)).cast("long")),
          ["k", "seq", "prev_1", "prev_2", "prev_count"])
    _same(keyed.first_per_key(e, "k", ["ts", "seq"]),
          e.withColumn("is_first", F.row_number().over(w) == 1), ["k", "seq", "is_first"])
    assert keyed.running_rank(e, "k", ["ts", "seq"], b).count() == len(rows)


@pytest.mark.parametrize("scan", ["rank", "last"])
def test_big_side_is_exchanged_once(spark, scan):
    """With broadcasts off, the rows are exchanged and sorted for the window only; the small
    table of the buckets comes to them."""
    from partflow.operators import keyed
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(1000).select((F.col("id") % 5).cast("string").alias("k"),
                                      F.col("id").alias("seq"), F.lit("payload").alias("p"))
        bucket = F.floor(F.col("seq") / 10)
        out = (keyed.running_rank(df, "k", ["seq"], bucket) if scan == "rank" else
               keyed.last_non_null(df, "k", ["seq"], bucket, {"p": "last_p"}))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    left = plan[plan.index("SortMergeJoin"):].split("\n:- ")[0]
    # The branch of the window holds one exchange; the other ones are of grouped counts.
    exchanges = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert len(exchanges) <= 4 and left
    window = plan[plan.index("Window"):]
    first = window.index("Exchange hashpartitioning")
    assert "Exchange" not in plan[plan.index("SortMergeJoin"):plan.index("Window")]
    assert first > 0
