"""What a query computes once, so that its time and its shuffles grow with its input only."""

import pytest
from pyspark.sql import functions as F

from partflow.operators import folds
from partflow.plans import assembly as A

from test_folds import cars_of, model_cars, random_parts


def test_a_fold_decides_once_per_event(spark):
    """Lambdas are interpreted: what a step mentions often is evaluated often."""
    t = "struct<ts:timestamp_ntz,seq:bigint>"
    wait = folds.Wait("full", "10 seconds")
    one = spark.sql(f"SELECT CAST(NULL AS {t}) AS x").schema["x"].dataType
    e = folds.event(wait, 0, F.col("x.ts"), F.col("x.seq"), F.col("x"), F.lit(None).cast(one))
    plan = spark.sql(f"SELECT CAST(NULL AS {t}) AS x").select(folds.fold(
        F.array(e), wait, one, one, spark.sql("SELECT TIMESTAMP_NTZ'2000-01-01' t").schema["t"]
        .dataType))._jdf.queryExecution().analyzed().toString()
    assert plan.count("CASE WHEN") < 60  # 118 when every condition was spelled out per field


@pytest.mark.parametrize("steps", [A.in_steps, A.with_remotes])
def test_chained_joins_are_not_counted_one_by_one(spark, monkeypatch, steps):
    """Counting a join's left side computes the joins before it once more."""
    _, parts = random_parts(spark, 4, keys=20)

    def counted(*a):
        raise AssertionError("counted")
    monkeypatch.setattr(folds, "hot_keys", counted)
    assert steps(parts, "10 seconds").count() > 0


def test_hot_and_calm_skus_together(spark):
    """Skus over and under the count in one table, each by its own way; null skus meet nobody."""
    arrivals, parts = random_parts(spark, 6, keys=60)
    lone = parts["body"].limit(1).withColumn("sku", F.lit(None).cast(
        parts["body"].schema["sku"].dataType))
    with_null = {**parts, "body": parts["body"].unionByName(lone)}
    assert cars_of(A.in_steps(parts, "10 seconds", most=6)) == model_cars(arrivals)
    assert A.in_steps(with_null, "10 seconds", most=6).count() == len(model_cars(arrivals)) + 1


def test_patched_cars_are_assembled_once(spark, monkeypatch):
    """One count serves assembly and patch join; hot skus give the same rows."""
    parts = spark.createDataFrame([(i % 7, i, i % 5) for i in range(60)], "sku long, id long, k long")
    parts = parts.withColumn("ts", F.timestamp_seconds(F.col("id") * 3 + 946_684_800).cast(
        "timestamp_ntz")).withColumn("seq", F.col("id"))
    own = ["sku", "id", "ts", "seq"]
    tables = {k: parts.where(F.col("k") == i).select(*own)
              for i, k in enumerate(("body", "engine", "remote"))}
    tables["wheel"] = parts.where("k > 2").select(
        *own, F.col("k").cast("int").alias("ln"), F.lit("FRONT_LEFT").alias("placement"))
    tables["prices"] = parts.select("id", F.col("id").cast("double").alias("price"))
    want = sorted(map(repr, A.patched(tables, "90 seconds", most=1).collect()))

    def counted(*a):
        raise AssertionError("counted")
    monkeypatch.setattr(folds, "hot_keys", counted)
    assert sorted(map(repr, A.patched(tables, "90 seconds").collect())) == want and want


def test_running_count_shuffles_lines_not_words(spark):
    """Lines travel to their bucket whole; only counts travel per word. Null, empty, repeated
    and unordered lines count as by a plain window."""
    from pyspark.sql import Window

    from partflow.operators import text
    lines = [(i, " ".join(["the"] * (i % 5) + [f"w{i % 7}", "", "x"])) for i in range(50)]
    lines += [(3, "the the"), (60, None), (61, ""), (None, "the w1"), (-5, "the  the"), (2000, "x")]
    df = spark.createDataFrame(lines[::-1], "doc_id long, text string").repartition(3)
    for per in (1, 8, 1024):
        got = text.running_word_count(df, docs_per_bucket=per)
        order = Window.partitionBy("word").orderBy("doc_id", "pos")
        want = text.words(df).withColumn("n", F.row_number().over(order).cast("long"))
        same = ["doc_id", "pos", "word", "n"]
        assert sorted(map(repr, got.select(*same).collect())) == sorted(
            map(repr, want.select(*same).collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    explode, moved = plan.index("posexplode"), plan.index("RepartitionByExpression")
    assert explode < moved  # words are taken apart above the exchange of lines


def test_running_totals_of_arrays(spark):
    """Micro-batches of lines give the totals of one batch over all, nulls and repeats too."""
    from partflow.operators import text
    from partflow.functions.scalars import split_words
    from partflow.session import scratch_path
    from partflow.streaming.totals import RunningTotals
    lines = [(i, None if i % 11 == 0 else f"the a{i % 3} the {'b' * (i % 4)}") for i in range(40)]
    v = RunningTotals(spark, scratch_path(spark, "arrays"), "word", ("doc_id",),
                      F.floor(F.col("doc_id") / 4), split_words("text"))
    for i in range(4):
        v.per_batch(spark.createDataFrame(lines[10 * i:10 * i + 10],
                                          "doc_id long, text string"), i)
    got = v.outputs("doc_id long, pos int, word string, n long")
    want = text.running_word_count(spark.createDataFrame(lines, "doc_id long, text string"))
    assert sorted(map(repr, got.collect())) == sorted(
        map(repr, want.select("doc_id", "pos", "word", "n").collect()))


def test_last_rows_over_micro_batches(spark):
    """Few keys with many arrivals: no task holds a key. Replays change nothing, late rows are
    kept apart, null keys and null values count."""
    from pyspark.sql import types as T

    from partflow.session import scratch_path
    from partflow.streaming.tails import LastRows
    rows = [(None if i % 5 == 0 else f"k{i % 2}", i // 2, i, None if i % 7 == 0 else float(i))
            for i in range(120)]
    job = LastRows(spark, scratch_path(spark, "tails"), 3, T.DoubleType())

    def batch(some):
        return spark.createDataFrame(some, "key string, s long, seq long, v double").select(
            "key", F.timestamp_seconds(F.col("s") * 1800).alias("ts"), "seq", "v")
    job.per_batch(batch(rows[:40][::-1]), 0)
    job.versions.write("state", 1, batch(rows[:1]))  # an attempt without manifest
    job.per_batch(batch(rows[40:80]), 1)
    job.per_batch(batch(rows[40:80]), 1)
    job.per_batch(batch([*rows[80:], ("k0", 3, 999, 1.0)]), 2)
    want, seen = set(), {}
    for k, _, seq, v in rows:
        seen[k] = [*seen.get(k, []), v][-3:]
        want.add((k, seq, tuple(seen[k])))
    assert {(r.key, r.seq, tuple(r.vals)) for r in job.outputs().collect()} == want
    assert [r.late for r in job.versions.manifests().orderBy("batch_id").collect()] == [0, 0, 1]
    assert job.versions.read("late", job.rows).collect()[0].seq == 999


def test_state_and_arrivals_meet_in_one_exchange(spark, monkeypatch):
    """Few or many touched keys: the same rows; with many, no join moves state a second time.
    The sinks read what the batch has written."""
    from test_incremental import END, PART, assembly, feed, got_cars, part_slices
    from partflow.session import scratch_path
    from partflow.streaming import incremental as I
    assert END
    arrivals, _ = random_parts(spark, 31, keys=60)
    plans, published = [], []
    for few in (0, 100_000):
        monkeypatch.setattr(I, "FEW_KEYS", few)
        base = scratch_path(spark, "one")
        stream = I.Incremental(spark, assembly(), f"{base}/tables", publish=lambda outs, b:
                               published.append(len(outs.inputFiles())))
        advance = stream._advance

        def seen(*a):
            got = advance(*a)
            plans.append(got._jdf.queryExecution().optimizedPlan().toString())
            return got
        monkeypatch.setattr(stream, "_advance", seen)
        feed(spark, stream, part_slices(arrivals, 3), PART, base)
        assert got_cars(stream.outputs()) == model_cars(arrivals)
        assert few or not any("Join" in p for p in plans)
    assert any("Join" in p for p in plans) and sum(published) > 0
