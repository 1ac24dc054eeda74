"""JN7 form 2 on streams, micro-batch by micro-batch, and the cars that its query feeds it."""

from pyspark.sql import functions as F

from data_dirs import SF001


def test_cars_wait_and_settle_by_one_grouping(spark, tmp_path):
    """Cars wait for retries or fail after the last one; a car without a key is kept."""
    from partflow.streaming.lookups import Lookups
    rows = [("a", "1", "2"), (None, "1", "1"), ("b", "3", "1"), ("c", None, "1"), ("d", "9", "1")]
    cars = spark.createDataFrame(
        rows, "sku string, b string, e string").select(
        "sku", F.timestamp_seconds(F.lit(0)).alias("ts"),
        *[F.struct(F.col(c[0]).alias("id")).alias(c) for c in ("body", "engine")])

    def fetch(ids, prices, tries):
        return {i: prices[i] for i in ids if i in prices and (i != "3" or tries > 0)}
    job = Lookups(spark, str(tmp_path / "t"), cars.schema, ["sku"],
                  {"BODY": F.col("body.id"), "ENGINE": F.col("engine.id")}, fetch,
                  spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "id int, price double"),
                  1, "1 day", "5 days")
    batch = cars.select("ts", F.struct("*").alias("car"))
    tick = spark.range(1).select(F.timestamp_seconds(F.lit(86_400)).alias("ts"),
                                 F.lit(None).cast(cars.schema).alias("car"))

    def got():
        return {r.sku: (r.situation, r.total_price, r.body_price, r.engine_price)
                for r in job.outputs().collect()}
    job.per_batch(batch, 0)
    first = {"a": ("COMPLETE", 30.0, 10.0, 20.0), None: ("COMPLETE", 20.0, 10.0, 10.0),
             "c": ("MISSING_BODY", 0.0, None, None)}
    assert got() == first
    job.per_batch(tick, 1)
    assert got() == {**first, "b": ("COMPLETE", 40.0, 30.0, 10.0),
                     "d": ("FAILED_GET_PRICE", -1.0, None, None)}


def test_awaiting_price_is_the_assembly_filtered(spark):
    """The same cars as from the whole assembly, and no fold before the test of the parts."""
    from partflow.plans import assembly as A
    from partflow.sources import fixtures as fx
    parts = fx.car_parts(spark, SF001)
    few, every = A.awaiting_price(parts), A.assemble(parts, "documented").where(
        "situation = 'AWAITING_PRICE'")
    assert few.count() and few.exceptAll(every).isEmpty() and every.exceptAll(few).isEmpty()
