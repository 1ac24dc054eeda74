"""Jobs B (last three tax tags) and D (first body per sku), and the event fixtures of
JN4 and JN6 (FIXTURES.md §2.2-2.3), batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.operators.latest import first_per_key, last_n, latest_value_join
from partflow.operators.waitjoins import priced_wait_join, wait_join_full
from partflow.schemas import FIRST_BODY_COLOR, LAST_N_TAGS
from partflow.sources import fixtures as fx
from partflow.sources.tables import table

PRICED_WAIT = "12 hours"
PURCHASE_KEEP = "24 hours"


def events(spark: SparkSession, sf_dir: str, cols=("event_id", "ts", "user_id",
                                                   "event_type", "value")) -> DataFrame:
    return table(spark, sf_dir, "events").select(*cols)


def last_tax_tags(spark: SparkSession, sf_dir: str, n: int = LAST_N_TAGS) -> DataFrame:
    """Job B: one LastTaxTags record per tax tag: (stateName, taxTags oldest first)."""
    tags = fx.tax_tags(spark, sf_dir).withColumn("tag", F.struct("icms", "state"))
    out = last_n(tags, "state", "tag", n)
    return out.select(F.col("seq").alias("event_id"), F.col("state").alias("stateName"),
                      F.col(f"last_{n}").alias("taxTags"), "n_last")


def first_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job D on events as bodies (key user_id, colour = event type): the first body of
    each key gets the fixed colour, the others pass unchanged."""
    e = events(spark, sf_dir, ("event_id", "ts", "user_id", "event_type")) \
        .withColumnRenamed("event_id", "seq")
    f = first_per_key(e, "user_id")
    return f.select(F.col("seq").alias("event_id"), "user_id", "is_first",
                    F.when(F.col("is_first"), F.lit(FIRST_BODY_COLOR))
                    .otherwise(F.col("event_type")).alias("color"))


def latest_view_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN4 fixture: key user_id, left = view values, right = click values."""
    e = (events(spark, sf_dir).filter(F.col("event_type").isin("view", "click"))
         .select("user_id", "ts", F.col("event_id").alias("seq"),
                 F.when(F.col("event_type") == "view", F.col("value")).alias("lv"),
                 F.when(F.col("event_type") == "click", F.col("value")).alias("rv")))
    j = latest_value_join(e, "user_id", "lv", "rv")
    return j.select("user_id", F.col("seq").alias("event_id"), "ts",
                    F.col("left_latest").alias("view_value"),
                    F.col("right_latest").alias("click_value"))


def priced_view_purchase(spark: SparkSession, sf_dir: str, within: str = PRICED_WAIT
                         ) -> DataFrame:
    """JN6 fixture: views = unpriced, purchases = priced, 12 hour wait."""
    return every_view_purchase(spark, sf_dir, within).drop("event_id")


VIEW_CLICK_WAIT = "6 hours"


def of_type(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    """All events of a type, as (user_id, ts, seq, value)."""
    return events(spark, sf_dir).filter(F.col("event_type") == event_type).select(
        "user_id", "ts", F.col("event_id").alias("seq"), "value")


def view_click_pairs(spark: SparkSession, sf_dir: str, within: str = VIEW_CLICK_WAIT
                     ) -> DataFrame:
    """JN1 on keys with many rows: a user's views and clicks wait for each other."""
    j = wait_join_full(of_type(spark, sf_dir, "view"), of_type(spark, sf_dir, "click"),
                       "user_id", within, "view", "click")
    return j.select("user_id", "ts", F.col("view.seq").alias("view_id"),
                    F.col("click.seq").alias("click_id"))


def every_view_purchase(spark: SparkSession, sf_dir: str, within: str = PRICED_WAIT,
                        keep: str | None = None) -> DataFrame:
    """JN6 on every view and purchase of a user."""
    j = priced_wait_join(of_type(spark, sf_dir, "view"), of_type(spark, sf_dir, "purchase"),
                         "user_id", within, keep)
    return j.select("user_id", "ts", "situation", F.col("record.seq").alias("event_id"),
                    F.col("record.value").alias("value"))
