"""Registered queries: name -> (spark, sf_dir) -> DataFrame. Each reads the driver's
tables (or what Spark derives from them) in full; columns are flat and named as in the
oracle SQL (``partflow.plans.oracle``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.functions.scalars import json_number, kind_label as label_of
from partflow.operators import text
from partflow.operators.pricing import from_table
from partflow.plans import assembly as A
from partflow.plans import events as E
from partflow.plans import streams as S
from partflow.session import scratch_path
from partflow.sinks.topics import encode, write_file_topic
from partflow.sources import fixtures as fx
from partflow.sources.topics import decode, read_file_topic

Query = Callable[[SparkSession, str], DataFrame]


def body_engine_wait_join(spark, sf_dir):
    return A.flat(A.body_engine(fx.car_parts(spark, sf_dir)))


def car_remote_wait_join(spark, sf_dir):
    parts = fx.car_parts(spark, sf_dir)
    return A.flat(A.with_remotes(parts))


def car_wheels_wait_join(spark, sf_dir):
    parts = fx.car_parts(spark, sf_dir)
    return A.flat(A.in_steps(parts))


def _assemble(policy):
    def q(spark, sf_dir):
        return A.flat(A.assemble(fx.car_parts(spark, sf_dir), policy)).drop("wheel_ids")
    q.__name__ = f"assemble_{policy}"
    return q


PRICE_COLS = {"code": ["body_price"],
              "documented": ["body_price", "engine_price", "remote_control_price",
                             "wheel_price"]}


def _price(policy):
    def q(spark, sf_dir):
        parts = fx.car_parts(spark, sf_dir)
        priced = A.price(A.assemble(parts, policy), parts["prices"], policy)
        return priced.select("sku", "ts", "situation", "total_price", *PRICE_COLS[policy])
    q.__name__ = f"price_{policy}"
    return q


def lookup_map_in_pandas(spark, sf_dir):
    parts = fx.car_parts(spark, sf_dir)
    priced = A.price_by_fetch(A.assemble(parts, "documented"), from_table, "documented",
                              table=parts["prices"], delay_s=0.5)
    return priced.select("sku", "ts", "situation", "total_price",
                         *PRICE_COLS["documented"])


def route_counts(spark, sf_dir):
    return A.route_counts(A.routes(spark, sf_dir, "code"))


def replaced_cars(spark, sf_dir):
    """The replacement metric: per sku, cars formed by JN1 that never
    left the assembly because a later car replaced them while waiting ("last wins")."""
    parts = fx.car_parts(spark, sf_dir)
    be = A.body_engine(parts)
    formed = be.groupBy("sku").agg(F.count(F.lit(1)).alias("formed"))
    out = A.cars_per_sku(parts).groupBy("sku").agg(
        F.count(F.lit(1)).alias("assembled"))
    return (formed.join(out, "sku", "left")
            .select("sku", "formed", F.coalesce("assembled", F.lit(0)).cast("long")
                    .alias("assembled"))
            .withColumn("replaced", F.col("formed") - F.col("assembled"))
            .filter(F.col("replaced") > 0))


def word_count(spark, sf_dir):
    return text.word_count(fx.text_lines(spark, sf_dir))


def running_word_count(spark, sf_dir):
    return text.running_word_count(fx.text_lines(spark, sf_dir))


def last_three_tags(spark, sf_dir):
    t = E.last_tax_tags(spark, sf_dir)
    icms = F.transform("taxTags", lambda x: x["icms"])
    return t.select("event_id", F.col("stateName").alias("state"),
                    F.col("n_last").alias("n_tags"),
                    *[F.try_element_at(icms, F.lit(i)).alias(f"icms_{i}") for i in (1, 2, 3)])


def first_per_key(spark, sf_dir):
    return E.first_body(spark, sf_dir)


def latest_value_join(spark, sf_dir):
    return E.latest_view_click(spark, sf_dir)


def priced_wait_join(spark, sf_dir):
    return E.priced_view_purchase(spark, sf_dir)


def patched_view(patched: DataFrame) -> DataFrame:
    first_price = F.try_element_at("wheels", F.lit(1))["part"]["price"]
    return patched.select(
        "sku", "ts", F.size("wheels").cast("long").alias("n_wheels"),
        first_price.alias("wheel_price"),
        F.size(F.filter("wheels", lambda w: w["part"]["price"] == first_price))
        .cast("long").alias("priced_wheels"))


def body_engine_repeated(spark, sf_dir):
    """JN1 with repeated rows on both sides: views and clicks of a user within 6 hours."""
    return E.view_click_pairs(spark, sf_dir)


def priced_wait_join_repeated(spark, sf_dir):
    """JN6 with repeated rows: every view waits 12 hours for a purchase of its user."""
    return E.every_view_purchase(spark, sf_dir)


def part_patch_join(spark, sf_dir):
    return patched_view(A.patched(fx.car_parts(spark, sf_dir)))


def _assemble_ordered(policy):
    """The same by the three operators one after the other (JN1, JN2, JN3), as for skus with
    very many parts."""
    def q(spark, sf_dir):
        cars = A.in_steps(fx.car_parts(spark, sf_dir))
        return A.flat(cars.withColumn("situation", A.situation(policy))).drop("wheel_ids")
    q.__name__ = f"assemble_ordered_{policy}"
    return q


def tags_sink_round_trip(spark, sf_dir):
    """Job B's sink (SNK2): LastTaxTags records keyed by state name, encoded, written,
    read back and decoded strictly; flattened like ``last_three_tags``."""
    from partflow.schemas import LAST_TAX_TAGS
    t = E.last_tax_tags(spark, sf_dir).withColumn("seq", F.col("event_id"))
    path = scratch_path(spark, "topic-last-tax-tags")
    write_file_topic(encode(t, "stateName", F.struct("stateName", "taxTags")), path)
    back = decode(read_file_topic(spark, path), LAST_TAX_TAGS)
    icms = F.transform("record.taxTags", lambda x: x["icms"])
    return back.select(F.col("seq").alias("event_id"), F.col("record.stateName").alias("state"),
                       F.size("record.taxTags").cast("long").alias("n_tags"),
                       *[F.try_element_at(icms, F.lit(i)).alias(f"icms_{i}") for i in (1, 2, 3)])


def text_sink_round_trip(spark, sf_dir):
    """Job C's sink (SNK3): ``word:::n`` lines as plain text values with no key,
    written, read back and parsed into (word, n, line)."""
    wc = text.word_count(fx.text_lines(spark, sf_dir))
    path = scratch_path(spark, "topic-word-count")
    write_file_topic(encode(wc, None, F.col("line"), fmt="text"), path)
    line = decode(read_file_topic(spark, path), None, fmt="text").select(
        F.col("record").alias("line"))
    cut = F.length("line") - F.locate(":::", F.reverse("line")) - 2
    return line.select(F.substring("line", 1, cut).alias("word"),
                       F.substring_index("line", ":::", -1).cast("long").alias("n"), "line")


def sink_fixed_partitions(spark, sf_dir):
    """SNK5: each sink task writes one partition. Per sku, its messages and how many partitions
    hold them: one, since a task holds whole skus; so their order is kept."""
    from partflow.sinks.topics import fixed_partition
    cars = A.flat(A.assemble(fx.car_parts(spark, sf_dir), "code")).drop("wheel_ids")
    path = scratch_path(spark, "topic-fixed")
    write_file_topic(fixed_partition(encode(cars, "sku", F.struct(*cars.columns)), "key",
                                     TOPIC_PARTITIONS), path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("key").cast("string").cast("bigint").alias("sku")).agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.count_distinct("partition").alias("n_partitions"))


TOPIC_PARTITIONS = 12


def priced_wait_join_expiry(spark, sf_dir):
    """ST4: JN6 in which a purchase that has waited a day for a view is gone (event time)."""
    return E.every_view_purchase(spark, sf_dir, keep=E.PURCHASE_KEEP)


def stream_route_records(spark, sf_dir):
    """Job A from part topics to car topics: what the two sinks hold, decoded strictly."""
    from partflow.schemas import CAR
    out = None
    for name, df in S.sinks(S.route_job(spark, sf_dir, "documented")).items():
        part = decode(df, CAR).select(
            F.lit(name).alias("sink"), "key", "ts", "record.*")
        out = part if out is None else out.unionByName(part)
    wheel = F.try_element_at("wheels", F.lit(1))
    return out.select("sink", F.col("key").alias("sku"), "ts", "situation",
                      F.col("totalPrice").alias("total_price"),
                      F.col("body.id").alias("body_id"), F.col("body.color").alias("color"),
                      F.col("body.part.price").alias("body_price"),
                      F.col("engine.id").alias("engine_id"),
                      F.col("engine.part.price").alias("engine_price"),
                      F.col("remoteControl.id").alias("remote_id"),
                      F.col("remoteControl.channelFrequency").alias("frequency"),
                      F.coalesce(F.size("wheels"), F.lit(0)).cast("long").alias("n_wheels"),
                      wheel["part"]["price"].alias("wheel_price"))


def stream_part_patch_join(spark, sf_dir):
    return patched_view(S.part_patch(spark, sf_dir))


def kind_label(spark, sf_dir):
    parts = fx.car_parts(spark, sf_dir)
    kinds = [("BODY", "body"), ("ENGINE", "engine"), ("REMOTE_CONTROL", "remote"),
             ("WHEEL", "wheel")]
    u = None
    for kind, name in kinds:
        k = parts[name].select(F.lit(kind).alias("kind"))
        u = k if u is None else u.unionByName(k)
    return (u.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
            .select("kind", label_of("kind").alias("label"), "n"))


def json_price(spark, sf_dir):
    e = E.events(spark, sf_dir, ("event_id", "props"))
    return e.select("event_id", json_number("props", "k").alias("k"))


def sink_round_trip(spark, sf_dir):
    """Cars encoded to a file topic (key = sku bytes, JSON value), read back and
    decoded strictly: the flat view equals the assembled cars."""
    cars = A.flat(A.assemble(fx.car_parts(spark, sf_dir), "code")).drop("wheel_ids")
    record = F.struct(*[c for c in cars.columns])
    path = scratch_path(spark, "topic-cars")
    write_file_topic(encode(cars, "sku", record), path)
    back = decode(read_file_topic(spark, path), cars.schema)
    return back.select("record.*")


QUERIES: dict[str, Query] = {
    "body_engine_wait_join": body_engine_wait_join,
    "car_remote_wait_join": car_remote_wait_join,
    "car_wheels_wait_join": car_wheels_wait_join,
    "assemble_code": _assemble("code"),
    "assemble_documented": _assemble("documented"),
    "price_code": _price("code"),
    "price_documented": _price("documented"),
    "lookup_map_in_pandas": lookup_map_in_pandas,
    "route_counts": route_counts,
    "replaced_cars": replaced_cars,
    "word_count": word_count,
    "running_word_count": running_word_count,
    "last_three_tags": last_three_tags,
    "first_per_key": first_per_key,
    "latest_value_join": latest_value_join,
    "priced_wait_join": priced_wait_join,
    "body_engine_repeated": body_engine_repeated,
    "priced_wait_join_repeated": priced_wait_join_repeated,
    "part_patch_join": part_patch_join,
    "kind_label": kind_label,
    "json_price": json_price,
    "sink_round_trip": sink_round_trip,
    "tags_sink_round_trip": tags_sink_round_trip,
    "text_sink_round_trip": text_sink_round_trip,
    "sink_fixed_partitions": sink_fixed_partitions,
    "priced_wait_join_expiry": priced_wait_join_expiry,
    "stream_priced_wait_join_expiry": S.priced_wait_join_expiry,
    "stream_body_engine_wait_join": S.body_engine,
    "stream_car_remote_wait_join": S.car_remote,
    "stream_car_wheels_wait_join": S.car_wheels,
    "assemble_ordered_code": _assemble_ordered("code"),
    "assemble_ordered_documented": _assemble_ordered("documented"),
    "stream_assemble_code": S.assemble("code"),
    "stream_assemble_documented": S.assemble("documented"),
    "stream_route_counts": S.route_counts,
    "stream_route_records": stream_route_records,
    "stream_lookup_retries": S.lookup_retries,
    "stream_latest_value_join": S.latest_value_join,
    "stream_last_three_tags": S.last_three_tags,
    "stream_first_per_key": S.first_per_key,
    "stream_priced_wait_join": S.priced_wait_join,
    "stream_word_count": S.word_count,
    "stream_running_word_count": S.running_word_count,
    "stream_part_patch_join": stream_part_patch_join,
}
