"""Command line for the jobs (SURVEY §2.10: the reference takes --brokers,
--registry-url, --enable-checkpoints; here checkpoints are always on).

    python -m partflow.plans.jobs assemble   --tables DIR --out DIR [--policy code|documented]
    python -m partflow.plans.jobs tax-tags   --tables DIR --out DIR
    python -m partflow.plans.jobs word-count --tables DIR --out DIR
    python -m partflow.plans.jobs first-body --tables DIR --out DIR
    python -m partflow.plans.jobs assemble-stream --brokers HOST:PORT --prices PARQUET
            --checkpoint DIR --out DIR --state-partitions N [--trigger "10 seconds"]
            [--registry-framed] [--format avro|json] [--price-id COL] [--price-col COL]

Batch jobs read the driver-style Parquet tables and write Parquet sinks (job A: one
folder per sink). The stream job reads the four part topics from Kafka (the connector
must be on the classpath), assembles, prices and routes continuously.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from partflow.plans import assembly as A
from partflow.plans import events as E
from partflow.plans import streams as S
from partflow.schemas import (EXPECTED_WHEELS, JOIN_WAIT_MS, TOPIC_BODY, TOPIC_ENGINE,
                              TOPIC_REMOTE_CONTROL, TOPIC_WHEEL)
from partflow.session import apply_core_conf, ship_package, state_partitions
from partflow.sources import fixtures as fx
from partflow.sources.topics import consumer_options, read_kafka
from partflow.streaming import runner as R
from partflow.streaming.machines import Assembly
from partflow.operators.text import word_count


def _assemble(spark, a):
    for name, df in A.routes(spark, a.tables, a.policy).items():
        df.write.mode("overwrite").parquet(f"{a.out}/{name}")


def _assemble_stream(spark, a):
    from partflow.operators.sizing import bounded_broadcast
    prices = bounded_broadcast(spark.read.parquet(a.prices).select(
        F.col(a.price_id).alias("id"), F.col(a.price_col).alias("price")))
    sources = {}
    for kind, topic in (("body", TOPIC_BODY), ("engine", TOPIC_ENGINE),
                        ("remote", TOPIC_REMOTE_CONTROL), ("wheel", TOPIC_WHEEL)):
        raw = read_kafka(spark, consumer_options(a.brokers, topic))
        sources[kind] = raw.select("key", "value", F.col("timestamp").alias("ts"),
                                   F.col("offset").alias("seq"))
    frame = S.decoded_frame(sources) if a.format == "json" else _avro_frame(sources, a)
    stage = R.machine_stream(frame, Assembly(a.wait_ms * 1000, EXPECTED_WHEELS, a.policy),
                             time_mode="ProcessingTime")

    def per_batch(batch, batch_id):
        S.write_routed(batch, prices, a.policy, lambda name: f"{a.out}/{name}/batch_id={batch_id}")

    with state_partitions(spark, a.state_partitions):
        q = (stage.writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", a.checkpoint).trigger(processingTime=a.trigger)
             .start())
    q.awaitTermination()


def _avro_frame(sources, a):
    from partflow.sources.topics import decode
    frame = None
    for kind, raw in sources.items():
        d = decode(raw, S.PART_RECORDS[kind], fmt="avro", registry_framed=a.registry_framed)
        f = d.select(F.col("record.part.sku").alias("key"), F.lit(kind).alias("side"),
                     F.col("ts").cast("timestamp").alias("ts"), "seq",
                     F.to_json("record").alias("value"))
        frame = f if frame is None else frame.unionByName(f)
    return frame


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="partflow.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("assemble", "tax-tags", "word-count", "first-body"):
        j = sub.add_parser(name)
        j.add_argument("--tables", required=True)
        j.add_argument("--out", required=True)
        if name == "assemble":
            j.add_argument("--policy", choices=["code", "documented"], default="code")
    st = sub.add_parser("assemble-stream")
    for arg in ("--brokers", "--prices", "--checkpoint", "--out"):
        st.add_argument(arg, required=True)
    st.add_argument("--policy", choices=["code", "documented"], default="code")
    st.add_argument("--format", choices=["avro", "json"], default="avro")
    st.add_argument("--registry-framed", action="store_true")
    st.add_argument("--price-id", default="p_partkey")
    st.add_argument("--price-col", default="p_retailprice")
    st.add_argument("--trigger", default="10 seconds")
    st.add_argument("--state-partitions", type=int, required=True)
    st.add_argument("--wait-ms", type=int, default=JOIN_WAIT_MS)
    a = p.parse_args(argv)

    from pyspark.sql import SparkSession
    spark = SparkSession.builder.appName(f"partflow-{a.job}").getOrCreate()
    apply_core_conf(spark)
    ship_package(spark)
    if a.job == "assemble":
        _assemble(spark, a)
    elif a.job == "tax-tags":
        E.last_tax_tags(spark, a.tables).write.mode("overwrite").parquet(a.out)
    elif a.job == "word-count":
        word_count(fx.text_lines(spark, a.tables)).write.mode("overwrite").parquet(a.out)
    elif a.job == "first-body":
        E.first_body(spark, a.tables).write.mode("overwrite").parquet(a.out)
    else:
        _assemble_stream(spark, a)


if __name__ == "__main__":
    main()
