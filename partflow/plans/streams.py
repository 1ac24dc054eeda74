"""Structured Streaming forms of the jobs: each builds its input topics
from the driver's tables (written as time-sliced file topics in the shared folder),
runs the stateful stage to the end with ``availableNow`` and reads the sink back.

Job C (word count) uses Spark's own streaming aggregation in ``update`` mode; job A's
routing uses ``foreachBatch``, writing each sink's slice of a micro-batch under its
batch id (a replayed batch overwrites its own files: idempotent)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.operators.folds import Wait
from partflow.operators.routing import route
from partflow.operators.waitjoins import apply_patch
from partflow.plans import assembly as A
from partflow.plans import events as E
from partflow.schemas import (BODY, CAR, ENGINE, EXPECTED_WHEELS, FIRST_BODY_COLOR, LAST_N_TAGS,
                              REMOTE_CONTROL, WHEEL)
from partflow.sinks.topics import encode
from partflow.sources.topics import FILE_TOPIC_SCHEMA, decode, read_file_topic
from partflow.session import scratch_path, state_partitions
from partflow.sources import fixtures as fx
from partflow.streaming import incremental as I
from partflow.streaming import runner as R
from partflow.streaming.machines import First, Latest
from partflow.streaming.tails import LastRows

# Waits on the machine clock (microseconds) and in milliseconds for topic horizons.
DAY_US = 86_400_000_000
CAR_WAIT_US = 700 * DAY_US
PRICED_WAIT_US = 12 * 3_600_000_000
CAR_WAIT_MS = CAR_WAIT_US // 1000
PRICED_WAIT_MS = PRICED_WAIT_US // 1000
ASM_HORIZON_MS = 3 * CAR_WAIT_MS + 1  # three waits in a chain
TEXT_EPOCH = 946_684_800  # 2000-01-01 in seconds: documents "arrive" from there
SLICES = 3
DOCS_PER_BUCKET = 1024


def _j(path: str, typ: str = "bigint"):
    return F.get_json_object("value", path).cast(typ)


def _ntz(c: str = "ts"):
    return F.col(c).cast("timestamp_ntz").alias("ts")


def _situation_jn1():
    return (F.when(F.col("body_id").isNull(), F.lit("MISSING_BODY"))
            .when(F.col("engine_id").isNull(), F.lit("MISSING_ENGINE"))
            .otherwise(F.lit("INCOMPLETE")))


def wait_stream(spark, frame: DataFrame, wait: Wait, left: tuple[str, str],
                right: tuple[str, str], name: str, horizon_ms: int) -> DataFrame:
    """A wait-join over a sliced topic frame; ``left`` and ``right``: side and value type."""
    job = I.WaitJob(wait, left[0], I.payload_type(left[1]), right[0], I.payload_type(right[1]))
    return I.run_sliced(spark, frame, job, dict([left, right]), name, SLICES,
                        horizon_ms).outputs()


def body_engine(spark, sf_dir):
    parts = fx.car_parts(spark, sf_dir)
    frame = R.topic_frame(parts["body"], "sku", "body", "seq", payload=["id"]).unionByName(
        R.topic_frame(parts["engine"], "sku", "engine", "seq", payload=["id"]))
    out = wait_stream(spark, frame, Wait("full", fx.CAR_WAIT), ("body", "id bigint"),
                      ("engine", "id bigint"), "jn1", CAR_WAIT_MS + 1)
    flat = out.select(F.col("key").cast("bigint").alias("sku"), F.col("l.id").alias("body_id"),
                      F.col("r.id").alias("engine_id"), _ntz())
    return flat.withColumn("situation", _situation_jn1())


def car_remote(spark, sf_dir):
    """JN2 on its own: the cars (batch JN1 output) wait for the remote."""
    parts = fx.car_parts(spark, sf_dir)
    cars = A.body_engine(parts).select(
        "sku", "ts", "seq", F.col("body.id").alias("body_id"),
        F.col("engine.id").alias("engine_id"))
    frame = R.topic_frame(cars, "sku", "car", "seq", payload=["body_id", "engine_id"]
                          ).unionByName(
        R.topic_frame(parts["remote"], "sku", "remote", "seq", payload=["id"]))
    out = wait_stream(spark, frame, Wait("left", fx.CAR_WAIT),
                      ("car", "body_id bigint, engine_id bigint"), ("remote", "id bigint"),
                      "jn2", 2 * CAR_WAIT_MS + 1)
    return out.select(F.col("key").cast("bigint").alias("sku"), "l.body_id", "l.engine_id",
                      F.col("r.id").alias("remote_id"), _ntz())


def car_wheels(spark, sf_dir):
    """JN3 on its own: the cars (batch JN1 + JN2 output) collect wheels, four expected."""
    parts = fx.car_parts(spark, sf_dir)
    cars = A.with_remotes(parts).select(
        "sku", "ts", "seq", F.col("body.id").alias("body_id"),
        F.col("engine.id").alias("engine_id"), F.col("remote.id").alias("remote_id"))
    frame = R.topic_frame(cars, "sku", "car", "seq",
                          payload=["body_id", "engine_id", "remote_id"]).unionByName(
        R.topic_frame(parts["wheel"], "sku", "wheel", "seq", payload=["id", "ln"]))
    out = wait_stream(spark, frame, Wait("collect", fx.CAR_WAIT, EXPECTED_WHEELS),
                      ("car", "body_id bigint, engine_id bigint, remote_id bigint"),
                      ("wheel", "id bigint, ln int"), "jn3", 3 * CAR_WAIT_MS + 1)
    return out.select(F.col("key").cast("bigint").alias("sku"), "l.body_id", "l.engine_id",
                      "l.remote_id", F.size("r").cast("long").alias("n_wheels"),
                      F.concat_ws(",", F.transform("r", lambda w: w["id"].cast("string")))
                      .alias("wheel_ids"), _ntz())


def assembly_frame(spark, sf_dir) -> DataFrame:
    parts = fx.car_parts(spark, sf_dir)
    frame = (R.topic_frame(parts["body"], "sku", "body", "seq", payload=["id"])
             .unionByName(R.topic_frame(parts["engine"], "sku", "engine", "seq", payload=["id"]))
             .unionByName(R.topic_frame(parts["remote"], "sku", "remote", "seq", payload=["id"]))
             .unionByName(R.topic_frame(parts["wheel"], "sku", "wheel", "seq",
                                        payload=["id", "ln", "placement"])))
    return frame


#: The values of ``assembly_frame``.
PART_VALUES = {"body": "id bigint", "engine": "id bigint", "remote": "id bigint",
               "wheel": "id bigint, ln int, placement string"}


def assembly_job(values: dict, within: str = fx.CAR_WAIT) -> I.AssemblyJob:
    return I.AssemblyJob(within, EXPECTED_WHEELS,
                         {k: I.payload_type(t) for k, t in values.items()})


def assembled_cars(out: DataFrame) -> DataFrame:
    """Machine output of job A on ``assembly_frame`` back to the batch car shape."""
    x = F.from_json("value", "struct<body:struct<id:bigint>,engine:struct<id:bigint>,"
                             "remote:struct<id:bigint>,wheels:array<struct<id:bigint,ln:int,"
                             "placement:string>>,n_wheels:bigint,situation:string>")
    return out.select(F.col("key").cast("bigint").alias("sku"), "ts", x.alias("x")).select(
        "sku", "ts", "x.*")


def cars_of(out: DataFrame, policy: str) -> DataFrame:
    """Outputs of the assembly stage in the batch car shape; skus stay text."""
    return out.select(F.col("key").alias("sku"), _ntz(), "seq", "body", "engine", "remote",
                      "wheels", F.size("wheels").cast("long").alias("n_wheels")).withColumn(
        "situation", A.situation(policy))


def whole_cars(out: DataFrame) -> DataFrame:
    """Machine output of job A on part records: cars with every field of their parts. Skus
    and ids stay text."""
    kinds = ", ".join(f"{k}: {v.simpleString()}" for k, v in (
        ("body", BODY), ("engine", ENGINE), ("remote", REMOTE_CONTROL)))
    x = F.from_json("value", f"struct<{kinds}, wheels: array<{WHEEL.simpleString()}>, "
                             "n_wheels: bigint, situation: string>")
    return out.select(F.col("key").alias("sku"), "ts", x.alias("x")).select("sku", "ts", "x.*")


def assemble(policy: str):
    """Job A, assembly stage, every sku."""
    def q(spark, sf_dir):
        out = I.run_sliced(spark, assembly_frame(spark, sf_dir), assembly_job(PART_VALUES),
                           PART_VALUES, f"asm-{policy}", SLICES, ASM_HORIZON_MS,
                           stored=False).outputs()
        cars = cars_of(out, policy).withColumn("sku", F.col("sku").cast("bigint"))
        return A.flat(cars).drop("wheel_ids")
    q.__name__ = f"stream_assemble_{policy}"
    return q


def part_patch(spark, sf_dir):
    """JN5 streaming: cars and priced parts wait for each other without limit; each pair
    leaves at the later arrival and the part is patched into the car."""
    parts = fx.car_parts(spark, sf_dir)
    cars = A.to_record(A.assemble(parts, "code"))
    priced = A.wheel_price_parts(parts)
    record = [c for c in cars.columns if c not in ("sku", "ts", "seq")]
    frame = (R.topic_frame(cars, "sku", "car", "seq", payload=record)
             .unionByName(R.topic_frame(priced, "sku", "part", "seq", payload=["part"])))
    sides = {"car": cars.select(*record).schema, "part": priced.select("part").schema}
    job = I.WaitJob(Wait("full", None), "car", I.payload_type(sides["car"]), "part",
                    I.payload_type(sides["part"]))
    out = I.run_sliced(spark, frame, job, sides, "jn5", SLICES, 1).outputs()
    pairs = out.select(F.col("key").cast("bigint").alias("sku"), _ntz(), F.col("l").dropFields(
        "ts", "seq").alias("c"), F.col("r.part").alias("part"))
    return apply_patch(pairs.select("sku", "ts", "c.*", "part")).drop("part")


PART_RECORDS = {"body": BODY, "engine": ENGINE, "remote": REMOTE_CONTROL, "wheel": WHEEL}
PART_KIND = {"body": "BODY", "engine": "ENGINE", "remote": "REMOTE_CONTROL", "wheel": "WHEEL"}


def _part(kind: str):
    return F.struct(F.concat(F.lit("SKU-"), F.col("sku")).alias("sku"),
                    F.lit(PART_KIND[kind]).alias("partName"), F.lit(0.0).alias("price"),
                    F.lit("").alias("productName"))


def encoded_part_topics(parts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four part topics as the reference's producers would fill them: key = sku
    bytes, value = the encoded Body / Engine / RemoteControl / Wheel record (SNK1). Skus
    and part ids are text that is no number, as the schemas allow."""
    pid = F.concat(F.lit("P-"), F.col("id")).alias("id")
    records = {
        "body": F.struct(_part("body").alias("part"), pid,
                         F.concat(F.lit("color-"), F.col("id") % 7).alias("color"),
                         F.lit("PLASTIC").alias("material"),
                         (F.col("id") % 100 / 10).cast("float").alias("weight")),
        "engine": F.struct(_part("engine").alias("part"), pid),
        "remote": F.struct(_part("remote").alias("part"), pid,
                           F.lit("RF_27").alias("channelFrequency")),
        "wheel": F.struct(_part("wheel").alias("part"), pid, F.col("placement")),
    }
    out = {}
    for kind, rec in records.items():
        if kind not in parts:
            continue
        out[kind] = encode(parts[kind], F.concat(F.lit("SKU-"), F.col("sku")), rec)
    return out


def decoded_frame(sources: dict[str, DataFrame]) -> DataFrame:
    """Decode each part topic strictly (SRC7) and key it by ``part.sku`` as the
    reference does: the topic frame of the assembly stage."""
    frame = None
    for kind, raw in sources.items():
        d = decode(raw, PART_RECORDS[kind])
        f = d.select(F.col("record.part.sku").alias("key"), F.lit(kind).alias("side"),
                     F.col("ts").cast("timestamp").alias("ts"), "seq",
                     F.to_json("record").alias("value"))
        frame = f if frame is None else frame.unionByName(f)
    return frame


def priced_and_routed(cars: DataFrame, prices: DataFrame, policy: str, once=lambda df: df
                      ) -> dict[str, DataFrame]:
    """Assembled cars of a micro-batch: priced, routed and encoded as car messages, by sink.
    ``once`` may store the priced cars, which both sinks take theirs from."""
    priced = once(A.with_part_prices(A.price(cars, prices, policy, check_size=False)))
    return {name: A.car_messages(df) for name, df in route(cars, priced).items()}


def write_routed(batch: DataFrame, prices: DataFrame, policy: str, path_of) -> None:
    """One micro-batch of cars from the per-key machine, written as encoded car messages, each
    sink's slice replacing what an earlier attempt of the batch wrote."""
    cars = whole_cars(batch.withColumn(
        "ts", F.timestamp_micros("ts_us").cast("timestamp_ntz"))).persist()
    for name, df in priced_and_routed(cars, prices, policy).items():
        df.write.mode("overwrite").parquet(path_of(name))
    cars.unpersist()


def typed_parts(sources: dict[str, DataFrame]) -> DataFrame:
    """The part topics decoded strictly (SRC7) and keyed by ``part.sku``, as rows of the
    assembly stage: one payload column per side."""
    frame = None
    for kind, raw in sources.items():
        d = decode(raw, PART_RECORDS[kind]).withColumn("ts", F.col("ts").cast("timestamp"))
        row = {k: F.lit(None).cast(I.payload_type(t)) for k, t in PART_RECORDS.items()}
        row[kind] = F.struct("ts", "seq", "record.*").cast(I.payload_type(PART_RECORDS[kind]))
        f = d.select(F.col("record.part.sku").alias("key"), F.lit(kind).alias("side"), "ts",
                     *[c.alias(f"p_{k}") for k, c in row.items()])
        frame = f if frame is None else frame.unionByName(f)
    return frame


def route_job(spark: SparkSession, sf_dir: str, policy: str = "code") -> I.Versions:
    """Job A end to end as one streaming query: four encoded part topics -> strict decode ->
    assembly stage (JN1 -> JN2 -> JN3) -> per micro-batch pricing against the price table and
    routing to the complete and incomplete sinks. Both sinks, the state and the late rows of a
    micro-batch become visible together, by its manifest (ST5). Each time slice of the four
    topics is written, then one ``availableNow`` run consumes it. Returns the tables; the sinks
    are ``complete`` and ``incomplete``."""
    from partflow.operators.sizing import bounded_broadcast
    prices = bounded_broadcast(fx.prices(spark, sf_dir).withColumn(  # checked once
        "id", F.concat(F.lit("P-"), F.col("id"))))
    base = scratch_path(spark, f"route-{policy}")
    topics = encoded_part_topics(fx.car_parts(spark, sf_dir))
    stream = I.Incremental(spark, assembly_job(PART_RECORDS), f"{base}/tables", tidy=True,
                           keep_out=False)  # the sinks hold the cars

    def publish(outs: DataFrame, batch_id: int) -> None:
        for name, df in priced_and_routed(
                cars_of(outs, policy), prices, policy,
                lambda priced: stream.versions.work("priced", priced)).items():
            stream.versions.write(name, batch_id, df)
    stream.publish = publish

    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    all_ts = None
    for t in topics.values():
        all_ts = t.select("ts") if all_ts is None else all_ts.unionByName(t.select("ts"))
    bounds = sorted(set(int(b) for b in all_ts.select(ms.alias("m")).approxQuantile(
        "m", [i / SLICES for i in range(1, SLICES)], 0.01)))
    edges = [None, *bounds, None]
    last = all_ts.agg(F.max(ms)).first()[0]
    end = encoded_part_topics({"body": spark.createDataFrame(
        [(R.SENTINEL, 0, None, 0)], "sku string, id long, ts timestamp_ntz, seq long")})["body"]
    steps = [{k: t.filter((ms >= lo) if lo is not None else F.lit(True))
              .filter((ms < hi) if hi is not None else F.lit(True)) for k, t in topics.items()}
             for lo, hi in zip(edges[:-1], edges[1:])]
    closing = end.withColumn("ts", F.timestamp_millis(  # past every deadline
        F.lit(last + ASM_HORIZON_MS)).cast("timestamp_ntz"))
    steps[-1]["body"] = steps[-1]["body"].unionByName(closing)
    for i, step in enumerate(steps):
        for kind, part in step.items():
            part.write.parquet(f"{base}/topic/{kind}/slice-{i:05d}", compression=I.PACKED)
        sources = {kind: spark.readStream.schema(FILE_TOPIC_SCHEMA)
                   .option("cleanSource", "delete").parquet(  # taken slices go
                       f"{base}/topic/{kind}/slice-*") for kind in topics}  # every step wrote each
        stream.run(typed_parts(sources), f"{base}/ckpt")
    stream.close()
    return stream.versions


def sinks(tables: I.Versions) -> dict[str, DataFrame]:
    """What the two sinks hold: encoded car messages of batches that are done."""
    return {name: tables.read(name, FILE_TOPIC_SCHEMA) for name in ("complete", "incomplete")}


def unsteady(ids: list[str], prices: dict[str, float], tries: int) -> dict[str, float]:
    """A price service with failures: by its id's digest, a price comes at the first, second or
    third try, or (one in sixteen) never."""
    import hashlib

    def first(i: str) -> int:
        n = hashlib.md5(i.encode()).digest()[0]
        return 99 if n % 16 == 0 else n % 3
    return {i: prices[i] for i in ids if i in prices and tries >= first(i)}


def lookup_retries(spark, sf_dir):
    """JN7 form 2 on its own: the cars (batch assembly) come in two time slices, their lookups
    are tried again by the clock; after each slice three rows without a car move it on."""
    from partflow.schemas import LOOKUP_RETRIES
    from partflow.streaming.lookups import Lookups
    parts = fx.car_parts(spark, sf_dir)
    cars = A.awaiting_price(parts).select(
        "sku", "seq", "ts", *[F.struct(F.col(f"{k}.id").alias("id")).alias(k)
                              for k in ("body", "engine", "remote")],
        F.transform("wheels", lambda w: F.struct(w["id"].alias("id"))).alias("wheels"))
    base = scratch_path(spark, "jn7")
    job = Lookups(spark, f"{base}/tables", cars.schema, ["sku", "ts", "seq"],
                  A.price_ids("documented"), unsteady, parts["prices"], LOOKUP_RETRIES,
                  "1 day", "5 days")
    rows = cars.select(F.col("ts").cast("timestamp").alias("ts"), F.struct("*").alias("car"))
    rows.write.parquet(f"{base}/cars")
    rows = spark.read.schema(rows.schema).parquet(f"{base}/cars")
    cut = F.unix_millis("ts") < R._bounds(rows, 2)[0]
    slices = []
    for half in (rows.where(cut), rows.where(~cut)):
        last = half.agg(F.max("ts").alias("t"))
        slices += [half, *[last.select((F.col("t") + F.expr(f"INTERVAL {i} days")).alias("ts"),
                                       F.lit(None).cast(cars.schema).alias("car"))
                           for i in (1, 2, 6)]]
    for i, part in enumerate(slices):
        part.write.parquet(f"{base}/topic/slice-{i:05d}")
        job.run(spark.readStream.schema(rows.schema).parquet(f"{base}/topic/slice-*"),
                f"{base}/ckpt")
    return job.outputs().select("sku", "ts", "situation", "total_price", "body_price",
                                "engine_price", "remote_control_price", "wheel_price")


def route_counts(spark, sf_dir):
    parts = [decode(df, CAR).select(
        F.lit(name).alias("sink"), F.col("record.situation").alias("situation"))
        for name, df in sinks(route_job(spark, sf_dir, "code")).items()]
    return (parts[0].unionByName(parts[1]).groupBy("sink", "situation")
            .agg(F.count(F.lit(1)).alias("n")))


def latest_value_join(spark, sf_dir):
    e = (E.events(spark, sf_dir).filter(F.col("event_type").isin("view", "click")))
    frame = R.topic_frame(e, "user_id", F.col("event_type"), seq="event_id",
                          payload=["value"])
    out = R.run_sliced(spark, frame, Latest("view", "click"), "jn4", SLICES, 1)
    return out.select(F.col("key").cast("bigint").alias("user_id"),
                      _j("$.seq").alias("event_id"), "ts",
                      _j("$.left.value", "double").alias("view_value"),
                      _j("$.right.value", "double").alias("click_value"))


def last_three_tags(spark, sf_dir):
    tags = fx.tax_tags(spark, sf_dir)
    frame = R.topic_frame(tags, "state", "tag", seq="seq", payload=["icms", "state"])
    value = "icms double, state string"
    base = scratch_path(spark, "ag2")
    last = LastRows(spark, f"{base}/tables", LAST_N_TAGS, T.StructType.fromDDL(value))
    for i, part in enumerate(R.time_slices(spark, frame, SLICES, 1)):
        part.write.parquet(f"{base}/topic/slice-{i:05d}")
        source = spark.readStream.schema(R.TOPIC_SCHEMA).parquet(f"{base}/topic/slice-*")
        last.run(source.select("key", "ts", "seq", F.from_json("value", value).alias("v")),
                 f"{base}/ckpt")
    vals = F.col("vals")
    return last.outputs().where(F.col("key") != R.SENTINEL).select(
        F.col("seq").alias("event_id"), F.col("key").alias("state"),
        F.size(vals).cast("long").alias("n_tags"),
        *[F.try_element_at(vals, F.lit(i))["icms"].alias(f"icms_{i}") for i in (1, 2, 3)])


def first_per_key(spark, sf_dir):
    e = E.events(spark, sf_dir, ("event_id", "ts", "user_id", "event_type"))
    frame = R.topic_frame(e, "user_id", "body", seq="event_id", payload=["event_type"])
    out = R.run_sliced(spark, frame, First(), "ag5", SLICES, 1)
    first = _j("$.first", "boolean")
    return out.select(_j("$.seq").alias("event_id"),
                      F.col("key").cast("bigint").alias("user_id"), first.alias("is_first"),
                      F.when(first, F.lit(FIRST_BODY_COLOR))
                      .otherwise(_j("$.row.event_type", "string")).alias("color"))


def _view_purchase(spark, sf_dir, wait: Wait, name: str) -> DataFrame:
    u, p = E.of_type(spark, sf_dir, "view"), E.of_type(spark, sf_dir, "purchase")
    frame = (R.topic_frame(u, "user_id", "unpriced", "seq", payload=["value"])
             .unionByName(R.topic_frame(p, "user_id", "priced", "seq", payload=["value"])))
    out = wait_stream(spark, frame, wait, ("unpriced", "value double"),
                      ("priced", "value double"), name, PRICED_WAIT_MS + 1)
    won = F.col("r").isNotNull()
    return out.select(F.col("key").cast("bigint").alias("user_id"), _ntz(),
                      F.when(won, F.lit("COMPLETE")).otherwise(F.lit("AWAITING_PRICE"))
                      .alias("situation"), F.coalesce("r.seq", "l.seq").alias("event_id"),
                      F.coalesce("r.value", "l.value").alias("value"))


def priced_wait_join(spark, sf_dir):
    return _view_purchase(spark, sf_dir, Wait("left", E.PRICED_WAIT), "jn6").drop("event_id")


def priced_wait_join_expiry(spark, sf_dir):
    """ST4: purchases that nobody took leave the state a day after they came."""
    return _view_purchase(spark, sf_dir, Wait("left", E.PRICED_WAIT, keep=E.PURCHASE_KEEP), "st4")


def running_word_count(spark, sf_dir):
    """Job C per input: every word gets its running total as it arrives. Arrival order
    is (doc_id, position): a document's words arrive at second ``doc_id`` after
    ``TEXT_EPOCH``."""
    from partflow.functions.scalars import split_words, word_count_text
    from partflow.streaming.totals import RunningTotals
    lines = fx.text_lines(spark, sf_dir).select(
        F.timestamp_seconds(F.col("doc_id") + TEXT_EPOCH).alias("ts"), "doc_id", "text")
    base = scratch_path(spark, "ag1")
    totals = RunningTotals(spark, f"{base}/tables", "word", ("doc_id",),
                           F.floor(F.col("doc_id") / DOCS_PER_BUCKET), split_words("text"))
    edges = [None, *R._bounds(lines, SLICES), None]
    ms = F.unix_millis("ts")
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        part = lines if lo is None else lines.where(ms >= lo)
        (part if hi is None else part.where(ms < hi)).write.parquet(
            f"{base}/topic/slice-{i:05d}")
        source = spark.readStream.schema(lines.schema).parquet(f"{base}/topic/slice-*")
        totals.run(source.select("doc_id", "text"), f"{base}/ckpt")
    return totals.outputs("word string, doc_id bigint, pos int, n bigint").select(
        "doc_id", "pos", "word", "n", word_count_text(F.col("word"), F.col("n")).alias("line"))


def word_count(spark, sf_dir):
    """Job C streaming: words -> groupBy(word).count() in update mode; each micro-batch's
    updated totals go to the sink under its batch id; the newest total per word is the
    running count's final value."""
    from partflow.functions.scalars import split_words, word_count_text
    lines = fx.text_lines(spark, sf_dir)
    path = scratch_path(spark, "topic-text")
    lines.write.parquet(path)  # written by all tasks; read as about four micro-batches
    files = len(spark.read.parquet(path).inputFiles())  # file listing only
    out = scratch_path(spark, "wc-out")
    src = (spark.readStream.schema("doc_id bigint, text string")
           .option("maxFilesPerTrigger", max(1, -(-files // 4))).parquet(path))
    counts = (src.select(F.explode(split_words("text")).alias("word"))
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{out}/b={batch_id}")

    with state_partitions(spark):
        q = (counts.writeStream.outputMode("update").foreachBatch(per_batch)
             .option("checkpointLocation", scratch_path(spark, "wc-ckpt"))
             .trigger(availableNow=True).start())
    q.awaitTermination()
    upd = spark.read.schema("word string, n bigint, batch_id long").parquet(f"{out}/*")
    final = upd.groupBy("word").agg(F.max_by("n", "batch_id").alias("n"))
    return final.select("word", "n", word_count_text("word", "n").alias("line"))
