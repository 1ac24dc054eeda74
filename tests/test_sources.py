"""SRC7: strict decoding. A value that does not parse stops the job (the reference's
deserializer rethrows), it is never dropped or nulled in silence."""

import pytest
from pyspark.sql import functions as F

from partflow.schemas import BODY, ENGINE, WHEEL
from partflow.session import scratch_path
from partflow.sinks.topics import encode, write_file_topic
from partflow.sources.topics import consumer_options, decode, read_file_topic


GOOD = ('{"part": {"sku": "1", "partName": "BODY", "price": 0.0, "productName": ""}, '
        '"id": "9", "color": "red", "material": "steel", "weight": 1.5}')


def _topic(spark, values):
    df = spark.createDataFrame([(str(i), v, i) for i, v in enumerate(values)],
                               "sku string, v string, seq long")
    enc = df.select(F.col("sku").cast("binary").alias("key"), F.col("v").alias("value"),
                    F.current_timestamp().cast("timestamp_ntz").alias("ts"), "seq")
    path = scratch_path(spark, "src7")
    enc.write.parquet(path)
    return read_file_topic(spark, path)


def test_good_records_decode(spark):
    good = GOOD
    out = decode(_topic(spark, [good]), BODY).select("record.part.sku", "record.id").first()
    assert tuple(out) == ("1", "9")


def test_bad_record_stops_the_job(spark):
    with pytest.raises(Exception):
        decode(_topic(spark, [GOOD, "{not json"]), BODY).select("record.id").collect()


@pytest.mark.parametrize("bad", [
    "{}", GOOD.replace('"sku": "1", ', ""), GOOD.replace('"id": "9"', '"id": null')])
def test_missing_required_field_stops_the_job(spark, bad):
    with pytest.raises(Exception, match="bad record"):
        decode(_topic(spark, [GOOD, bad]), BODY).select("record.id").collect()


def test_unknown_enum_symbol_stops_the_job(spark):
    wheel = '{"part": {"sku": "1", "partName": "WHEEL"}, "id": "9", "placement": "%s"}'
    ok = decode(_topic(spark, [wheel % "REAR_LEFT"]), WHEEL).select("record.placement").first()
    assert ok[0] == "REAR_LEFT"
    with pytest.raises(Exception, match="bad record"):
        decode(_topic(spark, [wheel % "NOWHERE"]), WHEEL).select("record.placement").collect()


def test_encode_round_trip_and_consumer_options(spark):
    df = spark.createDataFrame([(5, "x")], "sku long, id string")
    enc = encode(df, "sku", F.struct(F.struct(F.col("sku").cast("string").alias("sku"),
                                               F.lit("ENGINE").alias("partName"))
                                     .alias("part"), "id"))
    path = scratch_path(spark, "src-enc")
    write_file_topic(enc.withColumn("ts", F.current_timestamp().cast("timestamp_ntz"))
                     .withColumn("seq", F.lit(0).cast("long")), path)
    back = decode(read_file_topic(spark, path), ENGINE).first()
    assert back.key == "5" and back.record.id == "x" and back.record.part.sku == "5"
    opts = consumer_options("b:9092", "rccar-body")
    assert opts["subscribe"] == "rccar-body" and opts["kafka.group.id"].startswith(
        "rccar-body-group-") and opts["startingOffsets"] == "earliest"
