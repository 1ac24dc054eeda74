"""T1: scalar functions on literal tables."""

from pyspark.sql import functions as F

from partflow.functions import scalars as S


def test_half_even_money(spark):
    df = spark.createDataFrame([(2.665,), (2.675,), (0.125,), (10.0,)], "x double")
    got = [r[0] for r in df.select(S.money("x")).collect()]
    assert got == [2.66, 2.68, 0.12, 10.0]


def test_total_documented_and_code(spark):
    df = spark.createDataFrame([(10.0, 5.0, 2.5, 1.25)], "b double, e double, r double, w double")
    doc = df.select(S.add_rounded(S.money("b"), S.money("e"), S.money("r"),
                                  S.money("w") * 4)).first()[0]
    assert doc == 22.5
    assert df.select(S.add_rounded(F.lit(0.0), S.money("b"))).first()[0] == 10.0


def test_split_words_like_single_space_split(spark):
    df = spark.createDataFrame([("",), (" ",), ("a  b  ",), (" a",), ("x\ny\tz",)], "t string")
    got = [r[0] for r in df.select(S.split_words("t")).collect()]
    assert got == [[""], [], ["a", "", "b"], ["", "a"], ["x\ny\tz"]]


def test_kind_label_json_and_emptiness(spark):
    df = spark.createDataFrame([("REMOTE_CONTROL", '{"price": 3.5}', [1])],
                               "k string, js string, a array<int>")
    r = df.select(S.kind_label("k"), S.json_number("js", "price"), S.json_number("js", "x"),
                  S.emptiness("a"), S.emptiness(F.array().cast("array<int>")),
                  S.word_count_text(F.lit("w"), F.lit(3))).first()
    assert tuple(r) == ("remote-control", 3.5, None, False, True, "w:::3")


def test_key_bytes(spark):
    r = spark.range(1).select(S.key_bytes(F.lit(42))).first()[0]
    assert bytes(r) == b"42"


def test_avro_schema_of_records():
    import json
    from partflow.schemas import CAR, avro_schema
    s = json.loads(avro_schema(CAR, "Car"))
    assert s["type"] == "record" and [f["name"] for f in s["fields"]][:2] == ["sku", "totalPrice"]
    wheels = next(f for f in s["fields"] if f["name"] == "wheels")["type"]
    assert wheels[0] == "null" and wheels[1]["type"] == "array"


def test_fetch_timeout_is_enforced(spark):
    """A fetch slower than its timeout fails its car instead of holding the task."""
    import time
    from partflow.operators.pricing import fetch_prices

    def slow(ids):
        time.sleep(60)
        return {i: 1.0 for i in ids}

    cars = spark.createDataFrame([(1, 10)], "sku long, bid long").withColumn(
        "body", F.struct(F.col("bid").alias("id")))
    t0 = time.time()
    out = fetch_prices(cars, slow, {"BODY": F.col("body.id")}, ["sku"], timeout_s=0.2,
                       retries=1, delay_s=0.1).collect()
    assert out[0]["situation"] == "FAILED_GET_PRICE" and out[0]["total_price"] == -1.0
    assert time.time() - t0 < 40


def test_fetch_per_id_matches_batch_fetch(spark):
    from partflow.operators.pricing import fetch_prices
    table = {"1": 2.675, "2": 10.0}
    cars = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "sku long, bid long").withColumn(
        "body", F.struct(F.col("bid").alias("id")))
    ids = {"BODY": F.col("body.id")}
    a = fetch_prices(cars, lambda b: {i: table[i] for i in b if i in table}, ids, ["sku"],
                     retries=0).orderBy("sku").collect()
    b = fetch_prices(cars, lambda i: table.get(i), ids, ["sku"], retries=0,
                     per_id=True).orderBy("sku").collect()
    assert [(r.situation, r.total_price) for r in a] == [(r.situation, r.total_price) for r in b] \
        == [("COMPLETE", 2.68), ("COMPLETE", 10.0), ("FAILED_GET_PRICE", -1.0)]


def test_fetch_retries_what_an_answer_lacks_within_one_deadline(spark):
    """A partial answer is asked for again; a lookup with its retries ends at its timeout;
    each distinct id is asked for once per try."""
    import time
    from partflow.operators.pricing import fetch_prices
    from partflow.session import scratch_path
    log = scratch_path(spark, "asked")

    def partial(ids):
        import os
        os.makedirs(log, exist_ok=True)
        with open(f"{log}/{time.time_ns()}-{len(ids)}", "w"):
            pass
        return {i: float(i) for i in sorted(ids)[:1]}

    cars = spark.createDataFrame([(i, i % 3) for i in range(9)], "sku long, bid long"
                                 ).withColumn("body", F.struct(F.col("bid").alias("id")))
    ids = {"BODY": F.col("body.id")}
    out = fetch_prices(cars.coalesce(1), partial, ids, ["sku"], retries=3, delay_s=0.0)
    assert {(r.sku, r.total_price) for r in out.collect()} == {(i, i % 3) for i in range(9)}

    def broken(ids):
        raise OSError("no service")
    t0 = time.time()
    out = fetch_prices(cars.coalesce(1), broken, ids, ["sku"], retries=100, delay_s=0.3,
                       timeout_s=1.0).collect()
    assert {r.situation for r in out} == {"FAILED_GET_PRICE"} and time.time() - t0 < 20


def test_fetch_from_a_table_by_buckets(spark, monkeypatch):
    """Ids and prices meet by hash bucket: equal to the table join, ids without a price fail."""
    from partflow.operators import pricing as P
    monkeypatch.setattr(P, "BUCKET_PRICES", 40)
    prices = spark.range(300).select("id", (F.col("id") * 1.005).alias("price"))
    cars = spark.range(500).select(F.col("id").alias("sku"), F.struct(
        (F.col("id") % 330).alias("id")).alias("body"))
    ids = {"BODY": F.col("body.id")}
    got = P.fetch_prices(cars, P.from_table, ids, ["sku"], retries=0, table=prices)
    want = P.price_cars(cars, prices, ids, ["sku"])
    cols = ["sku", "situation", "total_price"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(
        map(tuple, want.select(cols).collect()))
    assert got.where("situation = 'FAILED_GET_PRICE'").count() == 30
