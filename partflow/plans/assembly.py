"""Job A, car assembly, batch form: body ⋈ engine ⟕ remote control ⟕ wheels per sku
(JN1 -> JN2 -> JN3), then pricing (JN7/JN9) and routing (SNK6).

Every stage is keyed by ``sku`` and takes every sku and every row, repeated parts included.
``assemble`` groups the four part tables by sku once and chains the folds of the three joins on
the grouped row: one exchange, no join. Skus with very many parts go through the three operators
one after the other, which cut them into segments (``operators/folds``).

Two policies (SURVEY §2.11 D-1/D-2): ``code`` reproduces what the reference computes,
``documented`` what its README describes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.operators import folds
from partflow.operators.folds import Wait, event, fold, number
from partflow.operators.pricing import fetch_prices, price_cars
from partflow.operators.routing import route, route_counts
from partflow.operators.waitjoins import (collect_join, patch_join, wait_join_full,
                                          wait_join_left)
from partflow.schemas import EXPECTED_WHEELS
from partflow.sources import fixtures as fx

# Two cars of one sku can leave at the same time; they never share all their parts.
CAR_KEY = ["sku", "ts", "body", "engine", "wheels"]


def body_engine(parts: dict[str, DataFrame], within: str = fx.CAR_WAIT, calm: bool = False
                ) -> DataFrame:
    """JN1 + PRJ4: (sku, body, engine, ts, seq, situation) for every sku."""
    be = wait_join_full(parts["body"], parts["engine"], "sku", within, "body", "engine",
                        numbered=True, calm=calm)
    sit = (F.when(F.col("body").isNull(), F.lit("MISSING_BODY"))
           .when(F.col("engine").isNull(), F.lit("MISSING_ENGINE"))
           .otherwise(F.lit("INCOMPLETE")))
    return be.withColumn("situation", sit)


def situation(policy: str) -> Column:
    """F8 after the last join."""
    body, engine, remote = F.col("body"), F.col("engine"), F.col("remote")
    n = F.col("n_wheels")
    if policy == "code":
        return (F.when(n == 0, F.lit("MISSING_WHEELS"))
                .when(remote.isNull(), F.lit("MISSING_REMOTE_CONTROL"))
                .otherwise(F.lit("AWAITING_PRICE")))
    return (F.when(body.isNull(), F.lit("MISSING_BODY"))
            .when(engine.isNull(), F.lit("MISSING_ENGINE"))
            .when(remote.isNull(), F.lit("MISSING_REMOTE_CONTROL"))
            .when(n == 0, F.lit("MISSING_WHEELS"))
            .otherwise(F.lit("AWAITING_PRICE")))


def car_remote(be: DataFrame, parts: dict[str, DataFrame], within: str = fx.CAR_WAIT,
               calm: bool = False) -> DataFrame:
    """JN2: cars ⟕ remote control, (sku, body, engine, remote, ts, seq) for every car."""
    return wait_join_left(be.select("sku", "body", "engine", "ts", "seq"), parts["remote"],
                          "sku", within, "remote", numbered=True, calm=calm)


def car_wheels(cars: DataFrame, parts: dict[str, DataFrame], within: str = fx.CAR_WAIT,
               calm: bool = False) -> DataFrame:
    """JN3: cars ⟕ wheels, with ``wheels`` and ``n_wheels``."""
    return collect_join(cars, parts["wheel"], "sku", within, EXPECTED_WHEELS, "wheels",
                        order=("ts", "seq"), numbered=True, calm=calm)


def by_heat(parts: dict[str, DataFrame], kinds: tuple[str, ...], most: int | None = None
            ) -> tuple[dict[str, DataFrame], dict[str, DataFrame] | None]:
    """The parts of skus with at most ``most`` parts of these kinds together, and of the others
    (None if there are none). Every join's rows of a sku are at most that many: a car that leaves
    a join stands for a body or an engine of its own. So one count of the part tables serves all
    joins of a chain, and none of them is computed twice to count the next one's left side."""
    from partflow.session import materialize
    n = None
    for k in kinds:
        one = parts[k].select("sku")
        n = one if n is None else n.unionByName(one)
    hot = materialize(n.where(F.col("sku").isNotNull()).groupBy("sku")
                      .agg(F.count(F.lit(1)).alias("_n"))
                      .where(F.col("_n") > (folds.MOST if most is None else most))
                      .select("sku"), "hot-skus")
    if hot.isEmpty():
        return parts, None
    return ({**parts, **{k: parts[k].join(hot, "sku", "left_anti") for k in kinds}},
            {**parts, **{k: parts[k].join(hot, "sku") for k in kinds}})


def with_remotes(parts: dict[str, DataFrame], within: str = fx.CAR_WAIT) -> DataFrame:
    """JN1 and JN2 as two operators, each with an exchange of its own."""
    def steps(some, calm):
        return car_remote(body_engine(some, within, calm), some, within, calm)
    calm, hot = by_heat(parts, ("body", "engine", "remote"))
    cars = steps(calm, True)
    return cars if hot is None else cars.unionByName(steps(hot, False))


def in_steps(parts: dict[str, DataFrame], within: str = fx.CAR_WAIT,
             most: int | None = None) -> DataFrame:
    """JN1, JN2 and JN3 as three operators, each with an exchange of its own."""
    calm, hot = by_heat(parts, tuple(parts_of(parts)), most)
    cars = _joined(calm, within, True)
    return cars if hot is None else cars.unionByName(_joined(hot, within, False))


def _joined(parts: dict[str, DataFrame], within: str, calm: bool) -> DataFrame:
    cars = car_remote(body_engine(parts, within, calm), parts, within, calm)
    return car_wheels(cars, parts, within, calm)


def cars_per_sku(parts: dict[str, DataFrame], within: str = fx.CAR_WAIT,
                 most: int | None = None, need: tuple[str, ...] = ()) -> DataFrame:
    """JN1 -> JN2 -> JN3 for every sku: (sku, body, engine, remote, wheels, n_wheels, ts, seq).

    The four tables meet once by sku; each join is a fold over the grouped row, whose output
    array is the next one's left side. Skus without any part of a kind in ``need`` may be left
    out: for a caller that takes cars with those parts only."""
    calm, hot = by_heat(parts, tuple(parts_of(parts)), most)
    done = _chain(calm, within, need)
    return done if hot is None else done.unionByName(
        _joined(hot, within, False).select(*done.columns))


def parts_of(parts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {k: parts[k] for k in ("body", "engine", "remote", "wheel")}


def _chain(parts: dict[str, DataFrame], within: str, need: tuple[str, ...] = ()) -> DataFrame:
    own = {k: F.struct(*(("ts", "seq") if k == "wheel" else ()), *[
        c for c in df.columns if c != "sku" and not (k == "wheel" and c in ("ts", "seq"))])
        for k, df in parts_of(parts).items()}
    kind = {k: folds.nullable(parts[k].select(c.alias("x")).schema["x"].dataType)
            for k, c in own.items()}
    rows = None
    for k, df in parts_of(parts).items():
        one = df.where(F.col("sku").isNotNull()).select("sku", *[
            (own[x] if x == k else F.lit(None).cast(kind[x])).alias(x) for x in kind])
        rows = one if rows is None else rows.unionByName(one)
    g = rows.groupBy("sku").agg(*[F.collect_list(k).alias(k) for k in kind])
    for k in need:  # no fold can give a car that part
        g = g.where(F.size(k) > 0)
    time = parts["body"].schema["ts"].dataType

    def part(k, wait, side, lt, rt):
        null = F.lit(None).cast(lt if side else rt)
        return F.transform(k, lambda x: event(wait, side, x["ts"], x["seq"].cast("long"),
                                              null if side else x, x if side else null))

    def cars(done, wait, make, rt):
        null = F.lit(None).cast(rt)
        return F.transform(done, lambda o, i: event(wait, 0, o["ts"], number(o, i), make(o),
                                                    null))

    w1, w2 = Wait("full", within), Wait("left", within)
    w3 = Wait("collect", within, EXPECTED_WHEELS)
    be = fold(F.sort_array(F.concat(
        part("body", w1, 0, kind["body"], kind["engine"]),
        part("engine", w1, 1, kind["body"], kind["engine"]))), w1, kind["body"], kind["engine"],
        time)
    t2 = T.StructType([T.StructField(k, kind[k]) for k in ("body", "engine")])
    cr = fold(F.sort_array(F.concat(
        cars(be, w2, lambda o: F.struct(o["l"].alias("body"), o["r"].alias("engine")),
             kind["remote"]),
        part("remote", w2, 1, t2, kind["remote"]))), w2, t2, kind["remote"], time)
    t3 = T.StructType([T.StructField(k, kind[k]) for k in ("body", "engine", "remote")])
    cw = fold(F.sort_array(F.concat(
        cars(cr, w3, lambda o: F.struct(o["l"]["body"].alias("body"),
                                        o["l"]["engine"].alias("engine"),
                                        o["r"].alias("remote")), kind["wheel"]),
        part("wheel", w3, 1, t3, kind["wheel"]))), w3, t3, kind["wheel"], time)
    out = g.select("sku", F.posexplode(cw).alias("_pos", "_o"))
    return out.select("sku", "_o.l.*", F.array_sort("_o.r").alias("wheels"),
                      F.size("_o.r").cast("long").alias("n_wheels"), "_o.ts",
                      number(F.col("_o"), F.col("_pos")).alias("seq"))


def patched(parts: dict[str, DataFrame], within: str = fx.CAR_WAIT, most: int | None = None
            ) -> DataFrame:
    """JN8, then JN5: assembled cars as records wait for the priced wheel parts. One count of parts
    and priced parts tells the skus that are hot in any of the joins."""
    priced = {"priced": wheel_price_parts(parts)}
    calm, hot = by_heat({**parts, **priced}, (*parts_of(parts), "priced"), most)

    def steps(some, cars, calm):
        cars = to_record(cars.withColumn("situation", situation("code")))
        return patch_join(cars, some["priced"], "sku", calm)
    out = steps(calm, _chain(calm, within), True)
    return out if hot is None else out.unionByName(
        steps(hot, _joined(hot, within, False), False))


def assemble(parts: dict[str, DataFrame], policy: str = "code",
             within: str = fx.CAR_WAIT) -> DataFrame:
    """JN8 for every sku: (sku, body, engine, remote, wheels, n_wheels, ts, seq, situation)."""
    return cars_per_sku(parts, within).withColumn("situation", situation(policy))


def awaiting_price(parts: dict[str, DataFrame], within: str = fx.CAR_WAIT) -> DataFrame:
    """The cars of ``assemble`` by the documented policy that await a price: those with a body,
    an engine, a remote control and a wheel. The condition is tested on a sku's parts first, so
    that no fold runs where it cannot hold."""
    return cars_per_sku(parts, within, need=tuple(parts_of(parts))).withColumn(
        "situation", situation("documented")).where("situation = 'AWAITING_PRICE'")


def car_key(cars: DataFrame) -> list[str]:
    """Columns that identify a car: where it has one, its number among those that leave a sku
    at the same time."""
    return ["sku", "ts", "seq"] if "seq" in cars.columns else CAR_KEY


def price_ids(policy: str) -> dict[str, Column]:
    """Which part ids are looked up (F7): the body only as coded (D-2), all four as
    documented (first wheel in arrival order for WHEEL)."""
    ids = {"BODY": F.col("body.id")}
    if policy == "documented":
        ids.update({"ENGINE": F.col("engine.id"), "REMOTE_CONTROL": F.col("remote.id"),
                    "WHEEL": F.try_element_at("wheels", F.lit(1))["id"]})
    return ids


def price(assembled: DataFrame, prices: DataFrame, policy: str = "code",
          check_size: bool = True) -> DataFrame:
    """JN7 form 1 + JN9 on the cars awaiting a price."""
    waiting = assembled.filter(F.col("situation") == "AWAITING_PRICE").drop("situation")
    return price_cars(waiting, prices, price_ids(policy), car_key(waiting),
                      check_size=check_size)


def price_by_fetch(assembled: DataFrame, fetch, policy: str = "code", **kw) -> DataFrame:
    """JN7 form 2 on the cars awaiting a price."""
    waiting = assembled.filter(F.col("situation") == "AWAITING_PRICE").drop("situation")
    return fetch_prices(waiting, fetch, price_ids(policy), car_key(waiting), **kw)


def with_part_prices(priced: DataFrame) -> DataFrame:
    """JN7's result in the record: the price that was looked up becomes the price of the
    part (the wheel price that of every wheel), in cars whose parts are whole records."""
    def priced_part(side: str, price: str) -> Column:
        return F.when(F.col(side).isNotNull() & F.col(price).isNotNull(),
                      F.col(side).withField("part.price", F.col(price))).otherwise(F.col(side))

    out = priced
    for side, price in (("body", "body_price"), ("engine", "engine_price"),
                        ("remote", "remote_control_price")):
        if price in priced.columns:
            out = out.withColumn(side, priced_part(side, price))
    if "wheel_price" in priced.columns:
        out = out.withColumn("wheels", F.when(F.col("wheel_price").isNotNull(), F.transform(
            "wheels", lambda w: w.withField("part.price", F.col("wheel_price"))))
            .otherwise(F.col("wheels")))
    return out


def car_messages(cars: DataFrame, **how) -> DataFrame:
    """Whole cars (parts as records) as messages: key = sku bytes, value = the encoded CAR."""
    from partflow.sinks.topics import encode
    total = F.col("total_price") if "total_price" in cars.columns else F.lit(0.0)
    record = F.struct(F.col("sku").cast("string").alias("sku"),
                      F.coalesce(total, F.lit(0.0)).alias("totalPrice"), "body", "engine",
                      F.col("remote").alias("remoteControl"), "wheels", "situation")
    return encode(cars.withColumn("seq", F.lit(0).cast("long")), "sku", record, **how)


def routes(spark: SparkSession, sf_dir: str, policy: str = "code") -> dict[str, DataFrame]:
    """Job A batch: assembled, priced and routed. The assembled cars feed three branches
    (priced complete, priced incomplete, missing a part); they are written once to the
    shared folder instead of being assembled three times."""
    from partflow.session import materialize
    parts = fx.car_parts(spark, sf_dir)
    asm = materialize(assemble(parts, policy), "assembled")
    return route(asm, price(asm, parts["prices"], policy))


def flat(df: DataFrame) -> DataFrame:
    """Flat view of a car for comparison: ids instead of part records."""
    cols = {"sku": F.col("sku")}
    for side in ("body", "engine", "remote"):
        if side in df.columns:
            cols[f"{side}_id"] = F.col(f"{side}.id")
    if "wheels" in df.columns:
        cols["n_wheels"] = F.col("n_wheels")
        cols["wheel_ids"] = F.concat_ws(",", F.transform("wheels", lambda w: w["id"].cast("string")))
    cols["ts"] = F.col("ts")
    if "situation" in df.columns:
        cols["situation"] = F.col("situation")
    return df.select(*[c.alias(n) for n, c in cols.items()])


def _part(kind: str) -> Column:
    return F.struct(F.col("sku").cast("string").alias("sku"), F.lit(kind).alias("partName"),
                    F.lit(0.0).alias("price"), F.lit("").alias("productName"))


def to_record(cars: DataFrame) -> DataFrame:
    """Assembled cars as car records (``schemas.CAR``; parts carry a ``part`` struct), keyed by
    ``sku`` and kept with their emit time ``ts``."""
    def opt(side: str, rec: Column) -> Column:
        return F.when(F.col(side).isNotNull(), rec)
    body = opt("body", F.struct(_part("BODY").alias("part"),
                                F.col("body.id").cast("string").alias("id"),
                                F.lit(None).cast("string").alias("color"),
                                F.lit(None).cast("string").alias("material"),
                                F.lit(None).cast("float").alias("weight")))
    engine = opt("engine", F.struct(_part("ENGINE").alias("part"),
                                    F.col("engine.id").cast("string").alias("id")))
    remote = opt("remote", F.struct(_part("REMOTE_CONTROL").alias("part"),
                                    F.col("remote.id").cast("string").alias("id"),
                                    F.lit(None).cast("string").alias("channelFrequency")))
    wheels = F.transform("wheels", lambda w: F.struct(
        F.struct(F.col("sku").cast("string").alias("sku"), F.lit("WHEEL").alias("partName"),
                 F.lit(0.0).alias("price"), F.lit("").alias("productName")).alias("part"),
        w["id"].cast("string").alias("id"), w["placement"].alias("placement")))
    total = F.col("total_price") if "total_price" in cars.columns else F.lit(0.0)
    return cars.select("sku", "ts", "seq", body.alias("body"), engine.alias("engine"),
                       remote.alias("remoteControl"), wheels.alias("wheels"),
                       total.alias("totalPrice"), "situation")


def wheel_price_parts(parts: dict[str, DataFrame]) -> DataFrame:
    """JN5 fixture: a priced WHEEL part for every wheel line that has a price; it arrives with
    that wheel."""
    from partflow.functions.scalars import money
    from partflow.operators.sizing import bounded_broadcast
    j = parts["wheel"].join(bounded_broadcast(parts["prices"]), "id")
    return j.select("sku", "ts", "seq", F.struct(
        F.col("sku").cast("string").alias("sku"), F.lit("WHEEL").alias("partName"),
        money("price").alias("price"), F.lit("").alias("productName")).alias("part"))


__all__ = ["assemble", "body_engine", "car_key", "car_remote", "car_wheels", "cars_per_sku",
           "flat", "in_steps", "price", "price_by_fetch", "route", "route_counts", "routes",
           "to_record", "wheel_price_parts", "with_part_prices", "car_messages"]
