"""Batch forms of the wait-joins (JN1, JN2, JN3, JN5, JN6).

Every operator takes side tables with the key column, an arrival-time column ``ts`` and
payload columns. Each side is packed into one struct column named after the side, so an
output row is ``(key, <left>, <right>, ts)`` where ``ts`` is the time the stream form
would emit the row: the match time, or the waiter's arrival plus the wait.

Keys may repeat rows on each side. The outcome then depends on arrival order (a newer row
replaces a waiting one and keeps its deadline, a match consumes both rows), so a key's rows are
folded in that order inside the JVM, hot keys in segments between quiet gaps
(``operators/folds``). No operator here emits all pairs within a key. ``unique=True`` takes a
closed form (grouped aggregates and equality joins) for inputs that have one row per key and
side by construction; there is no check of that. ``calm=True`` says that no key has more than
``folds.MOST`` rows on both sides together, so that they aren't counted first.

``numbered=True`` adds ``seq`` (in place of the left rows' own), the order of rows that leave a
key at the same time, for the next join of a chain.

Tie rules: a match needs the other arrival strictly before first arrival + wait; right
rows at or before the left row's time count as already there; rows of equal time go by the
side's ``seq`` column, where there is one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.operators.folds import Wait, join_in_order


def interval(within: str) -> Column:
    """``'5 seconds'`` / ``'700 days'`` as an interval literal."""
    return F.expr(f"INTERVAL {within}")


def pack(df: DataFrame, key: str, name: str, order: tuple[str, ...] = ()) -> DataFrame:
    """``(key, struct(<order cols first>, <other cols>) AS name)``."""
    rest = [c for c in df.columns if c != key and c not in order]
    return df.select(key, F.struct(*order, *rest).alias(name))


def wait_join_full(left: DataFrame, right: DataFrame, key: str, within: str,
                   left_name: str = "left", right_name: str = "right",
                   unique: bool = False, numbered: bool = False, calm: bool = False
                   ) -> DataFrame:
    """JN1: symmetric wait-join, full outer, one-to-one.

    An arrival that finds the other side waiting pairs with it at once; otherwise it
    waits ``within`` and leaves alone. Output ``(key, left, right, ts)``: a pair at the
    later arrival, a lone side at its arrival + wait.

    Plan of the closed form: the two sides are unioned and grouped by key (one shuffle,
    partial aggregation), not full-outer-joined: the result stays hash-partitioned by the
    key, so the next keyed stage (JN2, JN3) does not shuffle it again."""
    if not unique:
        out = join_in_order(left, right, key, Wait("full", within), left_name, right_name,
                            calm=calm)
        return out if numbered else out.drop("seq")
    T = interval(within)
    ls, rs = pack(left, key, left_name), pack(right, key, right_name)
    ltype, rtype = ls.schema[left_name].dataType, rs.schema[right_name].dataType
    tagged = (ls.withColumn(right_name, F.lit(None).cast(rtype))
              .unionByName(rs.withColumn(left_name, F.lit(None).cast(ltype))))
    g = tagged.groupBy(key).agg(F.max(left_name).alias(left_name),
                                F.max(right_name).alias(right_name))
    l, r = F.col(left_name), F.col(right_name)
    paired = (l.isNotNull() & r.isNotNull()
              & (l["ts"] < r["ts"] + T) & (r["ts"] < l["ts"] + T))
    pair = F.array(F.struct(l.alias(left_name), r.alias(right_name),
                            F.greatest(l["ts"], r["ts"]).alias("ts")))
    alone = F.filter(
        F.array(F.struct(l.alias(left_name), F.lit(None).cast(rtype).alias(right_name),
                         (l["ts"] + T).alias("ts")),
                F.struct(F.lit(None).cast(ltype).alias(left_name), r.alias(right_name),
                         (r["ts"] + T).alias("ts"))),
        lambda x: x[left_name].isNotNull() | x[right_name].isNotNull())
    return g.select(key, F.inline(F.when(paired, pair).otherwise(alone)))


def wait_join_left(left: DataFrame, right: DataFrame, key: str, within: str,
                   right_name: str = "right", unique: bool = False, numbered: bool = False,
                   keep: str | None = None, calm: bool = False) -> DataFrame:
    """JN2: asymmetric wait-join, left outer. ``left`` rows carry their arrival ``ts``.

    A left row finding the right row already there leaves at once with it; otherwise it
    waits ``within`` and leaves at the deadline with the right row if one came during
    the wait, else with null. A right row never triggers output.
    Output: ``left`` columns with ``ts`` replaced by the emit time, plus ``right_name``.
    With ``keep`` a right row expires that long after its arrival (ST4)."""
    if not unique:
        got = join_in_order(left, right, key, Wait("left", within, keep=keep), "_left",
                            right_name, calm=calm)
        return _spread(got, left, key, right_name, numbered=numbered)
    T = interval(within)
    rs = pack(right, key, right_name)
    j = left.join(rs, key, "left")
    r, t = F.col(right_name), F.col("ts")
    matched = r.isNotNull() & (r["ts"] < t + T)
    return (j.withColumn(right_name, F.when(matched, r))
            .withColumn("ts", F.when(matched & (r["ts"] <= t), t).otherwise(t + T)))


def _spread(got: DataFrame, left: DataFrame, key: str, *more: str, numbered: bool = False
            ) -> DataFrame:
    """The left row's own columns next to what it left with; ``ts`` is the emit time."""
    kept = ["ts", key, *(["seq"] if numbered else [])]
    own = [F.col(c) if c in kept else F.col(f"_left.{c}").alias(c) for c in left.columns]
    extra = ["seq"] if numbered and "seq" not in left.columns else []
    return got.select(*own, *more, *extra)


def collect_join(left: DataFrame, right: DataFrame, key: str, within: str, expected: int,
                 right_name: str = "right", order: tuple[str, ...] = ("ts",),
                 unique: bool = False, numbered: bool = False, calm: bool = False) -> DataFrame:
    """JN3: collecting wait-join, one left row to many right rows.

    Right rows collect per key. A left row that finds exactly ``expected`` of them
    leaves at once with them; otherwise it waits ``within`` and leaves with all that
    arrived before the deadline (none, fewer, or more than expected). Output: ``left``
    columns with ``ts`` = emit time, ``right_name`` = array of right rows in arrival
    ``order``, ``n_<right_name>`` = its length.

    Plan of the closed form: the left side arrives hash-partitioned by key (from JN1/JN2);
    the left join and the per-car aggregate reuse that partitioning, so only the right side
    moves."""
    if not unique:
        got = join_in_order(left, right, key, Wait("collect", within, expected), "_left",
                            right_name, order, calm=calm)
        return _spread(got, left, key, right_name, f"n_{right_name}", numbered=numbered)
    T = interval(within)
    rs = pack(right, key, "_r", order)
    other = [c for c in left.columns if c not in (key, "ts")]
    j = left.join(rs, key, "left")
    r, t = F.col("_r"), F.col("ts")
    g = j.groupBy(key, "ts").agg(
        *[F.first(c).alias(c) for c in other],
        F.count(F.when(r["ts"] <= t, 1)).alias("_n0"),
        F.count(F.when(r["ts"] < t + T, 1)).alias("_n1"),
        F.collect_list(F.when(r["ts"] < t + T, r)).alias("_rows"))
    now = F.col("_n0") == expected
    rows = F.array_sort(F.when(now, F.filter("_rows", lambda x: x["ts"] <= F.col("ts")))
                        .otherwise(F.col("_rows")))
    return g.select(key, *other,
                    F.when(now, t).otherwise(t + T).alias("ts"),
                    rows.alias(right_name),
                    F.when(now, F.col("_n0")).otherwise(F.col("_n1")).alias(f"n_{right_name}"))


def apply_patch(cars: DataFrame, part: str = "part") -> DataFrame:
    """Replace the car's part of the same ``partName`` (BODY, ENGINE, REMOTE_CONTROL) by
    the ``part`` column, or for WHEEL set its price on every wheel (PRJ2)."""
    kind = F.col(f"{part}.partName")

    def replace(field: str, name: str) -> Column:
        return F.when((kind == name) & F.col(field).isNotNull(),
                      F.col(field).withField("part", F.col(part))).otherwise(F.col(field))

    wheels = F.when(kind == "WHEEL", F.transform(
        "wheels", lambda w: w.withField("part.price", F.col(f"{part}.price")))
    ).otherwise(F.col("wheels"))
    return (cars.withColumn("body", replace("body", "BODY"))
            .withColumn("engine", replace("engine", "ENGINE"))
            .withColumn("remoteControl", replace("remoteControl", "REMOTE_CONTROL"))
            .withColumn("wheels", wheels))


def patch_join(cars: DataFrame, parts: DataFrame, key: str, calm: bool = False) -> DataFrame:
    """JN5: part-patch join with no timeout.

    Both sides wait for each other without limit; a pair leaves at the later arrival with
    the part patched into the car (``apply_patch``) and is consumed. ``cars`` columns: key,
    ts, body, engine, remoteControl, wheels (structs holding a ``part`` struct), and ``seq``
    where rows of a key can tie; ``parts``: key, ts, part struct (sku, partName, price, ...),
    ``seq`` likewise."""
    got = join_in_order(cars, parts, key, Wait("full", None), "_left", "_right", calm=calm)
    pairs = _spread(got, cars, key, F.col("_right.part").alias("part"))
    return apply_patch(pairs).drop("part", "seq")


def priced_wait_join(unpriced: DataFrame, priced: DataFrame, key: str, within: str,
                     keep: str | None = None) -> DataFrame:
    """JN6: unpriced/priced wait-join. An unpriced row waits ``within``; at the end the
    priced row wins (COMPLETE) if it came before the deadline, else the unpriced row
    leaves as AWAITING_PRICE. A priced row already there settles it at once.
    Output: key, ts (emit time), situation, ``record`` = the winning side's payload."""
    seq = [F.col("unpriced.seq").alias("seq")] if "seq" in unpriced.columns else []
    j = wait_join_left(pack(unpriced, key, "unpriced").select(
        key, F.col("unpriced.ts").alias("ts"), *seq, "unpriced"), priced, key, within, "priced",
        keep=keep)
    won = F.col("priced").isNotNull()
    return j.select(key, "ts",
                    F.when(won, F.lit("COMPLETE")).otherwise(F.lit("AWAITING_PRICE"))
                    .alias("situation"),
                    F.when(won, F.col("priced").dropFields("ts"))
                    .otherwise(F.col("unpriced").dropFields("ts")).alias("record"))
