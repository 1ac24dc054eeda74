"""Wait-joins of keys with any number of rows, as folds inside the JVM.

A key's rows of both sides are collected in arrival order and folded by ``aggregate`` with the
join's small state as a struct: who waits, until when, what has left. Nothing leaves the JVM
and there is one exchange, by key (``waits``; ``job`` chains the folds of several joins on one
grouped row).

A key with more than ``MOST`` rows (its count is known before anything is collected) is cut
into segments first: at a point where the join's state is empty, or is set anew by the next row
whatever it was, so that the segments can be folded apart from each other.

* ``full``: where nothing comes for as long as the wait, everybody has left.
* ``left``: likewise, but a right row goes on waiting. It doesn't where the last row before the
  gap is a left one (which takes it, or leaves without), and it is replaced where the first row
  after the gap is a right one.
* ``collect``: right rows go on collecting; only a gap after a left row ends them.
* no wait limit: of two rows of one side in a row the second is the one that waits, whatever
  was before.

Points are found by windows within time buckets of the key and a table of one row per bucket
(``keyed`` style), so a hot key is spread over many tasks throughout. A segment that is still
longer than ``MOST`` runs row by row through the streaming machine in sorted order
(``sequential.machine_join``), which holds one key's state and no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.operators.keyed import last_non_null, time_bucket

#: Rows of a key or segment that are folded in one piece at most, and in one step of it.
MOST, CHUNK = 10_000, 128
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}


def micros(within: str) -> int:
    """``'5 seconds'`` in microseconds."""
    n, unit = within.split()
    return int(n) * UNITS[unit.rstrip("s")] * 1_000_000


@dataclass(frozen=True)
class Wait:
    """Which wait-join: ``mode`` ``full``, ``left`` or ``collect``; ``within`` such as ``5
    seconds``, None without limit; the number of right rows that a left row leaves with at
    once (``collect``). With ``keep`` a right row that nobody took expires that long after
    its arrival (``left``, ``collect``; event time): it takes part strictly before."""
    mode: str
    within: str | None
    expected: int | None = None
    keep: str | None = None

    def kept(self, r: Column, at: Column) -> Column:
        """What of the waiting right row (or rows) has not expired by ``at``."""
        if self.keep is None:
            return r
        end = F.expr(f"INTERVAL {self.keep}")
        if self.mode == "collect":
            return F.filter(r, lambda x: x["ts"] + end > at)
        return F.when(r["ts"] + end > at, r)

    def until(self, ts: Column) -> Column:
        if self.within is None:
            return F.lit(None).cast("timestamp_ntz")
        return ts + F.expr(f"INTERVAL {self.within}")


def _null(t: T.DataType) -> Column:
    return F.lit(None).cast(t)


def nullable(t: T.DataType) -> T.DataType:
    """``t`` with every field and element nullable: the state's rows come from several
    branches."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType)) for f in t])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(nullable(t.elementType))
    if isinstance(t, T.MapType):
        return T.MapType(nullable(t.keyType), nullable(t.valueType))
    return t


def event(wait: Wait, side: int, ts: Column, seq: Column, left: Column, right: Column) -> Column:
    """An arrival. Sorted by its fields it comes in the join's order: by time, then in a full
    join by ``seq`` and left before right, else right before left and by ``seq``."""
    s = F.lit(side)
    first, then = ((seq, s.cast("long")) if wait.mode == "full"
                   else (F.lit(1 - side).cast("long"), seq))
    return F.struct(ts.alias("ts"), first.alias("a"), then.alias("b"), s.alias("s"),
                    left.alias("l"), right.alias("r"))


def state_type(wait: Wait, lt: T.DataType, rt: T.DataType, time: T.DataType) -> T.StructType:
    """Who waits: a left row, a right one (collected ones), the deadline."""
    lt, rt = nullable(lt), nullable(rt)
    return T.StructType([T.StructField("l", lt), T.StructField(
        "r", T.ArrayType(rt) if wait.mode == "collect" else rt), T.StructField("wd", time)])


def out_type(wait: Wait, lt: T.DataType, rt: T.DataType, time: T.DataType) -> T.StructType:
    """What leaves; ``now`` tells rows that leave on an arrival from those that leave at a
    deadline."""
    state = state_type(wait, lt, rt, time)
    return T.StructType([state["l"], state["r"], T.StructField("ts", time),
                         T.StructField("now", T.BooleanType())])


def fold_from(events: Column, wait: Wait, lt: T.DataType, rt: T.DataType, time: T.DataType,
              state: Column | None = None, until: Column | None = None) -> Column:
    """Fold ``events``, a sorted array of ``event``s, on from ``state`` (nothing waits): a
    struct of the state after them (l, r, wd) and ``out``, what has left, in order. Without
    ``until`` everybody who has a deadline leaves in the end; with it those whose deadline
    lies before.

    Outputs are gathered per ``CHUNK`` events, so that a long array isn't copied per event."""
    one, held = out_type(wait, lt, rt, time), state_type(wait, lt, rt, time)
    collect = wait.mode == "collect"
    none = F.array().cast(T.ArrayType(one))
    no_rows = F.array().cast(held["r"].dataType) if collect else _null(held["r"].dataType)

    none_l, none_r = _null(held["l"].dataType), _null(held["r"].dataType)
    never = _null(time)

    def leaves(l, r, ts, now):
        return F.array(F.struct(l.alias("l"), r.alias("r"), ts.cast(time).alias("ts"),
                                F.lit(now).alias("now")).cast(one))

    def acc_of(l, r, wd, out):
        return F.struct(l.alias("l"), r.alias("r"), wd.alias("wd"), out.alias("out"))

    # Lambdas are interpreted, every mention of a column is evaluated anew: one decision per
    # event, arrays are only touched when something leaves.
    def arrives(l, r, wd, out, e):
        is_left, starts = e["s"] == 0, wait.until(e["ts"]).cast(time)
        if wait.mode == "full":
            meets = F.when(is_left, r.isNotNull()).otherwise(l.isNotNull())
            met = leaves(F.coalesce(e["l"], l), F.coalesce(e["r"], r), e["ts"], True)
            return F.when(meets, acc_of(none_l, none_r, never, F.concat(out, met))).otherwise(
                acc_of(F.coalesce(e["l"], l), F.coalesce(e["r"], r),
                       F.when(l.isNotNull() | r.isNotNull(), wd).otherwise(starts), out))
        there = F.size(r) == wait.expected if collect else r.isNotNull()
        return (F.when(~is_left, acc_of(
            l, F.concat(r, F.array(e["r"])) if collect else e["r"], wd, out))
            .when(there, acc_of(l, no_rows, wd, F.concat(out, leaves(e["l"], r, e["ts"], True))))
            .otherwise(acc_of(e["l"], r, F.when(l.isNull(), starts).otherwise(wd), out)))

    def step(acc, e):
        after = arrives(acc["l"], wait.kept(acc["r"], e["ts"]), acc["wd"], acc["out"], e)
        if wait.within is None:
            return after
        gone = leaves(acc["l"], wait.kept(acc["r"], acc["wd"]), acc["wd"], False)
        return F.when(acc["wd"] <= e["ts"], arrives(
            none_l, no_rows, never, F.concat(acc["out"], gone), e)).otherwise(after)

    def begin(l, r, wd):
        return acc_of(l, r, wd, none)

    def chunk(acc, some):
        got = F.aggregate(some, begin(acc["l"], acc["r"], acc["wd"]), step)
        return F.aggregate(F.array(got), acc, lambda a, x: acc_of(
            x["l"], x["r"], x["wd"], F.concat(a["out"], x["out"])))

    def end(acc):
        over = acc["wd"].isNotNull() if until is None else acc["wd"] < until
        gone = leaves(acc["l"], wait.kept(acc["r"], acc["wd"]), acc["wd"], False)
        return F.when(over, acc_of(none_l, no_rows, never, F.concat(acc["out"], gone))).otherwise(
            acc_of(acc["l"], acc["r"] if until is None else wait.kept(acc["r"], until),
                   acc["wd"], acc["out"]))
    if state is None:
        start = begin(_null(held["l"].dataType), no_rows, _null(time))
    else:
        start = begin(state["l"], F.coalesce(state["r"], no_rows) if collect else state["r"],
                      state["wd"])
    def chunked(ev):
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(ev) - 1) / CHUNK).cast("int")),
                             lambda i: F.slice(ev, i * CHUNK + 1, CHUNK))
        return F.aggregate(chunks, start, chunk, end)

    # Bound once: it may be the fold before.
    return F.element_at(F.transform(F.array(events), lambda ev: F.when(
        F.size(ev) <= CHUNK, F.aggregate(ev, start, step, end)).otherwise(chunked(ev))), 1)


def fold(events: Column, wait: Wait, lt: T.DataType, rt: T.DataType, time: T.DataType) -> Column:
    """What leaves of a key whose arrivals are all there, in order."""
    return fold_from(events, wait, lt, rt, time)["out"]


def number(out: Column, pos: Column) -> Column:
    """Order of what leaves at one time: at a deadline first, then by arrival."""
    return F.when(out["now"], pos + 1).otherwise(F.lit(0)).cast("long")


def _sides(left: DataFrame, right: DataFrame, key: str, wait: Wait, order: tuple[str, ...]
           ) -> tuple[DataFrame, T.DataType, T.DataType]:
    """Both sides as one table ``key, e``."""
    def payload(df, first=()):
        return F.struct(*first, *[c for c in df.columns if c not in (key, *first)])

    def seq(df):
        return (F.col("seq").cast("long") if "seq" in df.columns else F.lit(0).cast("long"))
    first = order if wait.mode == "collect" else ()
    lt = nullable(left.select(payload(left).alias("x")).schema["x"].dataType)
    rt = nullable(right.select(payload(right, first).alias("x")).schema["x"].dataType)
    rows = left.select(key, event(wait, 0, F.col("ts"), seq(left), payload(left), _null(rt))
                       .alias("e")).unionByName(
        right.select(key, event(wait, 1, F.col("ts"), seq(right), _null(lt),
                                payload(right, first)).alias("e")))
    return rows, lt, rt


def hot_keys(rows: DataFrame, key: str, most: int) -> DataFrame | None:
    """Keys with more than ``most`` rows and, per key, the last arrival of a left row; None if
    there are none. Counted with partial aggregation, before anything is collected."""
    from partflow.session import materialize
    n = (rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                               F.max(F.when(F.col("e.s") == 0, F.col("e.ts"))).alias("_last"))
         .where(F.col("_n") > most).drop("_n"))
    found = materialize(n, "hot-keys")
    return None if found.isEmpty() else found


def segments(rows: DataFrame, key: str, wait: Wait) -> DataFrame:
    """``rows`` (key, e) with ``_seg``: the first arrival of the row's segment."""
    seconds = 86_400 if wait.within is None else max(1, 4 * micros(wait.within) // 1_000_000)
    order = ["_ts", "_a", "_b"]
    flat = rows.select(key, "e", *[F.col(f"e.{c}").alias(f"_{c}") for c in ("ts", "a", "b", "s")],
                       time_bucket(F.col("e.ts"), seconds).alias("_bk"))
    before = F.lag(F.struct("_ts", "_s")).over(
        Window.partitionBy(key, "_bk").orderBy(*order))
    # Per bucket its last row; the first row of a bucket looks at the bucket before.
    tails = (flat.groupBy(key, "_bk").agg(F.max(F.struct(*order, "_s")).alias("_t"))
             .select(key, "_bk", F.lag(F.struct("_t._ts", "_t._s")).over(
                 Window.partitionBy(key).orderBy("_bk")).alias("_carry")))
    both = (flat.withColumn("_before", before).join(tails, [key, "_bk"])
            .withColumn("_p", F.coalesce("_before", "_carry")))
    after, side, was = F.col("_p._ts"), F.col("_s"), F.col("_p._s")
    if wait.within is None:
        cut = was == side
    else:
        cut = F.col("_ts") >= wait.until(after)
        if wait.mode == "left":
            cut = cut & ((was == 0) | (side == 1))
        elif wait.mode == "collect":
            cut = cut & (was == 0)
    marks = both.withColumn("_start", F.when(
        F.col("_p").isNull() | cut, F.struct(*order))).drop("_before", "_carry", "_p")
    return last_non_null(marks, key, order, F.col("_bk"), {"_start": "_seg"}).select(
        key, "e", "_seg")


def _fold_groups(rows: DataFrame, by: list[str], wait: Wait, lt, rt, time) -> DataFrame:
    """Fold the events of each group: ``by, o`` (an output) and ``seq``."""
    grouped = rows.groupBy(*by).agg(F.sort_array(F.collect_list("e")).alias("_e"))
    out = grouped.select(*by, F.posexplode(fold(F.col("_e"), wait, lt, rt, time))
                         .alias("_pos", "o"))
    return out.withColumn("seq", number(F.col("o"), F.col("_pos")))


def join_in_order(left: DataFrame, right: DataFrame, key: str, wait: Wait,
                  left_name: str = "left", right_name: str = "right",
                  order: tuple[str, ...] = (), most: int | None = None, calm: bool = False
                  ) -> DataFrame:
    """A wait-join of two tables in arrival order: ``key, <left>, <right>, ts, seq``, the sides'
    rows as structs without the key. For a collecting join the right rows are an array with
    ``order`` as first fields, sorted, next to ``n_<right>``. ``seq`` orders what leaves at the
    same time. Rows with a null key meet nobody. ``calm``: the caller has counted, no key has more
    than ``MOST`` rows; else they are counted here, which computes both sides once more."""
    most = MOST if most is None else most
    time = left.schema["ts"].dataType
    every, lt, rt = _sides(left, right, key, wait, order)
    rows = every.where(F.col(key).isNotNull())
    hot = None if calm else hot_keys(rows, key, most)
    short = rows if hot is None else rows.join(hot, key, "left_anti")
    out = _fold_groups(short, [key], wait, lt, rt, time).select(key, "o", "seq")
    alone = every.where(F.col(key).isNull() & ((F.col("e.s") == 0) | F.lit(wait.mode == "full")))
    if wait.within is not None:
        lone = F.explode(fold(F.array("e"), wait, lt, rt, time)).alias("o")
        out = out.unionByName(alone.select(key, lone).withColumn("seq", F.lit(0).cast("long")))
    if hot is not None:
        out = out.unionByName(_hot(rows.join(hot, key), key, wait, lt, rt, time, most))
    got = F.col("o.r")
    cols = [F.col("o.l").alias(left_name)]
    if wait.mode == "collect":
        cols += [F.array_sort(got).alias(right_name),
                 F.size(got).cast("long").alias(f"n_{right_name}")]
    else:
        cols.append(got.alias(right_name))
    return out.select(key, *cols, F.col("o.ts").alias("ts"), "seq")


def _hot(rows: DataFrame, key: str, wait: Wait, lt, rt, time, most: int) -> DataFrame:
    """The rows of hot keys by segments: ``key, o, seq``."""
    from partflow.operators.sequential import machine_join
    from partflow.session import materialize
    if wait.mode != "full":
        # Right rows past the last left row's wait never leave; they may be many.
        ends = wait.until(F.col("_last"))
        rows = rows.where((F.col("e.s") == 0) | F.coalesce(F.col("e.ts") < ends, F.lit(False)))
    cut = materialize(segments(rows.select(key, "e"), key, wait), "segments")
    long = (cut.groupBy(key, "_seg").agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > most).drop("_n"))
    long = materialize(long, "long-segments")
    if long.isEmpty():
        return _fold_groups(cut, [key, "_seg"], wait, lt, rt, time).select(key, "o", "seq")
    short = cut.join(long, [key, "_seg"], "left_anti")
    whole = cut.join(long, [key, "_seg"], "left_semi")
    return (_fold_groups(short, [key, "_seg"], wait, lt, rt, time).select(key, "o", "seq")
            .unionByName(machine_join(whole, key, wait, lt, rt, time)))
