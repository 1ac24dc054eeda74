"""General batch form of the stateful operators: the per-key machines of
``partflow.streaming.machines`` run over a batch table.

The closed forms in ``waitjoins`` are exact when a key has one row per side; with
repeated rows per key (a second body while one waits, two cars for one sku, ...) the
outcome depends on the order of arrivals, so it is computed in that order. The table
is hash-partitioned by key and sorted within partitions by ``(key, ts, seq)`` (Spark's
external sort: spills, bounded memory); ``mapInPandas`` then streams the sorted Arrow
batches through the machine, holding one key's small state at a time and the rows of
one instant. No key is ever collected into memory, and the result equals the streaming
form on the same input (``tests/test_stream.py``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.streaming.machines import Machine, PyItems, WaitJoin, drive, expire
from partflow.streaming.processor import OUTPUT_SCHEMA

_END = 2**62  # settles every deadline of a key once its rows are done


def run_machine(frame: DataFrame, machine: Machine, partitions: int | None = None
                ) -> DataFrame:
    """``frame``: topic frame ``key, side, ts, seq, value``. Returns ``key, ts_us,
    value`` (emit time in microseconds), every wait settled."""
    df = frame.select("key", "side", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
                      "seq", "value")
    # By a hash of the key, not the key itself: were the input already partitioned by key,
    # Spark would drop this exchange, and its adaptive plan then need not keep a key's rows
    # of a union together, which mapInPandas can't ask for.
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df.repartition(n, F.xxhash64("key"))
    df = df.sortWithinPartitions("key", "ts_us", "seq")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, st, items, instant = None, {}, PyItems(), []
        for pdf in batches:
            outs: list[tuple[str, int, str]] = []

            def flush_instant():
                outs.extend((key, t, v) for t, v in drive(machine, st, items, instant))

            for k, t, seq, side, value in zip(pdf["key"], pdf["ts_us"], pdf["seq"],
                                              pdf["side"], pdf["value"]):
                if k != key or (instant and t != instant[0][0]):
                    if instant:
                        flush_instant()
                        instant = []
                    if k != key:
                        if key is not None:
                            outs.extend((key, t2, v) for t2, v in expire(machine, st, items, _END))
                        key, st, items = k, {}, PyItems()
                instant.append((int(t), int(seq), side, value))
            if outs:
                yield pd.DataFrame(outs, columns=["key", "ts_us", "value"])
        tail: list[tuple[str, int, str]] = []
        if instant:
            tail.extend((key, t, v) for t, v in drive(machine, st, items, instant))
        if key is not None:
            tail.extend((key, t, v) for t, v in expire(machine, st, items, _END))
        if tail:
            yield pd.DataFrame(tail, columns=["key", "ts_us", "value"])

    return (df.mapInPandas(run, OUTPUT_SCHEMA)
            .withColumn("ts", F.timestamp_micros("ts_us").cast("timestamp_ntz")))


# Times travel inside the JSON payloads with all their digits.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
         "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def machine_join(rows: DataFrame, key: str, wait, lt: T.DataType, rt: T.DataType,
                 time: T.DataType) -> DataFrame:
    """The wait-join ``wait`` of segments ``rows`` (key, _seg, e; see ``operators.folds``) in
    arrival order, row by row: ``key, o, seq`` as the fold gives them. For segments too long
    to be folded in one piece."""
    from partflow.operators.folds import micros
    collect = wait.mode == "collect"
    within = None if wait.within is None else micros(wait.within)
    keep = None if wait.keep is None else micros(wait.keep)
    machine = WaitJoin(wait.mode, within, "l", "r", wait.expected, numbered=True, keep=keep)
    of = T.StructType([T.StructField("k", rows.schema[key].dataType),
                       T.StructField("g", rows.schema["_seg"].dataType)])
    group = F.to_json(F.struct(F.col(key).alias("k"), F.col("_seg").alias("g")), _JSON)
    # The machine sorts by (ts, seq) and takes an instant's right rows first by itself.
    e, is_left = F.col("e"), F.col("e.s") == 0
    seq = (e["a"] * 2 + e["b"]) if wait.mode == "full" else e["b"]
    frame = rows.select(group.alias("key"), F.when(is_left, "l").otherwise("r").alias("side"),
                        e["ts"].cast("timestamp").alias("ts"), seq.alias("seq"),
                        F.when(is_left, F.to_json(e["l"], _JSON))
                        .otherwise(F.to_json(e["r"], _JSON)).alias("value"))
    out = run_machine(frame, machine)

    def side(name, t):
        return F.from_json(F.get_json_object("value", f"$.{name}"), t, _JSON)
    o = F.struct(side("l", lt).alias("l"), side("r", T.ArrayType(rt) if collect else rt)
                 .alias("r"), F.col("ts").cast(time).alias("ts"),
                 F.get_json_object("value", "$.now").cast("boolean").alias("now"))
    return out.select(F.from_json("key", of, _JSON)["k"].alias(key), o.alias("o"),
                      F.get_json_object("value", "$.at").cast("long").alias("seq"))
