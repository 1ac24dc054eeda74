"""JN4 latest-value join, AG2 last-N per key and AG5 first per key, batch forms over
an arrival order ``(ts, seq)``. All run on the skew-safe keyed scans of
``operators/keyed.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.operators import keyed

# Length of the time buckets a key is split into for its running scans.
BUCKET_SECONDS = 3600


def latest_value_join(df: DataFrame, key: str, left: str, right: str,
                      order=("ts", "seq"), bucket_seconds: int = BUCKET_SECONDS
                      ) -> DataFrame:
    """JN4: each side keeps its latest value for ever; every arrival emits once both
    sides have one. ``df`` holds both sides' arrivals: ``left`` is non-null on a left
    arrival, ``right`` on a right one. Output: the emitting rows with ``left_latest``
    and ``right_latest``."""
    out = keyed.last_non_null(df, key, list(order), keyed.time_bucket("ts", bucket_seconds),
                              {left: "left_latest", right: "right_latest"})
    return out.filter(F.col("left_latest").isNotNull() & F.col("right_latest").isNotNull())


def last_n(df: DataFrame, key: str, value: str, n: int, order=("ts", "seq"),
           bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """AG2: on every arrival, the key's newest ``n`` values, oldest first, the current
    one included: column ``last_<n>`` (array) and ``n_last``."""
    out = keyed.last_n(df, key, list(order), keyed.time_bucket("ts", bucket_seconds), n,
                       value, prefix="_prev")
    window = F.array(*[F.col(f"_prev_{k}") for k in range(n - 1, 0, -1)], F.col(value))
    cnt = F.col("_prev_count")
    return (out.withColumn(f"last_{n}", F.slice(window, (F.lit(n + 1) - cnt).cast("int"),
                                                cnt.cast("int")))
            .withColumnRenamed("_prev_count", "n_last")
            .drop(*[f"_prev_{k}" for k in range(1, n)]))


def first_per_key(df: DataFrame, key: str, order=("ts", "seq"), flag: str = "is_first"
                  ) -> DataFrame:
    """AG5: flag the first arrival of each key."""
    return keyed.first_per_key(df, key, list(order), flag)
