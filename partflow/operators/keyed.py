"""Skew-safe keyed scans: per-key running rank, last non-null value, last N rows and
first row, in the order of some columns.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task; with a key
that holds a third of all rows that task would do a third of the work. Here each key is
split into *buckets*: a column that never decreases along the order (a time bucket, an
id range). Windows run per ``(key, bucket)``; what crosses a bucket border (row counts,
last values, the last few rows) is first reduced to a table with one or a few rows per
``(key, bucket)`` and scanned per key there, which is small whatever the skew. The
result is joined back on ``(key, bucket)``; the big side is already partitioned that way,
so only the small table moves. The small tables come from grouped aggregates of the
input (combined map-side), so the big table is shuffled once per scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_B = "_bucket"


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def time_bucket(ts: str | Column, seconds: int) -> Column:
    """Bucket number of a timestamp for buckets of ``seconds`` length."""
    c = F.col(ts) if isinstance(ts, str) else ts
    micros = F.unix_micros(c.cast("timestamp"))  # NTZ and LTZ alike; session is UTC
    return F.floor(micros / F.lit(seconds * 1_000_000)).cast("long")


_DEFAULT = {T.StringType: "", T.BinaryType: b"", T.BooleanType: False}
_FIRST = -(1 << 63)


def _joinable(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with columns that say the same as ``keys`` and are never null: per key its value
    (or a default) and whether it is null. Windows, aggregates and joins all use them, by
    plain equality: rows with a null key are a group like any other, and the join finds the
    big side partitioned and sorted as the window left it."""
    out, names = df, []
    for i, c in enumerate(keys):
        t = df.schema[c].dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            default = F.lit("1970-01-01").cast(t)
        else:
            default = F.lit(_DEFAULT.get(type(t), 0)).cast(t)
        out = out.withColumn(f"_k{i}", F.coalesce(F.col(c), default)).withColumn(
            f"_z{i}", F.col(c).isNull())
        names += [f"_k{i}", f"_z{i}"]
    return out, names


def _with_bucket(df: DataFrame, keys: list[str], bucket: Column | str
                 ) -> tuple[DataFrame, list[str]]:
    """``df`` with its joinable keys and bucket (a null bucket comes before all others), and
    the names of the key columns."""
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    out, names = _joinable(df, keys)
    return out.withColumn(_B, F.coalesce(b.cast("long"), F.lit(_FIRST))), names


def _join(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner"
          ) -> DataFrame:
    """Join on ``cols`` with null-safe equality (a null key or a null time is a group
    like any other; plain equality would drop those rows), keeping one copy of
    ``cols``."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in cols])


def running_rank(df: DataFrame, key, order: Sequence[str], bucket, name: str = "rank"
                 ) -> DataFrame:
    """Add ``name`` = 1-based position of each row within its key, in ``order``.

    Equals ``row_number() over (partition by key order by order)``."""
    b, keys = _with_bucket(df, _cols(key), bucket)
    local = b.withColumn("_rn", F.row_number().over(
        Window.partitionBy(*keys, _B).orderBy(*order)))
    counts = b.groupBy(*keys, _B).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, _B, F.coalesce(F.sum("_n").over(before), F.lit(0))
                            .alias("_off"))
    return (local.join(offsets, [*keys, _B])
            .withColumn(name, (F.col("_off") + F.col("_rn")).cast("long"))
            .select(*df.columns, name))


def bucket_counts(lines: DataFrame, items: Column, key: str, bucket) -> DataFrame:
    """``key``, its bucket and how often the elements of ``items`` are the key there."""
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    return lines.select(F.coalesce(b.cast("long"), F.lit(_FIRST)).alias(_B),
                        F.explode(items).alias(key)).groupBy(_B, key).agg(
        F.count(F.lit(1)).alias("n"))


def running_rank_of_items(lines: DataFrame, items: Column, key: str, order: Sequence[str], bucket,
                          pos: str = "pos", name: str = "rank", counts: DataFrame | None = None,
                          so_far: DataFrame | None = None) -> DataFrame:
    """One row per element of the array ``items`` of each line: ``order``, ``pos`` (from 1), the
    element as ``key`` and its 1-based position ``name`` among equal elements, by ``order`` and
    place. ``so_far`` (key, n) counts on from there.

    Lines travel whole, once, to their bucket and are taken apart there; an element's count in
    earlier buckets comes as one more line of the bucket, before all others. So what is shuffled
    is the lines (all their columns) and a number per (bucket, key), no row per element. ``counts``:
    ``bucket_counts`` of the same lines, where the caller has them."""
    counts = bucket_counts(lines, items, key, bucket) if counts is None else counts
    per = counts.select(key, _B, "n")
    if so_far is not None:
        per = per.unionByName(so_far.select(key, F.lit(None).cast("long").alias(_B), "n"))
    before = (Window.partitionBy(key).orderBy(F.asc_nulls_first(_B))
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = per.select(key, _B, F.sum("n").over(before).alias("_v")).where(
        F.col(_B).isNotNull() & (F.col("_v") > 0))
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    own = lines.withColumn(_B, F.coalesce(b.cast("long"), F.lit(_FIRST)))
    # By a given number: lines grow when they are taken apart, so small partitions stay apart.
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = own.unionByName(carry.withColumnRenamed(key, "_key"), allowMissingColumns=True
                           ).repartition(n, _B)
    words = F.when(F.col("_v").isNull(), items).otherwise(F.array("_key"))
    rows = both.select(_B, "_v", *order, F.posexplode(words).alias("_p", key)).withColumn(
        "_h", F.xxhash64(_B, key))  # sorts by a number first
    w = (Window.partitionBy("_h", _B, key)
         .orderBy(F.col("_v").isNull(), *order, "_p")
         .rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(name, F.sum(F.coalesce("_v", F.lit(1).cast("long"))).over(w)).where(
        F.col("_v").isNull()).select(*order, (F.col("_p") + 1).alias(pos), key, name)


def last_non_null(df: DataFrame, key, order: Sequence[str], bucket,
                  columns: dict[str, str]) -> DataFrame:
    """For each ``src -> out`` in ``columns`` add ``out`` = the last non-null ``src`` of
    the key up to and including the row. Equals
    ``last(src, ignorenulls) over (partition by key order by order rows unbounded
    preceding)``."""
    b, keys = _with_bucket(df, _cols(key), bucket)
    w = (Window.partitionBy(*keys, _B).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, 0))
    local = b
    for src, out in columns.items():
        local = local.withColumn(f"_l_{out}", F.last(src, ignorenulls=True).over(w))
    ordering = F.struct(*order)
    tails = b.groupBy(*keys, _B).agg(*[
        F.max_by(F.col(src), F.when(F.col(src).isNotNull(), ordering)).alias(f"_t_{out}")
        for src, out in columns.items()])
    before = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select(*keys, _B, *[
        F.last(f"_t_{out}", ignorenulls=True).over(before).alias(f"_c_{out}")
        for out in columns.values()])
    return local.join(carry, [*keys, _B]).select(*df.columns, *[
        F.coalesce(F.col(f"_l_{out}"), F.col(f"_c_{out}")).alias(out)
        for out in columns.values()])


def last_n(df: DataFrame, key, order: Sequence[str], bucket, n: int, value: str,
           prefix: str = "prev") -> DataFrame:
    """Add ``{prefix}_1 .. {prefix}_{n-1}``: the ``value`` of the row 1 .. n-1 places
    before, within the key (null when there is none), and ``{prefix}_count`` = how many
    rows of the key up to and including this one, capped at n (the list length).

    Inside a bucket ``lag`` does it. Only the first n-1 rows of a bucket look across
    the border: they are matched by rank against the last n-1 rows of every bucket,
    two tables of at most n-1 rows per (key, bucket).

    The bucket windows feed three branches (rows that stay, heads, tails); they are
    computed once and written as a table in the shared folder (``spark.checkpoint.dir``)
    rather than recomputed, with a shuffle each, per branch."""
    b, keys = _with_bucket(df, _cols(key), bucket)
    w = Window.partitionBy(*keys, _B).orderBy(*order)
    local = (b.withColumn("_rn", F.row_number().over(w))
             .withColumn("_cnt", F.count(F.lit(1)).over(Window.partitionBy(*keys, _B))))
    for k in range(1, n):
        local = local.withColumn(f"{prefix}_{k}", F.lag(value, k).over(w))
    from partflow.session import materialize
    local = materialize(local, "last-n")
    # Each bucket has one first row, so its size comes from the written table.
    before = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = local.filter("_rn = 1").select(
        *keys, _B, F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    # Rows whose window reaches into an earlier bucket, and rows another bucket can
    # reach: both at most n-1 per (key, bucket).
    heads = local.filter(F.col("_rn") < n).join(offsets, [*keys, _B])
    heads = heads.withColumn("_rank", F.col("_off") + F.col("_rn"))
    tails = (local.filter(F.col("_rn") > F.col("_cnt") - (n - 1)).join(offsets, [*keys, _B])
             .select(*keys, (F.col("_off") + F.col("_rn")).alias("_trank"),
                     F.col(value).alias("_tval")))
    for k in range(1, n):
        t = tails.select(*keys, (F.col("_trank") + k).alias("_rank"),
                         F.col("_tval").alias(f"_x{k}"))
        heads = heads.join(t, [*keys, "_rank"], "left")
        heads = heads.withColumn(f"{prefix}_{k}", F.when(F.col("_rn") > k, F.col(f"{prefix}_{k}"))
                                 .otherwise(F.col(f"_x{k}"))).drop(f"_x{k}")
    heads = heads.withColumn(f"{prefix}_count", F.least(F.col("_rank"), F.lit(n)).cast("long"))
    rest = local.filter(F.col("_rn") >= n).withColumn(f"{prefix}_count", F.lit(n).cast("long"))
    cols = [c for c in df.columns] + [f"{prefix}_{k}" for k in range(1, n)] + [f"{prefix}_count"]
    return rest.select(*cols).unionByName(heads.select(*cols))


def first_per_key(df: DataFrame, key, order: Sequence[str], flag: str = "is_first"
                  ) -> DataFrame:
    """Add boolean ``flag``: the row is the first of its key in ``order``.

    The first row per key is a grouped ``min`` of the order struct (combined map-side,
    so a hot key costs one partial row per task); it is joined back on key *and* order
    columns, which spread evenly however skewed the key is. ``order`` must identify a
    row within its key."""
    keys = _cols(key)
    firsts = (df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_f"))
              .select(*keys, *[F.col(f"_f.{c}").alias(c) for c in order])
              .withColumn(flag, F.lit(True)))
    return (_join(df, firsts, [*keys, *order], "left")
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))
