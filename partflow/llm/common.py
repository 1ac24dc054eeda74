"""Shared pieces of the training-data operators: session settings, tables, word rules."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.session import apply_core_conf, shared_dir, ship_package

#: A word, and white space between words (fixed by the queries' contracts).
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every operator here relies on. Arrow batches are bounded in rows, because a
    batch of long texts must fit a Python worker."""
    apply_core_conf(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage, so a lost
    executor recomputes nothing before it, and lets several branches share one pass."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str | Column = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def parallelism(spark: SparkSession) -> int:
    """Partitions a shuffle gets in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash_chosen(df: DataFrame, key: Column, rows: int) -> Column:
    """Whether a row is among about ``rows`` rows at most, chosen by a hash of ``key`` alone,
    so that reruns agree."""
    n = df.count()
    if n <= rows:
        return F.lit(True)
    return (F.pmod(F.xxhash64(F.lit(17), key), F.lit(1 << 30))
            < F.lit(int((1 << 30) * rows / n)))


def hash_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """The rows that ``hash_chosen`` chooses."""
    return df.where(hash_chosen(df, key, rows))


def slices(items: list[str], most: int) -> Iterator[list[str]]:
    """``items`` in order, cut into lists of about ``most`` characters."""
    part, size = [], 0
    for x in items:
        part.append(x)
        size += len(x)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def texts(column) -> Iterable[str]:
    """Python strings of an Arrow column, null as the empty text."""
    return [x or "" for x in column.to_pylist()]
