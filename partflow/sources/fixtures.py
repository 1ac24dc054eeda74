"""Part, price, tax-tag and text tables derived from the driver's tables (FIXTURES.md §2).

Each derived table has the shape the operators consume: ``sku`` key, ``id`` payload,
``ts`` arrival time and ``seq``, the order of rows of a key that tie on time.

Mapping (FIXTURES.md §2.1): every order is a body; of its lines, every line 1 is an engine,
every line 2 a remote control, every line from 3 on a wheel; every part has a price.
``(l_orderkey, l_linenumber)`` repeats in the data, so parts of a sku do: they are further
arrivals of that part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.schemas import BR_STATES, WHEEL_PLACEMENTS
from partflow.sources.tables import table

# Fixed fixture parameters (FIXTURES.md).
ENGINE_LINE = 1
REMOTE_LINE = 2
FIRST_WHEEL_LINE = 3
CAR_WAIT = "700 days"
#: A wheel's ``seq`` is its line times this, plus its part.
LINE_STEP = 1 << 40


def line_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row of ``lineitem``. Rows that tie on time come by their part."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("sku"), F.col("l_partkey").alias("id"),
                     F.col("l_linenumber").alias("ln"), F.col("l_shipdate").alias("ts"))


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("sku"), F.col("o_custkey").alias("id"),
                    F.col("o_orderdate").alias("ts"), F.lit(0).cast("long").alias("seq"))


def _of_line(lines: DataFrame, line: int) -> DataFrame:
    return lines.filter(F.col("ln") == line).select("sku", "id", "ts", F.col("id").alias("seq"))


def engines(lines: DataFrame) -> DataFrame:
    return _of_line(lines, ENGINE_LINE)


def remotes(lines: DataFrame) -> DataFrame:
    return _of_line(lines, REMOTE_LINE)


def wheels(lines: DataFrame) -> DataFrame:
    """Lines from 3 on; places in turn, so that a fifth line is a second front left wheel."""
    placement = F.element_at(F.array(*[F.lit(p) for p in WHEEL_PLACEMENTS]),
                             ((F.col("ln") - FIRST_WHEEL_LINE) % len(WHEEL_PLACEMENTS) + 1)
                             .cast("int"))
    return (lines.filter(F.col("ln") >= FIRST_WHEEL_LINE)
            .select("sku", "id", "ts", "ln",
                    (F.col("ln") * F.lit(LINE_STEP) + F.col("id")).alias("seq"),
                    placement.alias("placement")))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"))


def car_parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    lines = line_parts(spark, sf_dir)
    return {"body": bodies(spark, sf_dir), "engine": engines(lines),
            "remote": remotes(lines), "wheel": wheels(lines),
            "prices": prices(spark, sf_dir)}


def tax_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIXTURES.md §2.2: state = 27-symbol list at user_id % 27, icms = value."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    state = F.element_at(F.array(*[F.lit(s) for s in BR_STATES]),
                         (F.pmod(F.col("user_id"), F.lit(len(BR_STATES))) + 1).cast("int"))
    return e.select(state.alias("state"), F.col("value").alias("icms"), "ts",
                    F.col("event_id").alias("seq"))


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIXTURES.md §2.4: each document text is one line of the text topic."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")
