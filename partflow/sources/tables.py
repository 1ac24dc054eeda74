"""Reading the driver's parquet tables. Column selection and filters are applied by the
callers right on top of the scan so that Catalyst prunes columns and pushes filters into
the Parquet reader (``ReadSchema`` / ``PushedFilters`` in the plan)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)
