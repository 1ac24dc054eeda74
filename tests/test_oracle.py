"""T4: every registered batch query against its DuckDB oracle (sf0.01)."""

import pytest

from partflow.plans.catalog import QUERIES
from partflow.plans.check import compare
from partflow.plans.oracle import ORACLE

from data_dirs import SF01

NAMES = [n for n in QUERIES if n in ORACLE]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF01, [name])[name]
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["columns_match"], res
    assert res["types_match"], res
    assert res["values_match"], res


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
