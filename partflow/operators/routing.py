"""SNK6 multi-way routing, batch form: priced COMPLETE cars go to the complete sink;
priced cars in any other state and assembled cars missing a part go to the incomplete
sink (two feeds into one sink: a UNION ALL)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPLETE = "COMPLETE"


def route(assembled: DataFrame, priced: DataFrame, situation: str = "situation"
          ) -> dict[str, DataFrame]:
    s_p, s_a = F.col(situation), F.col(situation)
    complete = priced.filter(s_p == COMPLETE)
    incomplete = priced.filter(s_p != COMPLETE).unionByName(
        assembled.filter(s_a.contains("MISSING")), allowMissingColumns=True)
    return {"complete": complete, "incomplete": incomplete}


def route_counts(routes: dict[str, DataFrame], situation: str = "situation") -> DataFrame:
    """Rows per (sink, situation): the conservation check of the routing."""
    parts = [df.select(F.lit(name).alias("sink"), F.col(situation).alias("situation"))
             for name, df in routes.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("sink", "situation").agg(F.count(F.lit(1)).alias("n"))
