"""Run registered queries in Spark and their oracle SQL in DuckDB and compare: row
count, column names and an order-insensitive digest of the values (doubles rounded to
6 places, timestamps as text). Used by the tests and by hand:

    python -m partflow.plans.check /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import sys
import time

from partflow.sources.tables import TABLES


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode())
        h.update(b"\n")
    return h.hexdigest()


DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
              "timestamp": "TIMESTAMP WITH TIME ZONE"}


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names=None) -> dict[str, dict]:
    from partflow.plans.catalog import QUERIES
    from partflow.plans.oracle import ORACLE
    con = duck(sf_dir)
    out = {}
    for name in names or list(QUERIES):
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        res = {"spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
        if name in ORACLE:
            cur = con.execute(ORACLE[name])
            d_cols = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
            s_types = {f.name: DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                       for f in df.schema.fields}
            d_types = {c[0]: str(c[1]) for c in cur.description}
            res.update(oracle_rows=len(d_rows),
                       columns_match=sorted(s_cols) == sorted(d_cols),
                       types_match=s_types == d_types,
                       values_match=digest(s_cols, s_rows) == digest(d_cols, d_rows))
            if not res["columns_match"]:
                res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
        out[name] = res
    return out


if __name__ == "__main__":
    from partflow.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    for k, v in compare(spark, sf, sys.argv[2:] or None).items():
        print(k, v, flush=True)
