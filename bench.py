"""Bench: run every query of the reference's operators (second names of a query left out) at
$BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and print one JSON line.
Each query runs to completion into Spark's ``noop`` sink (the whole plan executes, nothing is
collected to the driver)."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from partflow.plans.catalog import QUERIES
    from partflow.session import local_session
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app="partflow-bench")
    only = [q for q in sys.argv[1:] if q in QUERIES] or [q for q in QUERIES if "_all" not in q]
    times, errors = {}, {}
    for name in only:
        t0 = time.time()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report and go on with the others
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_sec", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    if "stream_route_counts" in times:  # job A end to end as a stream: part messages/s
        from partflow.sources import fixtures as fx
        parts = fx.car_parts(spark, sf_dir)
        msgs = sum(parts[k].count() for k in ("body", "engine", "remote", "wheel"))
        out["stream_job_a_messages"] = msgs
        out["stream_job_a_msgs_per_sec"] = round(msgs / times["stream_route_counts"], 1)
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
