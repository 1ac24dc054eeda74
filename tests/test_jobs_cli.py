"""The command line runs the batch jobs end to end."""

from partflow.plans import jobs
from partflow.session import scratch_path

from data_dirs import SF001


def test_cli_batch_jobs(spark):
    out = scratch_path(spark, "cli")
    jobs.main(["assemble", "--tables", SF001, "--out", f"{out}/a", "--policy", "documented"])
    jobs.main(["first-body", "--tables", SF001, "--out", f"{out}/d"])
    jobs.main(["word-count", "--tables", SF001, "--out", f"{out}/c"])
    n_cars = sum(spark.read.parquet(f"{out}/a/{s}").count() for s in ("complete", "incomplete"))
    assert n_cars > 0
    assert spark.read.parquet(f"{out}/d").filter("is_first").count() > 0
    assert spark.read.parquet(f"{out}/c").count() > 0
