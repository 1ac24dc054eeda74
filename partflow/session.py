"""Session helpers: the settings every job relies on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on. Timestamps must be compared in UTC so that batch,
# stream and the DuckDB oracle agree; AQE coalesces the small post-shuffle partitions
# of keyed stages and splits skewed join partitions at run time.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "partflow") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, RocksDB state)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_core_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of CORE_CONF to an existing session."""
    for k, v in CORE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # pragma: no cover - static conf on a shared session
            pass
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``partflow``'s code available to the Python workers: its classes and
    functions (processors, machines, ``mapInPandas`` functions, fetch services) are
    pickled by value into the tasks that use them, so executors need no installed copy
    and no file is staged anywhere. Idempotent."""
    if "partflow" in _SHIPPED:
        return
    import partflow
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(partflow)
    _SHIPPED.add("partflow")


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have none
        return None


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only a local
    session without one, as in tests, gets a scratch folder; elsewhere each executor would
    write to its own disk, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = spark.conf.get("spark.master", "")
        if sc is None or not re.fullmatch(r"local(\[[^]]*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and "
                               f"all executors share (master is {master!r})")
        d = tempfile.mkdtemp(prefix="partflow-ckpt-")
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    base = shared_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str):
    """Write ``df`` as a Parquet table under the shared folder and read it back: cuts
    the lineage (a lost executor doesn't recompute it) and lets several branches of a
    plan share one computation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def cores(spark: SparkSession) -> int:
    """The cluster's default parallelism; the number of shuffle partitions where there is no
    context to ask."""
    sc = _context(spark)
    return (sc.defaultParallelism if sc is not None
            else int(spark.conf.get("spark.sql.shuffle.partitions")))


class state_partitions:
    """Context for starting a streaming query: its stateful stages get ``n`` state
    partitions (default: the cluster's default parallelism, i.e. its cores), whatever
    ``spark.sql.shuffle.partitions`` says for batch work. The number is fixed in the
    checkpoint when the query first starts; restarts keep it. The session setting is
    restored on exit (the running query keeps its own copy)."""

    def __init__(self, spark: SparkSession, n: int | None = None):
        self.spark = spark
        self.n = n or cores(spark)

    def __enter__(self):
        self.old = self.spark.conf.get("spark.sql.shuffle.partitions")
        self.spark.conf.set("spark.sql.shuffle.partitions", str(self.n))
        return self

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.shuffle.partitions", self.old)
        return False


class brief_shuffles:
    """Context in which the shuffle files of a query are deleted when it has ended, not when the
    driver happens to collect its garbage. For jobs of many queries that execute no DataFrame
    object twice (its shuffles would be written again)."""
    KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.old = self.spark.conf.get(self.KEY, None)
        self.spark.conf.set(self.KEY, "true")
        return self

    def __exit__(self, *exc):
        if self.old is None:
            self.spark.conf.unset(self.KEY)
        else:
            self.spark.conf.set(self.KEY, self.old)
        return False
