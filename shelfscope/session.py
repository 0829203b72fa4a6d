"""Session defaults and the shared scratch location.

On a cluster the caller hands us a configured session; these helpers only
fill gaps (tests, bench) and never override settings that are already set.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on.  Applied only when the session lacks them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join is split even where its rows are then dealt once more than planned
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # shuffled listings are narrow and compressed, the rows rendered of them and sorted
    # next are not: 8 MB of the ones become some 160 MB of the others, sorted in memory
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session for local runs: UI off, AQE on, UTC."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName("shelfscope")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SHELFSCOPE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL settings we depend on, keeping any caller value
    except the time zone, which must be UTC for date parity.  Every overwrite
    names its ``partitionOverwriteMode``; the session's mode plays no part."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The checkpoint location is read from the session.  A local session without
    one gets a temporary folder, which is registered; on a cluster, where a
    temporary folder would lie on one machine, that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base and not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    if not base:
        base = tempfile.mkdtemp(prefix="shelfscope-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    sub = f"{name or 'work'}-{uuid.uuid4().hex[:12]}"
    return base.rstrip("/") + "/" + sub


@contextmanager
def freed_shuffles(spark: SparkSession, partly_dealt: bool = False):
    """What a write inside shuffles is deleted when the write ends, not when the
    driver next collects its garbage.  With ``partly_dealt`` rows that lie dealt by
    some of a join's keys stay where they are (not for joins on salted keys)."""
    conf = {SHUFFLE_CLEANUP: "true"} | ({ALL_KEYS: "false"} if partly_dealt else {})
    was = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in was.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def materialize(spark: SparkSession, df, partly_dealt: bool = False):
    """Write an intermediate table as Parquet into the shared folder and read
    it back.  Used where several branches of one job read the same table, as
    the persisted silver table is read by both the dimension and the facts;
    each branch then scans only the columns it needs (``freed_shuffles``)."""
    path = shared_dir(spark, "table")
    with freed_shuffles(spark, partly_dealt):
        df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
