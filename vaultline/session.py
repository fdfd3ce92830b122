"""Spark session helpers.

Library code never creates its own session on a cluster; it only pins the
few session settings the operators depend on (UTC, ANSI casts at the edge,
AQE).  ``local_session`` exists for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every operator relies on.  All are session-scoped SQL confs, so
# they can be applied to a session somebody else built (the driver's).
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Star joins onto a spine: AQE converts to broadcast only when the
    # runtime size of a side is below this bound (a checked size, not a hint).
    # The size is that of compressed shuffle files; key texts are 6 to 8 times as large in memory.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
    # A task that writes a few partitions holds their files open together instead of sorting its rows (and spilling) first.
    "spark.sql.maxConcurrentOutputFileWriters": "24",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


#: Tables that are read again as a whole, in the order they were written in: sorted keys become differences, the rest zstd.
COMPACT = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writers: dict[int, tuple[int, str | None]] = {}
_writers_lock = threading.Lock()


@contextmanager
def shuffles_end_with_write(spark: SparkSession) -> Iterator[None]:
    """Writes inside the block delete their own shuffle files when they end: what they wrote is read instead.

    So do queries that are collected once.  Elsewhere the files of a query stay until its plan is garbage, so the
    steps of a long job would add up on disk.  Threads may be in the block
    together; the setting is put back when the last one leaves.
    """
    with _writers_lock:
        inside, before = _writers.get(id(spark), (0, None))
        if not inside:
            before = spark.conf.get(_CLEAN_UP, None)
            spark.conf.set(_CLEAN_UP, "true")
        _writers[id(spark)] = inside + 1, before
    try:
        yield
    finally:
        with _writers_lock:
            inside, before = _writers.pop(id(spark))
            if inside > 1:
                _writers[id(spark)] = inside - 1, before
            elif before is None:
                spark.conf.unset(_CLEAN_UP)
            else:
                spark.conf.set(_CLEAN_UP, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    Reads ``spark.checkpoint.dir`` from the session (set by the cluster);
    only when it is unset and the master is local (tests) a scratch folder is
    created.  On a cluster an unset folder is an error: executors would write
    to their own disks and later reads would miss those files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="vaultline-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vaultline") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("VAULTLINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SQL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
