"""Helpers shared by the operators: shared scratch tables, fresh names, content keys, Arrow limits."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.session import checkpoint_dir, configure

#: ASCII white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"
#: The same as a Java regular expression class.
WHITE_RE = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows and bytes of one Arrow batch sent to Python: long texts must not pile up in a worker.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20


#: A join side is broadcast at run time only if its measured shuffle output is below this (several times that in memory).
BROADCAST_BYTES = 16 << 20


def settings(spark: SparkSession) -> SparkSession:
    """The library's session settings, with a tighter bound for broadcasts beside long texts."""
    configure(spark)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(BROADCAST_BYTES))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def python_side(spark: SparkSession) -> None:
    """Before work in Python: bound the Arrow batches by rows and bytes, and let workers find this package.

    On a cluster the package is installed or sent with ``--py-files``; the
    path added here serves sessions that run from a checkout.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), root]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only (``lower`` would follow Unicode)."""
    return F.translate(col, UPPER, LOWER)


def cols(columns: Sequence[str]) -> list[Column]:
    """Columns by name, also by names with dots."""
    return [F.col(f"`{c}`") for c in columns]


def whole_row(columns: Sequence[str]) -> Column:
    """The columns as one struct ``row``, so that working columns beside it never clash with theirs."""
    return F.struct(*cols(columns)).alias("row")


def from_row(columns: Sequence[str]) -> list[Column]:
    """The columns of ``row`` again."""
    return [F.col("row").getField(c).alias(c) for c in columns]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until no column of ``df`` (in any case) has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; the file system deletes it when the application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/vaultline-llm/{name}-{uuid.uuid4().hex}"
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    handle.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(handle)
    for owner in _owners:
        owner.append(path)
    return path


_owners: list[list[str]] = []


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that are published inside the block when it ends.

    For a caller that writes what it builds from them before the block ends;
    elsewhere they last until the application ends.
    """
    own: list[str] = []
    _owners.append(own)
    try:
        yield
    finally:
        _owners.remove(own)
        for path in own:
            handle = spark._jvm.org.apache.hadoop.fs.Path(path)
            handle.getFileSystem(spark._jsc.hadoopConfiguration()).delete(handle, True)


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def publish(df: DataFrame, name: str = "table", path: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    The write's own shuffle files go as soon as it has ended: nothing reads
    them again, as the table is read instead.
    """
    spark = df.sparkSession
    path = path or scratch(spark, name)
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete published tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for file in df.inputFiles()[:1]:
            handle = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            handle.getFileSystem(spark._jsc.hadoopConfiguration()).delete(handle, True)


def content_key(col: Column) -> tuple[Column, Column]:
    """128 bits of the value: two XXH64 with independent seeds (NULL has a key too)."""
    return F.xxhash64(F.lit(11), col), F.xxhash64(F.lit(23), col)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
