"""Snapshot landing layout and readers.

Layout: ``<root>/business_date=YYYY-MM-DD/<domain>/<table>/*.parquet`` - one
full snapshot per business date.  Version = integer ``yyyyMMdd``.

* ``source_path``            a date's path, or a ``*`` glob over all dates
* ``available_versions``     distinct versions from the directory listing
                             (Hadoop FileSystem, so any cluster storage works)
* ``read_snapshot``          Parquet with ``mergeSchema``
* ``next_snapshot``          the earliest version newer than ``latest``;
                             missing paths are skipped; ``None`` when caught up
* ``read_with_rescue``       text feed -> hinted types plus ``_rescued_data``
                             holding the original text of values that did not cast
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.operators.ingest import parse_hints

_DATE_DIR = re.compile(r"business_date=(\d{4})-(\d{2})-(\d{2})")


def source_path(root: str, domain: str, table: str, business_date: str | None = None) -> str:
    part = f"business_date={business_date}" if business_date else "business_date=*"
    return f"{root.rstrip('/')}/{part}/{domain}/{table}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def available_versions(spark: SparkSession, root: str) -> list[int]:
    """Sorted distinct ``yyyyMMdd`` versions found under ``root``."""
    p, fs = _fs(spark, root)
    try:
        statuses = fs.listStatus(p)
    except Exception as error:  # noqa: BLE001
        raise RuntimeError(f"cannot list snapshot root {root!r}; check the landing path and permissions") from error
    out = set()
    for st in statuses:
        m = _DATE_DIR.fullmatch(st.getPath().getName())
        if m and st.isDirectory():
            out.add(int("".join(m.groups())))
    return sorted(out)


def version_to_date(version: int) -> str:
    s = str(version)
    return f"{s[:4]}-{s[4:6]}-{s[6:]}"


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def next_snapshot(spark: SparkSession, root: str, domain: str, table: str, latest: int | None):
    """``(DataFrame, version)`` of the earliest snapshot newer than ``latest``,
    skipping dates where this table is missing; ``None`` when caught up."""
    for v in available_versions(spark, root):
        if latest is not None and v <= latest:
            continue
        path = source_path(root, domain, table, version_to_date(v))
        p, fs = _fs(spark, path)
        if not fs.exists(p):
            continue
        return read_snapshot(spark, path), v
    return None


def read_with_rescue(df: DataFrame, hints: str) -> DataFrame:
    """Cast hinted columns with ``try_cast``; values that were present but
    did not cast are kept, as text, in a ``_rescued_data`` JSON column
    (NULL when nothing was rescued)."""
    pairs = {c: t for c, t in parse_hints(hints) if c in df.columns}
    casted = {c: F.expr(f"try_cast(`{c}` AS {t})") for c, t in pairs.items()}
    lost = [F.when(F.col(c).isNotNull() & casted[c].isNull(), F.col(c).cast("string")).alias(c) for c in pairs]
    rescued = F.to_json(F.struct(*lost)) if lost else F.lit(None).cast("string")
    out = df.withColumn("_rescued_data", F.when(rescued != F.lit("{}"), rescued))
    return out.withColumns(casted) if casted else out


def legacy_path_metadata(df: DataFrame, fallback_date: str) -> DataFrame:
    """Legacy landing: business date and simulation id parsed from the file
    path (``business_date=YYYY-MM-DD``, ``simulation_id=...``), a fixed
    change operation and a deterministic sequence ``yyyyMMdd_<row hash>``."""
    path = F.col("_metadata.file_path")
    bd = F.coalesce(F.to_date(F.nullif(F.regexp_extract(path, r"business_date=(\d{4}-\d{2}-\d{2})", 1), F.lit(""))),
                    F.to_date(F.lit(fallback_date)))
    sim = F.nullif(F.regexp_extract(path, r"simulation_id=([^/]+)", 1), F.lit(""))
    data = [c for c in df.columns]
    seq = F.concat(F.date_format(bd, "yyyyMMdd"), F.lit("_"),
                   F.lpad(F.abs(F.xxhash64(path, *[F.col(c) for c in data])).cast("string"), 19, "0"))
    return df.select("*", bd.alias("business_date_from_path"), sim.alias("simulation_id"),
                     F.lit(1).alias("cdc_change_op"), seq.alias("cdc_sequence"),
                     F.col("_metadata.file_modification_time").alias("cdc_change_time"))
