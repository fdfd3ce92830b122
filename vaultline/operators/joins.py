"""Joins that stay even when the key is missing for most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 1024  # parts that rows without a key are dealt to


def left_join_sparse(rows: DataFrame, lookup: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Left join on a key that is NULL for many rows.

    NULL keys match nothing, but a shuffle would send all of them to one
    task.  They carry a salt from ``spread_by`` beside the key, so they are
    dealt out; rows with a key have salt 0, as the lookup has.
    """
    salted = rows.withColumn(
        "_salt", F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)).cast("int")).otherwise(0))
    return salted.join(lookup.withColumn("_salt", F.lit(0)), [key, "_salt"], "left").drop("_salt")
