"""Downstream reconciliations that are not row rules: latest-status
reconciliation, late-arrival ordering, stale references, conflicting
evidence, replays under new ids, change-manifest checks.

All are aggregates or equi/semi/anti joins; "latest" is ``max_by`` over a
total order (partial aggregation), never a collect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def reconcile_latest_status(parents: DataFrame, events: DataFrame, key: str, parent_status: str = "status",
                            event_status: str = "status") -> DataFrame:
    """Parent rows whose status differs from their last status event
    (ordered by sequence_number, then status_timestamp)."""
    last = events.groupBy(key).agg(
        F.max_by(F.col(event_status), F.struct("sequence_number", "status_timestamp", event_status))
        .alias("last_event_status"),
        F.max("sequence_number").alias("last_sequence_number"))
    j = parents.select(key, F.col(parent_status).alias("parent_status")).join(last, key)
    return j.filter(~F.col("parent_status").eqNullSafe(F.col("last_event_status")))


def late_arrivals(events: DataFrame, key: str, threshold_seconds: int) -> DataFrame:
    """Events that arrived more than ``threshold_seconds`` after their
    business time, or out of order: an event of the same parent with a
    lower sequence arrived later, or one with a higher sequence earlier.

    Arrival bounds are first aggregated per (parent, sequence) - a parent
    holding a third of all rows still yields one row per sequence number -
    then prefix max / suffix min run over those few rows per parent and
    are joined back on (parent, sequence)."""
    arr = F.col("source_arrival_timestamp")
    per_seq = events.groupBy(key, "sequence_number").agg(F.max(arr).alias("_max_arr"), F.min(arr).alias("_min_arr"))
    w = Window.partitionBy(key).orderBy("sequence_number")
    bounds = per_seq.select(
        key, "sequence_number",
        F.max("_max_arr").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_prior_max"),
        F.min("_min_arr").over(w.rowsBetween(1, Window.unboundedFollowing)).alias("_next_min"))
    lag_s = (F.unix_timestamp(arr.cast("timestamp")) - F.unix_timestamp(F.col("status_timestamp").cast("timestamp")))
    out = events.join(bounds, [key, "sequence_number"], "left").withColumn("arrival_lag_seconds", lag_s)
    ooo = F.coalesce((arr < F.col("_prior_max")) | (arr > F.col("_next_min")), F.lit(False))
    late = F.coalesce(F.col("arrival_lag_seconds") > threshold_seconds, F.lit(False))
    return out.filter(late | ooo).select("status_event_id", key, "sequence_number", "arrival_lag_seconds",
                                         late.alias("is_late"), ooo.alias("out_of_order"))


def stale_references(df: DataFrame, date_col: str, as_of: str, max_age_days: int) -> DataFrame:
    age = F.datediff(F.to_date(F.lit(as_of)), F.col(date_col))
    return df.withColumn("age_days", age).filter(F.col("age_days") > max_age_days)


def replays_with_new_ids(events: DataFrame, id_col: str, business_cols: list[str]) -> DataFrame:
    """Rows repeating the business fields of an earlier row under a new id
    (the first id per business identity is the original)."""
    firsts = events.groupBy(*business_cols).agg(F.min(id_col).alias("_first_id"), F.count(F.lit(1)).alias("_n"))
    return (events.join(firsts.filter("_n > 1"), business_cols)
            .filter(F.col(id_col) != F.col("_first_id"))
            .select(id_col, *business_cols, F.col("_first_id").alias("original_id")))


def change_manifest(feed: DataFrame, snapshots: DataFrame, keys: list[str], version: str = "version") -> DataFrame:
    """Per commit version: change counts and manifest violations - inserts
    whose key existed in the previous snapshot, updates/deletes whose key
    did not."""
    cal = snapshots.select(version).distinct()
    w = Window.orderBy(version)
    cal = cal.select(version, F.lag(version).over(w).alias("_prev"))
    present = snapshots.select(*keys, F.col(version).alias("_prev")).withColumn("_was_present", F.lit(True))
    f = (feed.join(F.broadcast(cal.withColumnRenamed(version, "_commit_version")), "_commit_version")
         .join(present, keys + ["_prev"], "left"))
    was = F.col("_was_present").isNotNull()
    typ = F.col("_change_type")
    return f.groupBy("_commit_version").agg(
        F.count_if(typ == "insert").alias("inserts"),
        F.count_if(typ == "update_postimage").alias("updates"),
        F.count_if(typ == "delete").alias("deletes"),
        F.count_if((typ == "insert") & was).alias("inserts_not_new"),
        F.count_if(typ.isin("update_postimage", "update_preimage", "delete") & ~was).alias("changes_without_prior"))
