"""Snapshot CDC: SCD type 2 / type 1 history and the change feed.

No Delta, no MERGE: everything is a DataFrame job over Parquet.

Batch form (``scd2_from_snapshots``): all full snapshots unioned with an
integer ``version`` (yyyyMMdd) -> gaps-and-islands per business key:
  * ``lag`` over (key ORDER BY version) finds where a key was absent in the
    previous snapshot (gap -> re-insert) or its tracked columns changed;
  * a running sum of those boundaries numbers the segments;
  * one aggregate per (key, segment) gives ``__START_AT`` (first version),
    the latest untracked values (in-place update) and ``__END_AT`` = the
    snapshot version that followed the segment's last version (NULL when
    the segment is still open).
One row per key per version means a key's window partition is bounded by
the number of snapshots, so a window per key cannot blow up on a hot key.
The version calendar (distinct versions) is tiny - one row per snapshot -
so it is the only broadcast side.

Incremental form (``scd2_apply_snapshot``): current history + one new
snapshot -> full outer join of the OPEN rows with the snapshot on the key;
closed history passes through untouched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "__START_AT", "__END_AT"


def _row_hash(cols: list[str]) -> Column:
    """Content hash of columns; a NULL counts, so a value that moves to the next column is a change."""
    if not cols:
        return F.lit(0).cast("bigint")
    return F.xxhash64(*[x for c in cols for x in (F.col(c), F.col(c).isNull())])


def version_calendar(snapshots: DataFrame, version: str = "version") -> DataFrame:
    """Distinct snapshot versions with their predecessor and successor."""
    w = Window.orderBy(version)
    return (snapshots.select(version).distinct()
            .select(version, F.lag(version).over(w).alias("_prev_global"),
                    F.lead(version).over(w).alias("_next_global")))


def one_row_per_key_version(snapshots: DataFrame, keys, version: str) -> DataFrame:
    """A snapshot must hold a key once; duplicates inside one snapshot are
    collapsed to their greatest row (deterministic) by a grouped aggregate,
    so afterwards a key's window partition holds at most one row per
    snapshot however hot the key is."""
    keys = list(keys)
    data = [c for c in snapshots.columns if c not in keys and c != version]
    if not data:
        return snapshots.select(*keys, version).distinct()
    return (snapshots.groupBy(*keys, version).agg(F.max(F.struct(*[F.col(c) for c in data])).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in data], version))


def one_row_per_key(snapshot: DataFrame, keys) -> DataFrame:
    """The same for one snapshot without a version column."""
    marked = one_row_per_key_version(snapshot.withColumn("_one", F.lit(0)), keys, "_one")
    return marked.select(*snapshot.columns)


def _prepared(snapshots: DataFrame, keys, version, track_except):
    keys = list(keys)
    cal = F.broadcast(version_calendar(snapshots, version))   # one row per snapshot: bounded
    # A scan's tasks are as large as its row groups, and the partial aggregate sorts a task's rows (structs
    # have no hash aggregate): the rows are dealt first, into tasks of the size that AQE aims at.  Dealt by
    # whole rows, so that a key which a snapshot repeats is still combined in many tasks.
    dealt = snapshots.hint("rebalance", *[F.col(c) for c in snapshots.columns])
    snapshots = one_row_per_key_version(dealt, keys, version).select(*snapshots.columns)
    data_cols = [c for c in snapshots.columns if c not in keys and c != version]
    tracked = [c for c in data_cols if c not in set(track_except)]
    untracked = [c for c in data_cols if c in set(track_except)]
    w = Window.partitionBy(*keys).orderBy(version)
    df = (snapshots.join(cal, version)
          .withColumn("_h", _row_hash(tracked))
          .withColumn("_hall", _row_hash(tracked + untracked))
          .withColumn("_prev_v", F.lag(version).over(w))
          .withColumn("_prev_h", F.lag("_h").over(w))
          .withColumn("_prev_hall", F.lag("_hall").over(w)))
    gap = F.col("_prev_v").isNull() | (F.col("_prev_v") != F.col("_prev_global"))
    df = (df.withColumn("_is_insert", gap)
          .withColumn("_new_seg", gap | (F.col("_h") != F.col("_prev_h")))
          .withColumn("_seg", F.sum(F.col("_new_seg").cast("int")).over(
              w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    return df, keys, tracked, untracked


def scd2_from_snapshots(snapshots: DataFrame, keys, version: str = "version",
                        track_except=()) -> DataFrame:
    """SCD2 history from full snapshots; ``track_except`` columns never open a version."""
    df, keys, tracked, untracked = _prepared(snapshots, keys, version, track_except)
    seg = df.groupBy(*keys, "_seg").agg(
        F.min(version).alias(START),
        F.max(version).alias("_last_v"),
        F.max_by(F.struct(*[F.col(c) for c in tracked + untracked]), F.col(version)).alias("_row"),
        F.max_by(F.col("_next_global"), F.col(version)).alias(END),
    )
    return seg.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in tracked + untracked],
                      F.col(START).cast("bigint").alias(START), F.col(END).cast("bigint").alias(END))


def change_feed(snapshots: DataFrame, keys, version: str = "version") -> DataFrame:
    """Change rows between consecutive snapshots, like a table change feed:
    insert / update_preimage / update_postimage / delete, each with the
    ``_commit_version`` of the snapshot that revealed it."""
    df, keys, tracked, untracked = _prepared(snapshots, keys, version, ())
    data = [c for c in snapshots.columns if c not in keys and c != version]
    w = Window.partitionBy(*keys).orderBy(version)
    prev_vals = [F.lag(c).over(w).alias(f"_p_{c}") for c in data]
    nxt = F.lead(version).over(w)
    df = df.select("*", *prev_vals, nxt.alias("_next_v"))
    changed = ~F.col("_is_insert") & (F.col("_hall") != F.col("_prev_hall"))
    gone = F.col("_next_global").isNotNull() & (F.col("_next_v").isNull() | (F.col("_next_v") != F.col("_next_global")))

    def event(when, kind: str, at: str, prefix: str = ""):
        row = [F.col(f"{prefix}{c}").alias(c) for c in data]
        return F.when(when, F.struct(*row, F.lit(kind).alias("_change_type"), F.col(at).cast("bigint").alias("_commit_version")))

    # One window pass: every version row emits its up to three change rows.
    events = F.array_compact(F.array(
        event(F.col("_is_insert"), "insert", version),
        event(changed, "update_preimage", version, "_p_"),
        event(changed, "update_postimage", version),
        event(gone, "delete", "_next_global"),
    ))
    return df.select(*keys, F.inline(events))


def scd1_from_snapshots(snapshots: DataFrame, keys, version: str = "version",
                        order_within=()) -> DataFrame:
    """SCD1: the latest full snapshot is the table (keys missing from it are
    deleted); duplicate keys inside it keep the greatest ``order_within``."""
    keys = list(keys)
    latest = snapshots.agg(F.max(version).alias("_max"))
    cur = snapshots.join(F.broadcast(latest), F.col(version) == F.col("_max")).drop("_max")
    data = [c for c in snapshots.columns if c not in keys]
    order = [F.col(c) for c in order_within] + [F.col(c) for c in data]
    return (cur.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in data]), F.struct(*order)).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in data]))


def scd2_apply_snapshot(history: DataFrame, snapshot: DataFrame, keys, version: int,
                        track_except=()) -> DataFrame:
    """Apply ONE new full snapshot (at ``version``) to an SCD2 history.

    A key that the snapshot repeats counts once, as in the batch form.
    Only open rows take part in the full outer join; closed rows are
    appended unchanged.  Result = closed history + closed-now rows + open
    rows (unchanged, updated in place, or newly opened).
    """
    keys = list(keys)
    snapshot = one_row_per_key(snapshot, keys)
    data = [c for c in snapshot.columns if c not in keys]
    tracked = [c for c in data if c not in set(track_except)]
    closed = history.filter(F.col(END).isNotNull())
    open_ = history.filter(F.col(END).isNull())
    o = open_.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in data], F.col(START).alias("_o_start"),
                     _row_hash(tracked).alias("_o_h"))
    s = snapshot.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in data],
                        _row_hash(tracked).alias("_s_h"), F.lit(True).alias("_in_snap"))
    j = o.join(s, keys, "full_outer")
    v = F.lit(version).cast("bigint")
    in_open, in_snap = F.col("_o_start").isNotNull(), F.col("_in_snap").isNotNull()
    same = in_open & in_snap & (F.col("_o_h") == F.col("_s_h"))
    # 1) open rows that close now (deleted or tracked change)
    closing = j.filter(in_open & ~same).select(
        *keys, *[F.col(f"_o_{c}").alias(c) for c in data], F.col("_o_start").alias(START), v.alias(END))
    # 2) rows open after this snapshot: kept (untracked values refreshed) or newly opened
    opened = j.filter(in_snap).select(
        *keys, *[F.col(f"_s_{c}").alias(c) for c in data],
        F.when(same, F.col("_o_start")).otherwise(v).alias(START), F.lit(None).cast("bigint").alias(END))
    return closed.select(*keys, *data, START, END).unionByName(closing).unionByName(opened)


def scd2_from_changes(changes: DataFrame, keys, sequence_by: str, operation: str | None = None,
                      delete_value: str = "DELETE", slices: int | None = None, unique: bool = False) -> DataFrame:
    """Sequenced change events -> SCD2 (out-of-order arrival is fine).

    Events are ordered by ``sequence_by`` per key; each non-delete event
    opens a version ending at the key's next event; a delete event only
    closes the previous version.  Ties on the sequence keep the last row
    by all columns (deterministic); ``unique`` says that there are none.

    Hot keys: the events are range-partitioned on (key, sequence) into
    ``slices`` ordered slices, so one key's history can span many tasks.
    ``lead`` runs per (key, slice); only the last event of a slice can go on
    in the next one, and takes that slice's first sequence if the key is the
    same: one row per slice, broadcast.  The slice count is explicit, so AQE keeps it as is and
    the slice ids are the range order; they are checkpointed once so every
    reader sees the same ones."""
    keys = list(keys)
    data = [c for c in changes.columns if c not in keys and c != sequence_by]
    dedup = changes if unique else (
        changes.groupBy(*keys, sequence_by)
        .agg(F.max(F.struct(*[F.col(c) for c in data])).alias("_r"))
        .select(*keys, sequence_by, *[F.col(f"_r.{c}").alias(c) for c in data]))
    n = slices or int(changes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Range bounds come from sampling, so the slice ids are written once
    # (checkpoint in the shared folder) and both branches below read them.
    from vaultline.session import checkpoint_dir

    checkpoint_dir(changes.sparkSession)
    sliced = (dedup.repartitionByRange(n, *keys, sequence_by)
              .withColumn("_slice", F.spark_partition_id()).checkpoint())
    in_slice = sliced.withColumn(
        "_next", F.lead(sequence_by).over(Window.partitionBy(*keys, "_slice").orderBy(sequence_by)))
    firsts = sliced.groupBy("_slice").agg(F.min(F.struct(*keys, sequence_by)).alias("_first"))
    following = firsts.select(F.col("_slice").alias("_s"), F.lead("_first").over(Window.orderBy("_slice")).alias("_after"))  # a row per slice
    goes_on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_after.{k}")) for k in keys])
    out = (in_slice.join(F.broadcast(following), F.col("_slice") == F.col("_s"), "left")
           .withColumn(END, F.coalesce(F.col("_next"), F.when(goes_on, F.col(f"_after.{sequence_by}"))))
           .withColumn(START, F.col(sequence_by))
           .drop("_next", "_after", "_slice", "_s"))
    if operation:
        out = out.filter(F.col(operation) != F.lit(delete_value)).drop(operation)
    return out.drop(sequence_by)


def active_versions(history: DataFrame, key: str) -> DataFrame:
    """Current version per key: (key, __START_AT) of the open row."""
    return history.filter(F.col(END).isNull()).select(key, START)


def as_of(history: DataFrame, version: int) -> DataFrame:
    """Point-in-time view: rows valid at ``version``."""
    v = F.lit(version)
    return history.filter((F.col(START) <= v) & (F.col(END).isNull() | (v < F.col(END))))


def as_of_join(facts: DataFrame, history: DataFrame, fact_key: str, hist_key: str, fact_version: str,
               ) -> DataFrame:
    """Attach to each fact the history version valid at the fact's version:
    an equi-join on the key with the validity range as a join filter (no
    cross product; the key equality drives the shuffle)."""
    h = history.withColumnRenamed(hist_key, "_hk")
    cond = ((F.col(fact_key) == F.col("_hk")) & (F.col(START) <= F.col(fact_version))
            & (F.col(END).isNull() | (F.col(fact_version) < F.col(END))))
    return facts.join(h, cond, "left").drop("_hk")
