"""Structured Streaming forms of the operators.

* ``assess_stream``   file-source change stream -> assess once per micro-batch
                      -> two sinks (validated, quarantine) from one
                      ``foreachBatch``; each batch writes to its own
                      ``batch_id=`` folder with overwrite, so a replayed
                      batch (after a failure) rewrites instead of duplicating.
* ``quarantine_streams``  the change streams of many sources -> one shared
                      quarantine folder, idempotent by (source, batch); a
                      lookup of current versions is read anew per micro-batch.
* ``sequenced_stream``    sequenced change events in any order -> SCD2 history,
                      kept in key buckets: a batch re-derives the versions of
                      the buckets it touches, and rewrites only those.
* ``dedup_stream``    replay removal with ``dropDuplicatesWithinWatermark``.
* ``window_counts``   event-time tumbling-window counts with a watermark
                      (update mode: closed windows leave the state) upserted
                      into a versioned result.
* ``scd2_stream``     snapshot files -> SCD2 history, applied in version order
                      per micro-batch; history persisted per batch id.

All sinks and checkpoints live under a folder the caller passes (on a
cluster: a subfolder of the shared ``spark.checkpoint.dir``), never a
machine-local temp folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from vaultline.operators import quarantine as Q
from vaultline.operators import scd
from vaultline.sources.committed import BucketTable


def _list_dirs(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def read_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)


def assess_stream(spark: SparkSession, source: DataFrame, table: str, current_path: str, sink: str,
                  checkpoint: str, as_of: str | None = None, run_id: str = "stream") -> None:
    """Run the assessment stream to completion (``availableNow``)."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        current = spark.read.parquet(current_path)          # stream-static: full bronze for duplicate rules
        assessed = Q.assess(batch, table, current=current, as_of=as_of).persist()
        try:
            Q.validated(assessed).write.mode("overwrite").parquet(f"{sink}/validated/batch_id={batch_id}")
            (Q.quarantine_records(assessed, table, run_id, with_timestamp=False)
             .write.mode("overwrite").parquet(f"{sink}/quarantine/batch_id={batch_id}"))
        finally:
            assessed.unpersist()

    q = (source.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


@dataclass(frozen=True)
class SourceStream:
    """A source's change rows, and what its cross-row rules look at.

    ``current``, ``active`` and ``repeated`` are called once per micro-batch,
    so each batch sees one state of the table.  ``active`` (key,
    ``__START_AT``) keeps superseded versions from being quarantined again.
    ``repeated`` (batch -> column -> values held several times) takes the place
    of ``current``: kept counts, read only where the batch has values.  ``stored``
    says that these values are read from files as they are.
    """

    table: str
    changes: DataFrame
    current: Callable[[], DataFrame] | None = None
    active: Callable[[], DataFrame] | None = None
    repeated: Callable[[DataFrame], Callable[[str], DataFrame]] | None = None
    stored: bool = False


def quarantine_streams(sources: Sequence[SourceStream], sink: str, checkpoint: str, as_of: str | None = None,
                       run_id: str = "stream", at_once: int = 6) -> None:
    """Run the assessment streams of all sources to completion, into one quarantine folder.

    Each micro-batch overwrites its own ``source_table_name=/batch_id=``
    folder, so a batch that is run again after a failure adds nothing.
    ``quarantine_result`` reads the folder.
    """
    def run(one: SourceStream) -> None:
        def per_batch(batch: DataFrame, batch_id: int) -> None:
            current = one.current() if one.current else batch
            lookup = one.repeated(batch) if one.repeated else lambda column: Q.repeated_values(current, column)

            def landed(column: str) -> DataFrame:
                # Of files Spark knows the size: few values are broadcast, and the batch's rows are not dealt for them.
                values, path = lookup(column), f"{sink}/_repeated/{one.table}/{column}/{batch_id}"
                values.write.mode("overwrite").parquet(path)
                return batch.sparkSession.read.schema(values.schema).parquet(path)

            assessed = Q.assess(batch, one.table, as_of=as_of, repeated=lookup if one.stored else landed)
            records = Q.quarantine_records(assessed, one.table, run_id, with_timestamp=False,
                                           active_versions=one.active() if one.active else None)
            (records.drop("source_table_name").write.mode("overwrite")
             .parquet(f"{sink}/source_table_name={one.table}/batch_id={batch_id}"))

        (one.changes.writeStream.foreachBatch(per_batch).option("checkpointLocation", f"{checkpoint}/{one.table}")
         .trigger(availableNow=True).start().awaitTermination())

    with ThreadPoolExecutor(max(1, min(at_once, len(sources)))) as pool:
        list(pool.map(run, sources))


def quarantine_result(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.option("basePath", sink).parquet(f"{sink}/source_table_name=*/batch_id=*").drop("batch_id")


class SequencedHistory:
    """Events by key and the SCD2 history derived from them, both in key buckets under ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str], sequence_by: str,
                 operation: str | None = None, delete_value: str = "DELETE", buckets: int = 64) -> None:
        self.keys, self.sequence_by, self.operation, self.delete_value = list(keys), sequence_by, operation, delete_value
        self.schema = schema
        columns = [f for f in schema.fields if f.name not in (sequence_by, operation)]
        stamp = schema[sequence_by].dataType
        self.history_schema = StructType(columns + [StructField(scd.START, stamp), StructField(scd.END, stamp)])
        self.events = BucketTable(spark, f"{root}/events", keys, buckets)
        self.versions = BucketTable(spark, f"{root}/versions", keys, buckets)

    def apply(self, batch: DataFrame, number: int) -> None:
        """Add a batch of events; a batch number that is applied again gives the same state."""
        touched = [r[0] for r in batch.select(self.events.bucket().alias("b")).distinct().collect()]  # at most all buckets
        # State as the batch before left it, also when this batch is run again.
        known = self.events.read(self.schema, touched, version=number - 1)
        data = [f.name for f in self.schema.fields if f.name not in (*self.keys, self.sequence_by)]
        one = (known.unionByName(batch.select(*known.columns)).groupBy(*self.keys, self.sequence_by)
               .agg(F.max(F.struct(*data)).alias("r")).select(*self.keys, self.sequence_by, "r.*"))
        self.events.commit(one.select(*self.schema.names), touched, number)
        now = self.events.read(self.schema, touched)
        derived = scd.scd2_from_changes(now, self.keys, self.sequence_by, self.operation, self.delete_value, unique=True)
        self.versions.commit(derived.select(*self.history_schema.names), touched, number)

    def history(self) -> DataFrame:
        return self.versions.read(self.history_schema)


def sequenced_stream(source: DataFrame, state: SequencedHistory, checkpoint: str) -> None:
    """Run a stream of change events into ``state`` to completion; late and shuffled events split the versions they fall into."""
    (source.writeStream.foreachBatch(lambda batch, number: state.apply(batch, number + 1)).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def dedup_stream(source: DataFrame, keys: list[str], event_time: str, delay: str, sink: str,
                 checkpoint: str) -> None:
    """Drop replays (same business keys) that arrive within ``delay`` of
    each other; state is bounded by the watermark."""
    ts = F.col(event_time).cast("timestamp")
    out = (source.withColumn("_event_ts", ts).withWatermark("_event_ts", delay)
           .dropDuplicatesWithinWatermark(keys).drop("_event_ts"))
    q = (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(d.split("=")[1]) for d in _list_dirs(spark, path) if d.startswith("batch_id="))


def window_counts(spark: SparkSession, source: DataFrame, event_time: str, by: list[str], window: str, delay: str,
                  sink: str, checkpoint: str) -> None:
    """Tumbling-window counts on event time (TIMESTAMP_NTZ is cast to
    TIMESTAMP first, as watermarks require).

    Update mode: a micro-batch emits only the windows it changed, and the
    watermark evicts a window's state once it closes, so state stays bounded
    by the open windows.  Each batch upserts its windows into the result:
    the previous result version minus the changed windows, plus the changed
    windows, written as version ``batch_id=b`` (overwrite, so a replayed
    batch rewrites the same version).  ``window_result`` reads the latest.
    """
    ts = F.col(event_time).cast("timestamp")
    agg = (source.withColumn("_event_ts", ts).withWatermark("_event_ts", delay)
           .groupBy(F.window("_event_ts", window), *by).agg(F.count(F.lit(1)).alias("events")))
    keys = ["window_start", "window_end", *by]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        changed = batch.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                               F.col("window.end").cast("timestamp_ntz").alias("window_end"), *by, "events")
        before = [v for v in _versions(spark, f"{sink}/versions") if v < batch_id]
        if before:
            prev = spark.read.parquet(f"{sink}/versions/batch_id={before[-1]}")
            changed = prev.join(changed.select(*keys), keys, "left_anti").unionByName(changed)
        changed.write.mode("overwrite").parquet(f"{sink}/versions/batch_id={batch_id}")

    q = (agg.writeStream.outputMode("update").foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def window_result(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(f"{sink}/versions/batch_id={_versions(spark, f'{sink}/versions')[-1]}")


def scd2_stream(spark: SparkSession, source: DataFrame, keys: list[str], version: str, sink: str,
                checkpoint: str, track_except=()) -> None:
    """Snapshot stream -> SCD2 history.

    A micro-batch may carry several snapshot versions, and a snapshot's files
    may arrive in several micro-batches: the newest version stays *pending*
    until a later one appears, and is merged with what arrives of it.  Each
    batch writes, under its id (overwrite: replay safe), the settled history,
    the pending rows, the last settled version and, last, the visible history
    (settled plus pending).  Rows of a settled version are rejected, also
    when that version changed nothing.
    """
    def table(kind: str, batch_id: int) -> str:
        return f"{sink}/{kind}/batch_id={batch_id}"

    def applied(history, rows: DataFrame, at: int) -> DataFrame:
        snap = rows.filter(F.col(version) == at).drop(version)
        if history is None:
            return (scd.one_row_per_key(snap, keys).withColumn(scd.START, F.lit(at).cast("bigint"))
                    .withColumn(scd.END, F.lit(None).cast("bigint")))
        return scd.scd2_apply_snapshot(history, snap, keys, at, track_except=track_except)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # A replayed batch starts from the batch before it, not from what it already wrote.
        done = [b for b in _versions(spark, f"{sink}/history") if b < batch_id]
        settled, last, rows = None, None, batch
        if done:
            last = spark.read.parquet(table("settled_version", done[-1])).first()[0]
            rows = batch.unionByName(spark.read.parquet(table("pending", done[-1])))
            if last is not None:
                settled = spark.read.parquet(table("settled", done[-1]))
        # distinct snapshot versions in this batch: one small value per snapshot
        versions = sorted(r[0] for r in rows.select(version).distinct().collect())
        if not versions:
            return
        if last is not None and versions[0] <= last:
            raise ValueError(f"snapshot {versions[0]} is not newer than settled version {last}")
        for v in versions[:-1]:
            settled = applied(settled, rows, v).checkpoint(eager=True)             # cut lineage per applied snapshot
            last = v
        newest = versions[-1]
        if settled is not None:
            settled.write.mode("overwrite").parquet(table("settled", batch_id))
            settled = spark.read.parquet(table("settled", batch_id))
        rows.filter(F.col(version) == newest).write.mode("overwrite").parquet(table("pending", batch_id))
        (spark.range(1).select(F.lit(last).cast("bigint").alias("version"))
         .write.mode("overwrite").parquet(table("settled_version", batch_id)))
        applied(settled, rows, newest).write.mode("overwrite").parquet(table("history", batch_id))

    q = (source.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def final_history(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(f"{sink}/history/batch_id={_versions(spark, f'{sink}/history')[-1]}")
