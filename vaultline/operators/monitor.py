"""Monitoring over the pipeline event log and the run ledger.

Event log shape: ``event_type, timestamp, origin STRUCT<pipeline_id,
pipeline_name, update_id, flow_name>, details STRING (JSON)``.  JSON paths
are read with ``get_json_object`` / ``from_json`` (no VARIANT needed).
Every view is grouped aggregation; "last status" is ``max_by`` filtered to
the relevant events, so no window over an update or a pipeline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.keys import table_layer

TERMINAL_UPDATE = ("COMPLETED", "FAILED", "CANCELED", "CANCELLED")
TERMINAL_FLOW = ("COMPLETED", "FAILED", "CANCELED", "CANCELLED", "EXCLUDED", "SKIPPED", "STOPPED", "IDLE")
ACTIVE_FLOW = ("STARTING", "RUNNING", "COMPLETED")
EXPECTATIONS = "array<struct<name:string,dataset:string,passed_records:bigint,failed_records:bigint>>"


def _j(path: str) -> Column:
    return F.get_json_object(F.col("details"), path)


def _seconds(start: Column, end: Column) -> Column:
    ms = (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1000
    return F.round(ms / 1000)


def pipeline_updates(events: DataFrame, as_of: str) -> DataFrame:
    """One row per pipeline update: last state, start, end (as-of when
    still running) and duration."""
    state = _j("$.update_progress.state")
    upd = events.filter(F.col("origin.update_id").isNotNull())
    is_prog = F.col("event_type") == "update_progress"
    g = upd.filter(F.col("event_type").isin("create_update", "update_progress")).groupBy(
        F.col("origin.pipeline_id").cast("string").alias("pipeline_id"),
        F.col("origin.update_id").cast("string").alias("pipeline_update_id")).agg(
        F.first("origin.pipeline_name", ignorenulls=True).alias("pipeline_name"),
        F.min(F.when(F.col("event_type") == "create_update", F.col("timestamp"))).alias("start_time"),
        F.max(F.when(is_prog & state.isin(*TERMINAL_UPDATE), F.col("timestamp"))).alias("_end"),
        F.max_by(F.when(is_prog, state), F.when(is_prog, F.struct("timestamp", state))).alias("pipeline_update_status"))
    end = F.coalesce(F.col("_end"), F.to_timestamp_ntz(F.lit(as_of)))
    return (g.filter(F.col("start_time").isNotNull() & F.col("pipeline_update_status").isNotNull())
            .select("pipeline_id", "pipeline_name", "pipeline_update_id", "start_time", end.alias("end_time"),
                    _seconds(F.col("start_time"), end).alias("duration_seconds"), "pipeline_update_status"))


def table_metrics(events: DataFrame) -> DataFrame:
    """Per (update, flow): timing, final flow status and row metrics."""
    fp = events.filter((F.col("event_type") == "flow_progress") & F.col("origin.flow_name").isNotNull()
                       & (F.col("origin.flow_name") != "pipelines.flowTimeMetrics.missingFlowName"))
    status = _j("$.flow_progress.status")
    num = lambda p: F.expr(f"try_cast(get_json_object(details, '{p}') AS BIGINT)")
    fp = fp.select(
        F.col("origin.pipeline_name").alias("pipeline_name"),
        F.col("origin.pipeline_id").cast("string").alias("pipeline_id"),
        F.col("origin.update_id").cast("string").alias("pipeline_update_id"),
        F.col("origin.flow_name").alias("table_name"), "timestamp", status.alias("flow_status"),
        num("$.flow_progress.metrics.num_output_rows").alias("o"),
        num("$.flow_progress.metrics.num_upserted_rows").alias("u"),
        num("$.flow_progress.metrics.num_deleted_rows").alias("d"),
        num("$.flow_progress.data_quality.dropped_records").alias("x"))
    active = F.col("flow_status").isin(*ACTIVE_FLOW)
    terminal = F.col("flow_status").isin(*TERMINAL_FLOW)
    g = fp.groupBy("pipeline_name", "pipeline_id", "pipeline_update_id", "table_name").agg(
        F.min(F.when(active, F.col("timestamp"))).alias("start_time"),
        F.max(F.when(active, F.col("timestamp"))).alias("end_time"),
        F.max_by(F.when(terminal, F.col("flow_status")), F.when(terminal, F.struct("timestamp", "flow_status")))
        .alias("flow_status"),
        F.sum(F.coalesce("o", F.lit(0))).alias("output_rows"),
        F.sum(F.coalesce("u", F.lit(0))).alias("upserted_rows"),
        F.sum(F.coalesce("d", F.lit(0))).alias("deleted_rows"),
        F.max(F.coalesce("x", F.lit(0))).alias("dropped_rows"))
    return g.select("pipeline_id", "pipeline_name", "pipeline_update_id", table_layer("table_name").alias("layer"),
                    "table_name", "flow_status", "start_time", "end_time",
                    _seconds(F.col("start_time"), F.col("end_time")).alias("duration_seconds"),
                    "output_rows", "upserted_rows", "deleted_rows", "dropped_rows")


def rule_metrics(events: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Expectation results exploded from flow events, unioned with the
    per-rule counts of the quarantine table."""
    ex = (events.filter((F.col("event_type") == "flow_progress")
                        & _j("$.flow_progress.data_quality.expectations").isNotNull())
          .select(F.col("origin.pipeline_id").cast("string").alias("pipeline_id"),
                  F.col("origin.update_id").cast("string").alias("pipeline_update_id"),
                  F.col("timestamp").alias("evaluated_at"),
                  F.explode(F.from_json(_j("$.flow_progress.data_quality.expectations"), EXPECTATIONS)).alias("e")))
    native = ex.groupBy("pipeline_id", "pipeline_update_id", F.col("e.dataset").alias("dataset_name"),
                        F.col("e.name").alias("rule_name")).agg(
        F.sum("e.passed_records").alias("passed_records"), F.sum("e.failed_records").alias("failed_records"),
        F.sum("e.failed_records").alias("rejected_records"), F.max("evaluated_at").alias("evaluated_at"))
    native = native.select("pipeline_id", "pipeline_update_id", table_layer("dataset_name").alias("layer"),
                           "dataset_name", "rule_name", F.lit("SDP_EXPECTATION").alias("metric_source"),
                           "passed_records", "failed_records", "rejected_records", "evaluated_at")
    q = quarantine.groupBy(F.col("source_table_name").alias("dataset_name"),
                           F.col("failed_rule_name").alias("rule_name")).agg(
        F.count(F.lit(1)).alias("failed_records"))
    q = q.select(F.lit(None).cast("string").alias("pipeline_id"), F.lit(None).cast("string").alias("pipeline_update_id"),
                 F.lit("SILVER_VALIDATED").alias("layer"), "dataset_name", "rule_name",
                 F.lit("SILVER_QUARANTINE").alias("metric_source"), F.lit(None).cast("bigint").alias("passed_records"),
                 "failed_records", F.col("failed_records").alias("rejected_records"),
                 F.lit(None).cast("timestamp_ntz").alias("evaluated_at"))
    return native.unionByName(q)


def run_status(run_events: DataFrame) -> DataFrame:
    """Run ledger from append-only run events: latest status per run; a run
    still RUNNING while a newer run of the same pipeline exists is
    ABANDONED.  The newest start per pipeline comes from a grouped
    aggregate joined back (no window over a pipeline)."""
    runs = run_events.groupBy("pipeline_run_id", "pipeline_id").agg(
        F.min("event_time").alias("start_time"),
        F.max_by("execution_status", F.struct("event_time", "execution_status")).alias("_latest"),
        F.max(F.when(F.col("execution_status") != "RUNNING", F.col("event_time"))).alias("end_time"),
        F.min("business_date").alias("business_date"))
    newest = runs.groupBy("pipeline_id").agg(F.max("start_time").alias("_newest_start"))
    j = runs.join(newest, "pipeline_id")
    status = (F.when((F.col("_latest") == "RUNNING") & (F.col("start_time") < F.col("_newest_start")),
                     F.lit("ABANDONED")).otherwise(F.col("_latest")))
    return j.select("pipeline_run_id", "pipeline_id", "business_date", "start_time", "end_time",
                    status.alias("execution_status"),
                    _seconds(F.col("start_time"), F.col("end_time")).alias("duration_seconds"))


def run_status_summary(runs: DataFrame) -> DataFrame:
    """Runs per status, and pipelines violating 'at most one active run'."""
    per_status = runs.groupBy(F.col("execution_status").alias("metric")).agg(F.count(F.lit(1)).alias("value"))
    active = (runs.filter(F.col("execution_status") == "RUNNING").groupBy("pipeline_id").count()
              .filter("count > 1").agg(F.count(F.lit(1)).alias("value"))
              .select(F.lit("PIPELINES_WITH_MULTIPLE_ACTIVE_RUNS").alias("metric"), "value"))
    return per_status.unionByName(active)
