"""Monitoring queries (MN-01..05) over the event log derived from ``events``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from vaultline.config import TABLES
from vaultline.operators import monitor as M
from vaultline.plans import oracle as O
from vaultline.plans import pipeline as P
from vaultline.plans.registry import register
from vaultline.sources import fixtures as fx

AS_OF = fx.EVENT_AS_OF


def _events(spark, sf):
    e = fx.source(spark, sf, "pipeline_event_log")
    return e.select("event_id", "event_type", "timestamp",
                    F.struct(F.col("origin_pipeline_id").alias("pipeline_id"),
                             F.col("origin_pipeline_name").alias("pipeline_name"),
                             F.col("origin_update_id").alias("update_id"),
                             F.col("origin_flow_name").alias("flow_name")).alias("origin"),
                    "details")


def _js(path: str) -> str:
    return f"json_extract_string(details, '{path}')"


def _layer(x: str) -> str:
    from vaultline.functions.keys import LAYER_PATTERNS
    whens = " ".join(f"WHEN lower({x}) LIKE '{p}' THEN '{layer}'" for p, layer in LAYER_PATTERNS)
    return f"CASE {whens} ELSE 'OTHER' END"


def _secs(a: str, b: str) -> str:
    return f"round((epoch_us({b}) - epoch_us({a})) / 1000 / 1000)"


def _updates_sql() -> str:
    q = O.Q()
    q.fixture("pipeline_event_log")
    st = _js("$.update_progress.state")
    q.add("u", f"""SELECT origin_pipeline_id AS pipeline_id, origin_update_id AS pipeline_update_id,
  min(origin_pipeline_name) AS pipeline_name,
  min(CASE WHEN event_type = 'create_update' THEN timestamp END) AS start_time,
  max(CASE WHEN event_type = 'update_progress' AND {st} IN ('COMPLETED', 'FAILED', 'CANCELED', 'CANCELLED')
      THEN timestamp END) AS e,
  arg_max({st}, (timestamp, {st})) FILTER (WHERE event_type = 'update_progress') AS pipeline_update_status
FROM pipeline_event_log WHERE origin_update_id IS NOT NULL AND event_type IN ('create_update', 'update_progress')
GROUP BY 1, 2""")
    end = f"coalesce(e, TIMESTAMP '{AS_OF}')"
    return q.sql(f"""SELECT pipeline_id, pipeline_name, pipeline_update_id, start_time, {end} AS end_time,
  {_secs('start_time', end)} AS duration_seconds, pipeline_update_status
FROM u WHERE start_time IS NOT NULL AND pipeline_update_status IS NOT NULL""")


register("mon_pipeline_updates", _updates_sql())(lambda spark, sf: M.pipeline_updates(_events(spark, sf), AS_OF))


def _tables_sql() -> str:
    q = O.Q()
    q.fixture("pipeline_event_log")
    st = _js("$.flow_progress.status")

    def num(p):
        return f"TRY_CAST({_js(p)} AS BIGINT)"

    q.add("f", f"""SELECT origin_pipeline_name AS pipeline_name, origin_pipeline_id AS pipeline_id,
  origin_update_id AS pipeline_update_id, origin_flow_name AS table_name, timestamp, {st} AS flow_status,
  {num('$.flow_progress.metrics.num_output_rows')} AS o, {num('$.flow_progress.metrics.num_upserted_rows')} AS u,
  {num('$.flow_progress.metrics.num_deleted_rows')} AS d, {num('$.flow_progress.data_quality.dropped_records')} AS x
FROM pipeline_event_log WHERE event_type = 'flow_progress' AND origin_flow_name IS NOT NULL
  AND origin_flow_name <> 'pipelines.flowTimeMetrics.missingFlowName'""")
    q.add("g", """SELECT pipeline_name, pipeline_id, pipeline_update_id, table_name,
  min(CASE WHEN flow_status IN ('STARTING', 'RUNNING', 'COMPLETED') THEN timestamp END) AS start_time,
  max(CASE WHEN flow_status IN ('STARTING', 'RUNNING', 'COMPLETED') THEN timestamp END) AS end_time,
  arg_max(flow_status, (timestamp, flow_status)) FILTER (WHERE flow_status IN ('COMPLETED', 'FAILED', 'CANCELED',
    'CANCELLED', 'EXCLUDED', 'SKIPPED', 'STOPPED', 'IDLE')) AS flow_status,
  sum(coalesce(o, 0)) AS output_rows, sum(coalesce(u, 0)) AS upserted_rows, sum(coalesce(d, 0)) AS deleted_rows,
  max(coalesce(x, 0)) AS dropped_rows
FROM f GROUP BY 1, 2, 3, 4""")
    return q.sql(f"""SELECT pipeline_id, pipeline_name, pipeline_update_id, {_layer('table_name')} AS layer, table_name,
  flow_status, start_time, end_time, {_secs('start_time', 'end_time')} AS duration_seconds,
  output_rows, upserted_rows, deleted_rows, dropped_rows FROM g""")


register("mon_table_metrics", _tables_sql())(lambda spark, sf: M.table_metrics(_events(spark, sf)))

QTABLES = tuple(TABLES)


def _rules(spark, sf):
    P.assess_all(spark, sf, QTABLES)
    quarantine = reduce(lambda a, b: a.unionByName(b), [P.quarantine(spark, sf, t) for t in QTABLES])
    return M.rule_metrics(_events(spark, sf), quarantine)


def _rules_sql() -> str:
    q = O.Q()
    q.fixture("pipeline_event_log")
    ex = "$.flow_progress.data_quality.expectations"
    q.add("x", f"""SELECT origin_pipeline_id AS pipeline_id, origin_update_id AS pipeline_update_id,
  timestamp AS evaluated_at, unnest(from_json(json_extract(details, '{ex}'),
    '[{{"name": "VARCHAR", "dataset": "VARCHAR", "passed_records": "BIGINT", "failed_records": "BIGINT"}}]')) AS e
FROM pipeline_event_log WHERE event_type = 'flow_progress' AND json_extract(details, '{ex}') IS NOT NULL""")
    fails = " UNION ALL ".join(f"SELECT '{t}' AS t, failed_rule_name FROM {q.failures(t)}" for t in QTABLES)
    return q.sql(f"""SELECT pipeline_id, pipeline_update_id, {_layer('e.dataset')} AS layer, e.dataset AS dataset_name,
  e.name AS rule_name, 'SDP_EXPECTATION' AS metric_source, sum(e.passed_records) AS passed_records,
  sum(e.failed_records) AS failed_records, sum(e.failed_records) AS rejected_records, max(evaluated_at) AS evaluated_at
FROM x GROUP BY pipeline_id, pipeline_update_id, e.dataset, e.name
UNION ALL SELECT NULL, NULL, 'SILVER_VALIDATED', t, failed_rule_name, 'SILVER_QUARANTINE', NULL, count(*), count(*),
  NULL FROM ({fails}) GROUP BY t, failed_rule_name""")


register("mon_rule_metrics", _rules_sql())(_rules)


def _runs(spark, sf):
    return M.run_status(fx.source(spark, sf, "pipeline_run_event"))


def _runs_cte(q: O.Q) -> str:
    q.fixture("pipeline_run_event")
    q.add("rr", """SELECT pipeline_run_id, pipeline_id, min(event_time) AS start_time,
  arg_max(execution_status, (event_time, execution_status)) AS latest,
  max(CASE WHEN execution_status <> 'RUNNING' THEN event_time END) AS end_time, min(business_date) AS business_date
FROM pipeline_run_event GROUP BY 1, 2""")
    return q.add("runs", f"""SELECT r.pipeline_run_id, r.pipeline_id, r.business_date, r.start_time, r.end_time,
  CASE WHEN r.latest = 'RUNNING' AND r.start_time < n.ns THEN 'ABANDONED' ELSE r.latest END AS execution_status,
  {_secs('r.start_time', 'r.end_time')} AS duration_seconds
FROM rr r JOIN (SELECT pipeline_id, max(start_time) AS ns FROM rr GROUP BY 1) n ON r.pipeline_id = n.pipeline_id""")


register("mon_run_status", (lambda q: q.sql(f"SELECT * FROM {_runs_cte(q)}"))(O.Q()))(_runs)


def _run_summary_sql() -> str:
    q = O.Q()
    r = _runs_cte(q)
    return q.sql(f"""SELECT execution_status AS metric, count(*) AS value FROM {r} GROUP BY 1
UNION ALL SELECT 'PIPELINES_WITH_MULTIPLE_ACTIVE_RUNS', count(*) FROM (SELECT pipeline_id FROM {r}
  WHERE execution_status = 'RUNNING' GROUP BY 1 HAVING count(*) > 1)""")


register("mon_run_summary", _run_summary_sql())(lambda spark, sf: M.run_status_summary(_runs(spark, sf)))
