"""Reconciliation queries (DQ-14..19) and expectation metrics (DQ-10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultline.operators import reconcile as R
from vaultline.operators import scd
from vaultline.operators.rules import expect_or_drop, rules_for
from vaultline.plans import oracle as O
from vaultline.plans import pipeline as P
from vaultline.plans.registry import register
from vaultline.sources import fixtures as fx

LATE_SECONDS = 300
STALE_DAYS = 3650


def _status(spark, sf):
    return R.reconcile_latest_status(P.validated(spark, sf, "account_transaction"),
                                     P.validated(spark, sf, "account_transaction_status_event"), "account_txn_id")


def _status_sql() -> str:
    q = O.Q()
    at, ev = q.validated("account_transaction"), q.validated("account_transaction_status_event")
    return q.sql(f"""SELECT t.account_txn_id, t.status AS parent_status, l.status AS last_event_status,
  l.last_sequence_number FROM {at} t JOIN (
  SELECT account_txn_id, status, sequence_number AS last_sequence_number FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY account_txn_id ORDER BY sequence_number DESC, status_timestamp DESC,
      status DESC) AS rn FROM {ev}) WHERE rn = 1) l ON t.account_txn_id = l.account_txn_id
WHERE t.status IS DISTINCT FROM l.status""")


register("dq_reconcile_status", _status_sql())(_status)


def _late(spark, sf):
    return R.late_arrivals(P.bronze(spark, sf, "account_transaction_status_event"), "account_txn_id", LATE_SECONDS)


def _late_sql() -> str:
    q = O.Q()
    q.normalized("account_transaction_status_event")
    ev = "r_account_transaction_status_event"
    ooo = (f"(EXISTS (SELECT 1 FROM {ev} o WHERE o.account_txn_id = e.account_txn_id AND o.sequence_number < "
           f"e.sequence_number AND o.source_arrival_timestamp > e.source_arrival_timestamp) OR EXISTS (SELECT 1 FROM "
           f"{ev} o WHERE o.account_txn_id = e.account_txn_id AND o.sequence_number > e.sequence_number AND "
           f"o.source_arrival_timestamp < e.source_arrival_timestamp))")
    lag = "CAST(epoch(e.source_arrival_timestamp) - epoch(e.status_timestamp) AS BIGINT)"
    return q.sql(f"""SELECT e.status_event_id, e.account_txn_id, e.sequence_number, {lag} AS arrival_lag_seconds,
  coalesce({lag} > {LATE_SECONDS}, FALSE) AS is_late, {ooo} AS out_of_order
FROM {ev} e WHERE coalesce({lag} > {LATE_SECONDS}, FALSE) OR {ooo}""")


register("dq_late_arrival", _late_sql())(_late)


def _stale(spark, sf):
    return R.stale_references(P.bronze(spark, sf, "watchlist"), "added_date", fx.ORDER_AS_OF, STALE_DAYS).select(
        "watchlist_id", "list_type", "added_date", "age_days")


register("dq_stale_reference", (lambda q: (q.normalized("watchlist"), q.sql(
    f"SELECT watchlist_id, list_type, added_date, DATE '{fx.ORDER_AS_OF[:10]}' - added_date AS age_days "
    f"FROM r_watchlist WHERE DATE '{fx.ORDER_AS_OF[:10]}' - added_date > {STALE_DAYS}"))[1])(O.Q()))(_stale)


def _conflicts(spark, sf):
    b = lambda t: P.bronze(spark, sf, t)
    fa = b("fraud_alert").filter(F.col("alert_status") == "CLOSED").select("alert_id")
    link = b("investigation_case_fraud_alert").select("case_id", "alert_id")
    open_cases = b("investigation_case").filter(F.col("case_status").isin("OPEN", "IN_PROGRESS")).select("case_id")
    c1 = (link.join(fa, "alert_id").join(open_cases, "case_id")
          .agg(F.count(F.lit(1)).alias("n")).select(F.lit("closed_alert_on_open_case").alias("conflict_type"), "n"))
    c2 = (b("sanction_screening").filter((F.col("result") == "CLEAR") & (F.col("match_score") >= 90))
          .agg(F.count(F.lit(1)).alias("n")).select(F.lit("clear_result_with_hit_evidence").alias("conflict_type"), "n"))
    return c1.unionByName(c2).withColumnRenamed("n", "records")


def _conflicts_sql() -> str:
    q = O.Q()
    for t in ("fraud_alert", "investigation_case_fraud_alert", "investigation_case", "sanction_screening"):
        q.normalized(t)
    return q.sql("""SELECT 'closed_alert_on_open_case' AS conflict_type, count(*) AS records
FROM r_investigation_case_fraud_alert l JOIN r_fraud_alert a ON a.alert_id = l.alert_id
JOIN r_investigation_case c ON c.case_id = l.case_id
WHERE a.alert_status = 'CLOSED' AND c.case_status IN ('OPEN', 'IN_PROGRESS')
UNION ALL SELECT 'clear_result_with_hit_evidence', count(*) FROM r_sanction_screening
WHERE result = 'CLEAR' AND match_score >= 90""")


register("dq_conflicting_evidence", _conflicts_sql())(_conflicts)

BUSINESS = ["account_txn_id", "status", "sequence_number", "status_timestamp"]


def _replays(spark, sf):
    return R.replays_with_new_ids(fx.source(spark, sf, "account_transaction_status_event"), "status_event_id", BUSINESS)


def _replays_sql() -> str:
    q = O.Q()
    q.fixture("account_transaction_status_event")
    b = ", ".join(BUSINESS)
    on = " AND ".join(f"e.{c} = f.{c}" for c in BUSINESS)
    return q.sql(f"""SELECT e.status_event_id, e.account_txn_id, e.status, e.sequence_number, e.status_timestamp,
  f.first_id AS original_id
FROM account_transaction_status_event e JOIN (SELECT {b}, min(status_event_id) AS first_id, count(*) AS n
  FROM account_transaction_status_event GROUP BY {b}) f ON {on}
WHERE f.n > 1 AND e.status_event_id <> f.first_id""")


register("dq_replay_new_ids", _replays_sql())(_replays)


def _manifest(spark, sf):
    snaps = fx.source(spark, sf, "customer_snapshot")
    return R.change_manifest(scd.change_feed(snaps, ["cust_no"], "version"), snaps, ["cust_no"])


def _manifest_sql() -> str:
    from vaultline.plans.q_cdc import _feed_sql
    q = O.Q()
    q.fixture("customer_snapshot")
    q.add("cal2", "SELECT version, lag(version) OVER (ORDER BY version) AS prev FROM "
                  "(SELECT DISTINCT version FROM customer_snapshot)")
    feed = _feed_sql()
    return q.sql(f"""SELECT f._commit_version,
  count_if(f._change_type = 'insert') AS inserts, count_if(f._change_type = 'update_postimage') AS updates,
  count_if(f._change_type = 'delete') AS deletes,
  count_if(f._change_type = 'insert' AND p.cust_no IS NOT NULL) AS inserts_not_new,
  count_if(f._change_type IN ('update_postimage', 'update_preimage', 'delete') AND p.cust_no IS NULL)
    AS changes_without_prior
FROM ({feed}) f JOIN cal2 c ON c.version = f._commit_version
LEFT JOIN customer_snapshot p ON p.cust_no = f.cust_no AND p.version = c.prev
GROUP BY f._commit_version""")


register("dq_change_manifest", _manifest_sql())(_manifest)


# ------------------------------------------------ expectations (DQ-10)
def _expect_or_drop(spark, sf):
    """Expectation of the contexts on all financial events: an event without a key is dropped; rows kept and dropped by event type."""
    events = P.silver(spark, sf, "financial_event").select("event_type", "financial_event_key")
    kept = expect_or_drop(events, {"valid_financial_event_key": F.col("financial_event_key").isNotNull()})
    rows = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))
    held = kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("kept"))
    kept_rows = F.coalesce("kept", F.lit(0))
    return rows.join(held, "event_type", "left").select(
        "event_type", kept_rows.alias("kept_rows"), (F.col("rows") - kept_rows).alias("dropped_rows"))


def _expect_sql() -> str:
    q = O.Q()
    fe = q.silver("financial_event")
    return q.sql(f"SELECT event_type, count(financial_event_key) AS kept_rows, "
                 f"count(*) - count(financial_event_key) AS dropped_rows FROM {fe} "
                 f"GROUP BY event_type")


register("dq_expect_or_drop", _expect_sql())(_expect_or_drop)


def _expect_scores(spark, sf):
    """Expectation on the risk scores: a score without an event, or outside 0 to 1, is dropped; the rows that stay are the result."""
    scores = P.bronze(spark, sf, "account_transaction_risk_score").select("score_id", "account_txn_id", "model_score")
    good = {"has_event": F.col("account_txn_id") > 0, "score_in_range": F.col("model_score").between(0, 1)}
    return expect_or_drop(scores, good)


def _expect_scores_sql() -> str:
    q = O.Q()
    q.normalized("account_transaction_risk_score")
    return q.sql("SELECT score_id, account_txn_id, model_score FROM r_account_transaction_risk_score "
                 "WHERE account_txn_id > 0 AND model_score >= 0 AND model_score <= 1")


register("dq_expect_or_drop_scores", _expect_scores_sql())(_expect_scores)


def _expect_all(spark, sf):
    """Track-only expectations on one table: per rule passed / failed."""
    from vaultline.operators.rules import rule_pass_counts
    return rule_pass_counts(P.bronze(spark, sf, "account_transaction"), "account_transaction", P.RUN_CLOCK)


def _expect_all_sql() -> str:
    q = O.Q()
    q.normalized("account_transaction")
    sels = [f"SELECT '{n}' AS rule_name, count_if(coalesce({p}, FALSE)) AS passed_records, "
            f"count_if(NOT coalesce({p}, FALSE)) AS failed_records FROM r_account_transaction"
            for n, p in rules_for("account_transaction", O.RUN_CLOCK).items()]
    return q.sql(" UNION ALL ".join(sels))


register("dq_expect_all", _expect_all_sql())(_expect_all)
