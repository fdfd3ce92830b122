"""Query catalogue: name -> (Spark builder, DuckDB oracle SQL or None).

Every Spark builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame
over the whole driver tables.  Oracle SQL is produced by ``plans.oracle``.
Clock-dependent columns (ingested_at, quarantined_at) and non-portable
text (JSON payloads, fingerprints) are left out of compared outputs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.config import TABLES
from vaultline.operators import quarantine as QU
from vaultline.operators.rules import rule_pass_counts
from vaultline.plans import oracle as O
from vaultline.plans import pipeline as P

from vaultline.plans.registry import ORACLE, QUERIES, Builder, register  # noqa: F401


# ------------------------------------------------------------------ silver
def _silver_builder(name: str) -> Builder:
    return lambda spark, sf: P.silver(spark, sf, name)


for _name in P.SILVER_TABLES + ("financial_event_association",):
    register(f"silver_{_name}", O.silver_sql(_name))(_silver_builder(_name))


# -------------------------------------------------------------------- gold
# Subtype table -> its columns for (amount, detail, direction, channel, merchant, source flag).
_SUBTYPE_COLUMNS = {
    "account_posting": ("posting_amount", "posting_type", "posting_direction", "channel_key", "merchant_key", "NULL"),
    "card_payment": ("payment_amount", "card_transaction_type", "NULL", "NULL", "merchant_key", "is_fraud_source_flag"),
    "atm_activity": ("amount", "activity_type", "NULL", "NULL", "NULL", "NULL"),
    "gateway_payment": ("amount", "payment_method", "NULL", "NULL", "merchant_key", "NULL"),
}


def _gold_fraud_sql() -> str:
    """Events with their subtype's details; counts and latest values as scalar lookups per event."""
    q = O.Q()
    names = ("amount", "transaction_type_detail", "posting_direction", "channel_key", "merchant_key", "is_fraud_source_flag")
    q.add("details", " UNION ALL ".join(
        f"SELECT financial_event_key, {', '.join(f'{x} AS {n}' for x, n in zip(columns, names))} FROM {q.silver(table)}"
        for table, columns in _SUBTYPE_COLUMNS.items()))
    q.add("scores", f"""SELECT financial_event_key, model_score AS latest_risk_score, risk_band AS latest_risk_band
FROM {q.silver("financial_event_risk_score")}
QUALIFY 1 = row_number() OVER (PARTITION BY financial_event_key
  ORDER BY scored_date DESC NULLS LAST, financial_event_risk_score_key DESC)""")
    q.add("alerts", f"""SELECT financial_event_key, count(*) AS alerts, max(alert_score) AS top, bool_or(alert_status <> 'CLOSED') AS any_open
FROM (SELECT DISTINCT financial_event_key, fraud_alert_key FROM {q.silver("financial_event_fraud_alert")})
JOIN {q.silver("fraud_alert")} USING (fraud_alert_key) GROUP BY financial_event_key""")
    q.add("flags", f"""SELECT financial_event_key, count(*) AS flags
FROM (SELECT DISTINCT financial_event_key, card_fraud_flag_key FROM {q.silver("financial_event_card_fraud_flag")}
      WHERE card_fraud_flag_key IS NOT NULL) GROUP BY financial_event_key""")
    q.add("stores", f"""SELECT merchant_key, count(*) AS stores,
  max(list_position(['LOW', 'MEDIUM', 'HIGH'], risk_rating)) AS worst FROM {q.silver("merchant_location")} GROUP BY merchant_key""")
    return q.sql(f"""SELECT e.financial_event_key, event_type, occurred_at, amount, e.currency, transaction_type_detail,
  posting_direction, account_key, payment_card_key, party_key, d.channel_key, c.channel_name, c.channel_type,
  d.merchant_key, s.merchant_name, s.mcc_code, s.country AS merchant_country,
  coalesce(stores, 0) AS merchant_store_count,
  list_extract(['LOW', 'MEDIUM', 'HIGH'], worst) AS merchant_max_store_risk,
  latest_risk_score, latest_risk_band, coalesce(alerts, 0) AS fraud_alert_count, top AS max_fraud_alert_score,
  coalesce(any_open, FALSE) AS open_fraud_alert_flag, coalesce(flags, 0) AS card_fraud_flag_count, is_fraud_source_flag,
  e.source_system, e.source_business_key, '{O.RUN_ID}' AS pipeline_run_id,
  if(e.data_quality_status = 'QUARANTINED', 'REJECTED_QUALITY',
     if(party_key IS NULL, 'WARNING_UNRESOLVED_PARTY', 'PASSED_CLEAN')) AS dq_status
FROM {q.silver("financial_event")} e LEFT JOIN details d USING (financial_event_key)
LEFT JOIN {q.silver("transaction_channel")} c ON c.channel_key = d.channel_key
LEFT JOIN {q.silver("merchant")} s ON s.merchant_key = d.merchant_key
LEFT JOIN stores ON stores.merchant_key = d.merchant_key
LEFT JOIN scores USING (financial_event_key) LEFT JOIN alerts USING (financial_event_key)
LEFT JOIN flags USING (financial_event_key)""")


def _newest(q: O.Q, table: str, key: str, rank: tuple[str, str], columns: str, where: str = "TRUE") -> str:
    """The row of each key that comes first by (date, own key), both descending."""
    return q.add(f"newest_{table}", f"""SELECT DISTINCT ON ({key}) {key}, {columns} FROM {q.silver(table)} WHERE {where}
ORDER BY {key}, {rank[0]} DESC NULLS LAST, {rank[1]} DESC""")


def _gold_c360_sql() -> str:
    """A party's row from scalar lookups: each measure is one statement about that party."""
    from vaultline.sources.fixtures import ORDER_AS_OF
    q = O.Q()
    day = f"DATE '{ORDER_AS_OF[:10]}'"
    profile = _newest(q, "party_profile_version", "party_key", ("effective_from", "party_profile_version_key"),
                      "preferred_contact_method, effective_from AS profile_effective_from", "is_current")
    kyc = _newest(q, "party_kyc_assessment", "party_key", ("verified_date", "kyc_assessment_key"),
                  "verification_status, id_type, id_number")
    job = _newest(q, "party_employment", "party_key", ("effective_from", "employment_key"),
                  "employer_name, job_title, monthly_income", "effective_to IS NULL")
    money = _newest(q, "account_balance_snapshot", "account_key", ("balance_date", "account_balance_snapshot_key"),
                    "closing_balance", f"balance_date >= {day} - 30")
    q.add("roles", f"""SELECT party_key, account_key, valid_to, account_status
FROM {q.silver("party_account_role")} SEMI JOIN {q.silver("account")} USING (account_key) LEFT JOIN {q.silver("account")} USING (account_key)""")
    q.add("live_cards", f"SELECT DISTINCT account_key, payment_card_key FROM {q.silver('payment_card')} WHERE card_status = 'ACTIVE'")
    calls, cases, aml = q.silver("call_center_contact"), q.silver("investigation_case"), q.silver("aml_case")
    mine = "x.party_key = p.party_key"
    return q.sql(f"""SELECT p.party_key, p.party_type, p.party_status, preferred_contact_method, profile_effective_from,
  verification_status AS kyc_verification_status, id_type AS kyc_id_type, if(id_number IS NULL, NULL, sha256(concat('KYC_ID|', id_number))) AS kyc_id_number,
  employer_name, job_title,
  list_extract(['<10M', '10-30M', '30-100M', '100M+'], 1 + (monthly_income >= 10000000)::INT + (monthly_income >= 30000000)::INT
    + (monthly_income >= 100000000)::INT) AS monthly_income_band,
  (SELECT count(DISTINCT account_key) FROM roles x WHERE {mine} AND valid_to IS NULL AND account_status = 'ACTIVE') AS active_account_count,
  (SELECT sum(closing_balance) FROM roles x JOIN {money} USING (account_key) WHERE {mine}) AS total_current_balance,
  (SELECT count(payment_card_key) FROM roles x JOIN live_cards USING (account_key) WHERE {mine}) AS active_card_count,
  (SELECT count(*) FROM {q.silver("party_service_request")} x WHERE {mine} AND request_status NOT IN ('RESOLVED', 'REJECTED'))
    AS open_service_request_count,
  (SELECT count(*) FROM {calls} x WHERE {mine} AND call_timestamp >= CAST({day} - 90 AS TIMESTAMP)) AS call_center_contact_count_90d,
  (SELECT max({{'a': call_timestamp, 'b': call_center_contact_key, 'why': call_reason}}).why FROM {calls} x WHERE {mine}) AS last_call_reason,
  EXISTS (SELECT 1 FROM {aml} x WHERE {mine} AND investigation_case_key IN (SELECT investigation_case_key FROM {cases}
          WHERE case_status NOT IN ('CLOSED', 'RESOLVED'))) AS open_investigation_flag,
  p.source_system, p.source_business_key, '{O.RUN_ID}' AS pipeline_run_id,
  if(p.data_quality_status = 'QUARANTINED', 'REJECTED_QUALITY',
     if(verification_status IS DISTINCT FROM 'VERIFIED', 'WARNING_UNRESOLVED_PARTY', 'PASSED_CLEAN')) AS dq_status
FROM {q.silver("party")} p LEFT JOIN {profile} USING (party_key) LEFT JOIN {kyc} USING (party_key) LEFT JOIN {job} USING (party_key)
WHERE p.party_key IS NOT NULL""")


def _gold_aml_sql() -> str:
    """A case's row from scalar lookups over its links, notes and screenings."""
    q = O.Q()
    aml = _newest(q, "aml_case", "investigation_case_key", ("opened_date", "aml_case_key"),
                  "party_key, aml_case_key, risk_level AS aml_risk_level")
    report = _newest(q, "suspicious_activity_report", "aml_case_key", ("filed_date", "suspicious_activity_report_key"),
                     "filed_date, regulatory_reference, report_status")
    q.add("screened", f"""SELECT investigation_case_key, sanctions_screening_key, match_score, list_type,
  coalesce(screening_result NOT IN ('CLEAR', 'FALSE_POSITIVE'), FALSE) AS hit
FROM {q.silver("sanctions_screening")} s JOIN {q.silver("investigation_case_sanctions_screening")} USING (sanctions_screening_key)
LEFT JOIN {q.silver("watchlist_entry")} USING (watchlist_entry_key)""")
    notes = q.silver("investigation_note")
    mine = "x.investigation_case_key = i.investigation_case_key"

    def linked(table: str, item: str) -> str:
        return f"(SELECT count(DISTINCT {item}) FROM {q.silver(table)} x WHERE {mine})"

    def screened(measure: str) -> str:
        return f"(SELECT {measure} FROM screened x WHERE {mine})"

    return q.sql(f"""SELECT i.investigation_case_key, investigation_type, case_origin, case_status, priority, opened_at, closed_at,
  assigned_analyst_id, a.party_key, a.aml_case_key, aml_risk_level, filed_date IS NOT NULL AS sar_filed_flag,
  filed_date AS sar_filed_date, regulatory_reference AS sar_regulatory_reference, report_status AS sar_report_status,
  {screened("count(DISTINCT sanctions_screening_key)")} AS sanctions_screening_count,
  {screened("coalesce(bool_or(hit), FALSE)")} AS sanctions_hit_flag,
  {screened("max(match_score)")} AS max_sanctions_match_score,
  {screened("if(count(*) = 0, NULL, coalesce(string_agg(DISTINCT list_type, ', ' ORDER BY list_type), ''))")} AS linked_watchlist_types,
  {linked("investigation_case_fraud_alert", "fraud_alert_key")} AS linked_fraud_alert_count,
  {linked("investigation_case_monitoring_alert", "monitoring_alert_key")} AS linked_monitoring_alert_count,
  {linked("investigation_case_financial_event", "financial_event_key")} AS linked_financial_event_count,
  (SELECT count(*) FROM {notes} x WHERE {mine}) AS investigation_note_count,
  (SELECT max({{'a': note_timestamp, 'b': investigation_note_key, 'words': note_text}}).words FROM {notes} x WHERE {mine}) AS latest_note_text,
  i.source_system, i.source_business_key, '{O.RUN_ID}' AS pipeline_run_id,
  if(case_status = 'CLOSED' AND regulatory_reference IS NULL AND a.aml_case_key IS NOT NULL, 'PENDING_REGULATORY_REF', 'PASSED_CLEAN')
    AS dq_status
FROM {q.silver("investigation_case")} i LEFT JOIN {aml} a USING (investigation_case_key)
LEFT JOIN {report} r ON r.aml_case_key = a.aml_case_key WHERE i.investigation_case_key IS NOT NULL""")


register("gold_fraud_transaction", _gold_fraud_sql())(P.gold_fraud)
register("gold_customer_360", _gold_c360_sql())(P.gold_customer_360)
register("gold_aml_investigation", _gold_aml_sql())(P.gold_aml)


# ----------------------------------------------------- data-quality rules
ALL_TABLES = list(TABLES)


def _dq_rule_counts(spark, sf):
    P.assess_all(spark, sf, ALL_TABLES)
    parts = []
    for t in ALL_TABLES:
        a = P.assessed(spark, sf, t)
        parts.append(rule_pass_counts(a, t, P.RUN_CLOCK).select(F.lit(t).alias("source_table_name"), "*"))
    return reduce(lambda x, y: x.unionByName(y), parts)


def _dq_rule_counts_sql() -> str:
    q = O.Q()
    sels = []
    for t in ALL_TABLES:
        n = q.normalized(t)
        for rn, p in q.rule_sql(t).items():
            sels.append(f"SELECT '{t}' AS source_table_name, '{rn}' AS rule_name, "
                        f"count_if(coalesce({p}, FALSE)) AS passed_records, "
                        f"count_if(NOT coalesce({p}, FALSE)) AS failed_records FROM {n}")
    return q.sql("\nUNION ALL\n".join(sels))


register("dq_rule_counts", _dq_rule_counts_sql())(_dq_rule_counts)


def _dq_split_counts(spark, sf):
    P.assess_all(spark, sf, ALL_TABLES)
    return reduce(lambda x, y: x.unionByName(y),
                  [QU.split_counts(P.assessed(spark, sf, t), t) for t in ALL_TABLES])


def _dq_split_counts_sql() -> str:
    q = O.Q()
    sels = []
    for t in ALL_TABLES:
        n = q.normalized(t)
        sels.append(f"SELECT '{t}' AS source_table_name, (SELECT count(*) FROM {n}) AS input_rows, "
                    f"(SELECT count(*) FROM {q.validated(t)}) AS validated_rows, "
                    f"(SELECT count(*) FROM {n}) - (SELECT count(*) FROM {q.validated(t)}) AS quarantined_rows")
    return q.sql("\nUNION ALL\n".join(sels))


register("dq_split_counts", _dq_split_counts_sql())(_dq_split_counts)

QUARANTINE_COLS = ["source_table_name", "source_business_key", "bronze_record_ref", "failed_rule_name",
                   "quarantine_reason", "pipeline_run_id"]


def _dq_quarantine_records(spark, sf):
    P.assess_all(spark, sf, ALL_TABLES)
    return reduce(lambda x, y: x.unionByName(y),
                  [P.quarantine(spark, sf, t).select(*QUARANTINE_COLS) for t in ALL_TABLES])


def _dq_quarantine_records_sql() -> str:
    q = O.Q()
    sels = []
    for t in ALL_TABLES:
        f = q.failures(t)
        keys = TABLES[t].lineage_keys
        sbk = "concat_ws(':', " + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '<NULL>')" for k in keys) + ")"
        sels.append(f"SELECT '{t}' AS source_table_name, {sbk} AS source_business_key, "
                    f"'{t}.{'+'.join(keys)}=' || {sbk} AS bronze_record_ref, failed_rule_name, "
                    f"'VALIDATION_RULE_FAILURE' AS quarantine_reason, '{O.RUN_ID}' AS pipeline_run_id FROM {f}")
    return q.sql("\nUNION ALL\n".join(sels))


register("dq_quarantine_records", _dq_quarantine_records_sql())(_dq_quarantine_records)


def _validated_rows(table: str):
    def build(spark, sf):
        return P.validated(spark, sf, table)
    q = O.Q()
    return build, q.sql(f"SELECT * FROM {q.validated(table)}")


for _t in ("core_banking_customer", "crm_customer", "account_transaction", "payment_gateway_status_event"):
    _b, _s = _validated_rows(_t)
    register(f"dq_validated_{_t}", _s)(_b)


def _failed_names(table: str):
    def build(spark, sf):
        a = P.assessed(spark, sf, table)
        keys = TABLES[table].lineage_keys
        return (a.filter("is_quarantined")
                .select(QU.source_business_key(keys).alias("source_business_key"),
                        F.array_join(F.array_sort("_failed_rule_names"), ",").alias("failed_rule_names")))
    q = O.Q()
    f = q.failures(table)
    keys = TABLES[table].lineage_keys
    sbk = "concat_ws(':', " + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '<NULL>')" for k in keys) + ")"
    cols = ", ".join(O.fixture_columns(table))
    return build, q.sql(f"SELECT {sbk} AS source_business_key, "
                        f"array_to_string(list_sort(list(failed_rule_name)), ',') AS failed_rule_names "
                        f"FROM {f} GROUP BY {cols}")


_b, _s = _failed_names("core_banking_customer")
register("dq_failed_rule_names", _s)(_b)


# further families register themselves on import
from vaultline.plans import q_cdc  # noqa: E402,F401
from vaultline.plans import q_history  # noqa: E402,F401
from vaultline.plans import q_contract  # noqa: E402,F401
from vaultline.plans import q_identity  # noqa: E402,F401
from vaultline.plans import q_mask  # noqa: E402,F401
from vaultline.plans import q_ingest  # noqa: E402,F401
from vaultline.plans import q_reconcile  # noqa: E402,F401
from vaultline.plans import q_monitor  # noqa: E402,F401
from vaultline.plans import q_stream  # noqa: E402,F401
from vaultline.plans import q_extra  # noqa: E402,F401
from vaultline.plans import q_sources  # noqa: E402,F401
from vaultline.plans import q_rescue  # noqa: E402,F401
