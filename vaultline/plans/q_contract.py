"""Contract-check queries (DC-01..17) over the bronze sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline import contracts as K
from vaultline.config import TABLES
from vaultline.operators import contract as C
from vaultline.operators import keycheck as KC
from vaultline.operators.scalar import side_by_side
from vaultline.plans import oracle as O
from vaultline.plans import pipeline as P
from vaultline.plans.registry import register
from vaultline.sources import fixtures as fx


def _run(spark, sf, checks):
    by_table: dict[str, list] = {}
    for c in checks:
        by_table.setdefault(c.table, []).append(c)
    parts = [C.evaluate(P.bronze(spark, sf, t), cs) for t, cs in by_table.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _duck_bad(c) -> str:
    if c.kind == "pattern":
        return f"({c.column} IS NOT NULL AND NOT regexp_matches({c.column}, '{c.pattern}'))"
    if c.kind == "missing":
        vals = ", ".join("'" + v + "'" for v in c.values)
        return f"({c.column} IS NULL OR trim(CAST({c.column} AS VARCHAR)) IN ({vals}))"
    return c.bad_sql()


def _sql(checks) -> str:
    q = O.Q()
    sels = []
    for c in checks:
        q.normalized(c.table)      # registers r_<table> (bronze rows)
        src = f"r_{c.table}"
        if c.kind == "duplicate":
            failed = f"count(*) - count(DISTINCT {c.column})"
        elif c.kind == "row_count":
            failed = "count(*)"
        else:
            failed = f"count_if({_duck_bad(c)})"
        sels.append(f"SELECT '{c.table}' AS table_name, '{c.name}' AS check_name, '{c.kind}' AS check_type, "
                    f"'{c.column or ''}' AS column_name, {failed} AS failed_records, count(*) AS total_records, "
                    f"'{c.unit}' AS unit, '{c.op}' AS operator, CAST({float(c.threshold)} AS DOUBLE) AS threshold "
                    f"FROM {src}")
    body = " UNION ALL ".join(sels)
    pct = "round(CAST(failed_records AS DOUBLE) * 100 / total_records, 4)"
    val = f"CASE WHEN unit = 'percent' THEN {pct} ELSE CAST(failed_records AS DOUBLE) END"
    return q.sql(f"""SELECT table_name, check_name, check_type, column_name, failed_records, total_records,
  CASE WHEN total_records > 0 THEN {pct} END AS failed_percent, unit, operator, threshold,
  coalesce(CASE operator WHEN 'mustBe' THEN {val} = threshold WHEN 'mustBeLessThan' THEN {val} < threshold
    WHEN 'mustBeGreaterThan' THEN {val} > threshold ELSE {val} <= threshold END, FALSE) AS passed
FROM ({body})""")


def _reg(name, checks):
    register(name, _sql(checks))(lambda spark, sf: _run(spark, sf, checks))


for _name, _kinds in K.CONDITIONAL_KINDS.items():
    _reg(_name, [c for c in K.CHECKS if c.kind in _kinds])
for _name, _names in K.CONDITION_GROUPS.items():
    _reg(_name, [c for c in K.CHECKS if c.name in _names])
_reg("contract_all_metrics", list(K.CHECKS))


# -------------------------------------------------- sequence uniqueness
SEQ = [("account_transaction_status_event", "account_txn_id"), ("card_transaction_status_event", "card_txn_id"),
       ("atm_transaction_status_event", "log_id"), ("payment_gateway_status_event", "gateway_txn_id")]


def _seq(spark, sf):
    parts = [C.sequence_violations(P.bronze(spark, sf, t), p, "sequence_number")
             .agg(F.count(F.lit(1)).alias("duplicate_pairs"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
             .select(F.lit(t).alias("table_name"), "duplicate_pairs", F.col("rows").cast("bigint").alias("rows"))
             for t, p in SEQ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _seq_sql() -> str:
    q = O.Q()
    sels = []
    for t, p in SEQ:
        q.normalized(t)
        sels.append(f"SELECT '{t}' AS table_name, count(*) AS duplicate_pairs, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows "
                    f"FROM (SELECT {p}, sequence_number, count(*) AS n FROM r_{t} GROUP BY 1, 2 HAVING count(*) > 1)")
    return q.sql(" UNION ALL ".join(sels))


register("contract_sequence_unique", _seq_sql())(_seq)


# ------------------------------------------------------- foreign keys
def _fk(spark, sf):
    return KC.reference_orphans(lambda t: P.bronze(spark, sf, t), [KC.Reference(*declared) for declared in K.FOREIGN_KEYS])


def _fk_sql() -> str:
    q = O.Q()
    sels = []
    for child, ccol, parent, pcol in K.FOREIGN_KEYS:
        q.normalized(child)
        q.normalized(parent)
        sels.append(f"SELECT '{child}' AS child_table, '{ccol}' AS child_column, '{parent}' AS parent_table, "
                    f"'{pcol}' AS parent_column, count(*) AS orphan_records FROM r_{child} c "
                    f"WHERE c.{ccol} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM r_{parent} p WHERE p.{pcol} = c.{ccol})")
    return q.sql(" UNION ALL ".join(sels))


register("contract_foreign_keys", _fk_sql())(_fk)

# Every source's own key, and the declared sequences of status events.
UNIQUE_KEYS = [(t, (s.business_key,)) for t, s in TABLES.items()] + K.UNIQUE_SEQUENCES


def _unique_sql() -> str:
    q, parts = O.Q(), []
    for t, columns in UNIQUE_KEYS:
        q.normalized(t)
        where = f"WHERE {columns[0]} IS NOT NULL" if len(columns) == 1 else ""
        parts.append(f"""SELECT '{t}' AS table_name, '{"+".join(columns)}' AS key_columns, count(*) AS distinct_values,
  count_if(held > 1) AS repeated_values, CAST(coalesce(sum(held) - count(*), 0) AS BIGINT) AS surplus_records
FROM (SELECT count(*) AS held FROM r_{t} {where} GROUP BY {", ".join(columns)})""")
    return q.sql(" UNION ALL ".join(parts))


register("contract_unique_keys", _unique_sql())(
    lambda spark, sf: KC.repeated_keys(lambda t: P.bronze(spark, sf, t), UNIQUE_KEYS))


# ------------------------------------------------ cross-table consistency
def _cross(spark, sf):
    b = lambda t: P.bronze(spark, sf, t)
    gw_ev = b("payment_gateway_status_event").alias("e")
    gw = b("payment_gateway_log").alias("g")
    m1 = (gw_ev.join(gw, F.col("e.gateway_txn_id") == F.col("g.gateway_txn_id"))
          .filter(((F.col("g.payment_method") == "CARD") & F.col("e.card_txn_id").isNull())
                  | ((F.col("g.payment_method") == "ACCOUNT_TRANSFER") & F.col("e.account_txn_id").isNull()))
          .agg(F.count(F.lit(1)).alias("violations")).select(F.lit("gateway_event_vs_method").alias("check_name"),
                                                            "violations"))
    aml = b("aml_case").alias("a")
    ic = b("investigation_case").alias("i")
    m2 = (aml.join(ic, F.col("a.investigation_case_id") == F.col("i.case_id"))
          .filter((F.col("i.case_status") == "CLOSED") & F.col("a.closed_date").isNull() & F.col("a.risk_level").isNotNull())
          .agg(F.count(F.lit(1)).alias("violations")).select(F.lit("aml_closed_vs_case").alias("check_name"),
                                                            "violations"))
    acc = b("account").alias("ac")
    bal = b("balance_snapshot").alias("bs")
    m3 = (bal.join(acc, F.col("bs.account_id") == F.col("ac.account_id"))
          .filter((F.col("ac.product_type") == "SAVINGS") & (F.col("bs.closing_balance") < 0))
          .agg(F.count(F.lit(1)).alias("violations")).select(F.lit("savings_negative_balance").alias("check_name"),
                                                            "violations"))
    # An ATM event may lack its account transaction only where the log's type moves no money.
    m4 = (b("atm_transaction_status_event").join(b("log_atm").select("log_id", "txn_type"), "log_id")
          .agg(F.count_if(F.col("account_txn_id").isNull() & ~F.col("txn_type").isin(*MOVES_NO_MONEY)).alias("violations"))
          .select(F.lit("atm_event_vs_log_type").alias("check_name"), "violations"))
    # A link's table says of which type its case must be: both link tables meet the cases in one join.
    links = reduce(DataFrame.unionByName, [b(t).select(F.lit(t).alias("link"), F.lit(kind).alias("wanted"), "case_id")
                                           for t, kind in LINKED_CASE_TYPES.items()])
    wrong = F.col("investigation_type") != F.col("wanted")
    m5 = (links.join(b("investigation_case").select("case_id", "investigation_type"), "case_id")
          .agg(*[F.count_if(wrong & (F.col("link") == t)).alias(t) for t in LINKED_CASE_TYPES])
          .select(F.inline(F.array(*[F.struct(F.lit(f"{t}_vs_case_type").alias("check_name"), F.col(t).alias("violations"))
                                     for t in LINKED_CASE_TYPES]))))
    return reduce(DataFrame.unionByName, [m1, m2, m3, m4, m5])


# ATM log types without an account transaction; link table -> type of its cases.
MOVES_NO_MONEY = ("BALANCE_INQUIRY", "PIN_CHANGE")
LINKED_CASE_TYPES = {"investigation_case_transaction_monitoring_alert": "AML", "investigation_case_card_fraud_flag": "FRAUD"}


def _cross_sql() -> str:
    q = O.Q()
    for t in ("payment_gateway_status_event", "payment_gateway_log", "aml_case", "investigation_case",
              "account", "balance_snapshot", "atm_transaction_status_event", "log_atm",
              "investigation_case_transaction_monitoring_alert", "investigation_case_card_fraud_flag"):
        q.normalized(t)
    return q.sql("""SELECT 'gateway_event_vs_method' AS check_name, count(*) AS violations
FROM r_payment_gateway_status_event e JOIN r_payment_gateway_log g ON e.gateway_txn_id = g.gateway_txn_id
WHERE (g.payment_method = 'CARD' AND e.card_txn_id IS NULL)
   OR (g.payment_method = 'ACCOUNT_TRANSFER' AND e.account_txn_id IS NULL)
UNION ALL SELECT 'aml_closed_vs_case', count(*) FROM r_aml_case a JOIN r_investigation_case i
  ON a.investigation_case_id = i.case_id WHERE i.case_status = 'CLOSED' AND a.closed_date IS NULL AND a.risk_level IS NOT NULL
UNION ALL SELECT 'savings_negative_balance', count(*) FROM r_balance_snapshot bs JOIN r_account ac
  ON bs.account_id = ac.account_id WHERE ac.product_type = 'SAVINGS' AND bs.closing_balance < 0
UNION ALL SELECT 'atm_event_vs_log_type', count(*) FROM r_atm_transaction_status_event e JOIN r_log_atm USING (log_id)
  WHERE e.account_txn_id IS NULL AND txn_type NOT IN ('BALANCE_INQUIRY', 'PIN_CHANGE')
UNION ALL SELECT 'investigation_case_transaction_monitoring_alert_vs_case_type', count(*)
  FROM r_investigation_case_transaction_monitoring_alert JOIN r_investigation_case USING (case_id) WHERE investigation_type <> 'AML'
UNION ALL SELECT 'investigation_case_card_fraud_flag_vs_case_type', count(*)
  FROM r_investigation_case_card_fraud_flag JOIN r_investigation_case USING (case_id) WHERE investigation_type <> 'FRAUD'""")


register("contract_cross_table", _cross_sql())(_cross)


# ------------------------------------------------------ reference lookup
def _reference(spark, sf):
    codes = spark.createDataFrame([(c,) for c in K.CHARGEBACK_REASON_CODES], "reason_code STRING")
    cb = P.bronze(spark, sf, "chargeback")
    return (C.foreign_key_orphans(cb, "reason_code", codes, "reason_code")
            .select("chargeback_id", "reason_code"))


def _reference_sql() -> str:
    q = O.Q()
    q.normalized("chargeback")
    vals = ", ".join(f"('{c}')" for c in K.CHARGEBACK_REASON_CODES)
    return q.sql(f"SELECT chargeback_id, reason_code FROM r_chargeback WHERE reason_code IS NOT NULL AND "
                 f"reason_code NOT IN (SELECT reason_code FROM (VALUES {vals}) AS r(reason_code))")


register("contract_reference_lookup", _reference_sql())(_reference)


# ------------------------------------------------------ customer mapping
def _mapping(spark, sf):
    """AML / monitoring customer references vs. the customer crosswalk
    (reference -> party): ambiguous (>1 party) and missing mappings."""
    core = P.validated(spark, sf, "core_banking_customer").select(F.col("cust_no").alias("ref"), "national_id")
    crm = P.validated(spark, sf, "crm_customer").select(F.col("party_id").alias("ref"), "national_id")
    xwalk = core.unionByName(crm).filter(F.col("national_id").isNotNull()).select(
        "ref", F.sha2(F.concat(F.lit("CUSTOMER_360|"), F.col("national_id")), 256).alias("enterprise_id"))
    amb = C.ambiguous_mapping(xwalk, "ref", "enterprise_id").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("ambiguous_mapping").alias("check_name"), "n")
    refs = (P.bronze(spark, sf, "aml_case").select(F.upper(F.trim("customer_ref")).alias("ref"))
            .unionByName(P.bronze(spark, sf, "transaction_monitoring_alert")
                         .select(F.upper(F.trim("customer_ref")).alias("ref"))))
    missing = C.foreign_key_orphans(refs, "ref", xwalk, "ref").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("missing_mapping").alias("check_name"), "n")
    return amb.unionByName(missing).withColumnRenamed("n", "violations")


def _mapping_sql() -> str:
    q = O.Q()
    core, crm = q.validated("core_banking_customer"), q.validated("crm_customer")
    q.normalized("aml_case")
    q.normalized("transaction_monitoring_alert")
    q.add("xw", f"SELECT ref, sha256('CUSTOMER_360|' || national_id) AS eid FROM (SELECT cust_no AS ref, national_id "
                f"FROM {core} UNION ALL SELECT party_id, national_id FROM {crm}) WHERE national_id IS NOT NULL")
    return q.sql("""SELECT 'ambiguous_mapping' AS check_name, count(*) AS violations FROM
  (SELECT ref FROM xw GROUP BY ref HAVING count(DISTINCT eid) > 1)
UNION ALL SELECT 'missing_mapping', count(*) FROM (SELECT upper(trim(customer_ref)) AS ref FROM r_aml_case
  UNION ALL SELECT upper(trim(customer_ref)) FROM r_transaction_monitoring_alert) r
  WHERE r.ref IS NOT NULL AND NOT EXISTS (SELECT 1 FROM xw WHERE xw.ref = r.ref)""")


register("contract_mapping", _mapping_sql())(_mapping)


# ------------------------------------------------------------ remediation
def _remediation(spark, sf):
    """Remediation actions applied as column expressions: NULL replace,
    clamp to range, canonical key, default currency."""
    fa = P.bronze(spark, sf, "fraud_alert")
    return fa.select(
        "alert_id",
        C.clamp("alert_score", 0, 100).cast("decimal(5,2)").alias("alert_score_clamped"),
        C.null_replace("alert_status", "UNKNOWN").alias("alert_status_filled"),
        C.canonical_key("alert_id").alias("alert_id_canonical"),
        F.when(F.col("account_txn_id") == -1, F.lit(None).cast("bigint")).otherwise(F.col("account_txn_id"))
        .alias("account_txn_id_repaired"))


def _remediation_sql() -> str:
    q = O.Q()
    q.normalized("fraud_alert")
    return q.sql("""SELECT alert_id, CAST(least(greatest(alert_score, 0), 100) AS DECIMAL(5,2)) AS alert_score_clamped,
  coalesce(alert_status, 'UNKNOWN') AS alert_status_filled, upper(trim(alert_id)) AS alert_id_canonical,
  CASE WHEN account_txn_id = -1 THEN NULL ELSE account_txn_id END AS account_txn_id_repaired FROM r_fraud_alert""")


register("contract_remediation", _remediation_sql())(_remediation)


# -------------------------------------------------------------------- SLA
ERROR_RATE_LIMIT = 5.0


# Fixed value: the contract's latency.
FRESHNESS_LIMIT_HOURS = 4


def _sla(spark, sf):
    """Alert-score error rate vs. the 5 % limit, and event freshness."""
    fa = P.bronze(spark, sf, "fraud_alert")
    rate = fa.agg(F.round(F.count_if(~F.coalesce((F.col("alert_score") >= 0) & (F.col("alert_score") <= 100),
                                                 F.lit(False))).cast("double") * 100 / F.count(F.lit(1)), 4)
                  .alias("error_rate_percent"))
    fresh = C.freshness(P.bronze(spark, sf, "account_transaction"), "txn_timestamp", fx.ORDER_AS_OF, FRESHNESS_LIMIT_HOURS)
    return side_by_side(rate, fresh).select(
        "error_rate_percent", (F.col("error_rate_percent") <= ERROR_RATE_LIMIT).alias("error_rate_ok"),
        F.col("latest_ts").cast("timestamp_ntz").alias("latest_ts"), "lag_hours", "within_sla")


def _sla_sql() -> str:
    q = O.Q()
    q.normalized("fraud_alert")
    q.normalized("account_transaction")
    return q.sql(f"""SELECT r.error_rate_percent, r.error_rate_percent <= {ERROR_RATE_LIMIT} AS error_rate_ok,
  f.latest_ts, round((epoch(TIMESTAMP '{fx.ORDER_AS_OF}') - epoch(f.latest_ts)) / 3600, 4) AS lag_hours,
  (epoch(TIMESTAMP '{fx.ORDER_AS_OF}') - epoch(f.latest_ts)) / 3600 <= {FRESHNESS_LIMIT_HOURS} AS within_sla
FROM (SELECT round(CAST(count_if(NOT coalesce(alert_score >= 0 AND alert_score <= 100, FALSE)) AS DOUBLE) * 100
        / count(*), 4) AS error_rate_percent FROM r_fraud_alert) r,
     (SELECT max(txn_timestamp) AS latest_ts FROM r_account_transaction) f""")


register("contract_sla", _sla_sql())(_sla)
