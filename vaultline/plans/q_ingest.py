"""Ingestion queries (ING-01..10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultline.config import TABLES
from vaultline.operators import ingest as IG
from vaultline.plans import oracle as O
from vaultline.plans import pipeline as P
from vaultline.plans.registry import register
from vaultline.sources import fixtures as fx


def _as_text(df, malformed_col: str, every: str):
    """The source as delivered by a text-only feed: every column STRING,
    with malformed text injected in one column."""
    cols = [F.col(c).cast("string").alias(c) for c in df.columns]
    out = df.select(*cols)
    return out.withColumn(malformed_col, F.when(F.expr(every), F.lit("not-a-number")).otherwise(F.col(malformed_col)))


def _hints(spark, sf):
    src = fx.source(spark, sf, "account_transaction")
    text = _as_text(src, "amount", "CAST(account_txn_id AS BIGINT) % 97 = 5")
    return IG.apply_schema_hints(text, TABLES["account_transaction"].hints)


def _hints_sql() -> str:
    q = O.Q()
    q.fixture("account_transaction")
    cols = ["account_txn_id", "account_id", "customer_ref", "amount", "transaction_type", "direction",
            "txn_timestamp", "status", "channel", "merchant_id", "business_date"]
    hinted = dict(IG.parse_hints(TABLES["account_transaction"].hints))
    exprs = []
    for c in cols:
        txt = (f"CASE WHEN account_txn_id % 97 = 5 THEN 'not-a-number' ELSE CAST(amount AS VARCHAR) END"
               if c == "amount" else f"CAST({c} AS VARCHAR)")
        exprs.append(f"TRY_CAST({txt} AS {hinted[c]}) AS {c}" if c in hinted else f"{txt} AS {c}")
    return q.sql(f"SELECT {', '.join(exprs)} FROM account_transaction")


register("ing_schema_hints", _hints_sql())(_hints)


def _contract_cols(spark, sf):
    crm = fx.source(spark, sf, "crm_customer")
    older = crm.filter(F.col("party_id").substr(-1, 1).isin("0", "2", "4", "6", "8")).drop("preferred_contact_method")
    newer = crm.filter(~F.col("party_id").substr(-1, 1).isin("0", "2", "4", "6", "8"))
    return (IG.apply_contract_columns(older, "crm_customer")
            .unionByName(IG.apply_contract_columns(newer, "crm_customer")))


def _contract_cols_sql() -> str:
    q = O.Q()
    q.fixture("crm_customer")
    return q.sql("""SELECT * REPLACE (CASE WHEN right(party_id, 1) IN ('0','2','4','6','8') THEN NULL
  ELSE preferred_contact_method END AS preferred_contact_method) FROM crm_customer""")


register("ing_contract_columns", _contract_cols_sql())(_contract_cols)


def _normalize_q(table: str):
    def build(spark, sf):
        return IG.normalize(fx.source(spark, sf, table))
    q = O.Q()
    q.normalized(table)
    return build, q.sql(f"SELECT * FROM n_{table}")


for _t in ("core_banking_customer", "crm_customer", "customer_kyc"):
    _b, _s = _normalize_q(_t)
    register(f"ing_normalize_{_t}", _s)(_b)


register("ing_event_parent_ref", (lambda q: (q.normalized("payment_gateway_status_event"),
                                             q.sql("SELECT * FROM r_payment_gateway_status_event"))[1])(O.Q()))(
    lambda spark, sf: P.bronze(spark, sf, "payment_gateway_status_event"))

register("ing_replay_dedup", (lambda q: (q.normalized("account_transaction_status_event"),
                                         q.sql("SELECT * FROM r_account_transaction_status_event"))[1])(O.Q()))(
    lambda spark, sf: IG.remove_replays(
        fx.source(spark, sf, "account_transaction_status_event"), "account_transaction_status_event",
        ["status_event_id", "account_txn_id"],
        order_by=["status_timestamp", "source_arrival_timestamp", "status", "sequence_number", "business_date"]))


def _type_repair(spark, sf):
    """Physical-type drift: a day where durations, timestamps and amounts
    arrive as text ('245 sec', ISO-8601 with 'T', decimal strings)."""
    call = fx.source(spark, sf, "call_center_log")
    drift = call.select(
        "call_id",
        F.concat(F.col("call_duration_seconds").cast("string"), F.lit(" sec")).alias("call_duration_seconds"),
        F.date_format("call_timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("call_timestamp"),
        F.when(F.length("call_id") % 2 == 0, F.lit("12.50")).otherwise(F.lit("n/a")).alias("fee"))
    return drift.select(
        "call_id",
        F.expr("try_cast(regexp_extract(call_duration_seconds, '([0-9]+)', 1) AS BIGINT)").alias("call_duration_seconds"),
        F.try_to_timestamp("call_timestamp", F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz").alias("call_timestamp"),
        F.expr("try_cast(fee AS DECIMAL(12,2))").alias("fee"))


def _type_repair_sql() -> str:
    q = O.Q()
    q.fixture("call_center_log")
    return q.sql("""SELECT call_id,
  TRY_CAST(regexp_extract(CAST(call_duration_seconds AS VARCHAR) || ' sec', '([0-9]+)', 1) AS BIGINT) AS call_duration_seconds,
  CAST(date_trunc('second', call_timestamp) AS TIMESTAMP) AS call_timestamp,
  CASE WHEN length(call_id) % 2 = 0 THEN CAST('12.50' AS DECIMAL(12,2)) END AS fee
FROM call_center_log""")


register("ing_type_repair", _type_repair_sql())(_type_repair)


def _evolution(spark, sf):
    """Two snapshot generations: old (customer_name called full_name, no
    contact method, score DECIMAL(5,2)) and new (renamed, added column,
    score widened to DECIMAL(9,2))."""
    crm = fx.source(spark, sf, "crm_customer")
    old = crm.filter(F.col("party_id").substr(-1, 1) < "5").select(
        "party_id", F.col("customer_name").alias("full_name"), "email",
        (F.length("party_id") / 4).cast("decimal(5,2)").alias("score"))
    new = crm.filter(F.col("party_id").substr(-1, 1) >= "5").select(
        "party_id", "customer_name", "email", "preferred_contact_method",
        (F.length("party_id") * 1000.5).cast("decimal(9,2)").alias("score"))
    return IG.union_evolving([old, new], renames={"full_name": "customer_name"})


def _evolution_sql() -> str:
    q = O.Q()
    q.fixture("crm_customer")
    return q.sql("""SELECT party_id, customer_name, email, CAST(NULL AS VARCHAR) AS preferred_contact_method,
  CAST(CAST(length(party_id) / 4 AS DECIMAL(5,2)) AS DECIMAL(9,2)) AS score FROM crm_customer WHERE right(party_id, 1) < '5'
UNION ALL SELECT party_id, customer_name, email, preferred_contact_method,
  CAST(length(party_id) * 1000.5 AS DECIMAL(9,2)) FROM crm_customer WHERE right(party_id, 1) >= '5'""")


register("ing_schema_evolution", _evolution_sql())(_evolution)


def _file_metadata(spark, sf):
    raw = spark.read.parquet(f"{sf}/orders.parquet")
    m = IG.file_metadata(raw)
    return m.groupBy("source_file_name", "path_business_date").agg(F.count(F.lit(1)).alias("rows"))


register("ing_file_metadata", "SELECT 'orders.parquet' AS source_file_name, CAST(NULL AS DATE) AS path_business_date, "
                              "count(*) AS rows FROM orders")(_file_metadata)


def _operational(spark, sf):
    raw = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus")
    out = IG.add_operational_metadata(raw, "transaction", fx.BUSINESS_DATE, load_ts=fx.ORDER_AS_OF)
    return out.drop("source_file_modified_at")


register("ing_operational_metadata", f"""SELECT o_orderkey, o_custkey, o_orderstatus, DATE '{fx.BUSINESS_DATE}' AS business_date,
  'transaction' AS domain, 'orders.parquet' AS source_file_name, TIMESTAMP '{fx.ORDER_AS_OF}' AS LOAD_DTTM,
  TIMESTAMP '{fx.ORDER_AS_OF}' AS EXTRACT_DTTM, DATE '{fx.BUSINESS_DATE}' AS EXTRACT_DTE FROM orders""")(_operational)
