"""Source/sink queries: snapshot discovery and iteration, rescued data,
legacy path metadata, clustered publication, as-of join."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from vaultline.config import TABLES, UNTRACKED_COLUMNS
from vaultline.functions.keys import hash_of_text
from vaultline.operators import scd
from vaultline.plans import oracle as O
from vaultline.plans import pipeline as P
from vaultline.plans.layouts import FRAUD_CONTEXT
from vaultline.plans.registry import ORACLE, register
from vaultline.session import COMPACT, checkpoint_dir
from vaultline.sources import fixtures as fx
from vaultline.sources import snapshots as SN
from vaultline.sources.published import PublishedTable


def _snapshot_versions(spark, sf):
    """Land the six daily snapshots in the date-partitioned layout, then
    discover versions and read them back one by one with the iterator."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/landing-{uuid.uuid4().hex[:12]}"
    snaps = fx.source(spark, sf, "customer_snapshot")
    for i in range(6):
        v = 20260705 + i
        path = SN.source_path(root, "customer", "core_banking_customer", SN.version_to_date(v))
        snaps.filter(F.col("version") == v).drop("version").write.mode("overwrite").parquet(path)
    parts, latest = [], None
    while True:
        nxt = SN.next_snapshot(spark, root, "customer", "core_banking_customer", latest)
        if nxt is None:
            break
        df, latest = nxt
        parts.append(df.agg(F.lit(latest).cast("bigint").alias("version"), F.count(F.lit(1)).alias("rows"),
                            F.count_distinct("cust_no").alias("keys")))
    return reduce(lambda a, b: a.unionByName(b), parts)


register("ing_snapshot_versions", (lambda q: (q.fixture("customer_snapshot"), q.sql(
    "SELECT version, count(*) AS rows, count(DISTINCT cust_no) AS keys FROM customer_snapshot GROUP BY version"))[1])(
    O.Q()))(_snapshot_versions)


def _rescued(spark, sf):
    src = fx.source(spark, sf, "account_transaction")
    text = src.select(*[F.col(c).cast("string").alias(c) for c in src.columns]).withColumn(
        "amount", F.when(F.expr("CAST(account_txn_id AS BIGINT) % 97 = 5"), F.lit("not-a-number"))
        .otherwise(F.col("amount")))
    out = SN.read_with_rescue(text, TABLES["account_transaction"].hints)
    return out.select("account_txn_id", "amount", "_rescued_data")


register("ing_rescued_data", (lambda q: (q.fixture("account_transaction"), q.sql(
    """SELECT account_txn_id, CASE WHEN account_txn_id % 97 = 5 THEN NULL ELSE amount END AS amount,
  CASE WHEN account_txn_id % 97 = 5 THEN '{"amount":"not-a-number"}' END AS _rescued_data
FROM account_transaction"""))[1])(O.Q()))(_rescued)


def _legacy(spark, sf):
    raw = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderstatus")
    return SN.legacy_path_metadata(raw, fx.BUSINESS_DATE).drop("cdc_sequence", "cdc_change_time")


register("ing_legacy_metadata", f"""SELECT o_orderkey, o_orderstatus, DATE '{fx.BUSINESS_DATE}' AS business_date_from_path,
  CAST(NULL AS VARCHAR) AS simulation_id, 1 AS cdc_change_op FROM orders""")(_legacy)


def _published(spark, sf) -> PublishedTable:
    """The fraud context in its declared layout, 32 ranges of (occurred_at, party_key)."""
    def build():
        table = PublishedTable(spark, f"{P._table_root(spark, sf)}/gold/ai_fraud_transaction_context", FRAUD_CONTEXT)
        # Stored with text keys first: its joins are off the disk before its rows are dealt, and hashes never travel.
        texts = P.publish(spark, sf, "fraud", "context", lambda: P.fraud_texts(spark, sf), COMPACT)
        table.publish(texts, files=32, made={k: hash_of_text(k) for k in P.FRAUD_KEYS} | {"ingested_at": F.current_timestamp()})
        return table

    return fx.memo(spark, sf, ("published", "fraud"), build)


register("gold_fraud_transaction_published", ORACLE["gold_fraud_transaction"])(
    lambda spark, sf: _published(spark, sf).read().drop("ingested_at"))

# Two days of events.
FROM_DAY, TO_DAY = "2024-01-10 00:00:00", "2024-01-12 00:00:00"
register("gold_fraud_transaction_days", f"""SELECT * FROM ({ORACLE["gold_fraud_transaction"]}) AS whole
WHERE occurred_at >= TIMESTAMP '{FROM_DAY}' AND occurred_at < TIMESTAMP '{TO_DAY}'""")(
    lambda spark, sf: _published(spark, sf).read_between(
        F.to_timestamp_ntz(F.lit(FROM_DAY)), F.to_timestamp_ntz(F.lit(TO_DAY))).drop("ingested_at"))

AS_OF_KEYS = ["cust_no"]


def _as_of_join(spark, sf):
    """Each transaction with the customer profile version valid on its
    (synthetic) snapshot day: equi-join on the key, validity range as a
    join filter."""
    from vaultline.plans.q_cdc import _history
    hist = _history(spark, sf).select("cust_no", "segment", "address", scd.START, scd.END)
    txn = P.bronze(spark, sf, "account_transaction").select(
        "account_txn_id", F.col("customer_ref"),
        (F.lit(20260705) + F.col("account_txn_id") % 6).cast("bigint").alias("txn_version"))
    return scd.as_of_join(txn, hist, "customer_ref", "cust_no", "txn_version").select(
        "account_txn_id", "customer_ref", "txn_version", "segment", "address")


def _as_of_join_sql() -> str:
    from vaultline.plans.q_cdc import _history_sql
    q = O.Q()
    h = _history_sql(q)
    q.normalized("account_transaction")
    return q.sql(f"""SELECT t.account_txn_id, t.customer_ref, t.txn_version, h.segment, h.address
FROM (SELECT account_txn_id, customer_ref, CAST(20260705 + account_txn_id % 6 AS BIGINT) AS txn_version
      FROM r_account_transaction) t
LEFT JOIN {h} h ON h.cust_no = t.customer_ref AND h.__START_AT <= t.txn_version
  AND (h.__END_AT IS NULL OR t.txn_version < h.__END_AT)""")


register("scd2_as_of_join", _as_of_join_sql())(_as_of_join)
