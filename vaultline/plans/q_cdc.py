"""CDC / SCD queries (CDC-01..06) and the cross-row duplicate checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultline.config import UNTRACKED_COLUMNS
from vaultline.operators import quarantine as QU
from vaultline.operators import scd
from vaultline.plans import oracle as O
from vaultline.plans.pipeline import RUN_CLOCK
from vaultline.plans.registry import register
from vaultline.sources import fixtures as fx

KEYS = ["cust_no"]
TRACKED = ["full_name", "segment", "address"]
UNTRACKED = ["business_date"]
AS_OF_VERSION = 20260707


def _history(spark, sf):
    snaps = fx.source(spark, sf, "customer_snapshot")
    return fx.memo(spark, sf, ("scd2", "customer"),
                   lambda: scd.scd2_from_snapshots(snaps, KEYS, "version", track_except=UNTRACKED_COLUMNS))


def _history_sql(q: O.Q) -> str:
    q.fixture("customer_snapshot")
    changed = " OR ".join(f"lag({c}) OVER w IS DISTINCT FROM {c}" for c in TRACKED)
    q.add("cal", "SELECT version, lag(version) OVER (ORDER BY version) AS pg, "
                 "lead(version) OVER (ORDER BY version) AS ng FROM (SELECT DISTINCT version FROM customer_snapshot)")
    q.add("x0", f"""SELECT s.*, c.pg, c.ng, lag(s.version) OVER w AS pv,
  (lag(s.version) OVER w IS NULL OR lag(s.version) OVER w <> c.pg) AS is_ins,
  (lag(s.version) OVER w IS NULL OR lag(s.version) OVER w <> c.pg OR {changed}) AS new_seg
FROM customer_snapshot s JOIN cal c ON s.version = c.version
WINDOW w AS (PARTITION BY s.cust_no ORDER BY s.version)""")
    q.add("x", "SELECT *, sum(CASE WHEN new_seg THEN 1 ELSE 0 END) OVER (PARTITION BY cust_no ORDER BY version "
               "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg FROM x0")
    q.add("g", "SELECT cust_no, seg, min(version) AS start_v, max(version) AS last_v FROM x GROUP BY cust_no, seg")
    return q.add("hist", """SELECT x.cust_no, x.full_name, x.segment, x.address, x.business_date,
  CAST(g.start_v AS BIGINT) AS __START_AT, CAST(x.ng AS BIGINT) AS __END_AT
FROM g JOIN x ON x.cust_no = g.cust_no AND x.seg = g.seg AND x.version = g.last_v""")


def _q(select_fn):
    q = O.Q()
    h = _history_sql(q)
    return q.sql(select_fn(h))


register("scd2_customer_history", _q(lambda h: f"SELECT * FROM {h}"))(
    lambda spark, sf: _history(spark, sf))

register("scd2_current", _q(lambda h: f"SELECT * FROM {h} WHERE __END_AT IS NULL"))(
    lambda spark, sf: _history(spark, sf).filter(F.col(scd.END).isNull()))

register("scd2_active_versions", _q(lambda h: f"SELECT cust_no, __START_AT FROM {h} WHERE __END_AT IS NULL"))(
    lambda spark, sf: scd.active_versions(_history(spark, sf), "cust_no"))

register("scd2_as_of", _q(lambda h: f"SELECT * FROM {h} WHERE __START_AT <= {AS_OF_VERSION} "
                                    f"AND (__END_AT IS NULL OR {AS_OF_VERSION} < __END_AT)"))(
    lambda spark, sf: scd.as_of(_history(spark, sf), AS_OF_VERSION))


def _version_summary(spark, sf):
    h = _history(spark, sf)
    opened = h.groupBy(F.col(scd.START).alias("version")).agg(F.count(F.lit(1)).alias("opened"))
    closed = (h.filter(F.col(scd.END).isNotNull()).groupBy(F.col(scd.END).alias("version"))
              .agg(F.count(F.lit(1)).alias("closed")))
    return (opened.join(closed, "version", "full_outer")
            .select("version", F.coalesce("opened", F.lit(0)).alias("opened"),
                    F.coalesce("closed", F.lit(0)).alias("closed")))


register("scd2_version_summary", _q(lambda h: f"""SELECT coalesce(o.version, c.version) AS version,
  coalesce(o.n, 0) AS opened, coalesce(c.n, 0) AS closed
FROM (SELECT __START_AT AS version, count(*) AS n FROM {h} GROUP BY 1) o
FULL OUTER JOIN (SELECT __END_AT AS version, count(*) AS n FROM {h} WHERE __END_AT IS NOT NULL GROUP BY 1) c
  ON o.version = c.version"""))(_version_summary)


# -------------------------------------------------------- change feed
def _feed(spark, sf):
    return scd.change_feed(fx.source(spark, sf, "customer_snapshot"), KEYS, "version")


def _feed_sql() -> str:
    q = O.Q()
    q.fixture("customer_snapshot")
    data = TRACKED + UNTRACKED
    diff = " OR ".join(f"p_{c} IS DISTINCT FROM {c}" for c in data)
    q.add("cal", "SELECT version, lag(version) OVER (ORDER BY version) AS pg, "
                 "lead(version) OVER (ORDER BY version) AS ng FROM (SELECT DISTINCT version FROM customer_snapshot)")
    lags = ", ".join(f"lag({c}) OVER w AS p_{c}" for c in data)
    q.add("y", f"""SELECT s.*, c.pg, c.ng, lag(s.version) OVER w AS pv, lead(s.version) OVER w AS nv, {lags}
FROM customer_snapshot s JOIN cal c ON s.version = c.version
WINDOW w AS (PARTITION BY s.cust_no ORDER BY s.version)""")
    cur = ", ".join(data)
    prev = ", ".join(f"p_{c} AS {c}" for c in data)
    return q.sql(f"""SELECT cust_no, {cur}, 'insert' AS _change_type, version AS _commit_version FROM y
  WHERE pv IS NULL OR pv <> pg
UNION ALL SELECT cust_no, {prev}, 'update_preimage', version FROM y WHERE pv = pg AND ({diff})
UNION ALL SELECT cust_no, {cur}, 'update_postimage', version FROM y WHERE pv = pg AND ({diff})
UNION ALL SELECT cust_no, {cur}, 'delete', ng FROM y WHERE ng IS NOT NULL AND (nv IS NULL OR nv <> ng)""")


register("cdc_change_feed", _feed_sql())(_feed)


def _deletes(spark, sf):
    return (_feed(spark, sf).filter(F.col("_change_type") == "delete")
            .groupBy("_commit_version").agg(F.count(F.lit(1)).alias("deleted_keys")))


register("scd2_deletes", "SELECT _commit_version, count(*) AS deleted_keys FROM (" +
         _feed_sql() + ") WHERE _change_type = 'delete' GROUP BY 1")(_deletes)


# ------------------------------------------------------------- SCD1
def _scd1(spark, sf):
    snaps = fx.source(spark, sf, "status_event_snapshot")
    return scd.scd1_from_snapshots(snaps, ["status_event_id", "account_txn_id"], "version")


def _scd1_sql() -> str:
    q = O.Q()
    q.fixture("status_event_snapshot")
    return q.sql("""SELECT status_event_id, account_txn_id, status, sequence_number, version FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY status_event_id, account_txn_id
    ORDER BY status DESC, sequence_number DESC) AS rn
  FROM status_event_snapshot WHERE version = (SELECT max(version) FROM status_event_snapshot)) WHERE rn = 1""")


register("scd1_status_event", _scd1_sql())(_scd1)


# ----------------------------------------------- sequenced change stream
def _sequenced(spark, sf):
    ev = fx.source(spark, sf, "account_transaction_status_event").select(
        "account_txn_id", "sequence_number", "status", "status_timestamp")
    return scd.scd2_from_changes(ev, ["account_txn_id"], "sequence_number")


def _sequenced_sql() -> str:
    q = O.Q()
    q.fixture("account_transaction_status_event")
    q.add("d", """SELECT account_txn_id, sequence_number, status, status_timestamp FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY account_txn_id, sequence_number
    ORDER BY status DESC, status_timestamp DESC) AS rn FROM account_transaction_status_event) WHERE rn = 1""")
    return q.sql("""SELECT account_txn_id, status, status_timestamp, sequence_number AS __START_AT,
  lead(sequence_number) OVER (PARTITION BY account_txn_id ORDER BY sequence_number) AS __END_AT FROM d""")


register("cdc_sequenced_scd2", _sequenced_sql())(_sequenced)


# ----------------------------------------- incremental == batch (rows-only)
def _incremental(spark, sf):
    """Apply the six snapshots one by one with the incremental operator.

    Lineage is cut after each step (checkpoint into the session's shared
    checkpoint folder) so the plan does not grow with the number of
    snapshots."""
    from vaultline.session import checkpoint_dir

    checkpoint_dir(spark)
    snaps = fx.source(spark, sf, "customer_snapshot")
    versions = [20260705 + i for i in range(6)]
    hist = None
    for v in versions:
        snap = snaps.filter(F.col("version") == v).drop("version")
        if hist is None:
            hist = scd.one_row_per_key(snap, KEYS).withColumn(scd.START, F.lit(v).cast("bigint")).withColumn(
                scd.END, F.lit(None).cast("bigint"))
        else:
            hist = scd.scd2_apply_snapshot(hist, snap, KEYS, v, track_except=UNTRACKED_COLUMNS)
        hist = hist.checkpoint(eager=True)
    return hist


register("scd2_incremental", _q(lambda h: f"SELECT * FROM {h}"))(_incremental)


# -------------------------------------------------- duplicate checks
def _dup_active(spark, sf):
    raw = fx.source(spark, sf, "card_transaction_raw")
    a = QU.assess(raw, "card_transaction", current=raw, as_of=RUN_CLOCK)
    return (a.filter(F.array_contains("_failed_rule_names", "card_transaction__card_txn_id__duplicate_active"))
            .groupBy("card_txn_id").agg(F.count(F.lit(1)).alias("active_rows")))


register("dq_duplicate_active_key", (lambda q: q.sql(
    "SELECT card_txn_id, count(*) AS active_rows FROM card_transaction_raw WHERE card_txn_id IN "
    "(SELECT card_txn_id FROM card_transaction_raw GROUP BY 1 HAVING count(*) > 1) GROUP BY 1"))(
    (lambda q: (q.fixture("card_transaction_raw"), q)[1])(O.Q())))(_dup_active)


def _dup_nid(spark, sf):
    from vaultline.plans import pipeline as P
    parts = []
    for t in QU.NATIONAL_ID_TABLES:
        a = P.assessed(spark, sf, t)
        key = "cust_no" if t == "core_banking_customer" else "party_id"
        parts.append(a.filter(F.array_contains("_failed_rule_names", f"{t}__national_id__duplicate"))
                     .select(F.lit(t).alias("source_table_name"), F.col(key).alias("source_business_key"),
                             "national_id"))
    return parts[0].unionByName(parts[1])


def _dup_nid_sql() -> str:
    q = O.Q()
    sels = []
    for t in ("core_banking_customer", "crm_customer"):
        n = q.normalized(t)
        key = "cust_no" if t == "core_banking_customer" else "party_id"
        sels.append(f"SELECT '{t}' AS source_table_name, {key} AS source_business_key, national_id FROM {n} "
                    f"WHERE national_id IN (SELECT national_id FROM {n} WHERE national_id IS NOT NULL "
                    f"GROUP BY 1 HAVING count(*) > 1)")
    return q.sql(" UNION ALL ".join(sels))


register("dq_duplicate_national_id", _dup_nid_sql())(_dup_nid)
