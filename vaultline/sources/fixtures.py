"""Banking-shaped source views derived from the driver's tables.

Every view is a pure projection (integer arithmetic, string concat, CASE,
one window for de-duplication) written in the SQL subset that Spark and
DuckDB evaluate identically, so the same text builds the inputs for the
Spark operators and for the DuckDB oracle.  All views read whole tables:
their size grows with the scale factor.

Injected defects reuse the sentinels of the rule inventory, so each rule,
contract metric and identity outcome has rows that exercise it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed as-of instants (never current time inside logic).
ORDER_AS_OF = "2001-12-01 00:00:00"
EVENT_AS_OF = "2024-02-01 00:00:00"
BUSINESS_DATE = "2001-11-30"


def pad(expr: str, n: int) -> str:
    return f"lpad(CAST({expr} AS STRING), {n}, '0')"


def money(expr: str, p: int = 12) -> str:
    return f"CAST(ROUND(({expr}) * 100) / 100 AS DECIMAL({p},2))"


NSUPP = "(SELECT COUNT(*) FROM supplier)"
NORD = "(SELECT COUNT(*) FROM orders)"
NCUST = "(SELECT COUNT(*) FROM customer)"


def nid(k: str) -> str:
    return f"('0' || {pad(f'{k} * 7 + 100000', 11)})"


BD = f"DATE '{BUSINESS_DATE}'"

# Row fan-outs: DuckDB text (the oracle) -> Spark text.  In Spark each row is
# repeated by a generator inside the scan's stage (no join operator at all).
_FANOUTS: dict[str, str] = {}


def fanout(values, alias: str, col: str) -> str:
    """Repeat every row once per value, with ``alias.col`` = that value."""
    duck = f"CROSS JOIN (VALUES {', '.join(f'({v})' for v in values)}) AS {alias}({col})"
    _FANOUTS[duck] = f"LATERAL VIEW explode(array({', '.join(str(v) for v in values)})) {alias} AS {col}"
    return duck


def spark_text(sql: str) -> str:
    for duck, spark in _FANOUTS.items():
        sql = sql.replace(duck, spark)
    return sql


_FAN2 = fanout(range(2), "s", "n")

FIXTURES: dict[str, str] = {}

# ---------------------------------------------------------------- customer
FIXTURES["core_banking_customer"] = f"""
SELECT
  CASE WHEN c_custkey % 30 = 4 THEN '  cb-' || {pad('c_custkey', 6)} || ' '
       ELSE 'CB-' || {pad('c_custkey', 6)} END AS cust_no,
  'CIF' || {pad('c_custkey', 8)} AS cif_number,
  c_name AS full_name,
  CASE WHEN c_custkey % 40 = 5 THEN NULL
       ELSE DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INT) END AS date_of_birth,
  CASE WHEN c_custkey % 24 = 0 THEN NULL
       WHEN c_custkey % 120 = 1 THEN {nid('(c_custkey + 3)')}
       WHEN c_custkey % 30 = 4 THEN lower(' ' || {nid('c_custkey')} || ' ')
       ELSE {nid('c_custkey')} END AS national_id,
  CASE WHEN c_custkey % 40 = 3 THEN '0000000000'
       ELSE '04-' || {pad('c_custkey', 8)} END AS phone,
  CAST(c_custkey AS STRING) || ' MAIN ST' AS address,
  'CORE_BANKING' AS source_system,
  DATE '2015-01-01' + CAST(c_custkey % 2000 AS INT) AS created_date,
  {BD} AS business_date
FROM customer
"""

FIXTURES["crm_customer"] = f"""
SELECT
  'CRM-' || {pad('c_custkey', 6)} AS party_id,
  c_name AS customer_name,
  '04' || {pad('c_custkey', 8)} AS phone,
  CASE WHEN c_custkey % 20 = 7 THEN NULL ELSE {nid('c_custkey')} END AS national_id,
  CASE WHEN c_custkey % 32 = 8 THEN NULL
       WHEN c_custkey % 53 = 9 THEN ' Malformed-Email '
       ELSE 'User' || CAST(c_custkey AS STRING) || '@Mail.Test' END AS email,
  'CRM' AS source_system,
  DATE '2016-01-01' + CAST(c_custkey % 1500 AS INT) AS created_date,
  CASE c_custkey % 4 WHEN 0 THEN 'EMAIL' WHEN 1 THEN 'PHONE' WHEN 2 THEN 'SMS' ELSE NULL END
    AS preferred_contact_method,
  {BD} AS business_date
FROM customer
"""

_REF = lambda k, flip: (
    f"CASE WHEN {k} % 100 = 0 THEN 'UNKNOWN-CUSTOMER' WHEN {k} % 25 = 4 THEN 'OLD-' || {pad(k, 6)} "
    f"WHEN {k} % 2 = {flip} THEN 'CB-' || {pad(k, 6)} ELSE 'CRM-' || {pad(k, 6)} END"
)

FIXTURES["customer_kyc"] = f"""
SELECT
  'KYC-' || {pad('c_custkey', 6)} AS kyc_id,
  {_REF('c_custkey', 0)} AS customer_ref,
  CASE WHEN c_custkey % 5 = 0 THEN 'PASSPORT' ELSE 'NATIONAL_ID' END AS id_type,
  CASE WHEN c_custkey % 50 = 25 THEN 'INVALID-ID' ELSE {nid('c_custkey')} END AS id_number,
  CASE WHEN c_custkey % 11 = 3 THEN NULL WHEN c_custkey % 7 = 0 THEN 'PENDING'
       WHEN c_custkey % 7 = 1 THEN 'REJECTED' ELSE 'VERIFIED' END AS verification_status,
  CASE WHEN c_custkey % 7 = 0 THEN NULL
       ELSE DATE '2001-01-01' + CAST(c_custkey % 300 AS INT) END AS verified_date,
  {BD} AS business_date
FROM customer
"""

FIXTURES["customer_employment"] = f"""
SELECT
  'EMP-' || {pad('c_custkey', 6)} AS employment_id,
  {_REF('c_custkey', 1)} AS customer_ref,
  'EMPLOYER ' || CAST(c_custkey % 50 AS STRING) AS employer_name,
  CASE c_custkey % 4 WHEN 0 THEN 'ANALYST' WHEN 1 THEN 'ENGINEER' WHEN 2 THEN 'TEACHER' ELSE 'NURSE' END
    AS job_title,
  CASE WHEN c_custkey % 60 = 7 THEN CAST(-1000 AS DECIMAL(12,2))
       ELSE CAST((c_custkey % 200) * 1000000 AS DECIMAL(12,2)) END AS monthly_income,
  {BD} AS business_date
FROM customer
"""

FIXTURES["customer_request"] = f"""
SELECT
  'REQ-' || {pad('o_orderkey', 8)} AS request_id,
  CASE WHEN o_orderkey % 500 = 0 THEN 'UNKNOWN-CUSTOMER' WHEN o_custkey % 25 = 4 THEN 'OLD-' || {pad('o_custkey', 6)}
       WHEN o_custkey % 2 = 0 THEN 'CB-' || {pad('o_custkey', 6)}
       ELSE 'CRM-' || {pad('o_custkey', 6)} END AS customer_ref,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'CARD_LOST' WHEN '2' THEN 'COMPLAINT'
       WHEN '3' THEN 'ADDRESS_CHANGE' ELSE 'INQUIRY' END AS request_type,
  CASE o_orderkey % 3 WHEN 0 THEN 'BRANCH' WHEN 1 THEN 'APP' ELSE 'PHONE' END AS channel,
  CAST(o_orderdate AS DATE) AS request_date,
  CASE WHEN o_orderkey % 35 = 0 THEN 'REJECTED' WHEN o_orderkey % 45 = 10 THEN NULL
       WHEN o_orderstatus = 'F' THEN 'RESOLVED'
       WHEN o_orderstatus = 'O' THEN 'OPEN' ELSE 'IN_PROGRESS' END AS status,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 35 <> 0 AND o_orderkey % 45 <> 10
       THEN CAST(o_orderdate AS DATE) + 10 END AS resolution_date,
  CASE WHEN o_orderkey % 80 = 5 THEN NULL ELSE 'REQUEST ' || CAST(o_orderkey AS STRING) END AS description,
  {BD} AS business_date
FROM orders
"""

FIXTURES["account"] = f"""
SELECT
  c_custkey * 10 + s.n AS account_id,
  'CB-' || {pad('c_custkey', 6)} AS customer_ref,
  CASE WHEN c_custkey % 100 = 7 THEN 'CIF99999999' ELSE 'CIF' || {pad('c_custkey', 8)} END AS cif_number,
  CASE (c_custkey + s.n) % 3 WHEN 0 THEN 'SAVINGS' WHEN 1 THEN 'CHECKING' ELSE 'LOAN' END AS product_type,
  CASE WHEN c_custkey % 10 = 9 THEN 'CLOSED' WHEN c_custkey % 10 = 8 AND s.n = 1 THEN 'DORMANT'
       ELSE 'ACTIVE' END AS status,
  DATE '2010-01-01' + CAST((c_custkey * 13 + s.n) % 3000 AS INT) AS open_date,
  'BR' || {pad('c_custkey % 50', 3)} AS branch_code,
  {BD} AS business_date
FROM customer {_FAN2}
WHERE s.n = 0 OR c_custkey % 4 = 0
"""

FIXTURES["customer_account"] = f"""
SELECT
  'LNK-' || CAST(account_id AS STRING) AS link_id,
  'CIF' || {pad('CAST(FLOOR(account_id / 10) AS BIGINT)', 8)} AS cif_number,
  CASE WHEN account_id % 1000 = 110 THEN CAST(-1 AS BIGINT) ELSE account_id END AS account_id,
  CASE WHEN account_id % 10 = 0 THEN 'PRIMARY' ELSE 'JOINT' END AS relationship_type,
  CASE WHEN account_id % 70 = 30 THEN 'CLOSED' ELSE 'OPEN' END AS role_status,
  open_date AS linked_date,
  {BD} AS business_date
FROM account
"""

# ------------------------------------------------------------- transaction
FIXTURES["account_transaction"] = f"""
SELECT
  o_orderkey AS account_txn_id,
  CASE WHEN o_orderkey % 100 = 13 THEN CAST(-1 AS BIGINT) ELSE o_custkey * 10 END AS account_id,
  'CB-' || {pad('o_custkey', 6)} AS customer_ref,
  CASE WHEN o_orderkey % 100 = 18 THEN CAST(-100 AS DECIMAL(12,2))
       ELSE {money('o_totalprice')} END AS amount,
  CASE o_orderkey % 4 WHEN 0 THEN 'TRANSFER' WHEN 1 THEN 'PAYMENT' WHEN 2 THEN 'DEPOSIT' ELSE NULL END
    AS transaction_type,
  CASE WHEN o_orderkey % 2 = 0 THEN 'CREDIT' ELSE 'DEBIT' END AS direction,
  o_orderdate AS txn_timestamp,
  CASE WHEN o_orderkey % 100 = 19 THEN 'PENDING'
       WHEN o_orderstatus = 'F' THEN 'SUCCESS' WHEN o_orderstatus = 'O' THEN 'PENDING'
       ELSE 'REJECTED' END AS status,
  'CH-' || substr(o_orderpriority, 1, 1) AS channel,
  'MER-' || {pad(f'o_orderkey % {NSUPP}', 6)} AS merchant_id,
  {BD} AS business_date
FROM orders
"""

FIXTURES["balance_snapshot"] = f"""
SELECT
  'BAL-' || {pad('o_orderkey', 8)} AS balance_id,
  o_custkey * 10 AS account_id,
  CAST(o_orderdate AS DATE) AS balance_date,
  {money('o_totalprice / 10 + 100', 14)} AS opening_balance,
  CASE WHEN o_orderkey % 100 = 23 THEN CAST(-250 AS DECIMAL(14,2))
       ELSE {money('o_totalprice / 10', 14)} END AS closing_balance,
  CASE WHEN o_orderkey % 50 = 1 THEN {money('o_totalprice / 10 + 5', 14)}
       ELSE {money('o_totalprice / 10', 14)} END AS available_balance,
  {BD} AS business_date
FROM orders
"""

FIXTURES["transaction_channel"] = f"""
SELECT DISTINCT
  'CH-' || substr(o_orderpriority, 1, 1) AS channel_id,
  substr(o_orderpriority, 3) AS channel_name,
  CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'DIGITAL' ELSE 'BRANCH' END AS channel_type,
  {BD} AS business_date
FROM orders
"""

FIXTURES["merchant"] = f"""
SELECT
  'MER-' || {pad('s_suppkey', 6)} AS merchant_id,
  s_name AS merchant_name,
  CAST(5000 + s_suppkey % 100 AS STRING) AS mcc_code,
  n_name AS country,
  {BD} AS business_date
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
"""

FIXTURES["merchant_store"] = f"""
SELECT
  'STO-' || {pad('p_partkey', 6)} AS store_id,
  'MER-' || {pad(f'p_partkey % {NSUPP}', 6)} AS merchant_id,
  p_name AS store_name,
  CASE WHEN p_partkey % 16 = 3 THEN NULL ELSE p_type END AS store_description,
  CASE WHEN p_partkey % 5 = 0 THEN 'ONLINE' ELSE 'PHYSICAL' END AS store_type,
  CASE WHEN p_partkey % 5 = 0 AND p_partkey % 45 <> 10 THEN NULL
       ELSE CAST(p_partkey AS STRING) || ' MARKET ST' END AS store_address,
  CASE WHEN p_partkey % 100 = 9 THEN 'UNKNOWN' WHEN p_size <= 15 THEN 'LOW'
       WHEN p_size <= 35 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_rating,
  DATE '2012-01-01' + CAST(p_partkey % 3000 AS INT) AS registered_date,
  {BD} AS business_date
FROM part
"""

# card_transaction: lineitem de-duplicated to (orderkey, linenumber) by the
# smallest (partkey, suppkey, shipdate); the raw table is the replay input.
FIXTURES["card_transaction"] = f"""
SELECT
  l_orderkey * 10 + l_linenumber AS card_txn_id,
  CASE WHEN (l_orderkey * 10 + l_linenumber) % 100 = 51 THEN 'UNKNOWN-CARD'
       ELSE 'CARD-' || {pad('o_custkey', 8)} END AS card_id,
  'MER-' || {pad(f'l_suppkey % {NSUPP}', 6)} AS merchant_id,
  {money('l_extendedprice')} AS amount,
  l_shipdate AS txn_timestamp,
  CASE WHEN l_linestatus = 'F' THEN 'SETTLED' ELSE 'AUTHORIZED' END AS txn_status,
  (l_returnflag = 'R' AND l_orderkey % 50 = 0) AS is_fraud,
  CASE l_linenumber % 3 WHEN 0 THEN 'PURCHASE' WHEN 1 THEN 'REFUND' ELSE NULL END AS card_transaction_type,
  {BD} AS business_date
FROM (
  SELECT l.*, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_partkey, l_suppkey, l_shipdate) AS rn
  FROM lineitem l
) d JOIN orders ON l_orderkey = o_orderkey
WHERE rn = 1
"""

# The same view for Spark, with the per-(orderkey, linenumber) pick written
# as a grouped min over a struct instead of a window.  Lines are dealt out by
# order once, which serves both the pick and the join.
SPARK_FIXTURES: dict[str, str] = {}
SPARK_FIXTURES["card_transaction"] = f"""
SELECT
  d.l_orderkey * 10 + d.l_linenumber AS card_txn_id,
  CASE WHEN (d.l_orderkey * 10 + d.l_linenumber) % 100 = 51 THEN 'UNKNOWN-CARD'
       ELSE 'CARD-' || {pad('o_custkey', 8)} END AS card_id,
  'MER-' || {pad(f'd.m.l_suppkey % {NSUPP}', 6)} AS merchant_id,
  {money('d.m.l_extendedprice')} AS amount,
  d.m.l_shipdate AS txn_timestamp,
  CASE WHEN d.m.l_linestatus = 'F' THEN 'SETTLED' ELSE 'AUTHORIZED' END AS txn_status,
  (d.m.l_returnflag = 'R' AND d.l_orderkey % 50 = 0) AS is_fraud,
  CASE d.l_linenumber % 3 WHEN 0 THEN 'PURCHASE' WHEN 1 THEN 'REFUND' ELSE NULL END AS card_transaction_type,
  {BD} AS business_date
FROM (
  SELECT l_orderkey, l_linenumber,
         min(struct(l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_linestatus, l_returnflag)) AS m
  FROM (SELECT /*+ REPARTITION(l_orderkey) */ l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
               l_extendedprice, l_linestatus, l_returnflag FROM lineitem WHERE l_orderkey IS NOT NULL) dealt
  GROUP BY l_orderkey, l_linenumber
) d JOIN orders ON d.l_orderkey = o_orderkey
"""

FIXTURES["log_atm"] = f"""
SELECT
  'ATM-' || {pad('event_id', 8)} AS log_id,
  'CARD-' || {pad('user_id * 10 + 1', 8)} AS card_id,
  CASE WHEN event_id % 100 = 61 THEN 'INVALID-PAN'
       ELSE '4' || {pad('user_id % 100000', 5)} || '******' || {pad('user_id % 10000', 4)} END AS card_number,
  CASE WHEN event_id % 3 = 0 THEN event_id % {NORD} END AS account_txn_id,
  'ATM' || {pad('event_id % 20', 3)} AS atm_id,
  CASE event_id % 4 WHEN 0 THEN 'WITHDRAWAL' WHEN 1 THEN 'DEPOSIT' WHEN 2 THEN 'BALANCE_INQUIRY'
       ELSE NULL END AS txn_type,
  CASE WHEN event_id % 4 = 2 THEN NULL ELSE {money('value * 100')} END AS amount,
  ts AS log_timestamp,
  CASE WHEN event_id % 100 = 71 THEN 'UNKNOWN' WHEN event_id % 10 = 1 THEN '51' ELSE '00' END
    AS response_code,
  {BD} AS business_date
FROM events WHERE event_type = 'view'
"""

FIXTURES["payment_gateway_log"] = f"""
SELECT
  'GW-' || {pad('event_id', 8)} AS gateway_txn_id,
  'PAY-' || CAST(event_id AS STRING) AS payment_ref,
  CASE WHEN event_id % 2 = 0 THEN 'ACCOUNT_TRANSFER' ELSE 'CARD' END AS payment_method,
  CASE WHEN event_id % 2 = 0 THEN (event_id * 7) % {NORD} END AS account_txn_id,
  CASE WHEN event_id % 2 = 1 THEN ((event_id * 7) % {NORD}) * 10 + 1 END AS card_txn_id,
  'MER-' || {pad(f'event_id % {NSUPP}', 6)} AS merchant_id,
  {money('value * 100')} AS amount,
  CASE WHEN event_id % 100 = 81 THEN 'XXX' WHEN event_id % 3 = 0 THEN NULL
       WHEN event_id % 3 = 1 THEN 'VND' ELSE 'USD' END AS currency,
  CASE WHEN event_id % 9 = 0 THEN 'FAILED' ELSE 'CAPTURED' END AS gateway_status,
  ts AS gateway_timestamp,
  'PRV' || CAST(event_id % 4 AS STRING) AS provider_code,
  {BD} AS business_date
FROM events WHERE event_type = 'purchase'
"""

_SEQ3 = fanout(range(3), "s", "seq")


def _status_ts(ts: str) -> str:
    return (f"CASE s.seq WHEN 0 THEN {ts} WHEN 1 THEN {ts} + INTERVAL '1' HOUR "
            f"ELSE {ts} + INTERVAL '2' HOUR END")


FIXTURES["account_transaction_status_event"] = f"""
SELECT
  'SE' || CAST(s.seq AS STRING) || '-' || CAST(o_orderkey % 1000 AS STRING) AS status_event_id,
  CASE WHEN o_orderkey % 100 = 27 THEN CAST(-1 AS BIGINT) ELSE o_orderkey END AS account_txn_id,
  CASE s.seq WHEN 0 THEN 'INITIATED' WHEN 1 THEN 'PENDING'
       ELSE CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' ELSE 'REJECTED' END END AS status,
  {_status_ts('o_orderdate')} AS status_timestamp,
  CASE WHEN s.seq = 0 AND o_orderkey % 100 = 29 THEN o_orderdate + INTERVAL '600' SECOND
       ELSE {_status_ts('o_orderdate')} + INTERVAL '5' SECOND END AS source_arrival_timestamp,
  CAST(s.seq AS BIGINT) AS sequence_number,
  {BD} AS business_date
FROM orders {_SEQ3}
WHERE s.seq < 2 OR o_orderstatus <> 'O'
UNION ALL
SELECT
  'SE9-' || CAST(o_orderkey % 1000 AS STRING), o_orderkey, 'PENDING',
  o_orderdate + INTERVAL '1' HOUR, o_orderdate + INTERVAL '1' HOUR + INTERVAL '5' SECOND,
  CAST(1 AS BIGINT), {BD}
FROM orders WHERE o_orderkey % 100 = 33
"""

FIXTURES["card_transaction_status_event"] = f"""
SELECT
  'CSE' || CAST(s.seq AS STRING) || '-' || CAST(card_txn_id % 1000 AS STRING) AS status_event_id,
  CASE WHEN card_txn_id % 100 = 37 THEN CAST(-1 AS BIGINT) ELSE card_txn_id END AS card_txn_id,
  CASE s.seq WHEN 0 THEN 'AUTHORIZED' ELSE txn_status END AS status,
  {_status_ts("(txn_timestamp + INTERVAL '25' YEAR)")} AS status_timestamp,
  {_status_ts("(txn_timestamp + INTERVAL '25' YEAR)")} + INTERVAL '5' SECOND AS source_arrival_timestamp,
  CAST(s.seq AS BIGINT) AS sequence_number,
  {BD} AS business_date
FROM card_transaction {_SEQ3}
WHERE s.seq < 2
"""

FIXTURES["atm_transaction_status_event"] = f"""
SELECT
  'ASE' || CAST(s.seq AS STRING) || '-' || CAST(event_id % 1000 AS STRING) AS status_event_id,
  CASE WHEN event_id % 100 = 43 THEN 'UNKNOWN-ATM-LOG' ELSE 'ATM-' || {pad('event_id', 8)} END AS log_id,
  event_id % {NORD} AS account_txn_id,
  CASE s.seq WHEN 0 THEN 'INITIATED' ELSE 'COMPLETED' END AS status,
  {_status_ts('ts')} AS status_timestamp,
  {_status_ts('ts')} + INTERVAL '5' SECOND AS source_arrival_timestamp,
  CAST(s.seq AS BIGINT) AS sequence_number,
  {BD} AS business_date
FROM events {_SEQ3}
WHERE event_type = 'view' AND s.seq < 2
"""

FIXTURES["payment_gateway_status_event"] = f"""
SELECT
  'GSE' || CAST(s.seq AS STRING) || '-' || CAST(event_id % 1000 AS STRING) AS status_event_id,
  CASE WHEN event_id % 100 = 47 THEN 'UNKNOWN-GATEWAY-LOG' ELSE 'GW-' || {pad('event_id', 8)} END
    AS gateway_txn_id,
  CASE WHEN event_id % 2 = 0 THEN (event_id * 7) % {NORD} END AS account_txn_id,
  CASE WHEN event_id % 2 = 1 AND event_id % 11 <> 4 THEN ((event_id * 7) % {NORD}) * 10 + 1 END
    AS card_txn_id,
  CASE s.seq WHEN 0 THEN 'INITIATED' ELSE 'CAPTURED' END AS status,
  {_status_ts('ts')} AS status_timestamp,
  {_status_ts('ts')} + INTERVAL '5' SECOND AS source_arrival_timestamp,
  CAST(s.seq AS BIGINT) AS sequence_number,
  {BD} AS business_date
FROM events {_SEQ3}
WHERE event_type = 'purchase' AND s.seq < 2
"""

# -------------------------------------------------------------------- card
FIXTURES["card"] = f"""
SELECT
  'CARD-' || {pad('c_custkey', 8)} AS card_id,
  CASE WHEN c_custkey % 100 = 21 THEN CAST(-1 AS BIGINT) ELSE c_custkey * 10 END AS account_id,
  CASE WHEN c_custkey % 100 = 31 THEN 'INVALID-PAN'
       ELSE '4' || {pad('c_custkey % 100000', 5)} || '******' || {pad('c_custkey % 10000', 4)} END
    AS card_number,
  CASE WHEN c_custkey % 2 = 0 THEN 'DEBIT' ELSE 'CREDIT' END AS card_type,
  DATE '2018-01-01' + CAST(c_custkey % 1000 AS INT) AS issue_date,
  DATE '2023-01-01' + CAST(c_custkey % 1000 AS INT) AS expiry_date,
  CASE WHEN c_custkey % 9 = 0 THEN 'BLOCKED' ELSE 'ACTIVE' END AS status,
  {BD} AS business_date
FROM customer
"""

FIXTURES["card_limit_history"] = f"""
SELECT
  'CLH-' || substr(card_id, 6) AS history_id,
  CASE WHEN account_id % 1000 = 410 THEN 'UNKNOWN-CARD' ELSE card_id END AS card_id,
  CAST(1000 * (1 + account_id % 17) AS DECIMAL(12,2)) AS limit_amount,
  issue_date AS effective_date,
  {BD} AS business_date
FROM card
"""

FIXTURES["card_fraud_flag"] = f"""
SELECT
  'CFF-' || CAST(card_txn_id AS STRING) AS flag_id,
  CASE WHEN card_txn_id % 1000 = 311 THEN CAST(-1 AS BIGINT) ELSE card_txn_id END AS card_txn_id,
  CASE WHEN is_fraud THEN 'CONFIRMED_FRAUD' ELSE 'VELOCITY' END AS flag_reason,
  CAST(txn_timestamp AS DATE) + 1 AS flag_date,
  CASE WHEN card_txn_id % 3 = 0 THEN 'OPEN' ELSE 'RESOLVED' END AS resolved_status,
  {BD} AS business_date
FROM card_transaction
"""

# ---------------------------------------------------------------- fincrime
_SCORE = "CAST(CAST(ROUND(o_totalprice * 100) AS BIGINT) % 101 AS DECIMAL(5,2))"

FIXTURES["fraud_alert"] = f"""
SELECT
  'FA' || CAST(s.n AS STRING) || '-' || {pad('o_orderkey', 8)} AS alert_id,
  CASE WHEN o_orderkey % 1000 = 11 THEN CAST(-1 AS BIGINT) ELSE o_orderkey END AS account_txn_id,
  CASE WHEN o_orderkey % 3 = 0 THEN 'VELOCITY' ELSE 'AMOUNT_SPIKE' END AS alert_type,
  CASE WHEN o_orderkey % 100 = 41 AND s.n = 0 THEN CAST(101 AS DECIMAL(5,2))
       WHEN s.n = 1 THEN CAST(CAST(ROUND(o_totalprice * 100) AS BIGINT) % 71 AS DECIMAL(5,2))
       ELSE {_SCORE} END AS alert_score,
  CASE (o_orderkey + s.n) % 3 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'CLOSED' ELSE 'IN_REVIEW' END AS alert_status,
  CAST(o_orderdate AS DATE) + 1 AS created_date,
  {BD} AS business_date
FROM orders {_FAN2}
WHERE s.n = 0 OR o_orderkey % 2 = 1
"""

FIXTURES["account_transaction_risk_score"] = f"""
SELECT
  'RS' || CAST(s.n AS STRING) || '-' || {pad('o_orderkey', 8)} AS score_id,
  CASE WHEN o_orderkey % 1000 = 12 THEN CAST(-1 AS BIGINT) ELSE o_orderkey END AS account_txn_id,
  CAST(((CAST(ROUND(o_totalprice * 100) AS BIGINT) + s.n * 37) % 10000) / 10000.0 AS DECIMAL(6,4))
    AS model_score,
  CASE WHEN (CAST(ROUND(o_totalprice * 100) AS BIGINT) + s.n * 37) % 10000 >= 7000 THEN 'HIGH'
       WHEN (CAST(ROUND(o_totalprice * 100) AS BIGINT) + s.n * 37) % 10000 >= 3000 THEN 'MEDIUM'
       ELSE 'LOW' END AS risk_band,
  CAST(o_orderdate AS DATE) + CAST(s.n AS INT) AS scored_date,
  {BD} AS business_date
FROM orders {_FAN2}
WHERE s.n = 0 OR o_orderkey % 2 = 0
"""

FIXTURES["transaction_monitoring_alert"] = f"""
SELECT
  'TMA-' || {pad('o_orderkey', 8)} AS alert_id,
  'CB-' || {pad('o_custkey', 6)} AS customer_ref,
  o_orderkey AS primary_account_txn_id,
  CASE WHEN o_orderkey % 7 = 0 THEN 'STRUCTURING' ELSE 'UNUSUAL_PATTERN' END AS alert_type,
  CASE WHEN o_orderkey % 1000 = 13 THEN CAST(-1 AS DECIMAL(5,2)) ELSE {_SCORE} END AS alert_score,
  CASE WHEN o_orderkey % 4 = 1 THEN 'CLOSED' ELSE 'OPEN' END AS alert_status,
  o_orderdate + INTERVAL '3' HOUR AS alert_timestamp,
  {BD} AS business_date
FROM orders
"""

FIXTURES["transaction_monitoring_alert_account_transaction"] = f"""
SELECT 'TAL-' || {pad('o_orderkey', 8)} AS alert_account_txn_link_id,
  'TMA-' || {pad('o_orderkey', 8)} AS alert_id,
  CASE WHEN o_orderkey % 1000 = 23 THEN CAST(-1 AS BIGINT) ELSE o_orderkey END AS account_txn_id,
  TRUE AS is_primary, {BD} AS business_date
FROM orders
"""

FIXTURES["transaction_monitoring_alert_card_transaction"] = f"""
SELECT 'TCL-' || {pad('o_orderkey', 8)} AS alert_card_txn_link_id,
  'TMA-' || {pad('o_orderkey', 8)} AS alert_id,
  CASE WHEN o_orderkey % 1000 = 33 THEN CAST(-1 AS BIGINT) ELSE o_orderkey * 10 + 1 END AS card_txn_id,
  FALSE AS is_primary, {BD} AS business_date
FROM orders
"""

FIXTURES["investigation_case"] = f"""
SELECT
  'IC-' || {pad('o_orderkey', 8)} AS case_id,
  CASE WHEN o_orderkey % 40 = 5 THEN 'AML' ELSE 'FRAUD' END AS investigation_type,
  CASE WHEN o_orderkey % 3 = 0 THEN 'MONITORING_ALERT' ELSE 'FRAUD_ALERT' END AS case_origin,
  CASE o_orderkey % 4 WHEN 0 THEN 'CLOSED' WHEN 1 THEN 'OPEN' WHEN 2 THEN 'RESOLVED' ELSE 'IN_PROGRESS' END
    AS case_status,
  CASE WHEN o_orderkey % 3 = 0 THEN 'HIGH' ELSE 'MEDIUM' END AS priority,
  o_orderdate + INTERVAL '4' HOUR AS opened_timestamp,
  CASE WHEN o_orderkey % 4 IN (0, 2) THEN o_orderdate + INTERVAL '30' DAY END AS closed_timestamp,
  'AN-' || CAST(o_orderkey % 12 AS STRING) AS assigned_analyst_id,
  {BD} AS business_date
FROM orders
"""

_IC = "'IC-' || " + pad("o_orderkey", 8)
FIXTURES["investigation_case_transaction_monitoring_alert"] = f"""
SELECT 'ICM-' || {pad('o_orderkey', 8)} AS case_alert_link_id, {_IC} AS case_id,
  CASE WHEN o_orderkey % 1000 = 45 THEN 'UNKNOWN-MONITORING-ALERT'
       ELSE 'TMA-' || {pad('o_orderkey - 2', 8)} END AS alert_id,
  o_orderdate + INTERVAL '5' HOUR AS linked_timestamp, {BD} AS business_date
FROM orders
"""

FIXTURES["investigation_case_card_fraud_flag"] = f"""
SELECT 'ICF-' || CAST(card_txn_id AS STRING) AS case_flag_link_id,
  'IC-' || {pad('CAST(FLOOR(card_txn_id / 10) AS BIGINT)', 8)} AS case_id,
  'CFF-' || CAST(card_txn_id AS STRING) AS flag_id,
  txn_timestamp + INTERVAL '1' DAY AS linked_timestamp, {BD} AS business_date
FROM card_transaction
"""

FIXTURES["investigation_case_account_transaction"] = f"""
SELECT 'ICA-' || {pad('o_orderkey', 8)} AS case_account_txn_link_id, {_IC} AS case_id,
  CASE WHEN o_orderkey % 1000 = 65 THEN CAST(-1 AS BIGINT) ELSE o_orderkey END AS account_txn_id,
  'SUSPICIOUS_AMOUNT' AS link_reason,
  o_orderdate + INTERVAL '5' HOUR AS linked_timestamp, {BD} AS business_date
FROM orders
"""

FIXTURES["investigation_case_card_transaction"] = f"""
SELECT 'ICC-' || {pad('o_orderkey', 8)} AS case_card_txn_link_id, {_IC} AS case_id,
  CASE WHEN o_orderkey % 1000 = 85 THEN CAST(-1 AS BIGINT) ELSE o_orderkey * 10 + 1 END AS card_txn_id,
  'CARD_ACTIVITY' AS link_reason,
  o_orderdate + INTERVAL '6' HOUR AS linked_timestamp, {BD} AS business_date
FROM orders
"""

FIXTURES["investigation_case_fraud_alert"] = f"""
SELECT 'ICFA-' || {pad('o_orderkey', 8)} AS case_alert_link_id, {_IC} AS case_id,
  CASE WHEN o_orderkey % 1000 = 105 THEN 'UNKNOWN-ALERT'
       ELSE 'FA0-' || {pad('o_orderkey - 4', 8)} END AS alert_id,
  o_orderdate + INTERVAL '5' HOUR AS linked_timestamp, {BD} AS business_date
FROM orders
"""

FIXTURES["investigation_case_sanction_screening"] = f"""
SELECT 'ICS-' || {pad('o_orderkey', 8)} AS case_screening_link_id, {_IC} AS case_id,
  CASE WHEN o_orderkey % 1000 = 125 THEN 'UNKNOWN-SCREENING'
       ELSE 'SCR-' || {pad(f'(o_custkey - o_custkey % 7) % {NCUST}', 6)} END AS screening_id,
  o_orderdate + INTERVAL '7' HOUR AS linked_timestamp, {BD} AS business_date
FROM orders
"""

FIXTURES["investigation_note"] = f"""
SELECT
  'NOTE-' || {pad('doc_id', 8)} AS note_id,
  'IC-' || {pad(f'(doc_id * 20 + 5) % {NORD}', 8)} AS case_id,
  'AN-' || CAST(doc_id % 12 AS STRING) AS author_id,
  CASE doc_id % 3 WHEN 0 THEN o_orderdate + INTERVAL '8' HOUR WHEN 1 THEN o_orderdate + INTERVAL '9' HOUR
       ELSE o_orderdate + INTERVAL '10' HOUR END AS note_timestamp,
  CASE WHEN doc_id % 100 = 17 THEN o_orderdate + INTERVAL '8' HOUR + INTERVAL '600' SECOND
       ELSE o_orderdate + INTERVAL '8' HOUR + INTERVAL '5' SECOND END AS source_arrival_timestamp,
  CASE WHEN lang = 'en' THEN 'ANALYST_NOTE' ELSE 'TRANSLATED_NOTE' END AS note_type,
  text AS note_text,
  {BD} AS business_date
FROM documents JOIN orders ON o_orderkey = (doc_id * 20 + 5) % {NORD}
"""

FIXTURES["aml_case"] = f"""
SELECT
  'AML' || CAST(s.n AS STRING) || '-' || {pad('o_orderkey', 8)} AS case_id,
  CASE WHEN o_orderkey % 1000 = 205 THEN 'UNKNOWN-CASE' ELSE {_IC} END AS investigation_case_id,
  'CB-' || {pad('o_custkey', 6)} AS customer_ref,
  CASE WHEN s.n = 0 THEN 'STRUCTURING' ELSE 'LAYERING' END AS case_type,
  CASE (o_orderkey + s.n) % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  CAST(o_orderdate AS DATE) + CAST(s.n * 10 AS INT) AS opened_date,
  CASE WHEN (o_orderkey + s.n) % 2 = 0 THEN CAST(o_orderdate AS DATE) + CAST(s.n * 10 + 40 AS INT) END
    AS closed_date,
  {BD} AS business_date
FROM orders {_FAN2}
WHERE s.n = 0 OR o_orderkey % 2 = 1
"""

FIXTURES["suspicious_activity_report"] = f"""
SELECT
  'SAR-' || {pad('o_orderkey', 8)} AS sar_id,
  CASE WHEN o_orderkey % 1000 = 245 THEN 'UNKNOWN-AML-CASE' ELSE 'AML0-' || {pad('o_orderkey', 8)} END
    AS case_id,
  CAST(o_orderdate AS DATE) + 20 AS filed_date,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'REG-' || CAST(o_orderkey AS STRING) END AS regulatory_ref,
  CASE WHEN o_orderkey % 3 = 0 THEN 'DRAFT' ELSE 'FILED' END AS status,
  {BD} AS business_date
FROM orders
"""

FIXTURES["watchlist"] = f"""
SELECT
  'WL-' || {pad('s_suppkey', 6)} AS watchlist_id,
  s_name AS entity_name,
  CASE s_suppkey % 3 WHEN 0 THEN 'PEP' WHEN 1 THEN 'OFAC' ELSE 'UN_SANCTIONS' END AS list_type,
  n_name AS country,
  CASE WHEN s_suppkey % 10 = 7 THEN DATE '1990-01-01' + CAST(s_suppkey % 100 AS INT)
       ELSE DATE '2000-01-01' + CAST(s_suppkey % 600 AS INT) END AS added_date,
  {BD} AS business_date
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
"""

FIXTURES["sanction_screening"] = f"""
SELECT
  'SCR-' || {pad('c_custkey', 6)} AS screening_id,
  'CB-' || {pad('c_custkey', 6)} AS customer_ref,
  'WL-' || {pad(f'c_custkey % {NSUPP}', 6)} AS watchlist_id,
  CASE WHEN c_custkey % 50 = 14 THEN 'AB' WHEN c_custkey % 50 = 28 THEN NULL ELSE c_name END AS screened_name,
  CAST((c_custkey * 13) % 10000 / 100.0 AS DECIMAL(5,2)) AS match_score,
  DATE '2001-01-01' + CAST(c_custkey % 300 AS INT) AS screening_date,
  CASE c_custkey % 3 WHEN 0 THEN 'CLEAR' WHEN 1 THEN 'HIT' ELSE 'FALSE_POSITIVE' END AS result,
  {BD} AS business_date
FROM customer
"""

FIXTURES["chargeback"] = f"""
SELECT
  'CHB-' || CAST(card_txn_id AS STRING) AS chargeback_id,
  card_txn_id,
  CASE WHEN card_txn_id % 1000 = 125 THEN 'UNKNOWN' WHEN card_txn_id % 2 = 0 THEN '4837' ELSE '4853' END
    AS reason_code,
  amount AS dispute_amount,
  CAST(txn_timestamp AS DATE) + 15 AS filed_date,
  CASE WHEN card_txn_id % 3 = 0 THEN 'RESOLVED' ELSE 'OPEN' END AS status,
  CASE WHEN card_txn_id % 3 = 0 AND card_txn_id % 45 <> 0 THEN CAST(txn_timestamp AS DATE) + 45 END
    AS resolved_date,
  {BD} AS business_date
FROM card_transaction
"""

FIXTURES["call_center_log"] = f"""
SELECT
  'CALL-' || {pad('event_id', 8)} AS call_id,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'CB-' || {pad('user_id * 10', 6)} END AS customer_ref,
  CASE WHEN event_id % 13 = 0 AND event_id % 2 = 0 THEN NULL
       ELSE '04' || {pad('user_id * 10', 8)} END AS caller_phone,
  ts AS call_timestamp,
  CASE event_id % 4 WHEN 0 THEN 'CARD_LOST' WHEN 1 THEN 'COMPLAINT' WHEN 2 THEN 'FRAUD_REPORT'
       ELSE 'BALANCE' END AS call_reason,
  'AG-' || CAST(event_id % 25 AS STRING) AS agent_id,
  CAST(60 + event_id % 900 AS BIGINT) AS call_duration_seconds,
  CASE WHEN event_id % 4 = 2 THEN 'IC-' || {pad(f'(event_id * 20 + 5) % {NORD}', 8)} END AS case_id,
  {BD} AS business_date
FROM events WHERE event_type = 'error'
"""

# ------------------------------------------------------- snapshot series
# Six full daily snapshots (versions 20260705..20260710).  A key is present
# in version v unless (k % 6 >= v and k % 7 = v) or k % 97 = v (deletes and
# re-inserts); the tracked address changes whenever (k + v) % 5 = 0; the
# untracked business_date changes every version.
_V6 = fanout(range(1, 7), "s", "v")
FIXTURES["customer_snapshot"] = f"""
SELECT
  'CB-' || {pad('c_custkey', 6)} AS cust_no,
  c_name AS full_name,
  c_mktsegment AS segment,
  'ADDR-' || CAST(c_custkey AS STRING) || '-' || CAST(CAST(FLOOR((c_custkey + s.v) / 5) AS BIGINT) AS STRING)
    AS address,
  DATE '2026-07-04' + CAST(s.v AS INT) AS business_date,
  CAST(20260704 + s.v AS BIGINT) AS version
FROM customer {_V6}
WHERE (c_custkey % 6 < s.v OR c_custkey % 7 <> s.v) AND c_custkey % 97 <> s.v
"""

# Status-event snapshots: version v holds every event with sequence < v.
FIXTURES["status_event_snapshot"] = f"""
SELECT
  'SE' || CAST(s.seq AS STRING) || '-' || CAST(o_orderkey % 1000 AS STRING) AS status_event_id,
  o_orderkey AS account_txn_id,
  CASE s.seq WHEN 0 THEN 'INITIATED' WHEN 1 THEN 'PENDING'
       ELSE CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' ELSE 'REJECTED' END END AS status,
  CAST(s.seq AS BIGINT) AS sequence_number,
  CAST(20260704 + v.v AS BIGINT) AS version
FROM orders {_SEQ3} {fanout(range(1, 4), 'v', 'v')}
WHERE s.seq < v.v
"""

# Natural replay input: lineitem as delivered, duplicates of
# (orderkey, linenumber) kept.
FIXTURES["card_transaction_raw"] = f"""
SELECT
  l_orderkey * 10 + l_linenumber AS card_txn_id,
  'CARD-' || {pad('l_orderkey % 1000', 8)} AS card_id,
  'MER-' || {pad(f'l_suppkey % {NSUPP}', 6)} AS merchant_id,
  {money('l_extendedprice')} AS amount,
  l_shipdate AS txn_timestamp,
  CASE WHEN l_linestatus = 'F' THEN 'SETTLED' ELSE 'AUTHORIZED' END AS txn_status,
  l_returnflag = 'R' AS is_fraud,
  {BD} AS business_date
FROM lineitem
"""

# Pipeline event log (monitoring input) derived from the event stream:
# signup -> create_update, view / error -> update_progress, others ->
# flow_progress with metrics and expectation results in the JSON details.
_FLOW = ("CASE event_id % 6 WHEN 0 THEN 'lake.bronze.account_transaction' "
         "WHEN 1 THEN 'lake.silver_validated.card' WHEN 2 THEN 'lake.silver.financial_event' "
         "WHEN 3 THEN 'lake.gold.ai_fraud_transaction_context' "
         "WHEN 4 THEN 'lake.governance.silver_quarantine_record' "
         "ELSE 'pipelines.flowTimeMetrics.missingFlowName' END")
_N = "CAST(FLOOR(value) AS BIGINT)"
FIXTURES["pipeline_event_log"] = f"""
SELECT
  event_id,
  CASE event_type WHEN 'signup' THEN 'create_update' WHEN 'view' THEN 'update_progress'
       WHEN 'error' THEN 'update_progress' ELSE 'flow_progress' END AS event_type,
  ts AS timestamp,
  'PL-' || CAST(user_id % 3 AS STRING) AS origin_pipeline_id,
  'banking_pipeline_' || CAST(user_id % 3 AS STRING) AS origin_pipeline_name,
  'U-' || CAST(user_id AS STRING) AS origin_update_id,
  {_FLOW} AS origin_flow_name,
  CASE WHEN event_type = 'signup' THEN '{{"create_update": {{"cause": "JOB_TASK"}}}}'
       WHEN event_type IN ('view', 'error') THEN '{{"update_progress": {{"state": "' ||
         CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_id % 4 = 0 THEN 'RUNNING' ELSE 'COMPLETED' END
         || '"}}}}'
       ELSE '{{"flow_progress": {{"status": "' ||
         CASE event_id % 3 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'COMPLETED' ELSE 'FAILED' END ||
         '", "metrics": {{"num_output_rows": ' || CAST({_N} AS STRING) ||
         ', "num_upserted_rows": ' || CAST({_N} % 7 AS STRING) ||
         ', "num_deleted_rows": ' || CAST(event_id % 2 AS STRING) ||
         '}}, "data_quality": {{"dropped_records": ' || CAST(event_id % 3 AS STRING) ||
         ', "expectations": [{{"name": "rule_' || CAST(event_id % 4 AS STRING) || '", "dataset": "' || {_FLOW} ||
         '", "passed_records": ' || CAST({_N} AS STRING) || ', "failed_records": ' || CAST(event_id % 5 AS STRING) ||
         '}}]}}}}}}'
  END AS details
FROM events
"""

# Append-only run ledger events: every signup starts a run; most runs
# finish ten minutes later, every fifth one is left RUNNING.
FIXTURES["pipeline_run_event"] = f"""
SELECT 'R-' || CAST(event_id AS STRING) AS pipeline_run_id, 'PL-' || CAST(user_id % 3 AS STRING) AS pipeline_id,
  CAST(ts AS DATE) AS business_date, 'RUNNING' AS execution_status, ts AS event_time
FROM events WHERE event_type = 'signup'
UNION ALL
SELECT 'R-' || CAST(event_id AS STRING), 'PL-' || CAST(user_id % 3 AS STRING), CAST(ts AS DATE),
  CASE WHEN event_id % 7 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END, ts + INTERVAL '600' SECOND
FROM events WHERE event_type = 'signup' AND event_id % 5 <> 0
"""

FIXTURE_NAMES = tuple(FIXTURES)
_IDENT = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def dependencies(name: str) -> list[str]:
    """Other fixtures referenced by a fixture's SQL (for CTE ordering)."""
    words = set(_IDENT.findall(FIXTURES[name]))
    return [f for f in FIXTURE_NAMES if f != name and f in words
            and re.search(rf"\b(FROM|JOIN)\s+{f}\b", FIXTURES[name])]


def closure(names) -> list[str]:
    """Fixtures needed for ``names`` in dependency order."""
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in dependencies(n):
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


_SESSION_CACHE: dict = {}


def _cache(spark: SparkSession, sf_dir: str) -> dict:
    """Per (session, sf_dir) registry of built views: each view is planned
    once and the same DataFrame object is reused, so repeated sub-plans are
    identical and Spark can reuse their exchanges."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    if key not in _SESSION_CACHE:
        _SESSION_CACHE.clear()
        _SESSION_CACHE[key] = {}
    return _SESSION_CACHE[key]


def forget() -> None:
    """Drop the registry: the next query builds and publishes its sources anew."""
    _SESSION_CACHE.clear()


def base_tables_of(name: str) -> list[str]:
    return [t for t in BASE_TABLES if re.search(rf"\b(FROM|JOIN)\s+{t}\b", FIXTURES[name])]


def register_base(spark: SparkSession, sf_dir: str, tables=BASE_TABLES) -> dict:
    """Expose the driver's parquet tables as session views (each once per
    sf_dir, only when a view needs it)."""
    cache = _cache(spark, sf_dir)
    for t in tables:
        if ("__base__", t) not in cache:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
            cache[("__base__", t)] = True
    return cache


def load(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """Build the named source views (and what they depend on) in Spark."""
    from vaultline.session import configure

    configure(spark)
    need = closure(names)
    cache = register_base(spark, sf_dir, sorted({t for n in need for t in base_tables_of(n)}
                                                | {"supplier", "orders", "customer"}))
    for n in need:
        if n not in cache:
            df = spark.sql(_bind_counts(spark, cache, spark_text(SPARK_FIXTURES.get(n, FIXTURES[n]))))
            if n in shared_fixtures() and spark.conf.get("vaultline.materialize", "true").lower() == "true":
                df = _land(spark, sf_dir, n, df)
            cache[n] = df
            cache[n].createOrReplaceTempView(n)
    return [cache[n] for n in names]


def shared_fixtures() -> set[str]:
    """Source views other source views are derived from."""
    return {d for n in FIXTURES for d in dependencies(n)}


def _land(spark: SparkSession, sf_dir: str, name: str, df: DataFrame) -> DataFrame:
    """Land a shared source once per run in the run folder (under the
    shared checkpoint directory) so its dependents scan it instead of
    recomputing it."""
    import hashlib

    from vaultline.session import checkpoint_dir, shuffles_end_with_write

    tag = hashlib.sha1(f"{sf_dir}|{spark.sparkContext.applicationId}".encode()).hexdigest()[:12]
    path = f"{checkpoint_dir(spark).rstrip('/')}/vaultline-tables/{tag}/landing/{name}"
    with shuffles_end_with_write(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _bind_counts(spark: SparkSession, cache: dict, sql: str) -> str:
    """Replace the row-count scalar subqueries by their value (one number per
    table, computed once per run) so the Spark plan carries a literal."""
    for sub, table in ((NSUPP, "supplier"), (NORD, "orders"), (NCUST, "customer")):
        if sub in sql:
            key = ("__count__", table)
            if key not in cache:
                cache[key] = spark.table(table).count()
            sql = sql.replace(sub, f"CAST({cache[key]} AS BIGINT)")
    return sql


def memo(spark: SparkSession, sf_dir: str, key, build):
    """Memoise a derived DataFrame for this (session, sf_dir)."""
    cache = _cache(spark, sf_dir)
    if key not in cache:
        cache[key] = build()
    return cache[key]


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, sf_dir, name)[0]


def cte(names, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause with the fixture views (for the DuckDB oracle)."""
    parts = [f"{n} AS ({FIXTURES[n].strip()})" for n in closure(names)]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v.strip()})")
    return "WITH " + ",\n".join(parts) + "\n"
