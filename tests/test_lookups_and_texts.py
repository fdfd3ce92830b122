"""Assessments are projections, keys travel as text, and the expectation covers all events; on own rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from vaultline.functions import keys as K
from vaultline.operators import silver as S
from vaultline.plans import pipeline as P
from vaultline.sources import fixtures as fx

DAY = dt.datetime(2024, 1, 10, 8)
TABLES = {
    "customer": ("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
                 [(k, f"C{k}", 1, 1.0, "S") for k in (1, 2, 3, 3, 11)]),
    "supplier": ("s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE", [(0, "A", 1, 1.0), (1, "B", 1, 1.0)]),
    "nation": ("n_nationkey INT, n_name STRING, n_regionkey INT", [(1, "N", 1)]),
    "part": ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE", [(1, "P", "B", "T", 5, 1.0)]),
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
               [(k, k, "F", 10.0 * k, DAY, "1-URGENT") for k in (1, 2, 3)]),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
                 "l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
                 [(1, 1, 1, 1, 1.0, 5.0, 0.0, 0.0, "R", "F", DAY), (1, 1, 0, 1, 1.0, 6.0, 0.0, 0.0, "R", "F", DAY),
                  (2, 1, 1, 2, 1.0, 7.0, 0.0, 0.0, "N", "F", DAY), (None, 1, 1, 2, 1.0, 7.0, 0.0, 0.0, "N", "F", DAY)]),
    "events": ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
               [(1, DAY, 1, "view", 1.0, ""), (2, DAY, 0, "purchase", 1.0, ""), (3, DAY, 1, "purchase", 2.0, "")]),
}


@pytest.fixture(scope="module")
def own_tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("own"))
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    fx.forget()
    yield root
    fx.forget()


def test_an_assessment_is_not_stored_and_looks_duplicates_up_without_a_shuffle(spark, own_tables):
    assessed = P.assessed(spark, own_tables, "card")
    assert {r.card_id for r in assessed.where("is_quarantined").collect()} == {"CARD-00000003"}
    plan = assessed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    root = P._table_root(spark, own_tables)
    assert "repeated" in os.listdir(root) and "assessed" not in os.listdir(root)


def test_the_fraud_context_joins_texts_and_returns_hashes(spark, own_tables):
    plan = P.gold_fraud(spark, own_tables)._jdf.queryExecution().optimizedPlan().toString()
    joins = plan[plan.index("Join"):]
    assert "sha2(" in plan and "unhex(sha2(" in joins
    assert joins.count("sha2(") == joins.count("unhex(sha2(")   # below the joins only the ranks of equal dates
    rows = P.gold_fraud(spark, own_tables).collect()
    assert {len(r.financial_event_key) for r in rows} == {64}


def test_both_key_forms_give_the_same_events_and_violations(spark):
    at = "TIMESTAMP_NTZ '2024-01-10 08:00:00'"
    acct = spark.sql(f"SELECT * FROM VALUES (1L, 10L, 'CB-1', {at}), (2L, NULL, 'CRM-2', {at}) AS t(account_txn_id, account_id, customer_ref, txn_timestamp)")
    cards = spark.sql(f"SELECT * FROM VALUES (5L, 'C1', {at}), (6L, 'C9', {at}), (7L, NULL, {at}) AS t(card_txn_id, card_id, txn_timestamp)")
    atm = spark.sql(f"SELECT * FROM VALUES ('A1', 'C2', {at}), ('A2', NULL, {at}) AS t(log_id, card_id, log_timestamp)")
    gateway = spark.sql(f"""SELECT * FROM VALUES ('G1', 1L, NULL, 'USD', {at}), ('G2', NULL, 5L, NULL, {at}), ('G3', 2L, 5L, 'USD', {at}),
        ('G4', NULL, NULL, 'USD', {at}) AS t(gateway_txn_id, account_txn_id, card_txn_id, currency, gateway_timestamp)""")
    card = spark.sql("SELECT * FROM VALUES ('C1', 10L), ('C2', NULL) AS t(card_id, account_id)")

    def events(form):
        role = spark.sql("SELECT * FROM VALUES ('p', 10L), ('q', 10L) AS t(p, a)").select(
            form.make(F.lit("x"), "p").alias("party_key"), form.make(F.lit("core_banking"), "a").alias("account_key"))
        return S.financial_event(acct, cards, atm, gateway, card, role, form=form)

    keys = ("financial_event_key", "account_key", "payment_card_key", "party_key")
    hashed, text = events(K.HASHED), events(K.TEXT)
    got = sorted(map(str, hashed.collect()))
    assert got == sorted(map(str, text.withColumns({k: K.hash_of_text(k) for k in keys}).collect())) and len(got) == 11
    party = {r.source_business_key: r.party_key for r in hashed.collect()}
    assert party["G1"] == party["G2"] == party["5"] is not None and party["G3"] == party["5"] and party["6"] is party["A1"] is None
    twice = hashed.unionByName(hashed), text.unionByName(text)
    one, other = (sorted(map(str, S.unique_key_violations(df, "t", ["financial_event_key"], form).collect()))
                  for df, form in zip(twice, (K.HASHED, K.TEXT)))
    assert one == other and len(one) == 11


def test_the_expectation_covers_every_event_type(spark, own_tables):
    rows = {r.event_type: (r.kept_rows, r.dropped_rows) for r in E.queries()["dq_expect_or_drop"](spark, own_tables).collect()}
    assert rows == {"ACCOUNT_POSTING": (3, 0), "CARD_PAYMENT": (2, 0), "ATM_ACTIVITY": (1, 0), "GATEWAY_PAYMENT": (1, 0)}   # the one without a currency is quarantined
