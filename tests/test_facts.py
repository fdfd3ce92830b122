"""Facts of many tables about one key, and the wide contexts built on them."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from vaultline.operators import gold as G
from vaultline.operators.facts import about, how_many, newest, tagged_facts


def test_facts_meet_in_one_exchange(spark):
    a = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("day"), F.lit("x").alias("name"))
    b = spark.range(50).select((F.col("id") % 9).alias("k"), F.col("id").alias("item"))
    out = about("k", {"a": a, "b": b}, newest("a"), how_many("b", "items"))
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    rows = {r.k: r for r in out.collect()}
    assert rows[0].a.day == 98 and rows[0]["items"] == 6
    assert rows[8].a is None and rows[8]["items"] == 5


def test_rows_without_a_key_and_ties(spark):
    a = spark.createDataFrame([(None, 1, "a"), ("p", None, "b"), ("p", None, "c"), ("p", None, "c")], "k STRING, day INT, own STRING")
    assert tagged_facts("k", {"a": a}).where("k IS NULL").count() == 0
    got = about("k", {"a": a}, newest("a"), how_many("a", "n")).collect()
    assert [(r.k, r.a.own, r.n) for r in got] == [("p", "c", 3)]


def _tables(spark, **given):
    """Empty silver tables of the customer context, but for those given."""
    schemas = {
        "party": "party_key STRING, party_type STRING, party_status STRING, source_system STRING, source_business_key STRING, "
                 "data_quality_status STRING",
        "party_profile_version": "party_key STRING, party_profile_version_key STRING, effective_from DATE, is_current BOOLEAN, "
                                 "preferred_contact_method STRING",
        "party_kyc_assessment": "party_key STRING, verified_date DATE, kyc_assessment_key STRING, verification_status STRING, "
                                "id_type STRING, id_number STRING",
        "party_employment": "party_key STRING, effective_from DATE, effective_to DATE, employment_key STRING, employer_name STRING, "
                            "job_title STRING, monthly_income DECIMAL(14,2)",
        "party_account_role": "party_key STRING, account_key STRING, valid_to DATE",
        "account": "account_key STRING, account_status STRING",
        "account_balance_snapshot": "account_key STRING, balance_date DATE, account_balance_snapshot_key STRING, closing_balance DECIMAL(14,2)",
        "payment_card": "account_key STRING, payment_card_key STRING, card_status STRING",
        "party_service_request": "party_key STRING, request_status STRING",
        "call_center_contact": "party_key STRING, call_timestamp TIMESTAMP_NTZ, call_center_contact_key STRING, call_reason STRING",
        "aml_case": "party_key STRING, aml_case_key STRING, investigation_case_key STRING",
        "investigation_case": "investigation_case_key STRING, case_status STRING",
    }
    return lambda name: spark.createDataFrame(given.get(name, []), schemas[name])


PARTY = [("p", "PERSON", "ACTIVE", "CORE", "1", "VALID"), (None, "PERSON", "ACTIVE", "CORE", "2", "VALID")]


def test_customer_of_empty_tables(spark):
    row, = G.customer_360_context(_tables(spark, party=PARTY), "2026-07-06").collect()
    assert (row.active_account_count, row.total_current_balance, row.active_card_count, row.open_investigation_flag) == (0, None, 0, False)
    assert row.dq_status == "WARNING_UNRESOLVED_PARTY"


def test_two_roles_in_one_account(spark):
    day = dt.date(2026, 7, 1)
    silver = _tables(
        spark, party=PARTY,
        party_account_role=[("p", "a", None), ("p", "a", day), ("p", "closed", None), ("p", "unknown", None), ("p", None, None)],
        account=[("a", "ACTIVE"), ("closed", "CLOSED")],
        account_balance_snapshot=[("a", day, "s1", Decimal("5.00")), ("a", day, "s2", Decimal("7.50")),
                                  ("a", dt.date(2026, 1, 1), "s9", Decimal("900.00"))],
        payment_card=[("a", "c1", "ACTIVE"), ("a", "c1", "ACTIVE"), ("a", "c2", "BLOCKED"), (None, "c3", "ACTIVE")],
        aml_case=[("p", "m", "i1"), ("p", "n", "i2")], investigation_case=[("i1", "CLOSED"), ("i2", None)])
    row, = G.customer_360_context(silver, "2026-07-06").collect()
    assert row.active_account_count == 1          # an account held twice is one account
    assert row.total_current_balance == Decimal("15.00")   # each role brings the newest balance
    assert row.active_card_count == 2             # one card, by two roles
    assert row.open_investigation_flag is False   # neither an ended case nor one without a status is open
