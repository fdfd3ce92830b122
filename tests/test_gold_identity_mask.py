from pyspark.sql import functions as F

from vaultline.functions import masking as M
from vaultline.operators import gold as G
from vaultline.operators import identity as I


def test_store_risk_ordering(spark):
    ml = spark.createDataFrame([("MA", "LOW"), ("MA", "HIGH"), ("MB", "LOW"), ("MC", "UNKNOWN")],
                               "merchant_key STRING, risk_rating STRING")
    got = {r.merchant_key: (r.merchant_store_count, r.merchant_max_store_risk)
           for r in G.merchant_store_risk(ml).collect()}
    assert got == {"MA": (2, "HIGH"), "MB": (1, "LOW"), "MC": (1, None)}


def test_latest_per_key_is_total_order(spark):
    df = spark.createDataFrame([("P", "2026-01-01", "k1", 0.10), ("P", "2026-02-01", "k2", 0.85),
                                ("P", "2026-02-01", "k0", 0.50)], "fk STRING, d STRING, sk STRING, score DOUBLE")
    out = G.latest_per_key(df, "fk", [F.col("d"), F.col("sk")], ["score"]).collect()
    assert out[0].score == 0.85


def test_identity_resolution_outcomes(spark):
    core = spark.createDataFrame([("CB-1", "N1", "2026-07-05"), ("CB-2", "N2", "2026-07-05"),
                                  ("CB-3", "N3", "2026-07-05"), ("CB-4", "N3", "2026-07-05")],
                                 "cust_no STRING, national_id STRING, business_date STRING")
    crm = spark.createDataFrame([("CRM-1", "N1", "2026-07-05")], "party_id STRING, national_id STRING, business_date STRING")
    active = I.active_customers(core, crm)
    cand = I.party_candidates(active)
    cov = sorted(r.source_coverage for r in cand.collect())
    assert cov == ["CORE_AND_CRM", "CORE_ONLY"]          # N3 has two core rows -> dropped
    ids = I.party_identifiers(active, cand)
    kyc = spark.createDataFrame([("K1", "CB-1", "2026-07-05"), ("K2", "CB-3", "2026-07-05"),
                                 ("K3", "XYZ", "2026-07-05"), ("K4", "CRM-1", "2026-07-05")],
                                "kyc_id STRING, customer_ref STRING, business_date STRING")
    res = I.resolve_references(kyc, ids, "kyc_id", "KYC", "customer_kyc", "KYC", resolved_at="2026-08-01 00:00:00")
    got = {r.source_business_key: r.resolution_status for r in res.collect()}
    assert got == {"K1": "CONFIRMED", "K2": "UNRESOLVED", "K3": "UNRESOLVED", "K4": "CONFIRMED"}
    # resolved + quarantined = active
    assert res.filter("resolution_status = 'CONFIRMED'").count() + res.filter(
        "resolution_status <> 'CONFIRMED'").count() == kyc.count()


def test_masking_rules(spark):
    df = spark.createDataFrame([("0123456789012", "John Smith", "0412 345 678", "", None)],
                               "nid STRING, name STRING, phone STRING, blank STRING, nul STRING")
    r = df.select(M.mask_as("nid", "national_id").alias("a"), M.mask_as("name", "individual_name").alias("b"),
                  M.mask_as("phone", "phone").alias("c"), M.mask_as("blank", "phone").alias("d"),
                  M.mask_as("nul", "phone").alias("e"), M.mask_as("name", "no_such_type").alias("f"),
                  M.mask("name", F.lit("address")).alias("g")).collect()[0]
    assert r.a == "0116789012" and r.b.startswith("J. MASKED_") and len(r.b) == 16
    assert r.c == "04121145678"[:4] + "11" + "5678" and r.d == "" and r.e is None
    assert r.f == "***PRIVATIZED***" and r.g.startswith("456 Masked Street")


def test_sql_function_matches_column_expression(spark):
    M.register_sql_function(spark)
    df = spark.createDataFrame([("Jane Doe",), ("4111111111111111",)], "v STRING")
    for t in ("individual_name", "card_number", "email", "vin", "lei", "tin"):
        a = [r[0] for r in df.select(M.mask("v", F.lit(t))).collect()]
        b = [r[0] for r in df.selectExpr(f"mask_pii(v, '{t}')").collect()]
        assert a == b
