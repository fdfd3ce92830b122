import tempfile

from vaultline.sources import snapshots as SN


def test_version_iterator(spark):
    root = tempfile.mkdtemp(prefix="vaultline-test-landing-")
    df = spark.createDataFrame([("CB-1", "a")], "cust_no STRING, v STRING")
    for d in ("2026-01-01", "2026-02-01"):
        df.write.mode("overwrite").parquet(SN.source_path(root, "customer", "core_banking_customer", d))
    # a date folder without this table is skipped
    df.write.mode("overwrite").parquet(SN.source_path(root, "customer", "crm_customer", "2026-01-15"))
    assert SN.available_versions(spark, root) == [20260101, 20260115, 20260201]
    first = SN.next_snapshot(spark, root, "customer", "core_banking_customer", None)
    assert first[1] == 20260101
    second = SN.next_snapshot(spark, root, "customer", "core_banking_customer", first[1])
    assert second[1] == 20260201
    assert SN.next_snapshot(spark, root, "customer", "core_banking_customer", second[1]) is None


def test_rescued_data(spark):
    df = spark.createDataFrame([("1", "12.5"), ("x", "7"), ("2", None)], "account_id STRING, amount STRING")
    out = SN.read_with_rescue(df, "account_id BIGINT, amount DECIMAL(12,2)").collect()
    assert out[0]["_rescued_data"] is None and out[1]["_rescued_data"] == '{"account_id":"x"}'
    assert out[1]["account_id"] is None and out[2]["_rescued_data"] is None
