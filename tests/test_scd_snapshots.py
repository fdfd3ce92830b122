"""Snapshots that repeat a key, change nothing, come late or come in several files."""

import pytest
from pyspark.sql import functions as F

from vaultline.operators import scd
from vaultline.streaming import stream as S

SCHEMA = "key STRING, address STRING, version BIGINT"
SERIES = [
    [("K", "a", 1), ("L", "x", 1)],
    [("K", "a", 2), ("K", "b", 2), ("L", "x", 2)],  # K twice
    [("K", "b", 3), ("L", "x", 3)],  # nothing changes
    [("K", "c", 4)],  # L is gone
]


def _rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def batch(spark):
    return _rows(scd.scd2_from_snapshots(spark.createDataFrame(sum(SERIES, []), SCHEMA), ["key"]))


def test_incremental_equals_batch(spark, batch):
    history = None
    for rows in SERIES:
        snap = spark.createDataFrame(rows, SCHEMA).drop("version")
        if history is None:
            history = scd.one_row_per_key(snap, ["key"]).withColumn(scd.START, F.lit(1).cast("bigint")).withColumn(
                scd.END, F.lit(None).cast("bigint"))
        else:
            history = scd.scd2_apply_snapshot(history, snap, ["key"], rows[0][2])
    assert _rows(history) == batch


def test_stream_equals_batch_with_split_snapshots(spark, batch, tmp_path):
    for rows in SERIES:  # one file per row: a snapshot spans several files
        for row in rows:
            spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    source = S.read_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], SCHEMA).schema, max_files=1)
    S.scd2_stream(spark, source, ["key"], "version", f"{tmp_path}/out", f"{tmp_path}/ckpt")
    assert _rows(S.final_history(spark, f"{tmp_path}/out")) == batch


def test_stream_rejects_a_late_snapshot(spark, tmp_path):
    late = [[("K", "x", 1)], [("K", "x", 3)], [("K", "x", 4)], [("K", "y", 2)]]  # 3 changes nothing
    for rows in late:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    source = S.read_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], SCHEMA).schema, max_files=1)
    with pytest.raises(Exception, match="not newer"):
        S.scd2_stream(spark, source, ["key"], "version", f"{tmp_path}/out", f"{tmp_path}/ckpt")


def test_shared_folder_is_required_on_a_cluster():
    from vaultline.session import checkpoint_dir

    class Session:
        conf = {}
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError):
        checkpoint_dir(Session)


def test_keys_in_two_spellings_are_duplicates(spark):
    from vaultline.operators import quarantine

    df = spark.createDataFrame([("CB-1",), (" cb-1 ",), ("CB-2",)], "cust_no STRING")
    assert [r[0] for r in quarantine.duplicate_active_keys(df, "cust_no").collect()] == ["CB-1"]


def test_rows_are_dealt_before_the_partial_aggregate_sorts_them(spark):
    rows = [("K", f"a{i % 40}", v) for v in (1, 2) for i in range(400)] + [(None, "n", 1), (None, "n", 1), ("L", "x", 2)]
    feed = scd.change_feed(spark.createDataFrame(rows, SCHEMA).coalesce(1), ["key"])
    plan = feed._jdf.queryExecution().executedPlan().toString()
    below_partial = plan[plan.index("partial_max"):].split("BroadcastExchange")[0]
    assert "REBALANCE_PARTITIONS" in below_partial
    assert _rows(feed.select("key", "address", "_change_type", "_commit_version")) == sorted([
        ("delete", 2, "n", None), ("insert", 1, "a9", "K"), ("insert", 1, "n", None), ("insert", 2, "x", "L")], key=repr)
