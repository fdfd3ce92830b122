"""What long jobs leave on disk while they run: no spent shuffle files, one large source at a time, compact state."""

import glob
import os
import threading
import time

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vaultline.operators.history import SnapshotHistory
from vaultline.plans import pipeline as P
from vaultline.plans import q_history as H
from vaultline.sources import fixtures as fx


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f for f in files if "/shuffle_" in f}


def test_the_fraud_context_stores_what_it_looks_up(spark):
    """Signals, cards and settled payments are written, and their shuffle files gone, before the events are shuffled."""
    fx.forget()
    before = shuffle_files(spark)
    context = P.gold_fraud(spark, SF_SMALL)
    assert not shuffle_files(spark) - before
    assert {"signals", "cards_held", "settled"} <= set(os.listdir(f"{P._table_root(spark, SF_SMALL)}/fraud"))
    plan = context._jdf.queryExecution().optimizedPlan().toString()
    assert "max(score" not in plan and "fraud_alert_key" not in plan


def test_a_version_leaves_no_shuffle_files_and_compact_ones(spark, tmp_path):
    rows = spark.range(4000).select(F.format_string("KEY-%08d", "id").alias("key"), (F.col("id") % 7).alias("v"))
    state, before = SnapshotHistory(spark, str(tmp_path), rows.schema, ["key"], buckets=4), shuffle_files(spark)
    for version in (1, 2):
        assert state.apply(rows.where(F.col("id") % 5 != version).withColumn("v", F.col("v") * version), version)
    assert not shuffle_files(spark) - before
    files = glob.glob(f"{tmp_path}/*/**/*.parquet", recursive=True)
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert state.current().count() == 3200 and state.history().where("v = 0 AND __END_AT IS NULL").count() > 0


def test_large_sources_go_one_at_a_time(spark, monkeypatch):
    running, most, lock = [0], [0], threading.Lock()

    def slow(spark, sf, table):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.2)
        with lock:
            running[0] -= 1
        return table

    monkeypatch.setattr(H, "history", slow)
    tables = ["card", "account", "merchant", "customer_kyc"]
    for limit, together in ((1 << 60, True), (0, False)):
        most[0] = 0
        monkeypatch.setattr(H, "ONE_BY_ONE_BYTES", limit)
        assert H.histories(spark, SF_SMALL, tables) == tables
        assert (most[0] > 1) == together
