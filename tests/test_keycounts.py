"""Holder counts kept from a change log against regrouping the current rows."""

import random

from pyspark.sql import functions as F

from vaultline.operators.history import SnapshotHistory
from vaultline.operators.keycounts import HOLDERS, KeyCounts

SCHEMA = "link_id STRING, national_id STRING, business_date INT"


def kept(counts):
    return {r[0]: r[1] for r in counts.counts().collect()}


def regrouped(state):
    rows = state.current().select(F.upper(F.trim("national_id")).alias("v")).where("v IS NOT NULL")
    return {r[0]: r[1] for r in rows.groupBy("v").count().collect()}


def test_counts_follow_the_log(spark, tmp_path):
    rng = random.Random(5)
    schema = spark.createDataFrame([], SCHEMA).schema
    for scd in (1, 2):
        state = SnapshotHistory(spark, f"{tmp_path}/s{scd}", schema, ["link_id"], scd, ["business_date"], buckets=4)
        counts = KeyCounts(spark, f"{tmp_path}/c{scd}", schema["national_id"], buckets=4)
        for v in (1, 2, 3, 4):
            # keys come and go, values move between keys, only the date moves; the third snapshot is empty
            rows = [(f"k{i}", rng.choice(["a", " A", "b", "c", "d", None]), rng.randint(1, 2)) for i in range(12) if rng.random() < 0.8]
            state.apply(spark.createDataFrame([] if v == 3 else rows, SCHEMA), v)
            counts.catch_up(state)
            assert kept(counts) == regrouped(state)
            counts.catch_up(state)                      # nothing new, nothing counted again
            assert kept(counts) == regrouped(state) and counts.latest() == v


def test_a_version_that_failed_is_counted_once(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    state = SnapshotHistory(spark, f"{tmp_path}/s", schema, ["link_id"], buckets=2)
    counts = KeyCounts(spark, f"{tmp_path}/c", schema["national_id"], buckets=2)
    state.apply(spark.createDataFrame([("k1", "a", 1), ("k2", "a", 1)], SCHEMA), 1)
    counts.catch_up(state)
    state.apply(spark.createDataFrame([("k1", "a", 1), ("k2", "b", 1)], SCHEMA), 2)
    counts.catch_up(state)
    counts.state._folder.delete("_manifests/v2")        # as after a crash before the manifest
    assert kept(counts) == {"A": 2}
    counts.catch_up(state)
    assert kept(counts) == {"A": 1, "B": 1}


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    state = SnapshotHistory(spark, f"{tmp_path}/s", schema, ["link_id"], buckets=2)
    counts = KeyCounts(spark, f"{tmp_path}/c", schema["national_id"], buckets=16)
    state.apply(spark.createDataFrame([(f"k{i}", f"v{i // 2}", 1) for i in range(100)], SCHEMA), 1)
    counts.catch_up(state)
    batch = spark.createDataFrame([("k1", "v0", 1), ("k3", None, 1)], SCHEMA)
    found = counts.repeated(batch)
    assert len({f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}) == 1
    assert "V0" in {r[0] for r in found.collect()}
    assert counts.repeated(batch.where("national_id IS NULL")).count() == 0
    assert HOLDERS not in found.columns
