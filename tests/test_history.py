"""Keyed snapshot history and its change log: equal to the batch form, replay safe, bounded rewrites."""

import os

import pytest
from pyspark.sql import functions as F

from vaultline.operators import scd
from vaultline.operators.history import SnapshotHistory
from vaultline.sources.committed import AppendLog, BucketTable

SCHEMA = "key STRING, part BIGINT, address STRING, note STRING, day INT"


def snap(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


SERIES = {
    1: [("K", 1, "a", None, 1), ("L", 1, "x", "n", 1), (None, 1, "null key", None, 1)],
    2: [("K", 1, "a", None, 2), ("K", 1, "b", None, 2), ("L", 1, "x", "n", 1), (None, 1, "null key", None, 1)],  # K twice
    3: [("K", 1, None, "b", 3), ("L", 1, "x", "n", 1)],  # a value moves to the next column; the NULL key is gone
    4: [],  # an empty snapshot closes every key
    5: [("L", 1, "x", "n", 5), ("M", 2, "y", None, 5)],
}


@pytest.fixture
def state(spark, tmp_path):
    return SnapshotHistory(spark, str(tmp_path), snap(spark, SERIES[1]).schema, ["key", "part"], untracked=["day"], buckets=8)


def test_history_and_log(spark, state):
    for v, rows in SERIES.items():
        assert state.apply(snap(spark, rows), v)
        assert not state.apply(snap(spark, rows), v)  # a replayed batch adds nothing
    assert state.log.versions() == list(SERIES)
    got = {(r.key, r.address, r.note, r.day, r[scd.START], r[scd.END]) for r in state.history().collect()}
    assert got == {
        ("K", "a", None, 1, 1, 2), ("K", "b", None, 2, 2, 3), ("K", None, "b", 3, 3, 4), ("L", "x", "n", 1, 1, 4),
        ("L", "x", "n", 5, 5, None), (None, "null key", None, 1, 1, 3), ("M", "y", None, 5, 5, None),
    }
    kinds = {(r._commit_version, r._change_type): r["count"] for r in state.log.read(state.log_schema).groupBy("_commit_version", "_change_type").count().collect()}
    assert kinds[1, "insert"] == 3 and kinds[2, "insert"] == 1 and kinds[2, "update_postimage"] == 1
    assert kinds[3, "update_preimage"] == kinds[3, "update_postimage"] == 2 and kinds[4, "update_postimage"] == 2
    assert rows_of(state.active_versions()) == rows_of(spark.createDataFrame([("L", 1, 5), ("M", 2, 5)], f"key STRING, part BIGINT, {scd.START} BIGINT"))


def test_equal_to_the_batch_form(spark, state):
    series = {v: [r for r in rows if r[0]] for v, rows in SERIES.items() if v < 4}
    for v, rows in series.items():
        state.apply(snap(spark, rows), v)
    whole = spark.createDataFrame([(*r, v) for v, rows in series.items() for r in rows], SCHEMA + ", version BIGINT")
    assert rows_of(state.history()) == rows_of(scd.scd2_from_snapshots(whole, ["key", "part"], track_except=["day"]))


def test_type_1(spark, tmp_path):
    table = SnapshotHistory(spark, str(tmp_path), snap(spark, SERIES[1]).schema, ["key", "part"], scd=1, buckets=4)
    for v, rows in SERIES.items():
        table.apply(snap(spark, rows), v)
    assert rows_of(table.current()) == rows_of(snap(spark, SERIES[5]))
    last = table.log.read(table.log_schema, after=3)
    assert sorted((r.key, r._change_type) for r in last.collect()) == [("K", "delete"), ("L", "delete"), ("L", "insert"), ("M", "insert")]


def test_a_late_version_is_set_aside(spark, state):
    state.apply(snap(spark, SERIES[1]), 1)
    state.apply(snap(spark, SERIES[3]), 3)
    before = rows_of(state.history())
    assert not state.apply(snap(spark, SERIES[2]), 2)
    assert rows_of(state.history()) == before
    assert state.rejected.versions() == [2] and state.apply(snap(spark, SERIES[4]), 4)


def test_a_version_that_failed_after_its_log(spark, state, monkeypatch):
    state.apply(snap(spark, SERIES[1]), 1)
    commit = BucketTable.commit
    monkeypatch.setattr(BucketTable, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        state.apply(snap(spark, SERIES[2]), 2)
    assert state.latest() == 1
    monkeypatch.setattr(BucketTable, "commit", commit)
    assert state.apply(snap(spark, SERIES[2]), 2)
    assert {(r.key, r.address, r[scd.END]) for r in state.history().collect()} == {
        ("K", "a", 2), ("K", "b", None), ("L", "x", None), (None, "null key", None)}


def test_a_version_is_dealt_by_key_once(spark, state, monkeypatch):
    """Log, closed and open rows come from one aggregate and one write: no join, no second shuffle, no sort for the write."""
    state.apply(snap(spark, SERIES[1]), 1)
    plan = state._step(snap(spark, SERIES[2]), 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    monkeypatch.setattr(type(state.open._folder), "write_text", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):  # all is staged and adopted, the manifest is not written
        state.apply(snap(spark, SERIES[2]), 2)
    monkeypatch.undo()
    assert state.latest() == 1 and state.apply(snap(spark, SERIES[2]), 2)
    assert {(r.key, r.address, r[scd.END]) for r in state.history().collect()} == {
        ("K", "a", 2), ("K", "b", None), ("L", "x", None), (None, "null key", None)}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "24"


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    base = spark.range(20_000).select(F.col("id").alias("key"), F.lit("v").alias("value"))
    table = SnapshotHistory(spark, str(tmp_path), base.schema, ["key"], buckets=200)
    table.apply(base, 1)
    few = table.open.bucket() < 2  # changes in 1 % of the buckets
    table.apply(base.withColumn("value", F.when(few, "w").otherwise(F.col("value"))), 2)
    written = table.open.manifest()
    assert sum(v == 2 for v in written.values()) == 2 and len(written) == 200
    assert table.log.read(table.log_schema, after=1).count() == 3 * base.where(few).count()
    table.apply(base.withColumn("value", F.lit("z")), 3)
    table.apply(base.withColumn("value", F.lit("z")), 4)  # nothing changes, nothing is written
    assert set(table.open.manifest().values()) == {3} and table.open.versions() == [3, 4]
    assert {n for n in os.listdir(f"{tmp_path}/open/data") if not n.startswith(".")} <= {"v3", "v4"}  # old versions are pruned


def test_a_version_of_the_log_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    log, rows = AppendLog(spark, str(tmp_path)), spark.range(10)
    monkeypatch.setattr(log._folder, "rename", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        log.append(rows, 1)
    assert log.versions() == [] and log.read(rows.schema).count() == 0
    again = AppendLog(spark, str(tmp_path))
    assert again.append(rows, 1) and not again.append(rows, 1) and again.append(rows, 2)
    assert again.read(rows.schema).count() == 20 and again.read(rows.schema, after=1).count() == 10

    def stream_all():
        q = (again.stream(rows.schema).writeStream.format("parquet").option("path", f"{tmp_path}/out")
             .option("checkpointLocation", f"{tmp_path}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
        return spark.read.schema(rows.schema).parquet(f"{tmp_path}/out").count()

    assert stream_all() == 20
    again.append(rows, 3)
    assert stream_all() == 30
