"""Streams into a shared quarantine folder and into sequenced history, also after a batch that is run again."""

import os

from pyspark.sql import functions as F

from vaultline.operators import quarantine as Q
from vaultline.operators import scd
from vaultline.operators.history import SnapshotHistory
from vaultline.streaming import stream as S

AS_OF = "2026-12-01 00:00:00"


def rows_of(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def forget_last_commit(checkpoint):
    """As after a crash: the last batch wrote its output but did not commit."""
    last = max(int(n) for n in os.listdir(f"{checkpoint}/commits") if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")



def test_sources_share_one_quarantine(spark, tmp_path):
    from vaultline.plans import pipeline as P

    sf = "/root/testdata/sf0.001"
    names = ("customer_kyc", "watchlist")
    rows = {t: P.bronze(spark, sf, t) for t in names}
    for t in names:
        rows[t].repartition(3).write.parquet(f"{tmp_path}/in/{t}")

    def run():
        sources = [S.SourceStream(t, S.read_stream(spark, f"{tmp_path}/in/{t}", rows[t].schema, max_files=1), lambda t=t: rows[t]) for t in names]
        S.quarantine_streams(sources, f"{tmp_path}/out", f"{tmp_path}/ckpt", as_of=AS_OF)
        return rows_of(S.quarantine_result(spark, f"{tmp_path}/out"))

    first = run()
    batch = [Q.quarantine_records(Q.assess(rows[t], t, as_of=AS_OF), t, "stream", with_timestamp=False) for t in names]
    assert first == rows_of(batch[0].unionByName(batch[1])) and first
    for t in names:
        forget_last_commit(f"{tmp_path}/ckpt/{t}")
    assert run() == first


def test_superseded_versions_are_not_quarantined(spark, tmp_path):
    from vaultline.plans import pipeline as P

    bronze = P.bronze(spark, "/root/testdata/sf0.001", "customer_kyc")
    state = SnapshotHistory(spark, f"{tmp_path}/state", bronze.schema, ["kyc_id"], buckets=4)
    failing = Q.assess(bronze, "customer_kyc", as_of=AS_OF).where("is_quarantined")
    ids = [r[0] for r in failing.select("kyc_id").limit(2).collect()]
    state.apply(bronze, 1)
    text = next(f.name for f in bronze.schema.fields if f.dataType.simpleString() == "string" and f.name != "kyc_id")
    state.apply(bronze.withColumn(text, F.when(F.col("kyc_id") == ids[0], F.concat(text, F.lit(" v2"))).otherwise(F.col(text))), 2)

    def quarantined(active):
        out = f"{tmp_path}/out-{active is not None}"
        S.quarantine_streams([S.SourceStream("customer_kyc", state.stream(), state.current, active)], out, f"{out}-ckpt", as_of=AS_OF)
        keys = S.quarantine_result(spark, out).where(F.col("source_business_key").isin(*ids))
        return {r[0]: r[1] for r in keys.groupBy("source_business_key").agg(F.countDistinct("quarantine_data_payload")).collect()}

    whole, current = quarantined(None), quarantined(state.active_versions)
    assert whole[ids[0]] > current.get(ids[0], 0) and whole[ids[1]] == current[ids[1]] == 1


EVENTS = [  # (key, sequence, status, operation), in the order of delivery
    [("a", 1, "new", "UPSERT"), ("b", 5, "late first", "UPSERT"), ("a", 9, "end", "UPSERT")],
    [("a", 4, "between", "UPSERT"), ("b", 2, "earlier", "UPSERT"), ("b", 7, None, "DELETE")],
    [("a", 4, "between", "UPSERT"), ("c", 1, "x", "UPSERT")],  # a replay
    [("a", 6, None, "DELETE"), ("b", 8, "again", "UPSERT")],
]
SCHEMA = "key STRING, seq BIGINT, status STRING, op STRING"


def test_sequenced_events_in_any_order(spark, tmp_path):
    for events in EVENTS:
        spark.createDataFrame(events, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    schema = spark.createDataFrame([], SCHEMA).schema
    state = S.SequencedHistory(spark, f"{tmp_path}/state", schema, ["key"], "seq", "op", buckets=4)

    def run():
        S.sequenced_stream(S.read_stream(spark, f"{tmp_path}/in", schema, max_files=1), state, f"{tmp_path}/ckpt")
        return rows_of(state.history())

    got = run()
    whole = spark.createDataFrame([e for events in EVENTS for e in events], SCHEMA)
    assert got == rows_of(scd.scd2_from_changes(whole, ["key"], "seq", "op"))
    versions = {(r.key, r.status, r[scd.START], r[scd.END]) for r in state.history().collect()}
    assert versions == {("a", "new", 1, 4), ("a", "between", 4, 6), ("a", "end", 9, None), ("b", "earlier", 2, 5),
                        ("b", "late first", 5, 7), ("b", "again", 8, None), ("c", "x", 1, None)}
    forget_last_commit(f"{tmp_path}/ckpt")
    assert run() == got


def test_sequenced_batch_touches_its_buckets_only(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    state = S.SequencedHistory(spark, f"{tmp_path}/state", schema, ["key"], "seq", buckets=32)
    state.apply(spark.createDataFrame([(f"k{i}", 1, "s", "UPSERT") for i in range(500)], SCHEMA), 1)
    state.apply(spark.createDataFrame([("k7", 2, "t", "UPSERT")], SCHEMA), 2)
    assert sorted(state.events.manifest().values())[-2:] == [1, 2] and sorted(state.versions.manifest().values())[-2:] == [1, 2]
    assert state.history().where("key = 'k7'").count() == 2


def test_expectations(spark):
    from vaultline.operators.rules import expect_or_drop, expectation_counts

    df = spark.createDataFrame([(1, 0.5), (None, 0.5), (3, 2.0), (4, None)], "id BIGINT, score DOUBLE")
    good = {"has_id": F.col("id").isNotNull(), "in_range": F.col("score").between(0, 1)}
    assert [r.id for r in expect_or_drop(df, good).collect()] == [1]
    counts = {r.expectation: (r.passed_records, r.failed_records) for r in expectation_counts(df, good).collect()}
    assert counts == {"has_id": (3, 1), "in_range": (2, 2), "*": (1, 3)}


def test_open_rows_are_looked_up_a_fixed_number_of_times(spark, tmp_path):
    """A log of many files makes large batches, not many."""
    from vaultline.operators.history import SnapshotHistory

    ids = [f"KYC-{i}" for i in range(6)]
    rows = spark.createDataFrame([(i, "x") for i in ids], "kyc_id STRING, note STRING")
    state = SnapshotHistory(spark, f"{tmp_path}/state", rows.schema, ["kyc_id"], buckets=4)
    for version in range(1, 9):
        state.apply(rows.withColumn("note", F.lit(f"v{version}")), version)
    assert len(state.log.read(state.log_schema).inputFiles()) >= 8
    seen = []
    stream = state.stream(max_files=1, at_most=3)
    (stream.writeStream.foreachBatch(lambda batch, n: seen.append(batch.count())).option("checkpointLocation", f"{tmp_path}/ckpt")
     .trigger(availableNow=True).start().awaitTermination())
    assert len(seen) <= 3 and sum(seen) == state.changes().count()
