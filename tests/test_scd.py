from pyspark.sql import functions as F
from pyspark.sql import Window

from vaultline.operators import scd


def _snaps(spark):
    rows = [  # key, tracked, untracked, version
        ("A", "x", "d1", 1), ("B", "y", "d1", 1),
        ("A", "x", "d2", 2), ("B", "z", "d2", 2),            # A untracked change, B tracked change
        ("B", "z", "d3", 3), ("C", "w", "d3", 3),            # A deleted, C inserted
        ("A", "x", "d4", 4), ("B", "z", "d4", 4), ("C", "w", "d4", 4),   # A re-inserted
    ]
    return spark.createDataFrame(rows, "k STRING, attr STRING, meta STRING, version INT")


def test_scd2_semantics(spark):
    h = scd.scd2_from_snapshots(_snaps(spark), ["k"], "version", track_except=("meta",))
    got = sorted((r["k"], r["attr"], r["meta"], r["__START_AT"], r["__END_AT"]) for r in h.collect())
    assert got == [("A", "x", "d2", 1, 3), ("A", "x", "d4", 4, None), ("B", "y", "d1", 1, 2),
                   ("B", "z", "d4", 2, None), ("C", "w", "d4", 3, None)]


def test_scd2_invariants_and_incremental_equivalence(spark):
    snaps = _snaps(spark)
    batch = scd.scd2_from_snapshots(snaps, ["k"], "version", track_except=("meta",))
    # exactly one open version per present key, intervals disjoint
    assert batch.filter(F.col("__END_AT").isNull()).groupBy("k").count().filter("count > 1").count() == 0
    w = Window.partitionBy("k").orderBy("__START_AT")
    overl = batch.withColumn("nxt", F.lead("__START_AT").over(w)).filter("nxt < __END_AT").count()
    assert overl == 0
    hist = None
    for v in (1, 2, 3, 4):
        s = snaps.filter(F.col("version") == v).drop("version")
        hist = (s.withColumn("__START_AT", F.lit(v).cast("bigint")).withColumn("__END_AT", F.lit(None).cast("bigint"))
                if hist is None else scd.scd2_apply_snapshot(hist, s, ["k"], v, track_except=("meta",)))
    key = lambda df: sorted(tuple(r) for r in df.select("k", "attr", "meta", "__START_AT", "__END_AT").collect())
    assert key(hist) == key(batch)


def test_change_feed(spark):
    feed = scd.change_feed(_snaps(spark), ["k"], "version")
    got = sorted((r.k, r._change_type, r._commit_version) for r in feed.collect())
    assert ("A", "delete", 3) in got and ("A", "insert", 4) in got and ("C", "insert", 3) in got
    assert ("B", "update_preimage", 2) in got and ("B", "update_postimage", 2) in got


def test_as_of(spark):
    h = scd.scd2_from_snapshots(_snaps(spark), ["k"], "version", track_except=("meta",))
    assert sorted(r.k for r in scd.as_of(h, 3).collect()) == ["B", "C"]
