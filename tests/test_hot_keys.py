"""A key that holds a third of all rows: flagged exactly, without a window."""

from pyspark.sql import functions as F

from vaultline.operators import quarantine as Q


def _customers(spark, n=300):
    rows = []
    for i in range(n):
        hot = i % 3 == 0                                   # one third of all rows share key and national id
        rows.append(("CB-HOT" if hot else f"CB-{i:04d}", "N-HOT" if hot else f"N-{i:04d}",
                     f"04-{i:08d}", "1980-01-01"))
    return spark.createDataFrame(rows, "cust_no STRING, national_id STRING, phone STRING, date_of_birth STRING")


def test_hot_key_duplicates_are_flagged_without_a_window(spark):
    df = _customers(spark)
    a = Q.assess(df, "core_banking_customer")
    flags = a.select(
        (F.col("cust_no") == "CB-HOT").alias("hot"),
        F.array_contains("_failed_rule_names", "core_banking_customer__cust_no__duplicate_active").alias("dup_key"),
        F.array_contains("_failed_rule_names", "core_banking_customer__national_id__duplicate").alias("dup_nid"),
    ).groupBy("hot", "dup_key", "dup_nid").count().collect()
    assert {(r.hot, r.dup_key, r.dup_nid): r["count"] for r in flags} == {(True, True, True): 100,
                                                                         (False, False, False): 200}
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "partial_count" in plan                         # combined on the map side before the shuffle


def test_sequenced_cdc_hot_key_spans_slices_exactly(spark):
    from vaultline.operators import scd

    rows = [("HOT", s, f"v{s}") for s in range(0, 300, 3)]            # one key: a third of all events
    rows += [(f"K{i}", s, f"w{s}") for i in range(100) for s in (5, 1)]  # out of order arrival
    ev = spark.createDataFrame(rows, "k STRING, seq BIGINT, val STRING")
    got = {(r.k, r["__START_AT"]): r["__END_AT"]
           for r in scd.scd2_from_changes(ev, ["k"], "seq", slices=8).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        seqs = sorted(r[1] for r in rows if r[0] == k)
        want.update({(k, a): b for a, b in zip(seqs, seqs[1:] + [None])})
    assert got == want


def test_sequenced_slices_look_one_row_ahead(spark):
    """Unique events need no second aggregate; a slice's last event finds its end in the next slice, also for NULL keys."""
    from vaultline.operators import scd

    ev = spark.createDataFrame([(k, p, s, f"v{s}") for k in (None, "a", "b") for p in (None, 1) for s in range(15)],
                               "k STRING, p BIGINT, seq BIGINT, status STRING")
    out = scd.scd2_from_changes(ev, ["k", "p"], "seq", slices=7, unique=True)
    got = {(r.k, r.p, r.status, r[scd.START], r[scd.END]) for r in out.collect()}
    assert got == {(k, p, f"v{s}", s, s + 1 if s < 14 else None) for k in (None, "a", "b") for p in (None, 1) for s in range(15)}
    assert out.count() == 90
