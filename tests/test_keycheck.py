"""Declared references and unique keys, all in one pass."""

import re

from vaultline.operators.keycheck import Reference, reference_orphans, repeated_keys


def _tables(spark):
    made = {
        "parent": spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, None)], "id INT, code STRING"),
        "child": spark.createDataFrame([(1, 1, "a"), (2, 9, "z"), (3, 9, None), (4, None, "")], "id BIGINT, parent_id BIGINT, code STRING"),
        "empty": spark.createDataFrame([], "id INT, parent_id STRING"),
        "text": spark.createDataFrame([("1",), ("01",), ("x",), ("7",)], "parent_id STRING"),
        "tree": spark.createDataFrame([(1, None), (2, 1), (3, 8)], "id INT, up INT"),
    }
    return made.__getitem__


def test_orphans(spark):
    refs = [Reference("child", "parent_id", "parent", "id"), Reference("child", "code", "parent", "code"),
            Reference("empty", "parent_id", "parent", "id"), Reference("text", "parent_id", "parent", "id"),
            Reference("tree", "up", "tree", "id"), Reference("child", "parent_id", "empty", "id")]
    got = {(r.child_table, r.child_column, r.parent_table): r.orphan_records for r in reference_orphans(_tables(spark), refs).collect()}
    assert got == {
        ("child", "parent_id", "parent"): 2,   # 9 twice; NULL refers to nothing
        ("child", "code", "parent"): 2,        # "z" and the empty text
        ("empty", "parent_id", "parent"): 0,
        ("text", "parent_id", "parent"): 2,    # "01" is 1; "x" and 7 have no parent
        ("tree", "up", "tree"): 1,             # a table that refers to itself
        ("child", "parent_id", "empty"): 3,    # the same column to a parent without rows
    }


def test_repeated(spark):
    got = {(r.table_name, r.key_columns): tuple(r)[2:] for r in repeated_keys(
        _tables(spark), [("parent", ("id",)), ("parent", ("id", "code")), ("child", ("id",)), ("empty", ("id",))]).collect()}
    assert got == {("parent", "id"): (2, 1, 1), ("parent", "id+code"): (3, 1, 1), ("child", "id"): (4, 0, 0), ("empty", "id"): (0, 0, 0)}


def test_one_scan_a_table_and_no_join_of_rows(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(50).selectExpr("id", "id % 5 AS x", "id % 3 AS y").write.parquet(f"{tmp_path}/{name}")
    refs = [Reference(c, col, p, "id") for c in "ab" for p in "ab" for col in ("x", "y")]
    out = reference_orphans(lambda t: spark.read.parquet(f"{tmp_path}/{t}"), refs)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall("FileScan", plan)) == 2
    assert "SortMergeJoin" not in plan
    assert {r.orphan_records for r in out.collect()} == {0}
