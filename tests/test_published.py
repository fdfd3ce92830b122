"""The declared layout of a published table: enforced, commented, versioned, and read by range."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from vaultline.session import shuffles_end_with_write
from vaultline.sources import fixtures as fx
from vaultline.sources.published import Layout, LayoutError, PublishedTable

LAYOUT = Layout((("k", "string", "the key"), ("day", "int", "when"), ("amount", "decimal(12,2)", "how much")), ("day", "k"), ("k",))


def rows(spark, n, day=None):
    day = F.col("id").cast("int") if day is None else day
    return spark.range(n).select(F.col("id").cast("string").alias("k"), day.alias("day"), (F.col("id") / 2).cast("decimal(12,2)").alias("amount"))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f for f in files if "/shuffle_" in f}


def test_a_frame_that_differs_is_refused(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t", LAYOUT)
    with pytest.raises(LayoutError) as error:
        table.publish(rows(spark, 3).withColumn("day", F.col("day").cast("bigint")).withColumnRenamed("k", "key"))
    assert str(error.value) == "missing k string; undeclared key string; day is bigint, declared int"
    with pytest.raises(PySparkException, match="NULL in k"):
        table.publish(rows(spark, 3).withColumn("k", F.when(F.col("day") > 0, F.col("k"))))
    assert table.versions() == [] and table.read().count() == 0
    assert table.read_between(F.lit(0), F.lit(9)).count() == 0


def test_a_range_reads_few_files(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t", LAYOUT)
    table.publish(rows(spark, 4000).orderBy(F.rand(3)), files=20)
    whole, part = table.read(), table.read_between(F.lit(1000), F.lit(1100))
    assert sorted(r.day for r in part.collect()) == list(range(1000, 1100))
    assert len(part.inputFiles()) <= 2 < 18 <= len(whole.inputFiles())
    assert [f.metadata.get("comment") for f in spark.read.parquet(whole.inputFiles()[0]).schema] == ["the key", "when", "how much"]
    assert table.read_between(F.lit(9000), F.lit(9001)).count() == 0


def test_a_hot_key_spans_files_and_rows_without_a_key_stay(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t", LAYOUT)
    hot = rows(spark, 3000, F.when(F.col("id") % 3 > 0, 7).when(F.col("id") > 2000, None).otherwise(F.col("id").cast("int")))
    table.publish(hot, files=12)
    assert table.read().count() == 3000
    biggest = table.read().groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert biggest < 600
    assert table.read_between(F.lit(7), F.lit(8)).count() == 2000


def test_versions(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t", LAYOUT)
    for n in (5, 6, 7):
        table.publish(rows(spark, n))
    assert table.versions() == [2, 3] and table.read().count() == 7
    table.files.drop(3)                                 # as after a crash before the list of files
    assert table.read().count() == 6
    table.publish(rows(spark, 8))
    assert table.read().count() == 8


def test_long_values_are_made_where_rows_are_written(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t", LAYOUT)
    table.publish(rows(spark, 2000).orderBy(F.rand(5)), files=10, made={"k": F.sha2("k", 256)})
    want = {(r.day, r.k) for r in rows(spark, 2000).withColumn("k", F.sha2("k", 256)).collect()}
    assert {(r.day, r.k) for r in table.read().collect()} == want
    assert len(table.read_between(F.lit(100), F.lit(120)).inputFiles()) <= 2
    with pytest.raises(LayoutError):
        table.publish(rows(spark, 3), made={"k": F.lit(1)})


def test_the_published_context_leaves_no_shuffle_files(spark):
    """Its joins and the dealing of its rows are off the disk once they are written."""
    before = shuffle_files(spark)
    fx.forget()
    got = E.queries()["gold_fraud_transaction_published"](spark, SF_SMALL)
    assert not shuffle_files(spark) - before
    want = E.queries()["gold_fraud_transaction"](spark, SF_SMALL)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_the_setting_is_put_back(spark):
    name, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    with shuffles_end_with_write(spark), shuffles_end_with_write(spark):
        seen.append(spark.conf.get(name))
    assert seen == ["true"] and spark.conf.get(name, None) in (None, "false")
