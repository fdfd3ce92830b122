"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup, personal data, packing.

Every stage takes all rows its predecessor kept and returns the columns of
``documents``, the last one the packed pieces.  ``run`` writes each stage's
result as Parquet in the shared folder and rereads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vaultline.llm import line_dedup, packing, pii, quality, simhash
from vaultline.llm.common import cols, discard, documents, fresh, publish, scratch, settings, working_tables


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject."""
    settings(spark)
    names = dict(zip(quality.RESULTS, fresh(docs, *quality.RESULTS)))
    return quality.judge(docs, names=names).where(F.col(names["kept"])).select(*cols(docs.columns))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that stand in many documents; the documents stay, with their new length in code points."""
    settings(spark)
    cleaned = line_dedup.drop_repeated_lines(docs)
    return _with_length(cleaned, docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the least id, and of rows that share it the least text."""
    settings(spark)
    fp, group, least, n = fresh(docs, "fp", "group", "least", "n")
    marked = simhash.near_duplicates(docs, fingerprint=fp, cluster=group, component=least)
    # The rows of a group that carry its least id are few, whatever the size of the group.
    first = Window.partitionBy(group).orderBy("text", *cols(docs.columns))
    keepers = marked.where(F.col("doc_id").eqNullSafe(F.col(least)))
    return keepers.withColumn(n, F.row_number().over(first)).where(F.col(n) == 1).select(*cols(docs.columns))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; the documents stay, with their new length in code points."""
    settings(spark)
    return _with_length(pii.redact(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 1024 tokens: one row per piece, with its ids."""
    settings(spark)
    return packing.pack(docs)


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    length = F.char_length("text").cast("long").alias("n_chars")
    return docs.select(*[length if c == "n_chars" else x for c, x in zip(columns, cols(columns))])


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", near_dedup),
    ("personal data", personal_data),
    ("best-fit packing", pack),
]

#: Tokenisation, robust estimates and SimHash have no SQL form; tests/llm compares run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        path = scratch(spark, f"stage-{i}")
        with working_tables(spark):
            before, docs = docs, publish(stage(spark, docs, sf_dir), path=path)
        if i:
            discard(before)
    return docs
