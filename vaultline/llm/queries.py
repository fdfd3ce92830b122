"""One query per operator, with production parameters over the whole ``documents`` table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm import bpe, fingerprints, licenses, line_dedup, packing, pii, quality, queries_text, sharding, simhash, token_counts
from vaultline.llm.common import documents, settings


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings(spark)
    pieces = packing.pack(documents(spark, sf_dir))
    return pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings(spark)
    kept = line_dedup.drop_repeated_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT r, doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM docs
), keyed AS (
  SELECT r, doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), frequent AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (WHERE k IN (SELECT k FROM frequent))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE k NOT IN (SELECT k FROM frequent)), '')) AS kept_sha256
FROM keyed GROUP BY r, doc_id
"""


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings(spark)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    marked = simhash.near_duplicates(docs, keep=["doc_id"])
    return marked.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings(spark)
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = fingerprints.with_next(fingerprints.sketches(docs), "doc_id", ["text", "sketch"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    both = fingerprints.sketches(pairs.withColumn("edited", edited), "edited", "edited_sketch")
    return both.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings(spark)
    placed = sharding.kd_shards(documents(spark, sf_dir))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings(spark)
    return token_counts.token_counts(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings(spark)
    judged = quality.judge(documents(spark, sf_dir), keep=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings(spark)
    coded = bpe.decode(bpe.encode(documents(spark, sf_dir).select("doc_id", "text")).drop("text"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings(spark)
    found = pii.find(documents(spark, sf_dir), keep=["doc_id"])
    base = F.filter("spans", lambda x: x.base)
    count = lambda kind: F.size(F.filter(base, lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(pii.as_text(base), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans")
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings(spark)
    found = licenses.scan(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "canonical_sha256", "license_id", F.array_join("notices", ";").alias("notices"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack": op1_pack,
    "op2_line_dedup": op2_line_dedup,
    "op3_simhash": op3_simhash,
    "op4_fingerprints": op4_fingerprints,
    "op5_shard": op5_shard,
    "op6_token_counts": op6_token_counts,
    "op7_quality": op7_quality,
    "op8_bpe": op8_bpe,
    "op9_pii": op9_pii,
    "op10_licenses": op10_licenses,
    **queries_text.QUERIES,
}

ORACLE: dict[str, str] = {"op2_line_dedup": OP2_SQL, "op10_licenses": licenses.oracle_sql(), **queries_text.ORACLE}
