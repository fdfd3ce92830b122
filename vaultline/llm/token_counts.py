"""Token counts by a separator scan of flat, unindexed token files.

A token file is nothing but ids (little-endian, fixed width), with an
end-of-document id after each document.  Files are read in blocks; NumPy
finds the separators of a block in one vectorised comparison, without
knowing where its first document began.  A prefix scan over the blocks'
totals (tokens, separators, place of the last separator) then gives every
document its start, length and number, also where it spans blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vaultline.llm.common import python_side, scratch
from vaultline.llm.tokens import library_encoder, vocabulary_path

END_ID = 50256
WIDTH = 2  # bytes of an id
BLOCK_TOKENS = 1 << 14
DOCUMENTS_PER_FILE = 2_000  # bounds a file, which Spark's binary reader takes as one row


def write_token_files(
    df: DataFrame, path: str, text_col: str = "text", vocabulary: str | None = None, end_id: int = END_ID, width: int = WIDTH
) -> None:
    """Tokenise whole texts and write them as flat files, in input order, each followed by ``end_id``.

    The separator's own string inside a text is encoded as ordinary text, so
    ``end_id`` stands only between documents.  NULL and empty texts are an
    ``end_id`` alone.  Spark's line writer puts the ids' bytes, and the
    separator's bytes as its line separator; nothing is shuffled.
    """
    python_side(df.sparkSession)
    vocabulary = vocabulary or vocabulary_path()
    kind = f"<u{width}"

    @F.pandas_udf("binary")
    def ids(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = library_encoder(vocabulary, special_as_text=True)
        for texts in parts:
            yield pd.Series([np.frombuffer(encode(x), "<u4").astype(kind).tobytes() for x in texts], dtype=object)

    separator = np.asarray([end_id], kind).tobytes().decode("latin-1")
    out = df.select(ids(df[text_col].cast("string")).cast("string").alias("value"))
    out.write.option("lineSep", separator).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", DOCUMENTS_PER_FILE).text(path)


def separators(spark: SparkSession, path: str, end_id: int = END_ID, width: int = WIDTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per block: file, block, its tokens and the places of its separators (ascending, from 0)."""
    python_side(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    size = block_tokens * width
    count = F.ceil(F.length("content") / size).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(F.col("content"), i * size + 1, F.lit(size)))
    dealt = files.where(F.col("length") > 0).select(
        F.regexp_extract("path", "([^/]+)$", 1).alias("file"), F.posexplode(blocks).alias("block", "content")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [np.frombuffer(x.as_buffer(), f"<u{width}") for x in batch.column(2)]
            places = [np.flatnonzero(x == end_id).astype(np.int32) for x in tokens]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(x) for x in tokens], pa.int64()), pa.array(places, pa.list_(pa.int32()))],
                names=["file", "block", "n", "places"],
            )

    return dealt.mapInArrow(run, "file string, block int, n long, places array<int>")


def count_tokens(spark: SparkSession, path: str, end_id: int = END_ID, width: int = WIDTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per document of the files under ``path``: file, document (from 0 in its file), start, n_tokens, terminated.

    ``n_tokens`` leaves the separator out.  Tokens after a file's last
    separator are a document that is not terminated.  Empty files have none.
    A file holds at most 2 GB (one row of Spark's binary reader), so the scan
    over a file's blocks is a small window.
    """
    blocks = separators(spark, path, end_id, width, block_tokens)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scanned = blocks.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ends = F.transform("places", lambda x: x + F.col("base"))
    scanned = scanned.select("file", "block", "n", "base", ends.alias("ends"))
    last = F.array_max("ends")
    scanned = scanned.withColumn("first", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0))).withColumn(
        "previous", F.coalesce(F.max(last).over(before), F.lit(-1))
    )
    at_end = F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull()
    total = F.col("base") + F.col("n")
    open_tail = at_end & (total > F.greatest(F.coalesce(last, F.lit(-1)), F.col("previous")) + 1)
    scanned = scanned.withColumn("open", open_tail)
    stops = F.when(F.col("open"), F.concat("ends", F.array(total))).otherwise(F.col("ends"))
    starts = F.concat(F.array("previous"), "ends")
    rows = scanned.select("file", "first", "open", F.size("ends").alias("closed"), starts.alias("starts"), F.posexplode(stops).alias("i", "stop"))
    start = F.get("starts", F.col("i")) + 1
    return rows.select(
        "file",
        (F.col("first") + F.col("i")).cast("long").alias("document"),
        start.alias("start"),
        (F.col("stop") - start).alias("n_tokens"),
        (F.col("i") < F.col("closed")).alias("terminated"),
    )


def token_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Write the token files of ``df`` to the shared folder and count their documents' tokens."""
    path = scratch(df.sparkSession, "tokens")
    write_token_files(df, path, text_col)
    return count_tokens(df.sparkSession, path)
