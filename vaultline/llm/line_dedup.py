"""Line deduplication: drop every line whose normalised form stands in too many documents.

Lines are exploded as digests only; texts are never exploded.  Digests are
counted per document (map-side partial counts), the frequent ones are joined
back to (text, position), and every text is rebuilt from the positions it
keeps.  Texts are joined by a 128-bit content key, as equal texts have equal
results, so rows need no unique id and repeated rows cause no mixing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import WHITE, ascii_lower, content_key, from_row, whole_row

MIN_DOCUMENTS = 10
MIN_KEY_CHARS = 1


def line_key(line: Column) -> Column:
    """ASCII white space stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def drop_repeated_lines(
    df: DataFrame,
    text_col: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    min_key_chars: int = MIN_KEY_CHARS,
    n_lines: str = "n_lines",
    n_dropped: str = "n_dropped",
) -> DataFrame:
    """Replace ``text_col`` by the lines that stay and add the two counts (both long).

    A row is a document: a line that a document repeats counts once, and
    repeated rows count once each.  NULL and empty texts are one empty line
    (its key is shorter than ``min_key_chars``, so it stays and the text is
    empty).  Other columns pass unchanged; columns with the two counts' names
    are replaced.
    """
    kept = [c for c in df.columns if c not in (n_lines, n_dropped)]
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    a, b = content_key(text)
    base = df.select(whole_row(kept), F.split(text, "\n", -1).alias("lines"), a.alias("key_a"), b.alias("key_b"))

    def digest_of(line: Column) -> Column:
        key = line_key(line)
        return F.when(F.length(key) >= min_key_chars, F.md5(key))

    digests = base.select("key_a", "key_b", F.transform("lines", digest_of).alias("digests"))
    frequent = (
        digests.select(F.explode(F.array_distinct("digests")).alias("digest"))
        .where(F.col("digest").isNotNull())
        .groupBy("digest")
        .count()
        .where(F.col("count") >= min_documents)
        .select("digest")
    )
    # posexplode_outer: before a plain posexplode the optimizer tests the array's size, which builds every digest twice.
    dropped = (
        digests.select("key_a", "key_b", F.posexplode_outer("digests").alias("at", "digest"))
        .where(F.col("digest").isNotNull())
        .join(frequent, "digest")
        .groupBy("key_a", "key_b")
        .agg(F.collect_set("at").alias("gone"))
    )
    joined = base.join(dropped, ["key_a", "key_b"], "left").withColumn("total", F.size("lines"))
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    stay = F.array_except(F.sequence(F.lit(0), F.col("total") - 1), gone)
    rebuilt = F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n")
    return joined.withColumn("stay", stay).select(
        *[rebuilt.alias(c) if c == text_col else x for c, x in zip(kept, from_row(kept))],
        F.col("total").cast("long").alias(n_lines),
        (F.col("total") - F.size("stay")).cast("long").alias(n_dropped),
    )
