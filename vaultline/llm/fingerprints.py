"""Document fingerprints: bottom-k sketches of word-shingle hashes, in SQL functions only.

A sketch is the ``k`` smallest distinct 64-bit hashes of a text's shingles,
ascending.  Sketches of parts merge into the sketch of the whole; two
sketches estimate resemblance (Jaccard) and containment, one estimates the
number of distinct shingles.  With fewer than ``k`` shingles all are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vaultline.llm.common import WHITE, WHITE_RE, cols, fresh, from_row, shuffle_partitions, whole_row

K = 128
SHINGLE_WORDS = 5


def sketch_of(words: Column, k: int = K, shingle_words: int = SHINGLE_WORDS) -> Column:
    """Bottom-k sketch of an array of words (its hashes; fewer words than a shingle: one shingle)."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return bottom(shingle_hashes(hashed, shingle_words), k)


def shingle_hashes(hashed: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """Hashes of all shingles of an array of word hashes, in text order."""
    last = F.greatest(F.size(hashed) - (shingle_words - 1), F.lit(1))
    shingles = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(hashed, i, shingle_words)))
    return F.when(F.size(hashed) > 0, shingles).otherwise(F.array().cast("array<bigint>"))


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def words_of(text: Column) -> Column:
    """Words between ASCII white space; none for a blank text."""
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_RE))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what two sketches stand for."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(parts: DataFrame, by: str, sketch: str, k: int = K) -> DataFrame:
    """Sketch of the union of all parts with one key (map-side: distinct hashes per key, ranked within bounds)."""
    hashes = parts.select(by, F.explode(sketch).alias("hash")).distinct()
    ranked = hashes.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy("hash"))).where(F.col("rank") <= k)
    return ranked.groupBy(by).agg(F.sort_array(F.collect_list("hash")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity; two empty sketches are alike (1)."""
    joint = merge(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(joint, a), b))
    return F.when(F.size(joint) == 0, F.lit(1.0)).otherwise(shared / F.size(joint))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has: of a's hashes under the largest that both sketches cover."""
    whole_a, whole_b = F.size(a) < k, F.size(b) < k
    top = F.lit((1 << 63) - 1)
    bound = F.least(F.when(whole_a, top).otherwise(F.array_max(a)), F.when(whole_b, top).otherwise(F.array_max(b)))
    covered = F.filter(a, lambda h: h <= bound)
    return F.when(F.size(a) == 0, F.lit(1.0)).when(F.size(covered) == 0, F.lit(0.0)).otherwise(
        F.size(F.array_intersect(covered, b)) / F.size(covered)
    )


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles (exact below k)."""
    share = (F.array_max(sketch).cast("double") + float(1 << 63)) / float(1 << 64)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise(F.lit(float(k - 1)) / share)


def as_text(sketch: Column) -> Column:
    """16 hexadecimal digits per hash, one after the other."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def sketches(df: DataFrame, text_col: str = "text", out: str = "sketch", k: int = K, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Add the sketch of every whole text (NULL: empty).  All rows and other columns pass."""
    text, hashed = fresh(df, "text_", "hashed")
    kept = [c for c in df.columns if c != out]
    words = words_of(F.coalesce(df[text_col].cast("string"), F.lit("")))
    step = df.withColumn(text, words).withColumn(hashed, F.transform(F.col(text), lambda w: F.xxhash64(w)))
    return step.withColumn(out, bottom(shingle_hashes(F.col(hashed), shingle_words), k)).select(*cols(kept), out)


def with_next(df: DataFrame, order_col: str, columns: list[str]) -> DataFrame:
    """Add ``next_<column>``: the columns of the next row by ``order_col``; the first row follows the last.

    NULLs come first; equal order values go by the columns themselves.  The
    rows are dealt once, by ranges of ``order_col`` whose bounds are quantiles
    from a sketch, ordered within their range, and the last row of each range
    gets the first row of the next range by a join on the range number: as
    many rows as there are ranges, never a broadcast of texts.
    """
    parts = shuffle_partitions(df.sparkSession)
    shares = [i / parts for i in range(1, parts)] or [0.5]
    bounds = df.agg(F.percentile_approx(order_col, shares, 10 * max(parts, 1000))).first()[0] or []
    limits = F.array(*[F.lit(b) for b in sorted(set(bounds))]).cast(f"array<{df.schema[order_col].dataType.simpleString()}>")
    base = df.select(whole_row(df.columns), F.col(order_col).alias("key"), F.struct(*columns).alias("payload"))
    number = F.size(F.filter(limits, lambda b: b <= F.col("key")))
    dealt = base.withColumn("part", F.when(F.col("key").isNull(), 0).otherwise(number))
    # The first order value of each range: one small row per range.
    ranges = dealt.groupBy("part").agg(F.min("key").alias("least"), F.count_if(F.col("key").isNull()).alias("nulls")).collect()
    if not ranges:
        return df.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    filled = sorted(r["part"] for r in ranges)
    before = {p: filled[i - 1] for i, p in enumerate(filled)}  # the first range follows the last
    in_part = Window.partitionBy("part").orderBy(F.col("key").asc_nulls_first(), "payload")
    chained = dealt.withColumn("given", F.lead("payload").over(in_part)).withColumn(
        "at_end", F.lead(F.lit(True)).over(in_part).isNull()
    )
    is_first = F.col("key").isin([r["least"] for r in ranges if r["least"] is not None])
    if any(r["nulls"] for r in ranges):
        is_first = is_first | F.col("key").isNull()
    first_of = F.get(F.array(*[F.lit(before.get(p, -1)) for p in range(filled[-1] + 1)]), F.col("part"))
    heads = dealt.where(is_first).withColumn("n", F.row_number().over(in_part)).where("n = 1").select(
        first_of.alias("first_of"), F.col("payload").alias("head")
    )
    joined = chained.join(heads, (chained.part == heads.first_of) & chained.at_end, "left")
    follower = F.coalesce("given", "head")
    return joined.select(*from_row(df.columns), *[follower[c].alias(f"next_{c}") for c in columns])
