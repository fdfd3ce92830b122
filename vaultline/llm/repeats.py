"""Suffix-array deduplication of long repeated byte strings by distributed prefix doubling.

Removed is every byte that is covered by a string of ``threshold`` bytes
which also starts earlier.  Positions do not enter the sort one by one: all
start positions whose string contains the same anchor form an interval, and an
interval is one row.  (The anchor of a string is its window of ``core`` bytes
with the least hash, the first of equal ones: equal strings have equal anchors
at equal distances, so they meet whatever surrounds them.)

1. Anchors whose core is unique in the corpus drop out; what is left is kept
   as a bitmap of bounded size, whose foreign keys the sort drops.
2. Intervals with equal whole contexts are one class: the first stays, the
   others are repeats from end to end.  A passage copied a million times is one
   row from here on.
3. Prefix doubling: the intervals are split at growing offsets, each half takes
   the bytes that all its strings have next to the core, the pairs (rank of the
   core, bytes at the offset) are sorted by Spark and ranked again.  Unique ranks
   drop out, equal contexts are one class, and the core grows until it is the
   whole string.

No step gathers a rank in one task: pairs are counted with map-side sums, and
members are joined to their class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.llm.bytehash import pieces, windows
from vaultline.llm.common import content_key, discard, publish, python_side
from vaultline.llm.membership import bitmap, contains

THRESHOLD = 100
_SLICE = 1 << 18  # bytes looked at together; a longer text is read in slices that overlap by threshold - 1
_ROWS = 1 << 14  # rows of one batch sent on


def core_bytes(threshold: int) -> int:
    """The largest power of two up to a third of the threshold (1 at least)."""
    return 1 << max(0, (threshold // 3).bit_length() - 1)


def _least(values: np.ndarray, count: int) -> np.ndarray:
    """Least of every ``count`` consecutive values."""
    have = 1
    while 2 * have <= count:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (count - have)], values[count - have :]) if have < count else values


class Slices:
    """Texts of one batch, in buffers of bounded size: (rows, starts in the buffer, starts in the text, buffer)."""

    def __init__(self, texts: Iterator[bytes], threshold: int) -> None:
        self.texts, self.threshold = texts, threshold

    def __iter__(self) -> Iterator[tuple[list[int], list[int], list[int], bytes]]:
        rows, starts, froms, held, size = [], [], [], [], 0
        for row, data in enumerate(self.texts):
            for at in range(0, max(0, len(data) - self.threshold + 1), _SLICE):
                part = data[at : at + _SLICE + self.threshold - 1]
                rows.append(row)
                starts.append(size)
                froms.append(at)
                held.append(part)
                size += len(part)
                if size >= _SLICE:
                    yield rows, starts, froms, b"".join(held)
                    rows, starts, froms, held, size = [], [], [], [], 0
        if held:
            yield rows, starts, froms, b"".join(held)


class Intervals:
    """Intervals of start positions with a common anchor, in one buffer of texts.

    ``low`` and ``high`` are the first and the last start, ``place`` is where
    the anchor stands, ``text`` says which of the buffer's parts it is.
    """

    def __init__(self, starts: list[int], buffer: bytes, threshold: int) -> None:
        core = core_bytes(threshold)
        self.data = np.frombuffer(buffer, np.uint8)
        hashes = windows(self.data, core)
        bits = np.uint64((1 << len(buffer).bit_length()) - 1)
        # The place in the low bits: the first of equal hashes is the least.
        placed = (hashes & ~bits) | np.arange(len(hashes), dtype=np.uint64)
        place = (_least(placed, threshold - core + 1) & bits).astype(np.int64)
        first = np.asarray(starts, np.int64)
        sizes = np.diff(np.append(first, len(buffer)))
        text = np.repeat(np.arange(len(first)), sizes)[: len(place)]
        whole = np.arange(len(place)) + threshold <= (first + sizes)[text]
        changes = (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | (whole[1:] != whole[:-1])
        low = np.concatenate([[0], np.flatnonzero(changes) + 1])
        high = np.append(low[1:], len(place)) - 1
        keep = whole[low]
        self.low, self.high = low[keep], high[keep]
        self.place, self.text = place[self.low], text[self.low]
        self.core = hashes[self.place]


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    return (x.as_py() for x in batch.column(batch.num_columns - 1))


def _anchors(source: DataFrame, threshold: int) -> DataFrame:
    """(core, n): the anchors' hashes, counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, starts, _, buffer in Slices(_texts(batch), threshold):
                keys, counts = np.unique(Intervals(starts, buffer, threshold).core, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["core", "n"])

    found = source.select("text").mapInArrow(run, "core long, n long")
    return found.groupBy("core").agg(F.sum("n").alias("n"))


def _intervals(source: DataFrame, threshold: int, known: np.ndarray, by_place: bool) -> DataFrame:
    """Intervals that pass a bitmap: of anchors' hashes, or (``by_place``) of text hash and place; these carry their context.

    core and context are hashes; ``low`` is the first start in the text,
    ``before`` its distance to the anchor, ``span`` how many further starts.
    """
    kind = source.schema["id"].dataType
    fields = [("core", T.LongType()), ("context", T.LongType()), ("before", T.IntegerType()), ("span", T.IntegerType()), ("id", kind), ("th", T.LongType()), ("low", T.LongType())]
    schema = T.StructType([T.StructField(*f) for f in (fields + [("bytes", T.BinaryType())] if by_place else fields)])
    bits = source.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(1).to_numpy()
            for rows, starts, froms, buffer in Slices(_texts(batch), threshold):
                found = Intervals(starts, buffer, threshold)
                row = np.asarray(rows)[found.text]
                low = found.low - np.asarray(starts)[found.text] + np.asarray(froms)[found.text]
                key = _place_key(marks[row], low) if by_place else found.core
                at = np.flatnonzero(contains(bits.value, key))
                if not len(at):
                    continue
                ends = found.high[at] + threshold
                out = [
                    found.core[at].view(np.int64),
                    pieces(found.data, found.low[at], ends).view(np.int64),
                    (found.place - found.low)[at].astype(np.int32),
                    (found.high - found.low)[at].astype(np.int32),
                    batch.column(0).take(pa.array(row[at])),
                    marks[row[at]],
                    low[at],
                ]
                if by_place:
                    out.append(pa.array([buffer[a:b] for a, b in zip(found.low[at].tolist(), ends.tolist())], pa.binary()))
                arrays = [x if isinstance(x, pa.Array) else pa.array(x) for x in out]
                for cut in range(0, len(at), _ROWS):
                    yield pa.RecordBatch.from_arrays([x[cut : cut + _ROWS] for x in arrays], names=schema.names)

    return source.select("id", "th", "text").mapInArrow(run, schema)


def _place_key(marks: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Key of a place in a text, as ``_place_column`` has it."""
    return (marks ^ low ^ (low << 32)).view(np.uint64)


def _place_column() -> Column:
    return F.col("th").bitwiseXOR(F.col("low")).bitwiseXOR(F.shiftleft("low", 32))


def _place() -> Column:
    return F.struct("id", "th", "low")


def _repeats(members: DataFrame, classes: DataFrame, key: list[str]) -> DataFrame:
    """Members that are not the first of their class: (id, th, low, span)."""
    several = classes.where("n > 1").select(*key, "first")
    return members.join(several, key).where(~_place().eqNullSafe(F.col("first"))).select("id", "th", "low", "span")


def _halves(items: DataFrame, threshold: int, core: int, step: int) -> DataFrame:
    """Each interval in two: the starts whose strings hold the ``step`` bytes before the core, and the others, whose strings hold those after it."""
    left_span = F.least("span", F.col("before") - step)
    skip = F.greatest(F.lit(0), F.col("before") - step + 1)
    right_span = F.col("span") - skip

    def part(at, length):
        return F.substring("bytes", at + 1, length)

    def half(side: int, low, before, span, pair, text):
        return F.struct(
            F.lit(side).alias("side"), low.alias("low"), before.alias("before"), span.alias("span"), pair.alias("pair"), text.alias("bytes")
        )

    left = half(0, F.col("low"), F.col("before") - step, left_span, part(F.col("before") - step, F.lit(step)), part(F.lit(0), left_span + threshold))
    right = half(1, F.col("low") + skip, F.col("before") - skip, right_span, part(F.col("before") + core, F.lit(step)), part(skip, right_span + threshold))
    both = F.filter(F.array(left, right), lambda x: (x.span >= 0) & (x.before >= 0))
    split = items.select("rank", "id", "th", F.inline(both))
    a, b = content_key(F.struct("rank", "side", "before", "span", "bytes"))
    return split.withColumns({"ka": a, "kb": b})


def repeated(source: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Starts of strings of ``threshold`` bytes that also start earlier, as intervals (id, th, low, span).

    ``source`` has id, th (hash of the text) and text (binary); earlier is by
    id, th and start.
    """
    spark = source.sparkSession
    twice = publish(_anchors(source, threshold).where("n > 1").select("core"), "cores")
    members = publish(_intervals(source, threshold, bitmap(twice, "core"), False), "intervals")
    discard(twice)
    key = ["core", "context", "before", "span"]
    classes = publish(members.groupBy(*key).agg(F.min(_place()).alias("first"), F.count("*").alias("n")), "classes")
    found = [publish(_repeats(members, classes, key), "repeats")]
    shared = classes.groupBy("core").agg(F.count("*").alias("contexts")).where("contexts > 1").select("core")
    firsts = publish(classes.join(shared, "core").select(*key, "first.*"), "firsts")
    discard(members, classes)
    # Their contexts: a second look at the texts, for these intervals only.
    with_bytes = _intervals(source, threshold, bitmap(firsts.select(_place_column().alias("k")), "k"), True)
    again = [*key, "th", "low"]
    f, g = firsts.alias("f"), with_bytes.alias("g")
    same = F.col("f.id").eqNullSafe(F.col("g.id"))
    for c in again:
        same = same & (F.col(f"f.{c}") == F.col(f"g.{c}"))
    items = f.join(g, same).select(F.lit(0).cast("long").alias("rank"), *[F.col(f"g.{c}") for c in ("id", "th", "low", "before", "span", "bytes")])
    items = publish(items.dropDuplicates(["id", "th", "low"]), "contexts")
    discard(firsts)

    core = core_bytes(threshold)
    while core < threshold and not items.isEmpty():
        step = -(-(threshold - core) // 2)
        members = _halves(items, threshold, core, step)
        if core == core_bytes(threshold):  # the first rank is of the whole core
            members = members.withColumn("pair", F.substring("bytes", F.col("before") + 1, F.lit(core + step)))
        groups = ["ka", "kb", "rank", "side", "pair", "before", "span", "bytes"]
        classes = publish(members.groupBy(*groups).agg(F.min(_place()).alias("first"), F.count("*").alias("n")), "classes")
        found.append(publish(_repeats(members, classes, ["ka", "kb"]), "repeats"))
        core += step
        pairs = classes.groupBy("rank", "side", "pair").agg(F.count("*").alias("contexts")).where("contexts > 1").drop("contexts")
        in_order = pairs.repartitionByRange("rank", "side", "pair").sortWithinPartitions("rank", "side", "pair")
        ranks = publish(in_order.withColumn("new", F.monotonically_increasing_id()), "ranks")
        before, items = items, publish(
            classes.join(ranks, ["rank", "side", "pair"]).select(F.col("new").alias("rank"), "first.*", "before", "span", "bytes"), "contexts"
        )
        discard(before, classes, ranks)
    discard(items)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _cut(threshold: int):
    """(text, starts) -> what is left, bytes removed, maximal removed runs."""

    @F.pandas_udf("kept binary, n_removed long, n_spans long")
    def cut(texts: pd.Series, lows: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for text, low, span in zip(texts, lows, spans):
            if text is None:
                rows.append((None, 0, 0))
                continue
            order = np.argsort(low, kind="stable")
            start = low[order]
            end = np.maximum.accumulate(start + span[order] + threshold)
            new = np.concatenate([[True], start[1:] > end[:-1]])
            begins, ends = start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]
            kept = b"".join(text[a:b] for a, b in zip([0, *ends.tolist()], [*begins.tolist(), len(text)]))
            rows.append((kept, len(text) - len(kept), len(begins)))
        return pd.DataFrame(rows, columns=["kept", "n_removed", "n_spans"])

    return cut


def drop_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``df``: the id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary).

    The text is taken as UTF-8 bytes.  Removed is each byte covered by a
    string of ``threshold`` bytes that also starts earlier: in a document
    before (by id, NULL first; of equal ids by a hash of the text), or in the
    same one.  Rows with the same id and text are documents in any order: the
    first keeps what it would keep alone, the others are repeated throughout.
    NULL and empty texts have no bytes; texts under ``threshold`` bytes stay;
    other columns are ignored; an empty table gives no row.
    """
    if threshold < 1:
        raise ValueError("threshold must be positive")
    python_side(df.sparkSession)
    text = F.coalesce(df[text_col].cast("string").cast("binary"), F.lit(b""))
    source = df.select(df[id_col].alias("id"), text.alias("text")).select("id", F.xxhash64(F.lit(42), "text").alias("th"), "text")
    where = repeated(source, threshold)
    lists = where.groupBy("id", "th").agg(F.collect_list("low").alias("lows"), F.collect_list("span").alias("spans"))
    copies = publish(source.groupBy("id", "th").count().where("count > 1"), "copies")
    out = _removed(source, lists, threshold)
    if not copies.isEmpty():
        on = ["ka", "kb"]
        several = _keyed(copies).select(*on, "count")
        rows = _keyed(source).join(several, on).select("id", "th", "text", "count")
        once = rows.groupBy("id", "th", "text").agg(F.max("count").alias("count"))
        more = once.withColumn("i", F.explode(F.expr("sequence(2L, count)")))
        long = F.octet_length("text") >= threshold
        n = F.octet_length("text").cast("long")
        rest = more.select(
            "id", n.alias("n_bytes"), F.when(long, n).otherwise(F.lit(0)).alias("n_removed"), long.cast("long").alias("n_spans"),
            F.when(long, F.lit(b"")).otherwise(F.col("text")).alias("kept"),
        )
        alone = _keyed(source).join(several, on, "left_anti").select("id", "th", "text")
        out = _removed(alone.unionByName(once.select("id", "th", "text")), lists, threshold).unionByName(rest)
    return out.withColumnRenamed("id", id_col)


def _keyed(df: DataFrame) -> DataFrame:
    a, b = content_key(F.struct("id", "th"))
    return df.withColumns({"ka": a, "kb": b})


def _removed(source: DataFrame, lists: DataFrame, threshold: int) -> DataFrame:
    joined = _keyed(source).join(_keyed(lists).select("ka", "kb", "lows", "spans"), ["ka", "kb"], "left")
    cut = _cut(threshold)(F.when(F.col("lows").isNotNull(), F.col("text")), "lows", "spans")
    return joined.withColumn("cut", cut).select(
        "id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        "cut.n_removed",
        "cut.n_spans",
        F.coalesce("cut.kept", "text").alias("kept"),
    )
