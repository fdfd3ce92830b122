"""Ranked lexical search: hybrid of term-at-a-time and document-at-a-time evaluation.

The documents are cut into blocks; each block has its own inverted lists of
the queries' terms.  For one query, the short lists of a block are summed into
accumulators term by term.  The accumulators then act as one more list, with a
bound of its own, beside the long lists, and all lists are read together by
document in windows.  A window whose summed bounds stay under the score of the
k-th best document so far is skipped.  Every task keeps its k best documents
per query; the k best of all tasks are the result.

Three passes over the documents: terms (the tokens are read once and kept as
counts of the queries' terms), frequencies, scores.  Queries are taken in
blocks of bounded size.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vaultline.llm.common import discard, publish, python_side

TOP = 20
BLOCK_ROWS = 8192  # documents whose lists are in memory at once
WINDOW = 256  # documents that share a bound
SHORT = 32  # lists under 1/SHORT of the block are summed into accumulators
QUERY_BYTES = 4 << 20  # texts of one block of queries
_BREAKS = bytes(b for b in range(128) if not chr(b).isalnum())
_TABLE = bytes(32 if b in _BREAKS else b + 32 if 65 <= b <= 90 else b for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order, as UTF-8: runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.encode().translate(_TABLE).split() if text else []


def _count_terms(docs: DataFrame, id_col: str, text_col: str, number: dict[bytes, int]) -> DataFrame:
    """Documents with a term: id, ``n`` (all terms), ``terms`` (numbers of those in ``number``, ascending) and their ``tfs``."""
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("n", T.LongType(), False),
        T.StructField("terms", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("tfs", T.ArrayType(T.LongType(), False), False),
    ])
    look_up = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = look_up.value
        for batch in batches:
            rows, counts, found, tfs, ends = [], [], [], [], [0]
            for at, text in enumerate(batch.column(1).to_pylist()):
                words = terms(text)
                if not words:
                    continue
                held = sorted(Counter(filter(None.__ne__, map(known.get, words))).items())
                rows.append(at)
                counts.append(len(words))
                found += [t for t, _ in held]
                tfs += [n for _, n in held]
                ends.append(len(found))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64())),
                ],
                names=schema.names,
            )

    return docs.select(docs[id_col], docs[text_col].cast("string")).mapInArrow(run, schema)


class Lists:
    """Inverted lists of one block of documents, with their scores and the bounds of each window."""

    def __init__(self, docs: np.ndarray, numbers: np.ndarray, scores: np.ndarray, rows: int) -> None:
        order = np.lexsort((docs, numbers))
        self.docs, self.scores, numbers = docs[order], scores[order], numbers[order]
        known, starts = np.unique(numbers, return_index=True)
        ends = np.append(starts[1:], len(numbers))
        self.rows, self.windows = rows, -(-rows // WINDOW)
        self.at = {int(t): (int(a), int(b)) for t, a, b in zip(known, starts, ends)}
        self.dense: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def short(self, number: int) -> bool:
        a, b = self.at[number]
        return (b - a) * SHORT < self.rows

    def spread(self, docs: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores by document, and the largest of each window."""
        by_doc = np.zeros(self.windows * WINDOW, np.int64)
        np.add.at(by_doc, docs, scores)
        by_doc = by_doc.reshape(self.windows, WINDOW)
        return by_doc, by_doc.max(axis=1)

    def long(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        if number not in self.dense:
            a, b = self.at[number]
            self.dense[number] = self.spread(self.docs[a:b], self.scores[a:b])
        return self.dense[number]

    def best(self, query: list[tuple[int, int]], top: int, least: int) -> list[tuple[int, int]]:
        """The ``top`` best (score, document) of at least ``least``; equal scores by document.

        ``query`` has (term number, repeats).  ``least`` is a score that
        ``top`` documents elsewhere reach already (1 if there are none).
        """
        here = [(t, n) for t, n in query if t in self.at]
        if not here:
            return []
        brief = [(t, n) for t, n in here if self.short(t)]
        lists = [(*self.long(t), n) for t, n in here if not self.short(t)]
        if brief:
            spans = [(*self.at[t], n) for t, n in brief]
            docs = np.concatenate([self.docs[a:b] for a, b, _ in spans])
            scores = np.concatenate([self.scores[a:b] * n for a, b, n in spans])
            summed, bound = self.spread(docs, scores)
            lists.append((summed, bound, 1))
            if len(docs) >= top and summed.size >= top:  # a document's accumulator is a lower bound of its score
                least = max(least, int(np.partition(summed, summed.size - top, axis=None)[-top]))
        bounds = sum(bound * n for _, bound, n in lists)
        found: list[tuple[int, int]] = []
        for window in np.flatnonzero(bounds >= least).tolist():
            if bounds[window] < least:  # the least score has risen since
                continue
            scores = sum(by_doc[window] * n for by_doc, _, n in lists)
            at = np.flatnonzero(scores >= least)
            if not len(at):
                continue
            found += zip(scores[at].tolist(), (at + window * WINDOW).tolist())
            if len(found) >= top:
                found.sort(key=lambda x: (-x[0], x[1]))
                del found[top:]
                least = max(least, found[-1][0])
        return sorted(found, key=lambda x: (-x[0], x[1]))


def _score(postings: DataFrame, queries: list[list[tuple[int, int]]], weights: np.ndarray, docs: int, length: int, top: int) -> DataFrame:
    """Each task's best documents: query (place in ``queries``), id, score."""
    id_type = postings.schema["id"].dataType
    schema = T.StructType([
        T.StructField("query", T.IntegerType(), False), T.StructField("id", id_type), T.StructField("score", T.LongType(), False),
    ])
    asked = postings.sparkSession.sparkContext.broadcast((queries, weights))

    def of_block(table: pa.Table) -> tuple[Lists, pa.Array]:
        ids = table.column("id").combine_chunks()
        order = pa.compute.sort_indices(ids, null_placement="at_end")
        table = table.take(order).combine_chunks()
        n = table.column("n").to_numpy()
        found, tfs = table.column("terms").combine_chunks(), table.column("tfs").combine_chunks()
        doc = np.repeat(np.arange(len(n)), np.diff(found.offsets.to_numpy()))
        number, tf = found.flatten().to_numpy(), tfs.flatten().to_numpy()
        m = 100 - 25 + (25 * n * docs) // length
        scores = asked.value[1][number] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        return Lists(doc, number, scores, len(n)), table.column("id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in asked.value[0]]

        def take(held: list[pa.RecordBatch]) -> None:
            lists, ids = of_block(pa.Table.from_batches(held))
            for at, query in enumerate(asked.value[0]):
                now = best[at]
                least = now[-1][0] if len(now) == top else 1
                more = lists.best(query, top, least)
                if more:
                    now += [(score, ids[doc].as_py()) for score, doc in more]
                    now.sort(key=lambda x: (-x[0], x[1] is None, 0 if x[1] is None else x[1]))
                    del now[top:]

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                take(held)
                held, rows = [], 0
        if rows:
            take(held)
        out = [(at, id_, score) for at, found in enumerate(best) for score, id_ in found]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(zip(*out), (pa.int32(), id_arrow, pa.int64()))], names=schema.names
            )

    id_arrow = _arrow_type(id_type)
    return postings.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple]]:
    """(place, item id, terms) of the items with a term, in blocks of bounded size; places count on over the blocks."""
    block, size = [], 0
    ordered = items.select(items[item_col].alias("item"), items[text_col].cast("string").alias("text")).orderBy("item", "text")
    for place, row in enumerate(ordered.toLocalIterator()):
        found = terms(row.text)
        if found:
            block.append((place, row.item, found))
            size += len(row.text)
        if size >= QUERY_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
) -> DataFrame:
    """The ``top`` best documents of every item: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score`` (names as given).

    A term's weight is floor(1000 ln((2N+2)/(2df+1))) over the N documents
    with at least one term; a document's score sums, over the item's terms
    with repeats, the weight times (10^9 tf) div (1000 tf + 12 m), where m is
    75 + (25 n N) div L.  Equal scores go by ascending id, NULL ids last.
    Documents and items without a term (NULL and empty texts too) give no row.
    Each row of ``docs`` is a document and each row of ``items`` an item of its
    own, also where ids repeat; other columns are ignored; without documents or
    items the result is empty.
    """
    if top < 1:
        raise ValueError("top must be positive")
    spark: SparkSession = docs.sparkSession
    python_side(spark)
    out = None
    for block in _blocks(items, item_col, item_text):
        number = {t: i for i, t in enumerate(dict.fromkeys(t for *_, found in block for t in found))}
        postings = publish(_count_terms(docs, id_col, text_col, number), "postings")
        total = postings.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
        if not total.docs:
            discard(postings)
            break
        weight = F.floor(F.lit(1000) * F.log(F.lit(2.0 * total.docs + 2) / (F.lit(2) * F.col("df") + F.lit(1))))
        df = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        weights = np.zeros(len(number), np.int64)
        for row in df.select("term", weight.alias("w")).collect():  # at most the terms of one block of queries
            weights[row.term] = row.w
        queries = [sorted(Counter(number[t] for t in found).items()) for *_, found in block]
        best = _score(postings, queries, weights, total.docs, total.length, top)
        first = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        ranked = best.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
        named = spark.createDataFrame(
            [(i, item) for i, (_, item, _) in enumerate(block)],
            T.StructType([T.StructField("query", T.IntegerType()), T.StructField("item", items.schema[item_col].dataType)]),
        )
        part = publish(
            ranked.join(F.broadcast(named), "query").select(  # one row per query of the block
                F.col("item").alias(item_col), "rank", F.col("id").alias(id_col if id_col != item_col else f"{id_col}_found"), "score"
            ),
            "found",
        )
        discard(postings)
        out = part if out is None else out.unionByName(part)
    if out is None:
        schema = T.StructType([
            T.StructField(item_col, items.schema[item_col].dataType), T.StructField("rank", T.IntegerType()),
            T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.LongType()),
        ])
        return spark.createDataFrame([], schema)
    return out
