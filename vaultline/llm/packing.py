"""Best-fit packing: bounded-space online best fit of token pieces into fixed-length sequences.

Each task reads its documents once, in input order, with a fixed number of
open bins.  The bins are indexed by free space; a bitset (one bit per amount
of free space) finds the tightest bin that still takes a piece.  When a new
bin is needed and all places are taken, the fullest open bin closes first.
Memory is bounded by the open bins, nothing is shuffled, and a task that is
run again gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vaultline.llm.common import python_side
from vaultline.llm.tokens import library_encoder, vocabulary_path

CAPACITY = 1024
OPEN_BINS = 64
END_ID = 2
PACK_MEMO_BYTES = 96 << 20  # per generation; little else is held in these workers
_FLUSH_BYTES = 8 << 20


class OpenBins:
    """At most ``places`` open bins of ``capacity`` tokens, found by free space."""

    def __init__(self, capacity: int, places: int) -> None:
        self.capacity, self.places = capacity, places
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits, self.open, self.made = 0, 0, 0

    def _hold(self, bin_id: int, free: int) -> None:
        if free:
            self.by_free[free].append(bin_id)
            self.bits |= 1 << free
            self.open += 1

    def _take(self, free: int) -> int:
        held = self.by_free[free]
        bin_id = held.pop()
        if not held:
            self.bits &= ~(1 << free)
        self.open -= 1
        return bin_id

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset for a piece of ``length`` tokens (1 to capacity)."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bin_id = self._take(free)
        else:
            if self.open >= self.places:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, bin_id = self.capacity, self.made
            self.made += 1
        self._hold(bin_id, free - length)
        return bin_id, self.capacity - free


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than ``capacity``."""
    if length <= capacity:
        return [(0, length)]
    head = length % capacity
    out = [(0, head)] if head else []
    return out + [(at, capacity) for at in range(head, length, capacity)]


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    open_bins: int = OPEN_BINS,
) -> DataFrame:
    """Tokenise whole texts, append ``end_id``, cut long documents and pack the pieces.

    Returns one row per piece: the id column, ``piece``, ``start``,
    ``length``, ``ids`` (little-endian uint32), ``sequence_id`` and
    ``offset``.  NULL and empty texts are the single token ``end_id``;
    repeated rows are packed once per row; ids may be NULL; other columns are
    ignored; an empty table gives no row.
    """
    if capacity < 1 or open_bins < 1:
        raise ValueError("capacity and open_bins must be positive")
    spark = df.sparkSession
    python_side(spark)
    path = vocabulary or vocabulary_path()
    source = df.select(df[id_col], df[text_col].cast("string"))
    schema = T.StructType([
        T.StructField(id_col, df.schema[id_col].dataType),
        T.StructField("piece", T.IntegerType(), False),
        T.StructField("start", T.LongType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("ids", T.BinaryType(), False),
        T.StructField("sequence_id", T.LongType(), False),
        T.StructField("offset", T.LongType(), False),
    ])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = library_encoder(path, memo_bytes=PACK_MEMO_BYTES)
        bins = OpenBins(capacity, open_bins)
        task = TaskContext.get().partitionId() << 40
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            ids, rows, held = batch.column(0), [], 0
            taken: list[int] = []
            for at, text in enumerate(batch.column(1).to_pylist()):
                tokens = encode(text) + end
                for piece, (start, length) in enumerate(cuts(len(tokens) >> 2, capacity)):
                    bin_id, offset = bins.place(length)
                    taken.append(at)
                    rows.append((piece, start, length, tokens[4 * start : 4 * (start + length)], task | bin_id, offset))
                held += len(tokens)
                if held >= _FLUSH_BYTES:
                    yield _batch(ids, taken, rows, names)
                    rows, taken, held = [], [], 0
            if rows:
                yield _batch(ids, taken, rows, names)

    return source.mapInArrow(run, schema)


def _batch(ids: pa.Array, taken: list[int], rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    piece, start, length, tokens, sequence, offset = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(taken, pa.int64())),
            pa.array(piece, pa.int32()),
            pa.array(start, pa.int64()),
            pa.array(length, pa.int64()),
            pa.array(tokens, pa.binary()),
            pa.array(sequence, pa.int64()),
            pa.array(offset, pa.int64()),
        ],
        names=names,
    )
