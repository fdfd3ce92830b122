"""SimHash near-duplicates by covering locality-sensitive hashing.

For radius r every bit position gets a vector of r + 1 bits.  Table v (each
non-zero vector of r + 1 bits) masks the positions whose vector has an odd
inner product with v.  The vectors of r differing positions span at most r
dimensions, so some v is orthogonal to all of them: that table's mask leaves
all differing bits out and the pair collides.  No pair within the radius is
missed, whatever the data.

Only distinct fingerprints enter the tables, so exact copies cost nothing.  A
bucket is never gathered as a whole: large ones are cut into tiles, and each
pair of tiles is one bounded group.  A group emits a spanning forest of its
links (at most one edge per member), found by a search that drops a member
from all further comparisons as soon as it is reached.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import from_row, publish, python_side, whole_row
from vaultline.llm.components import connected

BITS = 64
SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
TILE = 4096  # members of a bucket that meet in one group, twice
_SHINGLES_AT_ONCE = 1 << 15


def fingerprint_of(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a text; bit i is 1 if set in over half of the shingle hashes."""
    from xxhash import xxh64_intdigest

    found = (text or "").encode().lower().split()  # both on ASCII only, as the argument is bytes
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    stops = ends[words - 1 :] or ends[-1:]
    set_bits = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(stops), _SHINGLES_AT_ONCE):
        parts = [joined[a:b] for a, b in zip(starts[at : at + _SHINGLES_AT_ONCE], stops[at : at + _SHINGLES_AT_ONCE])]
        hashes = np.fromiter(map(xxh64_intdigest, parts, repeat(seed)), dtype="<u8", count=len(parts))
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * set_bits > len(stops)).tolist())


def fingerprints(df: DataFrame, text_col: str = "text", out: str = "fingerprint", words: int = SHINGLE_WORDS) -> DataFrame:
    """Add ``out`` (long, the 64 bits) to every row; NULL and wordless texts have 0."""
    python_side(df.sparkSession)

    @F.pandas_udf("long")
    def bits(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            values = np.fromiter((fingerprint_of(x, words) for x in texts), dtype=np.uint64, count=len(texts))
            yield pd.Series(values.astype(np.int64))

    return df.withColumn(out, bits(df[text_col].cast("string")))


def covering_masks(radius: int) -> list[int]:
    """The 2^(radius+1) - 1 masks (unsigned); position i has the vector 1 + i mod (2^(radius+1) - 1)."""
    tables = (1 << radius + 1) - 1
    return [sum(1 << i for i in range(BITS) if ((1 + i % tables) & v).bit_count() % 2) for v in range(1, tables + 1)]


def _differing(x: np.ndarray) -> np.ndarray:
    """Set bits of int64 values (numpy counts those of the absolute value, so go unsigned)."""
    return np.bitwise_count(x.view(np.uint64))


def forest(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links (at most ``radius`` differing bits) among distinct members."""
    edges: list[tuple[int, int]] = []
    rest = members
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            one = reached.pop()
            near = _differing(rest ^ one) <= radius
            if near.any():
                found = rest[near]
                edges += [(int(one), x) for x in found.tolist()]
                reached += list(found)
                rest = rest[~near]
    return edges


def _search(radius: int):
    """Batches sorted by group -> edges; a group may run on over batches."""

    def of(groups: np.ndarray, members: np.ndarray) -> list[tuple[int, int]]:
        cuts = np.flatnonzero(np.any(groups[1:] != groups[:-1], axis=1)) + 1
        starts = np.concatenate([[0], cuts])
        sizes = np.diff(np.concatenate([starts, [len(members)]]))
        two = starts[sizes == 2]
        a, b = members[two], members[two + 1]
        near = _differing(a ^ b) <= radius
        edges = list(zip(a[near].tolist(), b[near].tolist()))
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            edges += forest(members[start : start + size], radius)
        return edges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, members = np.empty((0, 4), np.int64), np.empty(0, np.int64)
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            groups = np.concatenate([groups, np.stack(columns[:4], axis=1)])
            members = np.concatenate([members, columns[4]])
            if not len(members):
                continue
            other = np.flatnonzero(np.any(groups != groups[-1], axis=1))
            whole = int(other[-1]) + 1 if len(other) else 0  # the last group may go on
            if whole:
                yield _edges(of(groups[:whole], members[:whole]))
                groups, members = groups[whole:], members[whole:]
        if len(members):
            yield _edges(of(groups, members))

    return run


def _edges(pairs: Sequence[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def links(distinct: DataFrame, radius: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that connect what links within ``radius`` connect; ``distinct`` has one long column ``fp``."""
    python_side(distinct.sparkSession)
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in covering_masks(radius)]
    keyed = distinct.select(
        "fp",
        F.inline(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(signed)])),
    )
    # Both sides are as many times longer than Spark thinks as there are masks (a generator adds nothing to its
    # estimate), so neither may be broadcast on that size.
    shared = keyed.groupBy("t", "key").count().where("count > 1").hint("merge")
    tiled = keyed.join(shared, ["t", "key"]).withColumn("n", F.ceil(F.col("count") / tile).cast("int"))
    tiled = tiled.withColumn("i", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda u: u != F.col("i"))
    grouped = tiled.select(
        "t", "key", "i", "fp", F.explode(F.when(F.col("n") > 1, others).otherwise(F.array(F.lit(0)))).alias("u")
    ).select("t", "key", F.least("i", "u").alias("i"), F.greatest("i", "u").alias("j"), "fp")
    sorted_groups = grouped.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")
    return sorted_groups.mapInArrow(_search(radius), "a long, b long").distinct()


def clusters(marked: DataFrame, id_col: str, fp_col: str, radius: int = MAX_BITS) -> DataFrame:
    """One row per distinct fingerprint: ``fp``, ``cluster`` (its root fingerprint), ``component_id`` (least id)."""
    ids = marked.groupBy(marked[fp_col].alias("fp")).agg(F.min(id_col).alias("least"))
    roots = connected(links(marked.select(marked[fp_col].alias("fp")).distinct(), radius))
    named = ids.join(roots, ids.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("cluster")
    )
    smallest = named.groupBy("cluster").agg(F.min("least").alias("component_id"))
    return named.join(smallest, "cluster").select("fp", "cluster", "component_id")


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    words: int = SHINGLE_WORDS,
    radius: int = MAX_BITS,
    fingerprint: str = "fingerprint",
    cluster: str = "cluster",
    component: str = "component_id",
) -> DataFrame:
    """Rows of ``df`` (columns ``keep``, default all) with fingerprint, cluster and component.

    Rows are linked when their fingerprints differ in at most ``radius``
    bits; ``component`` is the least id that links reach.  Wordless and NULL
    texts have fingerprint 0 and link like any other.  NULL ids are passed
    over (a component of NULL ids only has NULL).  Repeated rows stay, in one
    component.  Columns with the three names are replaced; all else passes.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c not in (fingerprint, cluster, component)]
    source = df.select(whole_row(kept), df[id_col].alias("id"), df[text_col].alias("text"))
    marked = fingerprints(source, "text", "fp", words).drop("text")
    found = clusters(publish(marked.select("id", "fp"), "simhash"), "id", "fp", radius)
    return marked.join(found, "fp").select(
        *from_row(kept),
        F.col("fp").alias(fingerprint),
        F.col("cluster").alias(cluster),
        F.col("component_id").alias(component),
    )
