"""Sharding by a k-d tree: recursive weighted-median cuts of the rows' metadata, in SQL functions only.

Rows are points: language and source (as positions of their hashes), text
size and id.  A node that must give m shards is cut along its widest
dimension, so that floor(m/2) / m of its bytes fall below the cut; ties on a
value are cut by a content hash and, for identical rows, by a row number.
Medians are found without sorting: all nodes of a level refine their cut
together, by histograms of at most ``BINS`` bins per node that Spark sums up
over all rows.  The driver only sees those bins.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vaultline.llm.common import content_key, discard, publish

SHARDS = 40
BINS = 1024
ROW_BYTES = 16
SLOT_ROWS = 100_000  # rows numbered together, about
#: Cut dimensions; the last two only break ties.
DIMENSIONS = ("x_lang", "x_source", "x_size", "x_id")
COORDINATES = (*DIMENSIONS, "x_hash", "x_row")
TIES = (4, 5)


@dataclass
class Node:
    """A node of the tree.  Rows whose (keys) are less than ``cut``, as tuples, go to child 2 * number."""

    number: int  # the root is 1
    first: int  # its first shard
    shards: int
    keys: tuple[int, ...] = ()  # places in COORDINATES
    cut: list[int] = field(default_factory=list)
    # while its cut is searched: bytes wanted below, the range still open for the next part of the cut, bytes below it
    target: float = 0.0
    low: int = 0
    high: int = 0
    below: float = 0.0
    done: bool = False


def _by_number(nodes: list[Node], value: Callable[[Node], int | None], size: int) -> Column:
    """The value for the row's node: a lookup in a literal array (one expression, however many nodes)."""
    values: list[int | None] = [None] * size
    for n in nodes:
        values[n.number] = value(n)
    listed = ", ".join("null" if x is None else f"{x}L" for x in values)
    return F.expr(f"cast(get(array({listed}), node) as bigint)")


def _coordinate(place: Column) -> Column:
    return F.get(F.array(*COORDINATES), place.cast("int"))


def _descend(nodes: list[Node], size: int) -> Column:
    """Number of the child that takes the row; rows of leaves stay."""
    left = F.lit(False)
    for at in (2, 1, 0):
        key = _coordinate(_by_number(nodes, lambda n: n.keys[at], size))  # noqa: B023
        cut = _by_number(nodes, lambda n: n.cut[at] if at < len(n.cut) else -1, size)  # noqa: B023
        left = (key < cut) | ((key == cut) & left)
    inner = _by_number(nodes, lambda n: 2 * n.number, size)
    return F.when(inner.isNull(), F.col("node")).when(left, inner).otherwise(inner + 1).cast("int")


def _search(points: DataFrame, nodes: list[Node], tolerance: float, size: int) -> None:
    """Refine the cuts of all nodes together until what is left undecided is under ``tolerance`` bytes."""
    while now := [n for n in nodes if not n.done]:
        of = lambda value: _by_number(now, value, size)  # noqa: E731, B023
        key = _coordinate(of(lambda n: n.keys[len(n.cut)]))
        step = of(lambda n: max(1, -(-(n.high - n.low + 1) // BINS)))
        inside = key.between(of(lambda n: n.low), of(lambda n: n.high))
        for at in (0, 1):  # parts of the cut that are settled
            settled = of(lambda n: n.cut[at] if at < len(n.cut) else None)  # noqa: B023
            part = _coordinate(of(lambda n: n.keys[at]))  # noqa: B023
            inside = inside & (settled.isNull() | (part == settled))
        found = (
            points.where(inside)
            .select("node", "size", key.alias("key"), of(lambda n: n.low).alias("low"), step.alias("step"))
            .groupBy("node", F.expr("(key - low) div step").alias("bin"))
            .agg(F.sum("size").alias("size"), F.min("key").alias("least"), F.max("key").alias("most"))
            .collect()  # at most BINS rows per node
        )
        bins: dict[int, list] = {}
        for r in sorted(found, key=lambda r: (r["node"], r["bin"])):
            bins.setdefault(r["node"], []).append(r)
        for n in now:
            for r in bins[n.number]:
                if n.below + r["size"] >= n.target:
                    break
                n.below += r["size"]
            else:
                n.below -= r["size"]
            single = r["least"] == r["most"]
            if r["size"] <= tolerance or (single and len(n.cut) == 2):  # settle for the nearer edge of the bin
                near_end = n.target - n.below > n.below + r["size"] - n.target
                n.cut.append(r["most"] + 1 if near_end else r["least"])
                n.done = True
            elif single:
                n.cut.append(r["least"])
                n.low, n.high = 0, (1 << 62) - 1
            else:
                n.low, n.high = r["least"], r["most"]


def _position(col: Column) -> Column:
    """62-bit position of a value's hash."""
    return F.shiftrightunsigned(F.xxhash64(col), 2)


def points_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Narrow rows: id, size, crc of the text, the metadata dimensions and the tie breakers."""
    text = df[text_col].cast("string")
    value = lambda name: df[name].cast("string") if name in df.columns else F.lit(None).cast("string")
    a, _ = content_key(F.struct(df[id_col].cast("string"), text))
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + ROW_BYTES
    narrow = df.select(
        df[id_col].alias("id"),
        size.alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        _position(value("lang")).alias("x_lang"),
        _position(value("source")).alias("x_source"),
        F.shiftrightunsigned(a, 2).alias("x_hash"),
        F.monotonically_increasing_id().alias("x_row"),
    )
    by_id = F.col("id").cast("bigint") if dict(narrow.dtypes)["id"] in ("bigint", "int", "smallint", "tinyint") else _position(F.col("id"))
    return narrow.withColumn("x_size", F.col("size")).withColumn("x_id", F.coalesce(by_id, F.lit(0)))


def kd_shards(df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", tolerance: float = 0.0005) -> DataFrame:
    """Put all rows into ``shards`` shards of nearly equal bytes (within ``tolerance`` of a shard per cut, or one row).

    Returns id, size, text_crc32, shard (from 0) and slot (gapless from 0 in
    each shard).  The size is the UTF-8 bytes of the text (NULL: none) plus
    16.  NULL ids, languages and sources are values of their own; a missing
    ``lang`` or ``source`` column counts as NULL; repeated rows are split
    like any others; other columns are ignored; an empty table stays empty.
    """
    points = publish(points_of(df, id_col, text_col).withColumn("node", F.lit(1)), "points")
    level, leaves = [Node(1, 0, shards)], []
    size = 2 << shards.bit_length()
    total, spread = None, {}
    while True:
        leaves += [n for n in level if n.shards == 1]
        level = [n for n in level if n.shards > 1]
        if not level:
            break
        ends = [f(c).alias(f"{name}{i}") for i, c in enumerate(DIMENSIONS) for name, f in (("low", F.min), ("high", F.max))]
        stats = {r["node"]: r for r in points.groupBy("node").agg(F.sum("size").alias("size"), *ends).collect()}  # a row per node
        if not total:
            total = sum(r["size"] for r in stats.values())
            spread = {i: max([1, *(r[f"high{i}"] - r[f"low{i}"] for r in stats.values())]) for i in range(len(DIMENSIONS))}
        for n in level:
            if r := stats.get(n.number):
                widest = max(spread, key=lambda i: (r[f"high{i}"] - r[f"low{i}"]) / spread[i])  # noqa: B023
                n.keys, n.low, n.high = (widest, *TIES), r[f"low{widest}"], r[f"high{widest}"]
                n.target = r["size"] * (n.shards // 2) / n.shards
            else:  # no rows
                n.keys, n.cut, n.done = (0, *TIES), [0], True
        _search(points, level, tolerance * (total or 0) / shards, size)
        moved = publish(points.withColumn("node", _descend(level, size)), "points")
        discard(points)
        points = moved
        level = [
            x
            for n in level
            for x in (Node(2 * n.number, n.first, n.shards // 2), Node(2 * n.number + 1, n.first + n.shards // 2, n.shards - n.shards // 2))
        ]
    placed = points.withColumn("shard", _by_number(leaves, lambda n: n.first, size).cast("int"))
    return number_slots(placed, "shard", ["id", "x_hash", "x_row"], "x_hash").select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot"
    )


def number_slots(df: DataFrame, group: str, order: list[str], spread: str) -> DataFrame:
    """Add ``slot``: gapless numbers from 0 within ``group``, without gathering a group in one task.

    Rows are numbered within (group, part of the ``spread`` hash); parts start
    where the parts before them end, which a sum over the few counts tells.
    """
    rows = df.count()
    parts = max(1, -(-rows // SLOT_ROWS))
    split = df.withColumn("part", F.pmod(F.col(spread), F.lit(parts)).cast("int"))
    counts = split.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("start"))
    numbered = split.withColumn("at", F.row_number().over(Window.partitionBy(group, "part").orderBy(*order)))
    return numbered.join(starts, [group, "part"]).withColumn("slot", F.col("start") + F.col("at") - 1).drop("part", "at", "start")
