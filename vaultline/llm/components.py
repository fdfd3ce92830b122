"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is an aggregation with map-side minima and a join that adaptive
execution splits where a node is hot.  Every round is written to the shared
folder, so lineage stays short and a lost executor repeats one round only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import discard, publish


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _print(edges: DataFrame) -> tuple:
    """Number of edges and an order-free checksum."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b: long); root is the least node reachable.

    Loops and repeated edges are allowed; an empty table gives an empty table.
    """
    now = publish(edges.where("a <> b").select("a", "b").distinct(), "edges")
    mark = _print(now)
    while mark[0]:
        after = publish(_small_star(_large_star(now)), "edges")
        discard(now)
        now, before, mark = after, mark, _print(after)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
