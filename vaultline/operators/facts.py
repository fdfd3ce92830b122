"""What many tables say about one key, brought together by one grouped aggregate.

A wide row needs the newest of one table, a count of another, a flag of a
third.  Instead of an aggregate and a join for each, the tables are stacked as
tagged facts: a row has the key and one struct, in the column named by its
tag, and NULL in the others.  One shuffle and one partial aggregation serve all
tags, so the number of satellites adds columns, not exchanges.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tagged_facts(key: str, facts: Mapping[str, DataFrame]) -> DataFrame:
    """``key`` and one nullable struct per tag; rows without a key are facts about nothing and go.

    A fact's columns keep their order, which is also the order in which its
    structs compare: rank first (date, then the row's own key), then the rest.
    """
    def tagged(tag: str, df: DataFrame) -> DataFrame:
        return df.where(F.col(key).isNotNull()).select(
            key, F.struct(*[F.col(c) for c in df.columns if c != key]).alias(tag))

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [tagged(tag, df) for tag, df in facts.items()])


def newest(tag: str) -> Column:
    """The greatest struct of a tag (NULL if the key has none)."""
    return F.max(tag).alias(tag)


def how_many(tag: str, name: str) -> Column:
    return F.count(tag).alias(name)


def about(key: str, facts: Mapping[str, DataFrame], *measures: Column) -> DataFrame:
    """One row per ``key`` with the measures over its facts."""
    return tagged_facts(key, facts).groupBy(key).agg(*measures)


Tables = Callable[[str], DataFrame]
