"""One-row summaries side by side (the reference's scalar subqueries).

Each extra input is a one-row aggregate; its columns become scalar
subqueries of the first, so there is no join at all.  Spark raises if a
subquery returns more than one row and merges subqueries that scan the same
input into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(first: DataFrame, *others: DataFrame) -> DataFrame:
    cols = [F.col(c) for c in first.columns]
    for other in others:
        cols += [other.select(c).scalar().alias(c) for c in other.columns]
    return first.select(*cols)
