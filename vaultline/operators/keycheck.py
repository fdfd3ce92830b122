"""Declared keys of many tables checked in one pass over each table.

Every table is scanned once: a row becomes one narrow row per declared key it
takes part in (the key's number, the value as text, and the part it plays).
All tables are stacked, and one grouped aggregate by (key, value) answers all
declarations, so their number adds narrow rows but neither scans nor joins.  A
value that a third of all rows hold is combined on the map side.

NULL refers to nothing and identifies nothing; it is not counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.operators.facts import Tables

PARENT = -1  # the part of a row that has the key itself


@dataclass(frozen=True)
class Reference:
    child: str
    column: str
    parent: str
    parent_column: str


def _stack(tables: Tables, entries: dict[str, list[Column]]) -> DataFrame:
    rows = [tables(t).select(F.inline(F.array(*parts))) for t, parts in entries.items()]
    return reduce(DataFrame.unionByName, rows).where(F.col("value").isNotNull())


def _entry(number: int, value: Column, part: int = PARENT) -> Column:
    return F.struct(F.lit(number).alias("key"), value.alias("value"), F.lit(part).alias("part"))


def _as_parent(tables: Tables, ref: Reference) -> Column:
    """The child's value as text of the parent's type; what has no such form stays as it is (and finds no parent)."""
    own, wanted = tables(ref.child).schema[ref.column].dataType, tables(ref.parent).schema[ref.parent_column].dataType
    text = F.col(ref.column).cast(T.StringType())
    if own == wanted:
        return text
    return F.coalesce(F.col(ref.column).try_cast(wanted).cast(T.StringType()), text)


def reference_orphans(tables: Tables, references: Sequence[Reference]) -> DataFrame:
    """Per reference, how many child rows have a value that no parent row has.

    One row per reference, in any order; 0 where every value has its parent.
    A table may be its own parent, and a reference may be declared to several
    parents (each is checked by itself).
    """
    parents = list(dict.fromkeys((r.parent, r.parent_column) for r in references))
    parts: dict[int, list[Reference]] = {n: [] for n in range(len(parents))}
    entries: dict[str, list[Column]] = {}
    for n, (table, column) in enumerate(parents):
        entries.setdefault(table, []).append(_entry(n, F.col(column).cast(T.StringType())))
    for ref in references:
        n = parents.index((ref.parent, ref.parent_column))
        entries.setdefault(ref.child, []).append(_entry(n, _as_parent(tables, ref), len(parts[n])))
        parts[n].append(ref)
    names = [f"n{i}" for i in range(max(len(p) for p in parts.values()))]
    per_value = _stack(tables, entries).groupBy("key", "value").agg(
        F.bool_or(F.col("part") == PARENT).alias("known"),
        *[F.count_if(F.col("part") == i).alias(name) for i, name in enumerate(names)])
    lost = per_value.where(~F.col("known")).groupBy("key").agg(*[F.sum(name).alias(name) for name in names])
    counted = lost.select("key", F.inline(F.array(*[
        F.struct(F.lit(i).alias("part"), F.col(name).alias("orphan_records")) for i, name in enumerate(names)])))
    declared = counted.sparkSession.createDataFrame(
        [(n, i, r.child, r.column, r.parent, r.parent_column) for n, refs in parts.items() for i, r in enumerate(refs)],
        "key INT, part INT, child_table STRING, child_column STRING, parent_table STRING, parent_column STRING")
    # `counted` has at most (declared keys x widest key) rows.
    return declared.join(F.broadcast(counted), ["key", "part"], "left").select(
        "child_table", "child_column", "parent_table", "parent_column",
        F.coalesce("orphan_records", F.lit(0)).cast("bigint").alias("orphan_records"))


def repeated_keys(tables: Tables, keys: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Per declared unique key (table, columns): values, values held more than once, and rows too many.

    A composite key with a NULL part is a value like any other; a single NULL is none.
    """
    entries: dict[str, list[Column]] = {}
    for n, (table, columns) in enumerate(keys):
        value = (F.col(columns[0]).cast(T.StringType()) if len(columns) == 1
                 else F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
        entries.setdefault(table, []).append(_entry(n, value))
    found = _stack(tables, entries).groupBy("key", "value").agg(F.count(F.lit(1)).alias("held")).groupBy("key").agg(
        F.count(F.lit(1)).alias("distinct_values"), F.count_if(F.col("held") > 1).alias("repeated_values"),
        F.sum(F.col("held") - 1).alias("surplus_records"))
    declared = found.sparkSession.createDataFrame(
        [(n, table, "+".join(columns)) for n, (table, columns) in enumerate(keys)], "key INT, table_name STRING, key_columns STRING")
    numbers = ("distinct_values", "repeated_values", "surplus_records")
    return declared.join(F.broadcast(found), "key", "left").select(
        "table_name", "key_columns", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers])
