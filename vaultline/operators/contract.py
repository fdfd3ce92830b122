"""Dataset-level contract checks (nullValues, missingValues, invalidValues,
duplicateValues, rowCount, conditional/structural rules, sequences,
foreign keys, reference lookups, mappings, SLA).

Column metrics of one table are evaluated in ONE aggregation pass (one
``count_if`` per check) and stacked to a long result, never one job per
check.  Multi-table checks are joins: ``left_anti`` for foreign keys and
reference lists (NULL foreign keys ignored), inner join + filter for
cross-table consistency.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    kind: str              # null | missing | valid_values | pattern | condition | duplicate | row_count
    column: str | None = None
    values: tuple = ()
    pattern: str | None = None
    bad: str | None = None          # SQL predicate that marks a failing row (condition)
    unit: str = "rows"              # rows | percent
    op: str = "mustBe"              # mustBe | mustBeLessThan | mustBeGreaterThan | mustBeLessOrEqualTo
    threshold: float = 0
    dimension: str = "completeness"
    severity: str = "error"

    def bad_col(self) -> Column:
        """The failing-row predicate as a Column (patterns go through the
        Column API so the regex text is not re-escaped by the SQL parser)."""
        if self.kind == "pattern":
            c = F.col(self.column)
            return c.isNotNull() & ~c.rlike(self.pattern)
        return F.expr(self.bad_sql())

    def bad_sql(self) -> str:
        """The failing-row predicate as Spark SQL text."""
        c = self.column
        if self.kind == "null":
            return f"{c} IS NULL"
        if self.kind == "missing":
            vals = ", ".join(_q(v) for v in self.values)
            return f"({c} IS NULL OR trim(CAST({c} AS STRING)) IN ({vals}))"
        if self.kind == "valid_values":
            vals = ", ".join(_q(v) for v in self.values)
            return f"({c} IS NOT NULL AND {c} NOT IN ({vals}))"
        if self.kind == "pattern":
            return f"({c} IS NOT NULL AND NOT ({c} RLIKE '{self.pattern}'))"
        if self.kind == "condition":
            return f"coalesce(({self.bad}), FALSE)"
        raise ValueError(self.kind)


def _q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def evaluate(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All checks of ONE table in a single aggregation -> long result."""
    if not checks:
        raise ValueError("no checks")
    table = checks[0].table
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, c in enumerate(checks):
        if c.kind == "duplicate":
            cols = [x.strip() for x in c.column.split(",")]
            aggs.append((F.count(F.lit(1)) - F.count_distinct(*[F.col(x) for x in cols])).alias(f"_f{i}"))
        elif c.kind == "row_count":
            aggs.append(F.count(F.lit(1)).alias(f"_f{i}"))
        else:
            aggs.append(F.count_if(c.bad_col()).alias(f"_f{i}"))
    wide = df.agg(*aggs)
    rows = ", ".join(f"'{c.name}', '{c.kind}', '{c.column or ''}', '{c.unit}', '{c.op}', "
                     f"CAST({float(c.threshold)} AS DOUBLE), _f{i}" for i, c in enumerate(checks))
    long = wide.selectExpr(
        "_total", f"stack({len(checks)}, {rows}) AS (check_name, check_type, column_name, unit, operator, "
                  f"threshold, failed_records)")
    pct = F.round(F.col("failed_records").cast("double") * 100 / F.col("_total"), 4)
    value = F.when(F.col("unit") == "percent", pct).otherwise(F.col("failed_records").cast("double"))
    passed = (F.when(F.col("operator") == "mustBe", value == F.col("threshold"))
              .when(F.col("operator") == "mustBeLessThan", value < F.col("threshold"))
              .when(F.col("operator") == "mustBeGreaterThan", value > F.col("threshold"))
              .otherwise(value <= F.col("threshold")))
    return long.select(F.lit(table).alias("table_name"), "check_name", "check_type", "column_name",
                       "failed_records", F.col("_total").alias("total_records"),
                       F.when(F.col("_total") > 0, pct).alias("failed_percent"), "unit", "operator", "threshold",
                       F.coalesce(passed, F.lit(False)).alias("passed"))


def sequence_violations(df: DataFrame, parent: str, seq: str) -> DataFrame:
    """(parent, sequence) pairs delivered more than once."""
    return df.groupBy(parent, seq).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def foreign_key_orphans(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row (left anti join).

    The parent side is reduced to its distinct keys first; AQE broadcasts it
    only when that runtime size is under the threshold, else sort-merge."""
    keys = parent.select(F.col(parent_col).alias("_pk")).distinct()
    return (child.filter(F.col(child_col).isNotNull())
            .join(keys, F.col(child_col) == F.col("_pk"), "left_anti"))


def ambiguous_mapping(crosswalk: DataFrame, ref: str, target: str) -> DataFrame:
    """Source references mapped to more than one target id."""
    return (crosswalk.groupBy(ref).agg(F.count_distinct(target).alias("targets"))
            .filter("targets > 1"))


# ------------------------------------------------------------ remediation
def null_replace(col: str, default) -> Column:
    return F.coalesce(F.col(col), F.lit(default))


def clamp(col: str, lo, hi) -> Column:
    return F.least(F.greatest(F.col(col), F.lit(lo)), F.lit(hi))


def canonical_key(col: str) -> Column:
    return F.upper(F.trim(F.col(col)))


def freshness(df: DataFrame, ts_col: str, as_of: str, max_hours: float) -> DataFrame:
    """Latest event time vs. as-of: hours of lag and whether within SLA."""
    latest = df.agg(F.max(ts_col).alias("latest_ts"))
    lag = (F.unix_timestamp(F.to_timestamp(F.lit(as_of))) - F.unix_timestamp(F.col("latest_ts").cast("timestamp"))) / 3600
    return latest.select("latest_ts", F.round(lag, 4).alias("lag_hours"),
                         (lag <= F.lit(max_hours)).alias("within_sla"))
