"""Tables published in a declared layout.

A ``Layout`` states the columns with their types and comments, which of them
never are NULL, and the columns the rows are ordered by.  ``publish`` refuses a
frame that differs (all differences in one error, before anything is written)
and fails on a NULL where none may be.  Rows are range-partitioned on the
ordering columns, so a file covers a narrow range; what each file covers is
kept in a list of files, and a read by range opens only the files that overlap.

A publication is a version: staged, renamed as a whole, and read entirely or
not at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.sources.committed import AppendLog


class LayoutError(ValueError):
    """A frame that does not have the declared columns."""


@dataclass(frozen=True)
class Layout:
    columns: Sequence[tuple[str, str, str]]   # name, type, comment
    order_by: Sequence[str]
    required: Sequence[str] = ()

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.DataType.fromDDL(t), True, {"comment": c}) for n, t, c in self.columns])

    def differences(self, given: T.StructType) -> list[str]:
        have = {f.name: f.dataType.simpleString() for f in given.fields}
        want = {f.name: f.dataType.simpleString() for f in self.schema().fields}
        return ([f"missing {n} {t}" for n, t in want.items() if n not in have]
                + [f"undeclared {n} {t}" for n, t in have.items() if n not in want]
                + [f"{n} is {have[n]}, declared {t}" for n, t in want.items() if n in have and have[n] != t])

    def enforced(self, df: DataFrame) -> DataFrame:
        """The declared columns in the declared order, with comments; reading a NULL in a required one is an error."""
        found = self.differences(df.schema)
        if found:
            raise LayoutError("; ".join(found))

        def checked(name: str) -> Column:
            if name not in self.required:
                return F.col(name)
            return F.when(F.col(name).isNull(), F.raise_error(F.lit(f"NULL in {name}"))).otherwise(F.col(name))

        return df.select(*[checked(n).alias(n, metadata={"comment": c}) for n, _, c in self.columns])


class PublishedTable:
    """Versions of one table in its layout under ``root``; the last ``keep`` stay."""

    def __init__(self, spark: SparkSession, root: str, layout: Layout, keep: int = 2) -> None:
        self.spark, self.layout, self.keep = spark, layout, keep
        self.rows = AppendLog(spark, f"{root.rstrip('/')}/rows")
        self.files = AppendLog(spark, f"{root.rstrip('/')}/files")

    def publish(self, df: DataFrame, files: int | None = None, rows_per_file: int = 5_000_000,
                made: Mapping[str, Column] | None = None) -> int:
        """Write ``df`` as the next version and return its number.

        ``files`` is the number of ranges (by default Spark's shuffle
        partitions, which adaptive execution may merge).  Equal ordering keys
        are dealt on by a hash of the row, so a hot key spans several files.
        ``made`` are columns that are computed where a row is written, so that
        long values (hashes) do not travel; they may replace what they are
        computed from.
        """
        made = dict(made or {})
        version = max([*self.rows.versions(), 0]) + 1
        ranges = [*[made.get(c, F.col(c)) for c in self.layout.order_by], F.xxhash64(*[F.col(c) for c in df.columns])]
        self.layout.enforced(df.withColumns(made))
        ranged = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
        rows = self.layout.enforced(ranged.withColumns(made))
        self.rows.append(rows.sortWithinPartitions(*self.layout.order_by), version,
                         {"maxRecordsPerFile": str(rows_per_file), "compression": "zstd"})
        first = F.col(self.layout.order_by[0])
        covered = self._version(version).groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.min(first).alias("low"), F.max(first).alias("high"), F.count(F.lit(1)).alias("rows"))
        self.files.append(covered, version)
        for old in self.versions()[:-self.keep]:
            for log in (self.files, self.rows):
                log.drop(old)
        return version

    def versions(self) -> list[int]:
        """Versions that are whole: rows and list of files."""
        return sorted(set(self.rows.versions()) & set(self.files.versions()))

    def _version(self, version: int) -> DataFrame:
        return self.rows.read(self.layout.schema(), version - 1, version)

    def read(self) -> DataFrame:
        """The latest version."""
        done = self.versions()
        return self._version(done[-1]) if done else self.spark.createDataFrame([], self.layout.schema())

    def read_between(self, low: Column, high: Column) -> DataFrame:
        """Rows of the latest version whose first ordering column is in [low, high), from the files that overlap."""
        key, done = F.col(self.layout.order_by[0]), self.versions()
        if not done:
            return self.read()
        kind = self.layout.schema()[self.layout.order_by[0]].dataType
        listed = self.files.read(T.StructType([T.StructField("file", T.StringType()), T.StructField("low", kind),
                                               T.StructField("high", kind)]), done[-1] - 1, done[-1])
        hit = [r[0] for r in listed.where((F.col("low") < high) & (F.col("high") >= low)).select("file").collect()]
        if not hit:
            return self.spark.createDataFrame([], self.layout.schema())
        return self.spark.read.schema(self.layout.schema()).parquet(*hit).where((key >= low) & (key < high))
