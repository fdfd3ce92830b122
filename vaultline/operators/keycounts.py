"""How many current rows hold a value, kept up to date from a change log.

The cross-row rules ask whether a value is held by more than one current row.
Regrouping the table answers that for every value; ``KeyCounts`` keeps the
counts as keyed state instead and adds what a log version changed: a row that
opens counts +1, its before-image -1, an after-image that closes it nothing.
A micro-batch then reads only the buckets of the values it holds.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.operators.history import CHANGE_TYPE, SnapshotHistory
from vaultline.operators.ingest import normalize
from vaultline.operators.scd import END
from vaultline.sources.committed import BucketTable

HOLDERS = "holders"


def weight(log: DataFrame) -> Column:
    """What a row of the log adds to the number of current rows that look like it."""
    opens = F.col(CHANGE_TYPE).isin("insert", "update_postimage")
    if END in log.columns:
        opens = opens & F.col(END).isNull()
    return F.when(opens, 1).when(F.col(CHANGE_TYPE).isin("update_preimage", "delete"), -1).otherwise(0)


class KeyCounts:
    """Holders of each value of ``column`` (normalised; NULL is no value) under ``root``.

    A value without holders is not kept.  A version that is applied again
    after a failure starts from the state before it, so it counts once.
    """

    def __init__(self, spark: SparkSession, root: str, column: T.StructField, buckets: int = 64) -> None:
        self.column = column.name
        self.schema = T.StructType([T.StructField(column.name, column.dataType), T.StructField(HOLDERS, T.LongType())])
        self.state = BucketTable(spark, root, [column.name], buckets)

    def latest(self) -> int | None:
        done = self.state.versions()
        return done[-1] if done else None

    def apply(self, log: DataFrame, version: int) -> bool:
        """Add one version of a change log; False if it is not newer than the latest."""
        latest = self.latest()
        if latest is not None and version <= latest:
            return False
        change = (normalize(log).where(F.col(self.column).isNotNull()).groupBy(self.column)
                  .agg(F.sum(weight(log)).alias(HOLDERS)).where(F.col(HOLDERS) != 0))
        touched = self._buckets(change)
        before = self.state.read(self.schema, touched)
        after = before.unionByName(change).groupBy(self.column).agg(F.sum(HOLDERS).alias(HOLDERS)).where(F.col(HOLDERS) > 0)
        self.state.commit(after.select(*self.schema.names), touched, version)
        return True

    def catch_up(self, history: SnapshotHistory) -> None:
        """Add what ``history`` committed since; a version whose open rows are not committed yet waits."""
        done, until = self.latest(), history.latest()
        for version in history.log.versions():
            if until is not None and version <= until and (done is None or version > done):
                self.apply(history.log.read(history.log_schema, version - 1, version), version)

    def _buckets(self, rows: DataFrame) -> list[int]:
        return [r[0] for r in rows.select(self.state.bucket().alias("b")).distinct().collect()]  # at most all buckets

    def counts(self, version: int | None = None) -> DataFrame:
        return self.state.read(self.schema, version=version)

    def repeated(self, rows: DataFrame | None = None) -> DataFrame:
        """Values with several holders; given ``rows``, only the buckets of their values are read."""
        if rows is None:
            known = self.counts()
        else:
            held = normalize(rows).where(F.col(self.column).isNotNull())
            known = self.state.read(self.schema, self._buckets(held))
        return known.where(F.col(HOLDERS) > 1).select(self.column)


def repeated_among(counts: Mapping[str, KeyCounts], rows: DataFrame) -> Callable[[str], DataFrame]:
    """The lookup ``assess`` takes: column -> its values with several holders, as far as ``rows`` need them."""
    return lambda column: counts[column].repeated(rows)
