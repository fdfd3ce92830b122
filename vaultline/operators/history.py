"""Snapshot history of one source as keyed state, with an append-only change log.

Every full snapshot is compared with the open rows once, in one grouped
aggregate by key.  The differences are the change log, in the form in which a
history table's change feed has them: a new version is an ``insert``, the row
it closes an ``update_preimage`` / ``update_postimage`` pair with ``__END_AT``
set, a change of untracked columns a pair that stays open; without history
(type 1) a change is a pair and a missing key a ``delete``.

The same aggregate gives the closed rows, which are appended, and the open
rows; all three are staged in one write, so a version's rows are dealt by key
once.  Open rows are replaced only in the key buckets that the log names.  A
version counts once the open rows are committed; one that failed before is
applied again from its log, if that was written, and else from the snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.operators.scd import END, START
from vaultline.session import shuffles_end_with_write
from vaultline.sources.committed import AppendLog, BucketTable

CHANGE_TYPE, COMMIT_VERSION = "_change_type", "_commit_version"
#: Numbers of the log and of closed rows beside the buckets of the open rows, while a version is staged.
_LOG, _CLOSED, _OPEN = -1, -2, 0
#: Changes that say what a row is now (a reader of the log takes these).
AFTER_IMAGES = ("insert", "update_postimage")


class _Row(NamedTuple):
    """A row that keys with one of ``fates`` get: the image it has, where it goes, what its stamps and change type are."""

    fates: str
    side: str
    to: int
    kind: str | None = None
    opens: bool = False
    ends: bool = False


FATES = ("came", "went", "moved", "touched", "stays")
_ROWS = {
    2: [
        _Row("moved went touched", "o", _LOG, "update_preimage"),
        _Row("moved went", "o", _LOG, "update_postimage", ends=True),
        _Row("touched", "s", _LOG, "update_postimage"),
        _Row("came moved", "s", _LOG, "insert", opens=True),
        _Row("moved went", "o", _CLOSED, ends=True),
        _Row("came moved", "s", _OPEN, opens=True),
        _Row("touched", "s", _OPEN),
        _Row("stays", "o", _OPEN),
    ],
    1: [
        _Row("moved touched", "o", _LOG, "update_preimage"),
        _Row("moved touched", "s", _LOG, "update_postimage"),
        _Row("came", "s", _LOG, "insert"),
        _Row("went", "o", _LOG, "delete"),
        _Row("came moved touched", "s", _OPEN),
        _Row("stays", "o", _OPEN),
    ],
}


class SnapshotHistory:
    """State of one source under ``root``: ``open``, ``closed`` and ``log``.

    ``schema`` is the snapshots' schema; ``untracked`` columns never open a
    version; ``scd`` is 1 or 2.  NULL keys are a key like any other; a key
    that a snapshot repeats counts once (its greatest row).
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], scd: int = 2,
                 untracked: Sequence[str] = (), buckets: int = 64) -> None:
        if scd not in (1, 2):
            raise ValueError("scd must be 1 or 2")
        self.spark, self.keys, self.scd = spark, list(keys), scd
        self.data = [f.name for f in schema.fields if f.name not in self.keys]
        self.tracked = [c for c in self.data if c not in set(untracked)]
        fields = [schema[k] for k in self.keys] + [schema[c] for c in self.data]
        stamps = [T.StructField(START, T.LongType()), T.StructField(END, T.LongType())] if scd == 2 else []
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + stamps)
        self.log_schema = T.StructType(self.schema.fields + [
            T.StructField(CHANGE_TYPE, T.StringType()), T.StructField(COMMIT_VERSION, T.LongType())])
        root = root.rstrip("/")
        self.open = BucketTable(spark, f"{root}/open", self.keys, buckets)
        self.closed = AppendLog(spark, f"{root}/closed")
        self.log = AppendLog(spark, f"{root}/log")
        self.rejected = AppendLog(spark, f"{root}/rejected")

    def latest(self) -> int | None:
        done = self.open.versions()
        return done[-1] if done else None

    def apply(self, snapshot: DataFrame, version: int) -> bool:
        """Apply the full snapshot of ``version``; an empty one closes every key.

        A version that is not newer than the latest changes nothing: its rows
        go to ``rejected`` (once) and the result is False.  So a late file
        never stops the versions after it.
        """
        latest = self.latest()
        if latest is not None and version <= latest:
            if version != latest:
                self.rejected.append(snapshot, version)
            return False
        if version in self.log.versions():
            self._redo(version)
            return True
        # One write: the change log, the closed rows and the open rows by bucket.
        first = latest is None
        folder = self.open.stage(self._step(snapshot, version))
        self.log.adopt(f"{folder}/bucket={_LOG}", version)
        if self.scd == 2:
            self.closed.adopt(f"{folder}/bucket={_CLOSED}", version)
        self.open.commit(folder, range(self.open.buckets) if first else self._touched(version), version)
        return True

    def _log_of(self, version: int) -> DataFrame:
        return self.log.read(self.log_schema, version - 1, version)

    def _touched(self, version: int) -> list[int]:
        with shuffles_end_with_write(self.spark):
            return [r[0] for r in self._log_of(version).select(self.open.bucket().alias("b")).distinct().collect()]  # at most all buckets

    def _redo(self, version: int) -> None:
        """Commit a version that has its log, from the log."""
        changes, touched = self._log_of(version), self._touched(version)
        rows = [f.name for f in self.schema.fields]
        after = changes.where(F.col(CHANGE_TYPE).isin(*AFTER_IMAGES))
        if self.scd == 2:
            self.closed.append(after.where(F.col(END).isNotNull()).select(*rows), version)
            after = after.where(F.col(END).isNull())
        changed = changes.select(*[F.col(k).alias(f"_c_{k}") for k in self.keys]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in self.keys]
        kept = self.open.read(self.schema, touched).join(changed, same, "left_anti")
        self.open.commit(kept.unionByName(after.select(*rows)), touched, version)

    def _step(self, snapshot: DataFrame, version: int) -> DataFrame:
        """Rows of the change log, closed rows and open rows, told apart by ``bucket``."""
        v, never = F.lit(version).cast("bigint"), F.lit(None).cast("bigint")
        image = F.struct(*[F.col(c) for c in self.data], *([F.col(START)] if self.scd == 2 else []))
        before = self.open.read(self.schema).select(*self.keys, image.alias("o"), F.lit(None).cast(image_type(self)).alias("s"))
        now = snapshot.select(*self.keys, *self.data)
        if self.scd == 2:
            now = now.withColumn(START, v)
        now = now.select(*self.keys, F.lit(None).cast(image_type(self)).alias("o"), image.alias("s"))
        # One aggregate compares both sides, and makes a repeated key's greatest row the snapshot's.
        both = before.unionByName(now).groupBy(*self.keys).agg(F.max("o").alias("o"), F.max("s").alias("s"))

        def differ(names: Sequence[str]):
            return reduce(or_, [~F.col(f"o.{c}").eqNullSafe(F.col(f"s.{c}")) for c in names], F.lit(False))

        came, went = F.col("o").isNull(), F.col("s").isNull()
        moved = ~came & ~went & differ(self.tracked)
        touched = ~came & ~went & ~moved & differ(self.data)

        # What becomes of a key (a column of its own, as it is compared once), and the rows that say so.
        fate = F.when(came, "came").when(went, "went").when(moved, "moved").when(touched, "touched").otherwise("stays")
        rows = _ROWS[self.scd]
        lists = [F.when(F.col("_fate") == f, F.array(*[F.lit(i) for i, r in enumerate(rows) if f in r.fates.split()])) for f in FATES]
        out = both.withColumn("_fate", fate).withColumn("_row", F.explode(F.coalesce(*lists)))

        def where(wanted):
            return F.col("_row").isin([i for i, r in enumerate(rows) if wanted(r)])

        new = where(lambda r: r.side == "s")
        data = [F.when(new, F.col(f"s.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in self.data]
        stamps = [F.when(where(lambda r: r.opens), v).otherwise(F.col(f"o.{START}")).alias(START),
                  F.when(where(lambda r: r.ends), v).alias(END)] if self.scd == 2 else []
        kind = F.coalesce(*[F.when(where(lambda r: r.kind == k), k) for k in sorted({r.kind for r in rows if r.kind})])
        bucket = F.when(where(lambda r: r.to == _LOG), _LOG).when(where(lambda r: r.to == _CLOSED), _CLOSED).otherwise(self.open.bucket())
        stamp = F.when(where(lambda r: r.to == _LOG), v)
        return out.select(*self.keys, *data, *stamps, kind.alias(CHANGE_TYPE), stamp.alias(COMMIT_VERSION), bucket.alias("bucket"))

    def current(self) -> DataFrame:
        """Open rows (type 1: the table)."""
        return self.open.read(self.schema)

    def history(self) -> DataFrame:
        """Open and closed rows."""
        if self.scd == 1:
            return self.current()
        return self.current().unionByName(self.closed.read(self.schema))

    def active_versions(self, until: int | None = None) -> DataFrame:
        """Keys with the start of their current version."""
        return self.open.read(self.schema, version=until).select(*self.keys, START)

    def changes(self, after: int | None = None, until: int | None = None, kinds: Sequence[str] = AFTER_IMAGES) -> DataFrame:
        """Rows of the log that say what a row is now, of versions in (after, until]."""
        return self.log.read(self.log_schema, after, until).where(F.col(CHANGE_TYPE).isin(*kinds))

    def stream(self, kinds: Sequence[str] = AFTER_IMAGES, max_files: int | None = None, at_most: int | None = None) -> DataFrame:
        """The log as a stream of those rows.

        ``at_most`` bounds the micro-batches that the files there are now make: a reader that looks into the whole
        table once a batch then costs a fixed number of looks, as a larger log makes its batches larger, not more.
        """
        if at_most:
            files = len(self.log.read(self.log_schema).inputFiles())
            max_files = max(max_files or 1, -(-files // at_most))
        return self.log.stream(self.log_schema, max_files).where(F.col(CHANGE_TYPE).isin(*kinds))


def image_type(history: SnapshotHistory) -> T.StructType:
    names = history.data + ([START] if history.scd == 2 else [])
    return T.StructType([history.schema[n] for n in names])
