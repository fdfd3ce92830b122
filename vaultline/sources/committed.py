"""Parquet tables that change by committed versions.

* ``AppendLog``    one folder per version, staged first and renamed as a whole,
                   so a reader (batch or file stream) sees a version entirely
                   or not at all; a version that is there is never written again.
* ``BucketTable``  the current rows of a keyed table in hash buckets.  A commit
                   writes the buckets it touches and a manifest (bucket ->
                   version that holds it); untouched buckets stay where they
                   are, and versions that no kept manifest names are deleted.
* ``stage``        one write of rows for several tables, by number; each table
                   then adopts its folder, so the rows are computed and dealt once.

Both live under a folder that all executors share.  A failure before the
rename or the manifest leaves the table as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.session import COMPACT, shuffles_end_with_write


class _Folder:
    """Hadoop file system calls below one root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def names(self, name: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(name))] if self.exists(name) else []

    def rename(self, name: str, to: str) -> None:
        self._fs.mkdirs(self._path(to).getParent())
        if not self._fs.rename(self._path(name), self._path(to)):
            raise OSError(f"cannot rename {self.root}/{name} to {to}")

    def take(self, folder: str, to: str) -> None:
        """Rename a folder given by its whole path; one that is not there becomes an empty folder."""
        target, source = self._path(to), self._jvm.org.apache.hadoop.fs.Path(folder)
        self._fs.mkdirs(target.getParent())
        if not self._fs.exists(source):
            self._fs.mkdirs(target)
        elif not self._fs.rename(source, target):
            raise OSError(f"cannot rename {folder} to {self.root}/{to}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def write_text(self, name: str, text: str) -> None:
        draft = f"_drafts/{uuid.uuid4().hex}"
        out = self._fs.create(self._path(draft), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.rename(draft, name)

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def _numbers(names: Sequence[str], prefix: str) -> list[int]:
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


class AppendLog:
    """Append-only versions: ``<root>/version=<n>/*.parquet``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self._folder = spark, root.rstrip("/"), _Folder(spark, root)

    def versions(self) -> list[int]:
        return _numbers(self._folder.names(""), "version=")

    def append(self, rows: DataFrame, version: int, options: dict[str, str] | None = None) -> bool:
        """Commit ``rows`` as ``version``; False, and nothing written, if that version is there."""
        if self._folder.exists(f"version={version}"):
            return False
        draft = f"_drafts/{version}-{uuid.uuid4().hex}"
        with shuffles_end_with_write(self.spark):
            rows.write.options(**(options or {})).parquet(f"{self.root}/{draft}")
        self._folder.rename(draft, f"version={version}")
        return True

    def adopt(self, folder: str, version: int) -> bool:
        """Commit a staged folder of this file system as ``version`` (one that is not there: no rows)."""
        if self._folder.exists(f"version={version}"):
            return False
        self._folder.take(folder, f"version={version}")
        return True

    def drop(self, version: int) -> None:
        """Remove a version that nobody reads any more."""
        self._folder.delete(f"version={version}")

    def read(self, schema: T.StructType, after: int | None = None, until: int | None = None) -> DataFrame:
        """Rows of the committed versions in (after, until]."""
        taken = [v for v in self.versions() if (after is None or v > after) and (until is None or v <= until)]
        if not taken:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/version={v}" for v in taken])

    def stream(self, schema: T.StructType, max_files: int | None = None) -> DataFrame:
        """The versions as a stream, each file once."""
        reader = self.spark.readStream.schema(schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", str(max_files))
        return reader.parquet(f"{self.root}/version=*")


class BucketTable:
    """Current rows by key, in ``buckets`` hash buckets."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 64, keep: int = 2) -> None:
        self.spark, self.root, self.keys, self.buckets, self.keep = spark, root.rstrip("/"), list(keys), buckets, keep
        self._folder = _Folder(spark, root)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def versions(self) -> list[int]:
        """Committed versions whose manifest is kept."""
        return _numbers(self._folder.names("_manifests"), "v")

    def manifest(self, version: int | None = None) -> dict[int, int]:
        """Bucket -> version whose files hold it (buckets without rows are left out)."""
        known = [v for v in self.versions() if version is None or v <= version]
        return {int(b): v for b, v in json.loads(self._folder.read_text(f"_manifests/v{known[-1]}")).items()} if known else {}

    def read(self, schema: T.StructType, buckets: Sequence[int] | None = None, version: int | None = None) -> DataFrame:
        """Rows of the buckets (all by default) as of the latest commit (or the one before ``version`` ends)."""
        held = self.manifest(version)
        taken = sorted(held) if buckets is None else [b for b in buckets if b in held]
        if not taken:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/data/v{held[b]}/bucket={b}" for b in taken])

    def stage(self, rows: DataFrame) -> str:
        """Write rows that carry their ``bucket``, or a negative number that is another table's, as ``<folder>/bucket=<n>``.

        The folder counts for nothing until ``commit`` takes it.
        """
        folder = f"{self.root}/_drafts/{uuid.uuid4().hex}"
        with shuffles_end_with_write(self.spark):
            rows.write.options(**COMPACT).partitionBy("bucket").parquet(folder)
        return folder

    def commit(self, rows: DataFrame | str, touched: Sequence[int], version: int) -> None:
        """Replace the ``touched`` buckets by ``rows`` (all rows of those buckets; or a staged folder) and commit.

        A commit that is run again after a failure writes the same version anew.
        """
        held = self.manifest(version - 1)
        if isinstance(rows, str):
            self._folder.delete(f"data/v{version}")
            draft = rows[len(self.root) + 1:]
            for b in set(_numbers(self._folder.names(draft), "bucket=")) & set(touched):
                self._folder.rename(f"{draft}/bucket={b}", f"data/v{version}/bucket={b}")
            self._folder.delete(draft)
        else:
            bucket = self.bucket().alias("bucket")
            target = f"{self.root}/data/v{version}"
            with shuffles_end_with_write(self.spark):
                rows.select("*", bucket).repartition("bucket").write.mode("overwrite").options(**COMPACT).partitionBy("bucket").parquet(target)
        written = set(_numbers(self._folder.names(f"data/v{version}"), "bucket="))
        held = {b: v for b, v in held.items() if b not in set(touched)} | {b: version for b in touched if b in written}
        self._folder.delete(f"_manifests/v{version}")
        self._folder.write_text(f"_manifests/v{version}", json.dumps(held))
        self._prune()

    def _prune(self) -> None:
        versions = self.versions()
        for v in versions[:-self.keep]:
            self._folder.delete(f"_manifests/v{v}")
        needed = {(v, b) for kept in self.versions() for b, v in self.manifest(kept).items()}
        for v in _numbers(self._folder.names("data"), "v"):
            if v > versions[-1]:
                continue
            held = _numbers(self._folder.names(f"data/v{v}"), "bucket=")
            spent = [b for b in held if (v, b) not in needed]
            for name in [f"data/v{v}"] if len(spent) == len(held) else [f"data/v{v}/bucket={b}" for b in spent]:
                self._folder.delete(name)
