"""JSON-line feeds read without losing what does not fit the declared schema.

A line is parsed into a map of texts first, so every field survives: declared
columns are cast, and a value that was there but does not cast, a column that
nobody declared, or a line that is no JSON object stays as text in
``_rescued_data`` (a JSON object, keys sorted; NULL if nothing was rescued).

``RescuedTable`` takes such a feed batch by batch.  With ``evolve`` a column
that a batch brings for the first time joins the schema, as text, from that
batch on; the schema of each batch is stored before its rows, so a batch that
is run again reads the same schema and adds nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.sources.committed import AppendLog, _Folder, _numbers

RESCUED, CORRUPT = "_rescued_data", "_corrupt_record"
MAX_COLUMNS = 10_000  # a feed that names more columns than this is not a table: an error, nothing is cut


def parsed(lines: DataFrame) -> DataFrame:
    """``line`` and ``fields`` (name -> text; NULL for a line that is no JSON object) of a text source."""
    return lines.select(F.col("value").alias("line"), F.from_json("value", "MAP<STRING, STRING>").alias("fields"))


def rescue(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of ``schema`` plus ``_rescued_data``; blank lines are no rows.

    A field that is NULL or absent is NULL and not rescued.  Names match exactly.
    """
    names = [f.name for f in schema.fields]

    def typed(field: T.StructField) -> Column:
        return F.col("fields")[field.name].try_cast(field.dataType)

    misfits = F.map_filter("fields", lambda name, text: text.isNotNull() & ~name.isin(*names))
    if names:
        lost = F.array(*[F.when(F.col("fields")[f.name].isNotNull() & typed(f).isNull(), F.lit(f.name)) for f in schema.fields])
        misfits = F.map_filter("fields", lambda name, text: text.isNotNull() & (~name.isin(*names) | F.array_contains(F.array_compact(lost), name)))
    kept = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(misfits))))
    rescued = F.when(F.col("fields").isNull(), F.to_json(F.struct(F.col("line").alias(CORRUPT)))).when(F.size(misfits) > 0, kept)
    return (parsed(lines).where(F.length(F.trim("line")) > 0)
            .select(*[typed(f).alias(f.name) for f in schema.fields], rescued.alias(RESCUED)))


def unknown_columns(lines: DataFrame, schema: T.StructType) -> list[str]:
    """Names that hold a value in some line and are not declared, sorted."""
    names = (parsed(lines).select(F.explode(F.map_keys(F.map_filter("fields", lambda _, text: text.isNotNull()))).alias("name"))
             .distinct().where(~F.col("name").isin(*[f.name for f in schema.fields], RESCUED)))
    found = [r[0] for r in names.limit(MAX_COLUMNS + 1).collect()]
    if len(found) > MAX_COLUMNS:
        raise ValueError(f"a feed with over {MAX_COLUMNS} undeclared columns")
    return sorted(found)


class RescuedTable:
    """Typed rows of a JSON-line feed under ``root``, one committed version per batch."""

    def __init__(self, spark: SparkSession, root: str, declared: T.StructType, evolve: bool = False) -> None:
        self.spark, self.declared, self.evolve = spark, declared, evolve
        self.rows = AppendLog(spark, f"{root.rstrip('/')}/rows")
        self._folder = _Folder(spark, f"{root.rstrip('/')}/schema")

    def schema(self, version: int | None = None) -> T.StructType:
        """The schema as of a version (the latest by default)."""
        known = [v for v in _numbers(self._folder.names(""), "v") if version is None or v <= version]
        return T.StructType.fromJson(json.loads(self._folder.read_text(f"v{known[-1]}"))) if known else self.declared

    def apply(self, lines: DataFrame, version: int) -> bool:
        """Add a batch of lines; False, and nothing written, if that version is there."""
        if version in self.rows.versions():
            return False
        if not self._folder.exists(f"v{version}"):
            schema = self.schema(version - 1)
            if self.evolve:
                schema = T.StructType(schema.fields + [T.StructField(n, T.StringType()) for n in unknown_columns(lines, schema)])
            self._folder.write_text(f"v{version}", json.dumps(schema.jsonValue()))
        return self.rows.append(rescue(lines, self.schema(version)), version)

    def read(self) -> DataFrame:
        """All rows in the latest schema; columns that came later are NULL in older rows."""
        return self.rows.read(T.StructType(self.schema().fields + [T.StructField(RESCUED, T.StringType())]))


def rescued_stream(spark: SparkSession, path: str, table: RescuedTable, checkpoint: str, max_files: int | None = None) -> None:
    """Run the text files under ``path`` into ``table`` to completion, each file once."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    (reader.text(path).writeStream.foreachBatch(lambda batch, number: table.apply(batch, number + 1) and None)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
