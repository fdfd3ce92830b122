"""Rescued data end to end (SRC-07, DQ-06, DQ-08): a JSON-line feed as a stream, typed rows with what did
not fit, assessment, and whole quarantine records (key, payload and rescued text compared).

By the first hex digit of its key's MD5 a row is delivered with a date that is none, or with a column
nobody declared; the SQL states the records, their JSON texts included, a second time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.config import TABLES
from vaultline.operators import quarantine as QU
from vaultline.operators.ingest import UPPERCASE_IDENTIFIERS
from vaultline.plans import oracle as O
from vaultline.plans import pipeline as P
from vaultline.plans.q_history import state_root
from vaultline.plans.registry import register
from vaultline.sources import fixtures as fx
from vaultline.sources.rescue import RescuedTable, rescued_stream

# Source -> its date column that some deliveries break.
FEEDS = {"customer_kyc": "verified_date", "watchlist": "added_date"}
BROKEN, EXTRA_COLUMN, EXTRA = "not-a-date", "remark", "carried over"


def _digit(table: str):
    return F.substring(F.md5(F.coalesce(F.col(TABLES[table].business_key), F.lit("")).cast("binary")), 1, 1)


def _feed(spark, sf, table: str, evolve: bool) -> RescuedTable:
    """The source as JSON lines in four files, streamed two at a time."""
    def build():
        src, digit, date = fx.source(spark, sf, table), _digit(table), FEEDS[table]
        texts = [F.when(digit == "7", BROKEN).otherwise(F.col(c).cast("string")).alias(c) if c == date else F.col(c).cast("string").alias(c)
                 for c in src.columns]
        work = state_root(spark, f"feed-{table}")
        lines = src.select(F.to_json(F.struct(*texts, F.when(digit == "8", EXTRA).alias(EXTRA_COLUMN))).alias("value"))
        lines.repartition(4).write.text(f"{work}/in")
        out = RescuedTable(spark, f"{work}/table", src.schema, evolve)
        rescued_stream(spark, f"{work}/in", out, f"{work}/ckpt", max_files=2)
        return out

    return fx.memo(spark, sf, ("feed", table, evolve), build)


def _records(spark, sf) -> DataFrame:
    parts = []
    for table in FEEDS:
        assessed = QU.assess(_feed(spark, sf, table, False).read(), table, as_of=P.RUN_CLOCK)
        parts.append(QU.quarantine_records(assessed, table, P.RUN_ID, with_timestamp=False))
    return reduce(DataFrame.unionByName, parts)


def _object(fields: dict[str, str]) -> str:
    """SQL of a JSON object without its NULL fields."""
    parts = ", ".join(f"""'"{name}":' || CAST(to_json({value}) AS VARCHAR)""" for name, value in fields.items())
    return f"concat('{{', concat_ws(',', {parts}), '}}')"


def _records_sql() -> str:
    q, parts = O.Q(), []
    for t, date in FEEDS.items():
        q.fixture(t)
        spec, cols = TABLES[t], O.fixture_columns(t)
        rewritten = [c for c in cols if c in UPPERCASE_IDENTIFIERS]
        dates = {c for c in cols if c.endswith("_date")}
        q.add(f"r_{t}", f"""SELECT * REPLACE (CASE WHEN d <> '7' THEN {date} END AS {date}), {"".join(f"{c} AS raw_{c}, " for c in rewritten)}
  CASE d WHEN '7' THEN '{{"{date}":"{BROKEN}"}}' WHEN '8' THEN '{{"{EXTRA_COLUMN}":"{EXTRA}"}}' END AS rescued
FROM (SELECT *, substr(md5(coalesce({spec.business_key}, '')), 1, 1) AS d FROM {t})""")
        n = q.normalized(t)
        tests = [f"CASE WHEN NOT coalesce({p}, FALSE) THEN '{name}' END" for name, p in q.rule_sql(t).items()]
        tests += [f"CASE WHEN {flag} THEN '{name}' END" for name, flag in q.dup_conditions(t)]
        q.add(f"a_{t}", f"""SELECT *, [x FOR x IN CAST([{", ".join(tests)}] AS VARCHAR[]) IF x IS NOT NULL] AS failed,
  concat_ws(':', {", ".join(f"coalesce(CAST({k} AS VARCHAR), '<NULL>')" for k in spec.lineage_keys)}) AS sbk FROM {n}""")
        text = {c: f"CAST({c} AS VARCHAR)" if c in dates else c for c in cols}
        row = _object({**text, "_rescued_data": "rescued", "_failed_rule_names": "failed", "_rescued_data_json": "rescued",
                       "validation_business_date": "CAST(business_date AS VARCHAR)", "is_quarantined": "TRUE"})
        given = _object({**{c: f"raw_{c}" if c in rewritten else v for c, v in text.items()}, "_rescued_data": "rescued"})
        parts.append(f"""SELECT sha256(concat_ws('|', '{spec.domain}', '{t}', sbk, sha256({row}), name)) AS quarantine_key,
  '{O.RUN_ID}' AS pipeline_run_id, '{t}' AS source_table_name, sbk AS source_business_key,
  '{t}.{"+".join(spec.lineage_keys)}=' || sbk AS bronze_record_ref, name AS failed_rule_name,
  if(name = '{QU.RESCUED}', name, '{QU.RULE_FAILURE}') AS quarantine_reason, rescued AS rescued_data_json, {given} AS quarantine_data_payload
FROM a_{t}, unnest(list_concat(failed, if(rescued IS NULL, [], ['{QU.RESCUED}']))) AS u(name)""")
    return q.sql("\nUNION ALL\n".join(parts))


register("dq_rescued_quarantine", _records_sql())(_records)


def _evolved(spark, sf) -> DataFrame:
    """The same feeds with a schema that grows: the new column is a column, only the broken dates are rescued."""
    parts = []
    for t, date in FEEDS.items():
        rows = _feed(spark, sf, t, True).read()
        extra = F.col(EXTRA_COLUMN) if EXTRA_COLUMN in rows.columns else F.lit(None).cast("string")  # no delivery had it
        parts.append(rows.select(F.lit(t).alias("source_table_name"), F.col(TABLES[t].business_key).alias("source_business_key"),
                                 F.col(date).alias("day"), extra.alias(EXTRA_COLUMN), F.col("_rescued_data").alias("rescued_data_json")))
    return reduce(DataFrame.unionByName, parts)


def _evolved_sql() -> str:
    q, parts = O.Q(), []
    for t, date in FEEDS.items():
        q.fixture(t)
        key = TABLES[t].business_key
        parts.append(f"""SELECT '{t}' AS source_table_name, {key} AS source_business_key, CASE WHEN d <> '7' THEN {date} END AS day,
  CASE WHEN d = '8' THEN '{EXTRA}' END AS {EXTRA_COLUMN}, CASE WHEN d = '7' THEN '{{"{date}":"{BROKEN}"}}' END AS rescued_data_json
FROM (SELECT *, substr(md5(coalesce({key}, '')), 1, 1) AS d FROM {t})""")
    return q.sql(" UNION ALL ".join(parts))


register("stream_rescued_evolution", _evolved_sql())(_evolved)
