"""Snapshot histories of all sources as keyed state, and the change log they append (CDC-01, CDC-02, SNK-01, SRC-05).

Every source is delivered as three full snapshots: by the first hex digit of
its key's MD5 a row is missing from one of them, has a new ``revision`` in
later ones, or moves only its untracked business date.  The same rules are
written a second time, as SQL, for the oracle.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.config import DOMAINS, TABLES, UNTRACKED_COLUMNS
from vaultline.operators import quarantine as QU
from vaultline.operators.history import SnapshotHistory
from vaultline.operators.keycounts import HOLDERS, KeyCounts, repeated_among
from vaultline.operators.ingest import UPPERCASE_IDENTIFIERS
from vaultline.operators.scd import END, START
from vaultline.plans import oracle as O
from vaultline.plans import pipeline as P
from vaultline.plans.registry import register
from vaultline.session import checkpoint_dir
from vaultline.sources import fixtures as fx
from vaultline.streaming import stream as S

VERSIONS = (20260705, 20260706, 20260707)
AT_ONCE = 6  # sources whose jobs are submitted side by side
#: Sources that Spark sizes above this go one at a time: each fills the cluster, and its shuffle files the disks, by itself.
ONE_BY_ONE_BYTES = 128 << 20
CUSTOMER_VERSIONS = tuple(20260705 + i for i in range(6))


def state_root(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/history/{name}-{uuid.uuid4().hex[:12]}"


def source_keys(table: str, columns) -> list[str]:
    """The source's keys as delivered (a key that ingestion derives is not there yet)."""
    return [k for k in TABLES[table].keys if k in columns]


def _business_key(keys):
    return F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def snapshot(df: DataFrame, keys, step: int) -> DataFrame:
    """The ``step``-th (1 to 3) full snapshot of a source."""
    digit = F.substring(F.md5(_business_key(keys).cast("binary")), 1, 1)
    missing = F.lit({1: "1", 2: "0", 3: "2"}[step])
    revision = F.when(digit == "3", step).when((digit == "4") & F.lit(step >= 2), 2).otherwise(1)
    out = df.where(digit != missing).withColumn("revision", revision.cast("int"))
    if "business_date" in df.columns:
        out = out.withColumn("business_date", F.when(digit == "5", F.date_add("business_date", step - 1)).otherwise(F.col("business_date")))
    return out


def history(spark: SparkSession, sf: str, table: str) -> SnapshotHistory:
    """All snapshots of a source applied in order (once per run)."""
    return fx.memo(spark, sf, ("history", table), lambda: _history(spark, sf, table))


def histories(spark: SparkSession, sf: str, tables) -> list[SnapshotHistory]:
    fx.load(spark, sf, *tables)
    with ThreadPoolExecutor(AT_ONCE) as small, ThreadPoolExecutor(1) as large:
        jobs = [(large if sized(fx.source(spark, sf, t)) > ONE_BY_ONE_BYTES else small).submit(history, spark, sf, t) for t in tables]
        return [job.result() for job in jobs]


def sized(df: DataFrame) -> int:
    """Bytes that Spark estimates; far too many for a join, never for a scan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _history(spark: SparkSession, sf: str, table: str) -> SnapshotHistory:
    df = fx.source(spark, sf, table)
    keys = source_keys(table, df.columns)
    state = SnapshotHistory(spark, state_root(spark, table), snapshot(df, keys, 1).schema, keys, TABLES[table].scd, UNTRACKED_COLUMNS, buckets=16)
    for step, version in enumerate(VERSIONS, 1):
        state.apply(snapshot(df, keys, step), version)
    return state


def _result(state: SnapshotHistory, table: str) -> DataFrame:
    rows = state.history()
    stamp = lambda c: (F.col(c) if c in rows.columns else F.lit(None)).cast("bigint").alias(c)
    date = F.col("business_date") if "business_date" in rows.columns else F.lit(None)
    return rows.select(
        F.lit(table).alias("source_table_name"), _business_key(state.keys).alias("source_business_key"), "revision",
        date.cast("date").alias("business_date"), stamp(START), stamp(END),
    )


def _domain(domain: str):
    tables = [t for t, s in TABLES.items() if s.domain == domain]

    def build(spark: SparkSession, sf: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [_result(s, t) for s, t in zip(histories(spark, sf, tables), tables)])

    return build


def _domain_sql(domain: str) -> str:
    q, parts = O.Q(), []
    for t, spec in TABLES.items():
        if spec.domain != domain:
            continue
        q.fixture(t)
        cols = [c for c in O.fixture_columns(t) if c != "rn"]  # rn: a working column inside a source's text
        keys = source_keys(t, cols)
        key = "concat_ws(':', " + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys) + ")"
        date = "business_date + CASE WHEN d = '5' THEN v - 1 ELSE 0 END" if "business_date" in cols else "NULL"
        order = ", ".join(f"{c} DESC NULLS LAST" for c in cols if c not in keys)
        q.add(f"d_{t}", f"SELECT *, {key} AS sbk, substr(md5({key}), 1, 1) AS d FROM {t}")
        q.add(f"s_{t}", f"""SELECT sbk, v, CAST(CASE WHEN d = '3' THEN v WHEN d = '4' AND v >= 2 THEN 2 ELSE 1 END AS INTEGER) AS revision,
  CAST({date} AS DATE) AS business_date
FROM (SELECT *, row_number() OVER (PARTITION BY sbk, v ORDER BY {order}) AS pick FROM d_{t}, (VALUES (1), (2), (3)) x(v)
      WHERE NOT (v = 1 AND d = '1') AND NOT (v = 2 AND d = '0') AND NOT (v = 3 AND d = '2')) WHERE pick = 1""")
        if spec.scd == 1:
            parts.append(f"SELECT '{t}' AS source_table_name, sbk AS source_business_key, revision, business_date, "
                         f"CAST(NULL AS BIGINT) AS __START_AT, CAST(NULL AS BIGINT) AS __END_AT FROM s_{t} WHERE v = 3")
            continue
        q.add(f"m_{t}", f"""SELECT *, sum(CASE WHEN pv = v - 1 AND pr = revision THEN 0 ELSE 1 END) OVER (PARTITION BY sbk ORDER BY v) AS seg
FROM (SELECT *, lag(v) OVER w AS pv, lag(revision) OVER w AS pr FROM s_{t} WINDOW w AS (PARTITION BY sbk ORDER BY v))""")
        parts.append(f"SELECT '{t}' AS source_table_name, sbk AS source_business_key, max(revision) AS revision, arg_max(business_date, v) "
                     f"AS business_date, CAST(20260704 + min(v) AS BIGINT) AS __START_AT, "
                     f"CAST(CASE WHEN max(v) < 3 THEN 20260705 + max(v) END AS BIGINT) AS __END_AT FROM m_{t} GROUP BY sbk, seg")
    return q.sql("\nUNION ALL\n".join(parts))


for _d in DOMAINS:
    register(f"bronze_scd_{_d}", _domain_sql(_d))(_domain(_d))


# ------------------------------------------------------------ change log


def customer_history(spark: SparkSession, sf: str) -> SnapshotHistory:
    """Six customer snapshots; each delivered twice, as a replayed batch would."""
    snaps = fx.source(spark, sf, "customer_snapshot")
    at = lambda v: snaps.where(F.col("version") == v).drop("version")
    state = SnapshotHistory(spark, state_root(spark, "customer"), snaps.drop("version").schema, ["cust_no"], 2, UNTRACKED_COLUMNS, buckets=16)
    for v in CUSTOMER_VERSIONS:
        state.apply(at(v), v)
        state.apply(at(v), v)
    return state


def _customer_state(spark, sf) -> SnapshotHistory:
    return fx.memo(spark, sf, ("customer-log",), lambda: customer_history(spark, sf))


def _log_sql(where: str = "") -> str:
    from vaultline.plans.q_cdc import _history_sql

    q = O.Q()
    _history_sql(q)
    cols = "cust_no, full_name, segment, address, business_date"
    q.add("spans", "SELECT cust_no, seg, min(version) AS start_v, max(version) AS last_v FROM x GROUP BY cust_no, seg")
    q.add("rows_", """SELECT x.*, s.start_v, s.last_v, lag(x.business_date) OVER (PARTITION BY x.cust_no, x.seg ORDER BY x.version) AS was
FROM x JOIN spans s ON s.cust_no = x.cust_no AND s.seg = x.seg""")
    was = cols.replace("business_date", "was AS business_date")
    q.add("log_", f"""SELECT {cols}, start_v AS __START_AT, NULL AS __END_AT, 'insert' AS _change_type, version AS _commit_version FROM rows_ WHERE version = start_v
UNION ALL SELECT {was}, start_v, NULL, 'update_preimage', version FROM rows_ WHERE version > start_v AND was IS DISTINCT FROM business_date
UNION ALL SELECT {cols}, start_v, NULL, 'update_postimage', version FROM rows_ WHERE version > start_v AND was IS DISTINCT FROM business_date
UNION ALL SELECT {cols}, start_v, NULL, 'update_preimage', ng FROM rows_ WHERE version = last_v AND ng IS NOT NULL
UNION ALL SELECT {cols}, start_v, ng, 'update_postimage', ng FROM rows_ WHERE version = last_v AND ng IS NOT NULL""")
    return q.sql(f"SELECT {cols}, CAST(__START_AT AS BIGINT) AS __START_AT, CAST(__END_AT AS BIGINT) AS __END_AT, _change_type, "
                 f"CAST(_commit_version AS BIGINT) AS _commit_version FROM log_ {where}")


register("bronze_change_log", _log_sql())(
    lambda spark, sf: _customer_state(spark, sf).log.read(_customer_state(spark, sf).log_schema))


def _stream_log(spark, sf):
    """The log read as a stream, a few files a batch, through the filter for after-images."""
    state = _customer_state(spark, sf)
    work = state_root(spark, "log-reader")
    (state.stream(max_files=4).writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/ckpt")
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(state.log_schema).parquet(f"{work}/out")


register("stream_change_log", _log_sql("WHERE _change_type IN ('insert', 'update_postimage')"))(_stream_log)


def _rebuilt(spark, sf):
    """The current customers, rebuilt from nothing but the log: each key's last change, unless it closed the row."""
    state = _customer_state(spark, sf)
    image = F.struct("full_name", "segment", "address", "business_date", START, END)
    last = state.changes().groupBy("cust_no").agg(F.max_by(image, F.struct(F.col("_commit_version"), F.col(END).isNull())).alias("r"))
    return last.select("cust_no", "r.*").where(F.col(END).isNull())


def _rebuilt_sql() -> str:
    from vaultline.plans.q_cdc import _history_sql

    q = O.Q()
    return q.sql(f"SELECT * FROM {_history_sql(q)} WHERE __END_AT IS NULL")


register("bronze_rebuilt_from_log", _rebuilt_sql())(_rebuilt)


# ------------------------------------ only current versions are quarantined
LOOKS = 4  # micro-batches of a log whose reader looks up the open rows in each
VERSIONED = tuple(t for t, s in TABLES.items() if s.domain == "customer" and s.scd == 2)
_FOUND = ("source_table_name", "source_business_key", "failed_rule_name")


def _quarantine_current(spark, sf):
    """Assess every after-image of the logs; records of each key's current version only."""
    parts = []
    for state, t in zip(histories(spark, sf, VERSIONED), VERSIONED):
        assessed = QU.assess(state.changes(), t, current=state.current(), as_of=P.RUN_CLOCK)
        parts.append(QU.quarantine_records(assessed, t, P.RUN_ID, state.active_versions(), with_timestamp=False).select(*_FOUND))
    return reduce(DataFrame.unionByName, parts).distinct()


def _stream_quarantine_current(spark, sf):
    """The same, reading the logs as streams; the current versions are looked up once per micro-batch."""
    work = state_root(spark, "quarantine-current")
    sources = [S.SourceStream(t, state.stream(max_files=8, at_most=LOOKS), state.current, state.active_versions)
               for state, t in zip(histories(spark, sf, VERSIONED), VERSIONED)]
    S.quarantine_streams(sources, f"{work}/out", f"{work}/ckpt", as_of=P.RUN_CLOCK, run_id=P.RUN_ID)
    return S.quarantine_result(spark, f"{work}/out").select(*_FOUND).distinct()


def _current_sql() -> str:
    """The rules over the rows that the last snapshot holds, one per key."""
    q, parts = O.Q(), []
    for t in VERSIONED:
        q.fixture(t)
        cols = O.fixture_columns(t)
        key = "concat_ws(':', " + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in source_keys(t, cols)) + ")"
        order = ", ".join(f"{c} DESC NULLS LAST" for c in cols if c not in TABLES[t].keys)
        q.add(f"r_{t}", f"""SELECT * EXCLUDE (pick) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS pick
  FROM {t} WHERE substr(md5({key}), 1, 1) <> '2') WHERE pick = 1""")
        sbk = "concat_ws(':', " + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '<NULL>')" for k in TABLES[t].keys) + ")"
        parts.append(f"SELECT DISTINCT '{t}' AS source_table_name, {sbk} AS source_business_key, failed_rule_name FROM {q.failures(t)}")
    return q.sql("\nUNION ALL\n".join(parts))


register("dq_quarantine_current_versions", _current_sql())(_quarantine_current)
register("stream_quarantine_current_versions", _current_sql())(_stream_quarantine_current)


# ------------------------------------------- duplicate lookups from kept counts
def _counts(spark, sf) -> dict[str, dict[str, KeyCounts]]:
    """Per source and unique column: holders, added up version by version from the source's log (once per run)."""
    def build():
        out = {}
        for state, t in zip(histories(spark, sf, VERSIONED), VERSIONED):
            out[t] = {c: KeyCounts(spark, state_root(spark, f"counts-{t}-{c}"), state.schema[c], buckets=16) for c in QU.unique_columns(t)}
            for kept in out[t].values():
                kept.catch_up(state)
        return out

    return fx.memo(spark, sf, ("key-counts",), build)


def _holder_counts(spark, sf):
    """How many values have how many holders, by source and unique column."""
    parts = [kept.counts().groupBy(HOLDERS).agg(F.count(F.lit(1)).alias("distinct_values"))
             .select(F.lit(t).alias("source_table_name"), F.lit(c).alias("column_name"), HOLDERS, "distinct_values")
             for t, columns in _counts(spark, sf).items() for c, kept in columns.items()]
    return reduce(DataFrame.unionByName, parts)


def _holder_counts_sql() -> str:
    """The same counts by regrouping the rows of the last snapshot."""
    q, parts = O.Q(), []
    for t in VERSIONED:
        q.fixture(t)
        cols = O.fixture_columns(t)
        key = "concat_ws(':', " + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in source_keys(t, cols)) + ")"
        order = ", ".join(f"{c} DESC NULLS LAST" for c in cols if c not in TABLES[t].keys)
        q.add(f"last_{t}", f"""SELECT DISTINCT ON ({key}) * FROM {t} WHERE substr(md5({key}), 1, 1) <> '2' ORDER BY {key}, {order}""")
        for c in QU.unique_columns(t):
            value = f"upper(trim({c}))" if c in UPPERCASE_IDENTIFIERS else c
            parts.append(f"""SELECT '{t}' AS source_table_name, '{c}' AS column_name, holders, count(*) AS distinct_values
FROM (SELECT count(*) AS holders FROM last_{t} WHERE {c} IS NOT NULL GROUP BY {value}) GROUP BY holders""")
    return q.sql("\nUNION ALL\n".join(parts))


def _stream_quarantine_counted(spark, sf):
    """The stream of current versions again; duplicate values come from kept counts, not from the whole table."""
    work = state_root(spark, "quarantine-counted")
    counts = _counts(spark, sf)
    sources = [S.SourceStream(t, state.stream(max_files=8, at_most=LOOKS), active=state.active_versions,
                              repeated=lambda batch, t=t: repeated_among(counts[t], batch))
               for state, t in zip(histories(spark, sf, VERSIONED), VERSIONED)]
    S.quarantine_streams(sources, f"{work}/out", f"{work}/ckpt", as_of=P.RUN_CLOCK, run_id=P.RUN_ID)
    return S.quarantine_result(spark, f"{work}/out").select(*_FOUND).distinct()


register("bronze_key_holders", _holder_counts_sql())(_holder_counts)
register("stream_quarantine_kept_counts", _current_sql())(_stream_quarantine_counted)
