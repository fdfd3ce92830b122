"""Streaming queries (ST-01..06): the same answers as batch, via
file-source streams with ``availableNow`` triggers.

Each run lands its input files, sinks and checkpoints in a fresh folder
under the session's shared checkpoint directory."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vaultline.config import TABLES, UNTRACKED_COLUMNS
from vaultline.plans import oracle as O
from vaultline.plans import pipeline as P
from vaultline.plans.registry import register
from vaultline.session import checkpoint_dir
from vaultline.sources import fixtures as fx
from vaultline.streaming import stream as S


def _workdir(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/stream-{name}-{uuid.uuid4().hex[:12]}"


def _land(df, path: str, files: int = 4) -> None:
    df.repartition(files).write.mode("overwrite").parquet(path)


def _assess_run(spark, sf, table: str):
    key = ("stream", "assess", table)
    cache = fx._cache(spark, sf)
    if key not in cache:
        work = _workdir(spark, f"assess-{table}")
        bronze = P.bronze(spark, sf, table)
        _land(bronze, f"{work}/in")
        src = S.read_stream(spark, f"{work}/in", bronze.schema, max_files=1)
        S.assess_stream(spark, src, table, f"{work}/in", f"{work}/out", f"{work}/ckpt", as_of=P.RUN_CLOCK,
                        run_id=P.RUN_ID)
        cache[key] = f"{work}/out"
    return cache[key]


def _stream_validated(spark, sf):
    out = _assess_run(spark, sf, "core_banking_customer")
    return spark.read.parquet(f"{out}/validated").drop("batch_id")


register("stream_assess_split", (lambda q: q.sql(f"SELECT * FROM {q.validated('core_banking_customer')}"))(O.Q()))(
    _stream_validated)


def _stream_quarantine(spark, sf):
    out = _assess_run(spark, sf, "core_banking_customer")
    return spark.read.parquet(f"{out}/quarantine").select(
        "source_table_name", "source_business_key", "bronze_record_ref", "failed_rule_name", "quarantine_reason",
        "pipeline_run_id")


def _stream_quarantine_sql() -> str:
    q = O.Q()
    f = q.failures("core_banking_customer")
    return q.sql(f"""SELECT 'core_banking_customer' AS source_table_name, coalesce(cust_no, '<NULL>') AS source_business_key,
  'core_banking_customer.cust_no=' || coalesce(cust_no, '<NULL>') AS bronze_record_ref, failed_rule_name,
  'VALIDATION_RULE_FAILURE' AS quarantine_reason, '{P.RUN_ID}' AS pipeline_run_id FROM {f}""")


register("stream_quarantine", _stream_quarantine_sql())(_stream_quarantine)

DEDUP_KEYS = ["gateway_txn_id", "status", "sequence_number", "status_timestamp"]


def _stream_dedup(spark, sf):
    work = _workdir(spark, "dedup")
    src_df = fx.source(spark, sf, "payment_gateway_status_event")
    # replays: every event delivered twice, the copy under a new event id
    replayed = src_df.unionByName(src_df.withColumn("status_event_id", F.concat(F.lit("RPL-"), "status_event_id")))
    _land(replayed, f"{work}/in")
    src = S.read_stream(spark, f"{work}/in", replayed.schema, max_files=2)
    S.dedup_stream(src, DEDUP_KEYS, "status_timestamp", "40 days", f"{work}/out", f"{work}/ckpt")
    return spark.read.parquet(f"{work}/out").select(*DEDUP_KEYS)


register("stream_dedup", (lambda q: (q.fixture("payment_gateway_status_event"), q.sql(
    f"SELECT DISTINCT {', '.join(DEDUP_KEYS)} FROM payment_gateway_status_event"))[1])(O.Q()))(_stream_dedup)


def _stream_windows(spark, sf):
    """Events arrive as six time-ordered deliveries (each its own append,
    several files each).  An event is at most one delivery late, so the
    watermark delay is one delivery's span: nothing is dropped and closed
    windows leave the state."""
    work = _workdir(spark, "windows")
    ev = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts", "event_type")
    epoch = F.unix_timestamp(F.col("ts").cast("timestamp"))
    lo, hi = ev.agg(F.min(epoch), F.max(epoch)).first()               # one row
    deliveries = 6
    span = max(1, (hi - lo) // deliveries + 1)
    for i in range(deliveries):
        ev.filter((epoch >= lo + i * span) & (epoch < lo + (i + 1) * span)).write.mode("append").parquet(f"{work}/in")
    src = S.read_stream(spark, f"{work}/in", ev.schema, max_files=1)
    S.window_counts(spark, src, "ts", ["event_type"], "1 hour", f"{span} seconds", f"{work}/out", f"{work}/ckpt")
    return S.window_result(spark, f"{work}/out")


register("stream_window_counts", """SELECT date_trunc('hour', ts) AS window_start,
  date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS events
FROM events GROUP BY 1, 2, 3""")(_stream_windows)


def _stream_scd(spark, sf):
    work = _workdir(spark, "scd")
    snaps = fx.source(spark, sf, "customer_snapshot")
    versions = [20260705 + i for i in range(6)]
    for v in versions:       # land the snapshots one after the other, as they arrive daily
        snaps.filter(F.col("version") == v).repartition(2).write.mode("append").parquet(f"{work}/in")
    src = S.read_stream(spark, f"{work}/in", snaps.schema)
    S.scd2_stream(spark, src, ["cust_no"], "version", f"{work}/out", f"{work}/ckpt", track_except=UNTRACKED_COLUMNS)
    return S.final_history(spark, f"{work}/out")


def _scd_sql() -> str:
    from vaultline.plans.q_cdc import _history_sql
    q = O.Q()
    h = _history_sql(q)
    return q.sql(f"SELECT * FROM {h}")


register("stream_scd", _scd_sql())(_stream_scd)


LATE_SECONDS = 300


def _stream_late(spark, sf):
    """Stateless late-arrival flagging on the status-event stream: events
    that arrived more than 5 minutes after their business time."""
    work = _workdir(spark, "late")
    ev = P.bronze(spark, sf, "account_transaction_status_event")
    _land(ev, f"{work}/in")
    src = S.read_stream(spark, f"{work}/in", ev.schema, max_files=1)
    lag = (F.unix_timestamp(F.col("source_arrival_timestamp").cast("timestamp"))
           - F.unix_timestamp(F.col("status_timestamp").cast("timestamp")))
    late = src.withColumn("arrival_lag_seconds", lag).filter(F.col("arrival_lag_seconds") > LATE_SECONDS).select(
        "status_event_id", "account_txn_id", "sequence_number", "arrival_lag_seconds")
    (late.writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/ckpt")
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{work}/out")


def _stream_late_sql() -> str:
    q = O.Q()
    q.normalized("account_transaction_status_event")
    return q.sql(f"""SELECT status_event_id, account_txn_id, sequence_number,
  CAST(epoch(source_arrival_timestamp) - epoch(status_timestamp) AS BIGINT) AS arrival_lag_seconds
FROM r_account_transaction_status_event
WHERE CAST(epoch(source_arrival_timestamp) - epoch(status_timestamp) AS BIGINT) > {LATE_SECONDS}""")


register("stream_late_arrival", _stream_late_sql())(_stream_late)


# ------------------------------------------- all sources, one quarantine
def _quarantine_all(spark, sf):
    """Every source's files in two micro-batches; duplicates are looked up in the whole source, which is counted once, not per batch."""
    from concurrent.futures import ThreadPoolExecutor

    work = _workdir(spark, "quarantine-all")
    P.assess_all(spark, sf, ALL_SOURCES)
    rows = {t: P.bronze(spark, sf, t) for t in ALL_SOURCES}

    def landed(t: str) -> int:
        rows[t].write.mode("overwrite").parquet(f"{work}/in/{t}")     # as the source's tasks have it, nothing is shuffled
        return len(spark.read.schema(rows[t].schema).parquet(f"{work}/in/{t}").inputFiles())

    with ThreadPoolExecutor(6) as pool:
        files = dict(zip(ALL_SOURCES, pool.map(landed, ALL_SOURCES)))
    sources = [S.SourceStream(t, S.read_stream(spark, f"{work}/in/{t}", rows[t].schema, max_files=-(-files[t] // 2) or 1),
                              repeated=lambda batch, t=t: lambda column: P.repeated(spark, sf, t, column), stored=True) for t in ALL_SOURCES]
    S.quarantine_streams(sources, f"{work}/out", f"{work}/ckpt", as_of=P.RUN_CLOCK, run_id=P.RUN_ID)
    return S.quarantine_result(spark, f"{work}/out").select(
        "source_table_name", "source_business_key", "bronze_record_ref", "failed_rule_name", "quarantine_reason", "pipeline_run_id")


def _register_all():
    from vaultline.plans.catalog import _dq_quarantine_records_sql

    register("stream_quarantine_all", _dq_quarantine_records_sql())(_quarantine_all)


ALL_SOURCES = tuple(TABLES)
_register_all()


# --------------------------------------------- sequenced change events
PARTS = 5  # deliveries of the status events


def _sequenced(spark, sf):
    """Status events delivered in five parts in no order of their sequence, about one a micro-batch."""
    work = _workdir(spark, "sequenced")
    ev = fx.source(spark, sf, "account_transaction_status_event").select(
        "account_txn_id", "sequence_number", "status", "status_timestamp")
    for part in range(PARTS):
        at = F.pmod(F.xxhash64("account_txn_id", "sequence_number"), F.lit(PARTS)) == part
        ev.where(at).write.mode("append").parquet(f"{work}/in")      # as the source's tasks have it, not by one task
    files = len(spark.read.schema(ev.schema).parquet(f"{work}/in").inputFiles())
    state = S.SequencedHistory(spark, f"{work}/state", ev.schema, ["account_txn_id"], "sequence_number", buckets=16)
    S.sequenced_stream(S.read_stream(spark, f"{work}/in", ev.schema, max_files=-(-files // PARTS) or 1), state, f"{work}/ckpt")
    return state.history()


def _register_sequenced():
    from vaultline.plans.q_cdc import _sequenced_sql

    register("stream_sequenced_scd2", _sequenced_sql())(_sequenced)


_register_sequenced()
