"""Wiring: banking sources -> assessment -> validated -> silver -> gold.

No function collects rows.  The repeated values that the duplicate rules look
up, two joined silver tables and the fraud context's dimensions are published
once per run (written to the shared table location and read back) while a
query is built; what is built on them is lazy.  An assessment is a projection
of its source and of the small published lookups, so it is never stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vaultline.functions import keys as K
from vaultline.operators import gold as G
from vaultline.operators import quarantine as Q
from vaultline.operators import silver as S
from vaultline.operators.ingest import prepare_source
from vaultline.session import shuffles_end_with_write
from vaultline.sources import fixtures as fx

# Fixed run clock for rules that compare with "now" (reproducible runs).
RUN_CLOCK = "2026-12-01 00:00:00"
RUN_ID = "run-local"


def bronze(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """Current bronze rows of a source (hints, contract columns, derived keys, replay removal)."""
    return fx.memo(spark, sf, ("bronze", table),
                   lambda: prepare_source(fx.source(spark, sf, table), table))


def _table_root(spark: SparkSession, sf: str) -> str:
    """Run-scoped folder for published tables, under the shared checkpoint
    directory the cluster configures (a scratch folder only when unset)."""
    from vaultline.session import checkpoint_dir

    def build():
        import hashlib
        tag = hashlib.sha1(f"{sf}|{spark.sparkContext.applicationId}".encode()).hexdigest()[:12]
        return f"{checkpoint_dir(spark).rstrip('/')}/vaultline-tables/{tag}"
    return fx.memo(spark, sf, ("table_root",), build)


def publish(spark: SparkSession, sf: str, kind: str, name: str, build, options: dict[str, str] | None = None) -> DataFrame:
    """Compute a table ONCE per run: write it to the run folder and read it
    back.  Downstream queries scan the written table instead of re-running
    its lineage (and a lost executor only loses work since the write), and the
    shuffle files of the write go when it ends.
    Set ``vaultline.materialize=false`` to keep everything lazy."""
    def do():
        df = build()
        if not _materialize(spark):
            return df
        path = f"{_table_root(spark, sf)}/{kind}/{name}"
        with shuffles_end_with_write(spark):
            df.write.mode("overwrite").options(**(options or {})).parquet(path)
        return spark.read.parquet(path)
    return fx.memo(spark, sf, ("published", kind, name), do)


def _materialize(spark: SparkSession) -> bool:
    return spark.conf.get("vaultline.materialize", "true").lower() == "true"


def publish_many(spark: SparkSession, sf: str, kind: str, builds: dict) -> None:
    """Publish several independent tables at once: each is planned and
    written on its own driver thread, so plan analysis and the write jobs
    of small tables overlap instead of queueing behind each other.  The
    builders must only read inputs that are already registered."""
    from concurrent.futures import ThreadPoolExecutor

    cache = fx._cache(spark, sf)
    names = [n for n in builds if ("published", kind, n) not in cache]
    if not names:
        return
    if not _materialize(spark):
        for n in names:
            cache[("published", kind, n)] = builds[n]()
        return
    root = _table_root(spark, sf)

    def write(n):
        builds[n]().write.mode("overwrite").parquet(f"{root}/{kind}/{n}")

    with shuffles_end_with_write(spark), ThreadPoolExecutor(max_workers=min(8, len(names))) as pool:
        list(pool.map(write, names))
    for n in names:
        cache[("published", kind, n)] = spark.read.parquet(f"{root}/{kind}/{n}")


def _repeated_build(spark: SparkSession, sf: str, table: str, column: str):
    return lambda: Q.repeated_values(bronze(spark, sf, table), column)


def repeated(spark: SparkSession, sf: str, table: str, column: str) -> DataFrame:
    """Values of a unique column that several rows of a source hold, published
    once per run: their stored size is known, so Spark broadcasts them when
    they are few and the source's rows are not shuffled to look them up."""
    return publish(spark, sf, "repeated", f"{table}-{column}", _repeated_build(spark, sf, table, column))


def assess_all(spark: SparkSession, sf: str, tables) -> None:
    """Publish the duplicate lookups of several sources concurrently (their
    source views are registered first, on this thread)."""
    fx.load(spark, sf, *tables)
    for t in tables:
        bronze(spark, sf, t)
    publish_many(spark, sf, "repeated", {f"{t}-{c}": _repeated_build(spark, sf, t, c) for t in tables for c in Q.unique_columns(t)})


def assessed(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """Assessment of a source; validated rows and quarantine records are both
    projections of it."""
    return fx.memo(spark, sf, ("assessed", table), lambda: Q.assess(
        bronze(spark, sf, table), table, as_of=RUN_CLOCK, repeated=lambda column: repeated(spark, sf, table, column)))


def validated(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return fx.memo(spark, sf, ("validated", table), lambda: Q.validated(assessed(spark, sf, table)))


def quarantine(spark: SparkSession, sf: str, table: str, with_timestamp: bool = False) -> DataFrame:
    return Q.quarantine_records(assessed(spark, sf, table), table, RUN_ID, with_timestamp=with_timestamp)


def silver(spark: SparkSession, sf: str, name: str, form: K.KeyForm = K.HASHED) -> DataFrame:
    """Any silver table by name (memoised per session and sf_dir), its keys hashed or still as text."""
    if name in PUBLISHED_SILVER and form is K.HASHED:
        return publish(spark, sf, "silver", name, lambda: _silver(spark, sf, name))
    return fx.memo(spark, sf, ("silver", name, form), lambda: _silver(spark, sf, name, form))


# Silver tables that several tables of a query are built from are published
# (computed once per run); the others stay lazy views over the assessments.
PUBLISHED_SILVER = ("party", "party_account_role")


def _stored(spark: SparkSession, sf: str, kind: str):
    """For operators that may store a table once per run."""
    return lambda name, df: publish(spark, sf, kind, name, lambda: df)


def _silver(spark: SparkSession, sf: str, name: str, form: K.KeyForm = K.HASHED, keep: G.Keep = G.as_is) -> DataFrame:
    if name in S.SPECS:
        spec = S.SPECS[name]
        return S.project(validated(spark, sf, spec.source), spec, form)
    v = lambda t: validated(spark, sf, t)
    if name == "party_account_role":
        return S.party_account_role(v("customer_account"), v("core_banking_customer"), form)
    if name == "party":
        return S.party(v("core_banking_customer"), v("crm_customer"),
                       S.last_transaction_by_ref(v("account_transaction")), fx.ORDER_AS_OF, form)
    if name == "party_identifier":
        return S.party_identifier(v("core_banking_customer"), form)
    if name == "party_profile_version":
        return S.party_profile_version(v("core_banking_customer"), v("crm_customer"), form)
    if name == "financial_event":
        return S.financial_event(v("account_transaction"), v("card_transaction"), v("log_atm"),
                                 v("payment_gateway_log"), v("card"), silver(spark, sf, "party_account_role", form), form=form, keep=keep)
    if name == "financial_event_status_history":
        return S.financial_event_status_history(v("account_transaction_status_event"),
                                                v("card_transaction_status_event"), form)
    if name == "monitoring_alert_financial_event":
        return S.monitoring_alert_financial_event(v("transaction_monitoring_alert_account_transaction"),
                                                  v("transaction_monitoring_alert_card_transaction"), form)
    if name == "investigation_case_financial_event":
        return S.investigation_case_financial_event(v("investigation_case_account_transaction"),
                                                    v("investigation_case_card_transaction"), form)
    if name == "financial_event_association":
        return S.financial_event_association(v("payment_gateway_log"), form)
    raise ValueError(f"unknown silver table {name!r}")


JOINED_SILVER = ("party", "party_identifier", "party_profile_version", "party_account_role", "financial_event",
                 "financial_event_status_history", "monitoring_alert_financial_event",
                 "investigation_case_financial_event")

SILVER_TABLES = tuple(S.SPECS) + JOINED_SILVER


FRAUD_SOURCES = ("account_transaction", "card_transaction", "log_atm", "payment_gateway_log", "card",
                 "customer_account", "core_banking_customer", "transaction_channel", "merchant", "merchant_store",
                 "account_transaction_risk_score", "fraud_alert", "card_fraud_flag")
C360_SOURCES = ("core_banking_customer", "crm_customer", "account_transaction", "customer_kyc", "customer_employment",
                "customer_account", "account", "balance_snapshot", "card", "customer_request", "call_center_log",
                "aml_case", "investigation_case")
AML_SOURCES = ("investigation_case", "aml_case", "suspicious_activity_report", "investigation_case_sanction_screening",
               "sanction_screening", "watchlist", "investigation_case_fraud_alert",
               "investigation_case_transaction_monitoring_alert", "investigation_case_account_transaction",
               "investigation_case_card_transaction", "investigation_note")


def _texts(spark: SparkSession, sf: str):
    """Silver tables for the contexts, which join and group by keys as text."""
    return lambda name: silver(spark, sf, name, K.TEXT)


def _hashed(context: DataFrame, *keys: str) -> DataFrame:
    """A context with its keys in their published form."""
    return context.withColumns({k: K.hash_of_text(k) for k in keys})


FRAUD_KEYS = ("financial_event_key", "account_key", "payment_card_key", "party_key", "channel_key", "merchant_key")


def fraud_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The fraud context with its keys still as text."""
    assess_all(spark, sf, FRAUD_SOURCES)
    keep = _stored(spark, sf, "fraud")
    texts = _texts(spark, sf)

    def silver_or_events(name: str) -> DataFrame:
        if name != "financial_event":
            return texts(name)
        return fx.memo(spark, sf, ("fraud", name), lambda: _silver(spark, sf, name, K.TEXT, keep))

    return G.fraud_transaction_context(silver_or_events, RUN_ID, K.TEXT, keep)


def gold_fraud(spark: SparkSession, sf: str) -> DataFrame:
    return _hashed(fraud_texts(spark, sf), *FRAUD_KEYS)


def gold_customer_360(spark: SparkSession, sf: str) -> DataFrame:
    assess_all(spark, sf, C360_SOURCES)
    return _hashed(G.customer_360_context(_texts(spark, sf), fx.ORDER_AS_OF, RUN_ID, K.TEXT), "party_key")


def gold_aml(spark: SparkSession, sf: str) -> DataFrame:
    assess_all(spark, sf, AML_SOURCES)
    return _hashed(G.aml_investigation_context(_texts(spark, sf), RUN_ID, K.TEXT),
                   "investigation_case_key", "party_key", "aml_case_key")
