"""Cross-cutting checks and alternative names from the query catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from vaultline.config import TABLES
from vaultline.functions import keys as K
from vaultline.operators import silver as S
from vaultline.plans import oracle as O
from vaultline.plans import pipeline as P
from vaultline.plans.registry import ORACLE, QUERIES, register

# Unique-key contract of every silver table (SV-41).
JOINED_KEYS = {
    "party": ("party_key",), "party_identifier": ("party_identifier_key",),
    "party_profile_version": ("party_profile_version_key",), "party_account_role": ("party_account_role_key",),
    "financial_event": ("financial_event_key",),
    "financial_event_status_history": ("financial_event_status_history_key", "financial_event_key"),
    "monitoring_alert_financial_event": ("monitoring_alert_financial_event_key",),
    "investigation_case_financial_event": ("investigation_case_financial_event_key",),
}
UNIQUE = {**{n: s.unique for n, s in S.SPECS.items() if s.unique}, **JOINED_KEYS}


def _unique(spark, sf):
    """Equal texts have equal keys, so the texts are grouped; only what is reported is hashed."""
    P.assess_all(spark, sf, list(TABLES))
    parts = [S.unique_key_violations(P.silver(spark, sf, n, K.TEXT), n, list(k), K.TEXT) for n, k in UNIQUE.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _unique_sql() -> str:
    q = O.Q()
    sels = []
    for n, k in UNIQUE.items():
        cte = q.silver(n)
        cols = ", ".join(k)
        kv = "concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in k) + ")"
        sels.append(f"SELECT '{n}' AS table_name, {kv} AS key_value, count(*) AS row_count FROM {cte} "
                    f"GROUP BY {cols} HAVING count(*) > 1")
    return q.sql(" UNION ALL ".join(sels))


register("silver_unique_keys", _unique_sql())(_unique)


def _validated_counts(spark, sf):
    P.assess_all(spark, sf, list(TABLES))
    parts = [P.validated(spark, sf, t).agg(F.lit(t).alias("source_table_name"),
                                           F.count(F.lit(1)).alias("validated_rows")) for t in TABLES]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _validated_counts_sql() -> str:
    q = O.Q()
    return q.sql(" UNION ALL ".join(f"SELECT '{t}' AS source_table_name, count(*) AS validated_rows "
                                    f"FROM {q.validated(t)}" for t in TABLES))


register("dq_validated_rows", _validated_counts_sql())(_validated_counts)

# Alternative names used by the query catalogue.
for alias, name in (("silver_event_association", "silver_financial_event_association"),
                    ("ing_normalize", "ing_normalize_core_banking_customer")):
    register(alias, ORACLE[name])(QUERIES[name])
