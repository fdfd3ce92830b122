"""Identity-resolution queries (ID-01..16)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.functions.keys import display_key
from vaultline.operators import identity as I
from vaultline.operators.scalar import side_by_side
from vaultline.plans import oracle as O
from vaultline.plans import pipeline as P
from vaultline.plans.registry import register
from vaultline.sources import fixtures as fx

RESOLVED_AT = fx.ORDER_AS_OF
# Per entity (table, key, source system, entity, hash prefix, curated prefix).
ENTITIES = {
    "kyc": ("customer_kyc", "kyc_id", "KYC", "customer_kyc", "KYC", "KYC-"),
    "employment": ("customer_employment", "employment_id", "EMPLOYMENT", "customer_employment", "EMPLOYMENT", "EMP-"),
    "request": ("customer_request", "request_id", "REQUEST", "customer_request", "REQUEST", "SR-"),
}


def _active(spark, sf):
    return fx.memo(spark, sf, ("id", "active"), lambda: I.active_customers(
        P.bronze(spark, sf, "core_banking_customer"), P.bronze(spark, sf, "crm_customer")))


def _candidates(spark, sf):
    return fx.memo(spark, sf, ("id", "cand"), lambda: I.party_candidates(_active(spark, sf)))


def _identifiers(spark, sf):
    return fx.memo(spark, sf, ("id", "ident"), lambda: I.party_identifiers(_active(spark, sf), _candidates(spark, sf)))


def _resolution(spark, sf, entity):
    t, key, system, ent, hp, _ = ENTITIES[entity]
    return fx.memo(spark, sf, ("id", "res", entity), lambda: I.resolve_references(
        P.bronze(spark, sf, t), _identifiers(spark, sf), key, system, ent, hp, resolved_at=RESOLVED_AT))


# ------------------------------------------------------------- SQL side
def _sq(q: O.Q) -> None:
    """Register the identity CTEs on an oracle query builder."""
    q.normalized("core_banking_customer")
    q.normalized("crm_customer")
    for t in ("customer_kyc", "customer_employment", "customer_request"):
        q.normalized(t)
    tok = "sha256('CUSTOMER_360|' || upper(trim(national_id)))"
    q.add("ia", f"""SELECT 'CORE_BANKING' AS source_system, cust_no AS source_business_key, {tok} AS national_id_token,
  business_date FROM r_core_banking_customer WHERE national_id IS NOT NULL AND trim(national_id) <> ''
UNION ALL SELECT 'CRM', party_id, {tok}, business_date FROM r_crm_customer
  WHERE national_id IS NOT NULL AND trim(national_id) <> ''""")
    q.add("ic0", """SELECT *, count_if(source_system = 'CORE_BANKING') OVER (PARTITION BY national_id_token) AS cc,
  count_if(source_system = 'CRM') OVER (PARTITION BY national_id_token) AS rc FROM ia""")
    q.add("ipc", """SELECT 'P-' || upper(substr(sha256('PARTY_TEST|' || national_id_token), 1, 12)) AS party_key,
  'PERSON' AS party_type, 'ACTIVE' AS party_status, 'VALID' AS data_quality_status,
  CASE WHEN max(cc) = 1 AND max(rc) = 1 THEN 'CORE_AND_CRM' WHEN max(cc) = 1 THEN 'CORE_ONLY' ELSE 'CRM_ONLY' END
    AS source_coverage, max(business_date) AS latest_business_date, national_id_token
FROM ic0 WHERE cc <= 1 AND rc <= 1 GROUP BY national_id_token""")
    q.add("ipi", """SELECT 'PI-' || upper(substr(sha256(p.party_key || '|' || i.source_system || '|' ||
    CASE i.source_system WHEN 'CORE_BANKING' THEN 'CORE_CUST_NO' ELSE 'CRM_PARTY_ID' END || '|' ||
    i.source_business_key), 1, 16)) AS party_identifier_key,
  p.party_key, CASE i.source_system WHEN 'CORE_BANKING' THEN 'CORE_CUST_NO' ELSE 'CRM_PARTY_ID' END AS identifier_type,
  sha256('IDENTIFIER|' || i.source_business_key) AS identifier_value_token, i.source_system, TRUE AS is_primary,
  CAST(NULL AS BIGINT) AS valid_from, CAST(NULL AS BIGINT) AS valid_to, i.source_business_key,
  CASE i.source_system WHEN 'CORE_BANKING' THEN 'core_banking_customer|cust_no=' ELSE 'crm_customer|party_id=' END
    || i.source_business_key || '|business_date=' || CAST(i.business_date AS VARCHAR) AS bronze_record_ref
FROM ia i JOIN ipc p ON p.party_key = 'P-' || upper(substr(sha256('PARTY_TEST|' || i.national_id_token), 1, 12))""")
    # What a reference can mean: how many open identifiers carry it, and which party if it is one.
    q.add("reference_hits", """SELECT identifier_value_token AS ref_token, identifier_type AS ref_kind,
  count(*) AS hits, min(party_key) AS party FROM ipi WHERE valid_to IS NULL GROUP BY ALL""")
    kinds = "CASE split_part(customer_ref, '-', 1) WHEN 'CB' THEN 'CORE_CUST_NO' WHEN 'CRM' THEN 'CRM_PARTY_ID' END"
    for ent, (t, key, system, ent_name, hp, _) in ENTITIES.items():
        found = f"(SELECT r.*, coalesce(hits, 0) AS hits, party FROM r_{t} r LEFT JOIN reference_hits ON ref_token = " \
                f"sha256('IDENTIFIER|' || customer_ref) AND ref_kind = {kinds})"
        outcome = "list_extract(['UNRESOLVED', 'CONFIRMED', 'AMBIGUOUS'], 1 + least(hits, 2))"
        sure = lambda value: f"if(hits = 1, {value}, NULL)"
        q.add(f"res_{ent}", f"""SELECT
  'IR-' || upper(left(sha256('{hp}|' || {key}), 16)) AS identity_resolution_key, '{system}' AS source_system,
  '{ent_name}' AS source_entity, {key} AS source_business_key, customer_ref,
  {sure('party')} AS candidate_party_key, {outcome} AS resolution_status, 'DIRECT_IDENTIFIER' AS match_method,
  {sure('CAST(1 AS DECIMAL(5,4))')} AS match_confidence, {sure(f"TIMESTAMP '{RESOLVED_AT}'")} AS resolved_at,
  concat('{ent_name}|{key}=', {key}, '|business_date=', CAST(business_date AS VARCHAR)) AS bronze_record_ref, business_date
FROM {found}""")


def _osql(select: str) -> str:
    q = O.Q()
    _sq(q)
    return q.sql(select)


register("id_active_customers", _osql("SELECT * FROM ia"))(
    lambda spark, sf: _active(spark, sf).drop("__START_AT"))
register("id_party_candidate", _osql("SELECT * FROM ipc"))(_candidates)
register("id_identifiers", _osql("SELECT * FROM ipi"))(_identifiers)


def _party_checks(spark, sf):
    a, c = _active(spark, sf), _candidates(spark, sf)
    src = a.agg(F.count_if(F.col("source_system") == "CORE_BANKING").alias("core_rows"),
                F.count_if(F.col("source_system") == "CRM").alias("crm_rows"))
    cand = c.agg(F.count(F.lit(1)).alias("canonical_parties"),
                 (F.count(F.lit(1)) - F.count_distinct("party_key")).alias("duplicate_party_keys"),
                 F.count_if(F.col("source_coverage") == "CORE_AND_CRM").alias("core_and_crm"),
                 F.count_if(F.col("source_coverage") == "CORE_ONLY").alias("core_only"),
                 F.count_if(F.col("source_coverage") == "CRM_ONLY").alias("crm_only"))
    dup_tokens = (a.groupBy("source_system", "national_id_token").count().filter("count > 1")
                  .agg(F.count(F.lit(1)).alias("duplicate_source_tokens")))
    return side_by_side(src, cand, dup_tokens).select(
        "core_rows", "crm_rows", (F.col("core_rows") + F.col("crm_rows")).alias("total_rows"),
        "canonical_parties", "duplicate_party_keys", "core_and_crm", "core_only", "crm_only",
        "duplicate_source_tokens")


register("id_party_checks", _osql("""SELECT s.core_rows, s.crm_rows, s.core_rows + s.crm_rows AS total_rows,
  c.canonical_parties, c.duplicate_party_keys, c.core_and_crm, c.core_only, c.crm_only, d.duplicate_source_tokens
FROM (SELECT count_if(source_system = 'CORE_BANKING') AS core_rows, count_if(source_system = 'CRM') AS crm_rows FROM ia) s,
  (SELECT count(*) AS canonical_parties, count(*) - count(DISTINCT party_key) AS duplicate_party_keys,
     count_if(source_coverage = 'CORE_AND_CRM') AS core_and_crm, count_if(source_coverage = 'CORE_ONLY') AS core_only,
     count_if(source_coverage = 'CRM_ONLY') AS crm_only FROM ipc) c,
  (SELECT count(*) AS duplicate_source_tokens FROM (SELECT source_system, national_id_token FROM ia
     GROUP BY 1, 2 HAVING count(*) > 1)) d"""))(_party_checks)


def _identifier_checks(spark, sf):
    i = _identifiers(spark, sf)
    bad_tok = (i.groupBy("identifier_type", "identifier_value_token").count().filter("count <> 1")
               .agg(F.count(F.lit(1)).alias("n")).select(F.lit("token_mapped_not_once").alias("check_name"), "n"))
    bad_key = (i.groupBy("party_identifier_key").agg(F.count_distinct("party_key").alias("p")).filter("p <> 1")
               .agg(F.count(F.lit(1)).alias("n")).select(F.lit("key_not_one_party").alias("check_name"), "n"))
    dist = (i.groupBy("source_system", "identifier_type", "is_primary").agg(F.count(F.lit(1)).alias("n"))
            .select(F.concat_ws(":", "source_system", "identifier_type", F.col("is_primary").cast("string"))
                    .alias("check_name"), "n"))
    return bad_tok.unionByName(bad_key).unionByName(dist).withColumnRenamed("n", "record_count")


register("id_identifier_checks", _osql("""SELECT 'token_mapped_not_once' AS check_name, count(*) AS record_count FROM
  (SELECT identifier_type, identifier_value_token FROM ipi GROUP BY 1, 2 HAVING count(*) <> 1)
UNION ALL SELECT 'key_not_one_party', count(*) FROM (SELECT party_identifier_key FROM ipi GROUP BY 1
  HAVING count(DISTINCT party_key) <> 1)
UNION ALL SELECT source_system || ':' || identifier_type || ':' || CAST(is_primary AS VARCHAR), count(*) FROM ipi
  GROUP BY source_system, identifier_type, is_primary"""))(_identifier_checks)

for _ent in ENTITIES:
    register(f"id_resolve_{_ent}", _osql(f"SELECT * FROM res_{_ent}"))(
        (lambda e: lambda spark, sf: _resolution(spark, sf, e))(_ent))


# Curated table of an entity: its key's name, source system, and its columns as (Spark SQL, DuckDB SQL, name).
CURATED = {
    "kyc": ("kyc_assessment_key", "KYC", [
        ("id_type",) * 3, ("sha2('ID_NUMBER|' || id_number, 256)", "sha256('ID_NUMBER|' || id_number)", "id_number"),
        ("verification_status",) * 3, ("verified_date",) * 3]),
    "employment": ("employment_key", "EMPLOYMENT", [
        ("employer_name",) * 3, ("job_title",) * 3, ("monthly_income",) * 3, ("business_date", "business_date", "effective_from"),
        ("CAST(NULL AS DATE)", "CAST(NULL AS DATE)", "effective_to")]),
    "request": ("service_request_key", "SERVICE_REQUEST", [
        ("request_type",) * 3, ("channel",) * 3, ("request_date",) * 3, ("status", "status", "request_status"),
        ("resolution_date",) * 3, ("description", "description", "request_description")]),
}


def _curated(spark, sf, entity):
    table, key, _, _, hash_prefix, prefix = ENTITIES[entity]
    name, system, columns = CURATED[entity]
    own = display_key(prefix, F.concat(F.lit(hash_prefix + "|"), F.col(key)), 16).alias(name)
    return I.curated(P.bronze(spark, sf, table), _resolution(spark, sf, entity), key, own, system,
                     [F.expr(spark_sql).alias(c) for spark_sql, _, c in columns])


def _curated_select(entity: str) -> str:
    """Records whose reference one open identifier carries (the resolution is not asked)."""
    table, key, _, ent_name, hash_prefix, prefix = ENTITIES[entity]
    name, system, columns = CURATED[entity]
    return f"""SELECT concat('{prefix}', upper(left(sha256(concat('{hash_prefix}|', {key})), 16))) AS {name}, party AS party_key,
  {", ".join(f"{sql} AS {c}" for _, sql, c in columns)}, '{system}' AS source_system, {key} AS source_business_key,
  concat('{ent_name}|{key}=', {key}, '|business_date=', CAST(business_date AS VARCHAR)) AS bronze_record_ref
FROM r_{table} JOIN reference_hits ON ref_token = sha256('IDENTIFIER|' || customer_ref)
  AND ref_kind = CASE split_part(customer_ref, '-', 1) WHEN 'CB' THEN 'CORE_CUST_NO' WHEN 'CRM' THEN 'CRM_PARTY_ID' END
WHERE hits = 1"""


for _ent in ENTITIES:
    register(f"id_curated_{_ent}", _osql(_curated_select(_ent)))((lambda e: lambda spark, sf: _curated(spark, sf, e))(_ent))


def _of_all(one):
    return lambda spark, sf: reduce(DataFrame.unionByName, [one(spark, sf, e).select(F.lit(e).alias("entity"), "*") for e in ENTITIES])


register("id_curated_checks", _osql(" UNION ALL ".join(
    f"SELECT '{e}' AS entity, CAST(count(*) AS BIGINT) AS curated_records, count_if(party_key IS NULL) AS without_party, "
    f"count(*) - count(DISTINCT {CURATED[e][0]}) AS duplicate_keys FROM ({_curated_select(e)})" for e in ENTITIES)))(
    _of_all(lambda spark, sf, e: I.curated_checks(_curated(spark, sf, e), CURATED[e][0])))

register("id_status_by_reference", _osql(" UNION ALL ".join(
    f"""SELECT '{e}' AS entity, resolution_status, if(starts_with(customer_ref, 'CB-'), 'CORE_CUST_NO',
  if(starts_with(customer_ref, 'CRM-'), 'CRM_PARTY_ID', 'UNRECOGNISED_FORMAT')) AS reference_type, count(*) AS records
FROM res_{e} GROUP BY ALL""" for e in ENTITIES)))(_of_all(lambda spark, sf, e: I.status_by_reference(_resolution(spark, sf, e))))

for _ent in ("employment", "request"):
    _key = ENTITIES[_ent][1]
    register(f"id_unresolved_{_ent}", _osql(f"""SELECT source_business_key AS {_key}, resolution_status, bronze_record_ref,
  if(resolution_status = 'AMBIGUOUS', 'AMBIGUOUS_CUSTOMER_REFERENCE', 'UNRESOLVED_CUSTOMER_REFERENCE') AS quarantine_reason
FROM res_{_ent} WHERE candidate_party_key IS NULL"""))(
        (lambda e, k: lambda spark, sf: I.unresolved_evidence(_resolution(spark, sf, e), k))(_ent, _key))


def _unresolved_kyc(spark, sf):
    return I.unresolved(P.bronze(spark, sf, "customer_kyc"), _resolution(spark, sf, "kyc"), "kyc_id",
                        ["id_type", "verification_status", "verified_date"])


register("id_unresolved_kyc", _osql("""SELECT k.business_date AS as_of_date, k.kyc_id, k.customer_ref, k.id_type,
  k.verification_status, k.verified_date,
  CASE WHEN r.resolution_status = 'UNRESOLVED' THEN 'UNRESOLVED_CUSTOMER_REFERENCE'
       ELSE 'AMBIGUOUS_CUSTOMER_REFERENCE' END AS quarantine_reason
FROM r_customer_kyc k JOIN res_kyc r ON r.source_business_key = k.kyc_id
WHERE r.resolution_status <> 'CONFIRMED'"""))(_unresolved_kyc)


def _reconciliation(spark, sf):
    parts = []
    for ent in ENTITIES:
        r = _resolution(spark, sf, ent)
        parts.append(r.agg(
            F.lit(ent).alias("entity"), F.count(F.lit(1)).alias("active_records"),
            F.count_if(F.col("resolution_status") == "CONFIRMED").alias("resolved_records"),
            F.count_if(F.col("resolution_status") != "CONFIRMED").alias("quarantined_records"),
            F.count_if(F.col("resolution_status") == "UNRESOLVED").alias("unresolved_records"),
            F.count_if(F.col("resolution_status") == "AMBIGUOUS").alias("ambiguous_records"),
            F.count_if((F.col("resolution_status") == "CONFIRMED") & F.col("candidate_party_key").isNull())
            .alias("confirmed_without_party"),
            (F.count(F.lit(1)) - F.count_distinct("identity_resolution_key")).alias("duplicate_resolution_keys")))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("reconciled", F.col("resolved_records") + F.col("quarantined_records")
                          == F.col("active_records"))


register("id_reconciliation", _osql(" UNION ALL ".join(f"""SELECT '{e}' AS entity, count(*) AS active_records,
  count_if(resolution_status = 'CONFIRMED') AS resolved_records,
  count_if(resolution_status <> 'CONFIRMED') AS quarantined_records,
  count_if(resolution_status = 'UNRESOLVED') AS unresolved_records,
  count_if(resolution_status = 'AMBIGUOUS') AS ambiguous_records,
  count_if(resolution_status = 'CONFIRMED' AND candidate_party_key IS NULL) AS confirmed_without_party,
  count(*) - count(DISTINCT identity_resolution_key) AS duplicate_resolution_keys,
  count_if(resolution_status = 'CONFIRMED') + count_if(resolution_status <> 'CONFIRMED') = count(*) AS reconciled
FROM res_{e}""" for e in ENTITIES)))(_reconciliation)


def _reasons(spark, sf):
    a = _active(spark, sf)
    core = a.filter(F.col("source_system") == "CORE_BANKING")
    crm = a.filter(F.col("source_system") == "CRM")
    return reduce(lambda x, y: x.unionByName(y), [
        I.unresolved_reasons(_resolution(spark, sf, e), core, crm).select(F.lit(e).alias("entity"), "*")
        for e in ENTITIES])


register("id_unresolved_reasons", _osql(" UNION ALL ".join(f"""SELECT '{e}' AS entity,
  CASE WHEN u.customer_ref LIKE 'CB-%' AND u.customer_ref IN (SELECT source_business_key FROM ia
         WHERE source_system = 'CORE_BANKING') THEN 'PRESENT_IN_CORE_BUT_NOT_MAPPED'
       WHEN u.customer_ref LIKE 'CRM-%' AND u.customer_ref IN (SELECT source_business_key FROM ia
         WHERE source_system = 'CRM') THEN 'PRESENT_IN_CRM_BUT_NOT_MAPPED'
       WHEN u.customer_ref LIKE 'CB-%' THEN 'MISSING_FROM_ACTIVE_CORE'
       WHEN u.customer_ref LIKE 'CRM-%' THEN 'MISSING_FROM_ACTIVE_CRM'
       ELSE 'UNRECOGNISED_FORMAT' END AS unresolved_reason, count(*) AS record_count
FROM res_{e} u WHERE u.resolution_status = 'UNRESOLVED' GROUP BY 2""" for e in ENTITIES)))(_reasons)


def _unresolved_refs(spark, sf, ent):
    return (_resolution(spark, sf, ent).filter(F.col("resolution_status") == "UNRESOLVED")
            .groupBy("customer_ref").agg(F.count(F.lit(1)).alias("n")))


def _overlap(spark, sf):
    k = _unresolved_refs(spark, sf, "kyc").withColumnRenamed("n", "unresolved_kyc_records").withColumn("_k", F.lit(1))
    e = (_unresolved_refs(spark, sf, "employment").withColumnRenamed("n", "unresolved_employment_records")
         .withColumn("_e", F.lit(1)))
    j = k.join(e, "customer_ref", "full_outer")
    pop = (F.when(F.col("_k").isNotNull() & F.col("_e").isNotNull(), "UNRESOLVED_IN_BOTH")
           .when(F.col("_k").isNotNull(), "KYC_ONLY").otherwise("EMPLOYMENT_ONLY"))
    return j.groupBy(pop.alias("orphan_population")).agg(
        F.count(F.lit(1)).alias("distinct_customer_references"),
        F.sum(F.coalesce("unresolved_kyc_records", F.lit(0))).alias("unresolved_kyc_records"),
        F.sum(F.coalesce("unresolved_employment_records", F.lit(0))).alias("unresolved_employment_records"))


_UK = "(SELECT customer_ref, count(*) AS unresolved_kyc_records FROM res_kyc WHERE resolution_status = 'UNRESOLVED' GROUP BY 1)"
_UE = ("(SELECT customer_ref, count(*) AS unresolved_employment_records FROM res_employment "
       "WHERE resolution_status = 'UNRESOLVED' GROUP BY 1)")
register("id_orphan_overlap", _osql(f"""SELECT CASE WHEN k.customer_ref IS NOT NULL AND e.customer_ref IS NOT NULL
    THEN 'UNRESOLVED_IN_BOTH' WHEN k.customer_ref IS NOT NULL THEN 'KYC_ONLY' ELSE 'EMPLOYMENT_ONLY' END AS orphan_population,
  count(*) AS distinct_customer_references, sum(coalesce(k.unresolved_kyc_records, 0)) AS unresolved_kyc_records,
  sum(coalesce(e.unresolved_employment_records, 0)) AS unresolved_employment_records
FROM {_UK} k FULL OUTER JOIN {_UE} e ON e.customer_ref = k.customer_ref GROUP BY 1"""))(_overlap)


def _topk(spark, sf):
    k = _unresolved_refs(spark, sf, "kyc").withColumnRenamed("n", "unresolved_kyc_records")
    e = _unresolved_refs(spark, sf, "employment").withColumnRenamed("n", "unresolved_employment_records")
    # top-k report: the limit IS the feature (first 100 references in both)
    return k.join(e, "customer_ref").orderBy("customer_ref").limit(100)


register("id_orphan_topk", _osql(f"""SELECT k.customer_ref, k.unresolved_kyc_records, e.unresolved_employment_records
FROM {_UK} k JOIN {_UE} e ON e.customer_ref = k.customer_ref ORDER BY k.customer_ref LIMIT 100"""))(_topk)


def _summary(spark, sf):
    names = {"KYC": "kyc", "EMPLOYMENT": "employment", "SERVICE_REQUEST": "request"}
    return I.orphan_summary({n: _resolution(spark, sf, e).filter(F.col("resolution_status") == "UNRESOLVED")
                             for n, e in names.items()})


# Population by the bit mask of the entities that hold an orphan (1 KYC, 2 employment, 4 request).
POPULATIONS = {1: "KYC_ONLY", 2: "EMPLOYMENT_ONLY", 3: "KYC_AND_EMPLOYMENT", 4: "SERVICE_REQUEST_ONLY",
               5: "KYC_AND_SERVICE_REQUEST", 6: "EMPLOYMENT_AND_SERVICE_REQUEST", 7: "ALL_THREE"}


def _summary_sql() -> str:
    """Bit masks per reference, then one grouping-sets pass for the populations and the grand total."""
    q = O.Q()
    _sq(q)
    bits = {"kyc": 1, "employment": 2, "request": 4}
    q.add("bits", " UNION ALL ".join(
        f"SELECT customer_ref, {bit} AS bit FROM res_{ent} WHERE candidate_party_key IS NULL AND resolution_status <> 'AMBIGUOUS'"
        for ent, bit in bits.items()))
    q.add("masks", "SELECT customer_ref, bit_or(bit) AS mask, "
          + ", ".join(f"sum((bit = {bit})::INT) AS {ent}_orphan_records" for ent, bit in bits.items())
          + " FROM bits GROUP BY customer_ref")
    names = ", ".join(f"({m}, '{n}')" for m, n in POPULATIONS.items())
    sums = ", ".join(f"sum({ent}_orphan_records) AS {ent}_orphan_records" for ent in bits)
    total = " + ".join(f"{ent}_orphan_records" for ent in bits)
    return q.sql(f"""SELECT coalesce(label, 'ALL_ORPHAN_CUSTOMER_REFERENCES') AS orphan_population,
  count(*) AS distinct_orphan_customer_references, {sums}, sum({total}) AS total_orphan_records
FROM masks JOIN (VALUES {names}) AS p(mask, label) USING (mask) GROUP BY GROUPING SETS ((label), ())""")


register("id_orphan_summary", _summary_sql())(_summary)


# ---------------------------------------------------- as-of-date variant
AS_OF_DATE = fx.BUSINESS_DATE


def _xref(spark, sf):
    return fx.memo(spark, sf, ("id", "xref"), lambda: I.crosswalk_as_of(
        P.validated(spark, sf, "core_banking_customer"), P.validated(spark, sf, "crm_customer"), AS_OF_DATE))


def _xref_sql(q: O.Q) -> str:
    """People first (a national id and who holds it), then one row per holder of those with one holder a system."""
    core, crm = q.validated("core_banking_customer"), q.validated("crm_customer")
    q.add("holders", f"""SELECT business_date, national_id, {{'sys': 'CORE_BANKING', 'id': cust_no}} AS holder FROM {core}
UNION ALL SELECT business_date, national_id, {{'sys': 'CRM', 'id': party_id}} FROM {crm}""")
    q.add("people", f"""SELECT business_date AS as_of_date, sha256('CUSTOMER_360|' || upper(trim(national_id))) AS party_key,
  list(holder) AS held_by, count_if(holder.sys = 'CORE_BANKING') AS in_core, count_if(holder.sys = 'CRM') AS in_crm
FROM holders WHERE business_date = DATE '{AS_OF_DATE}' GROUP BY as_of_date, upper(trim(national_id))""")
    return q.add("xref", """SELECT as_of_date, party_key, h.sys AS source_system, h.id AS source_customer_key,
  list_extract(['CORE_ONLY', 'CRM_ONLY', 'CONFIRMED_CORE_CRM'], CAST(in_core + 2 * in_crm AS BIGINT)) AS resolution_status
FROM people, unnest(held_by) AS u(h) WHERE greatest(in_core, in_crm) = 1""")


register("id_crosswalk_as_of", (lambda q: q.sql(f"SELECT * FROM {_xref_sql(q)}"))(O.Q()))(_xref)


def _kyc_cand(spark, sf):
    return I.kyc_as_of(P.validated(spark, sf, "customer_kyc"), _xref(spark, sf))


def _kyc_cand_sql(q: O.Q) -> str:
    """What a reference can mean on the day; a document is repeated for each meaning and sure only with one."""
    q.add("meanings", f"""SELECT as_of_date, source_customer_key AS customer_ref, list(party_key) AS parties FROM {_xref_sql(q)} GROUP BY ALL""")
    k = q.validated("customer_kyc")
    return q.add("kc", f"""SELECT business_date AS as_of_date, kyc_id, d.customer_ref, id_type, id_number, verification_status, verified_date,
  if(candidate_count = 1, parties[1], NULL) AS party_key, candidate_count
FROM (SELECT k.*, parties, coalesce(len(parties), 0) AS candidate_count FROM {k} k
      LEFT JOIN meanings m ON m.customer_ref = k.customer_ref AND m.as_of_date = k.business_date) d, range(greatest(candidate_count, 1))""")


register("id_kyc_as_of", (lambda q: q.sql(f"SELECT * FROM {_kyc_cand_sql(q)}"))(O.Q()))(_kyc_cand)


def _snapshot(spark, sf):
    return I.customer_360_snapshot(_xref(spark, sf), P.validated(spark, sf, "core_banking_customer"),
                                   P.validated(spark, sf, "crm_customer"), _kyc_cand(spark, sf))


def _snapshot_sql() -> str:
    """The crosswalk turned into one row per party with its two keys; the newest sure document as a struct."""
    q = O.Q()
    x, kc = _xref_sql(q), _kyc_cand_sql(q)
    core, crm = q.validated("core_banking_customer"), q.validated("crm_customer")
    q.add("parties", f"""SELECT as_of_date, party_key, any_value(source_customer_key) FILTER (source_system = 'CORE_BANKING') AS in_core,
  any_value(source_customer_key) FILTER (source_system = 'CRM') AS in_crm FROM {x} GROUP BY as_of_date, party_key""")
    q.add("papers", f"""SELECT as_of_date, party_key, count(*) AS papers,
  first({{'id': kyc_id, 'kind': id_type, 'status': verification_status, 'day': verified_date}}
        ORDER BY verified_date DESC NULLS LAST, kyc_id DESC) AS paper
FROM {kc} WHERE candidate_count = 1 GROUP BY as_of_date, party_key""")
    return q.sql(f"""SELECT as_of_date, party_key, b.cust_no, b.cif_number, b.full_name AS core_full_name, b.date_of_birth,
  b.address AS core_address, m.party_id, m.customer_name AS crm_customer_name, m.email AS crm_email, m.preferred_contact_method,
  paper.id AS latest_kyc_id, paper.kind AS latest_kyc_id_type, paper.status AS latest_kyc_status, paper.day AS latest_kyc_verified_date,
  coalesce(papers, 0) AS kyc_record_count,
  if(b.cust_no IS NULL, 'CRM_ONLY', if(m.party_id IS NULL, 'CORE_ONLY', 'CORE_AND_CRM')) AS source_coverage
FROM parties LEFT JOIN papers USING (as_of_date, party_key)
LEFT JOIN {core} b ON b.cust_no = in_core AND b.business_date = as_of_date
LEFT JOIN {crm} m ON m.party_id = in_crm AND m.business_date = as_of_date""")


register("id_customer_360_snapshot", _snapshot_sql())(_snapshot)
