"""Customer identity resolution (core + CRM) and reference resolution.

Every step is a grouped aggregate or an equi-join on a token, never a
window over an identity: a national id shared by a third of all rows is
combined map-side by partial aggregation instead of landing whole in one
task.

* ``active_customers``     open rows with a non-blank national id + token
* ``party_candidates``     one party per token whose core and CRM counts are both <= 1
* ``party_identifiers``    source keys (cust_no / party_id) mapped to the party
* ``resolve_references``   generic CONFIRMED / UNRESOLVED / AMBIGUOUS rule for
                           any table with a customer reference (KYC, employment,
                           service requests)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.keys import display_key, reference_type, token


def _open(df: DataFrame) -> DataFrame:
    return df.filter(F.col("__END_AT").isNull()) if "__END_AT" in df.columns else df


def _start(df: DataFrame) -> Column:
    return F.col("__START_AT") if "__START_AT" in df.columns else F.lit(None).cast("bigint")


def active_customers(core: DataFrame, crm: DataFrame) -> DataFrame:
    """Union of open core and CRM rows with a usable national id."""
    def one(df, key, system):
        ok = F.col("national_id").isNotNull() & (F.trim("national_id") != "")
        return _open(df).filter(ok).select(
            F.lit(system).alias("source_system"), F.col(key).alias("source_business_key"),
            token("CUSTOMER_360", F.upper(F.trim("national_id"))).alias("national_id_token"),
            F.col("business_date"), _start(df).alias("__START_AT"))
    return one(core, "cust_no", "CORE_BANKING").unionByName(one(crm, "party_id", "CRM"))


def party_key_of(tok) -> Column:
    return display_key("P-", F.concat(F.lit("PARTY_TEST|"), tok), 12)


def party_candidates(active: DataFrame) -> DataFrame:
    """One candidate party per identity token, dropping tokens with more
    than one active row in either source; coverage by source."""
    g = active.groupBy("national_id_token").agg(
        F.count_if(F.col("source_system") == "CORE_BANKING").alias("core_active_count"),
        F.count_if(F.col("source_system") == "CRM").alias("crm_active_count"),
        F.max("business_date").alias("latest_business_date"))
    g = g.filter((F.col("core_active_count") <= 1) & (F.col("crm_active_count") <= 1))
    coverage = (F.when((F.col("core_active_count") == 1) & (F.col("crm_active_count") == 1), F.lit("CORE_AND_CRM"))
                .when(F.col("core_active_count") == 1, F.lit("CORE_ONLY")).otherwise(F.lit("CRM_ONLY")))
    return g.select(party_key_of(F.col("national_id_token")).alias("party_key"),
                    F.lit("PERSON").alias("party_type"), F.lit("ACTIVE").alias("party_status"),
                    F.lit("VALID").alias("data_quality_status"), coverage.alias("source_coverage"),
                    "latest_business_date", "national_id_token")


def party_identifiers(active: DataFrame, candidates: DataFrame) -> DataFrame:
    """Each active source key as an identifier of its candidate party (inner
    equi-join on the token; AQE splits a skewed token partition)."""
    ident_type = F.when(F.col("source_system") == "CORE_BANKING", F.lit("CORE_CUST_NO")).otherwise(F.lit("CRM_PARTY_ID"))
    src_table = F.when(F.col("source_system") == "CORE_BANKING", F.lit("core_banking_customer|cust_no="))\
        .otherwise(F.lit("crm_customer|party_id="))
    j = active.join(candidates.select("national_id_token", "party_key"), "national_id_token")
    return j.select(
        display_key("PI-", F.concat_ws("|", "party_key", "source_system", ident_type, "source_business_key"), 16)
        .alias("party_identifier_key"),
        "party_key", ident_type.alias("identifier_type"),
        token("IDENTIFIER", F.col("source_business_key")).alias("identifier_value_token"),
        "source_system", F.lit(True).alias("is_primary"), F.col("__START_AT").alias("valid_from"),
        F.lit(None).cast("bigint").alias("valid_to"), "source_business_key",
        F.concat(src_table, F.col("source_business_key"), F.lit("|business_date="),
                 F.col("business_date").cast("string")).alias("bronze_record_ref"))


def resolve_references(records: DataFrame, identifiers: DataFrame, key: str, source_system: str,
                       source_entity: str, hash_prefix: str, ref: str = "customer_ref",
                       resolved_at: str | None = None) -> DataFrame:
    """CONFIRMED (exactly one candidate party) / UNRESOLVED (none) /
    AMBIGUOUS (several) for every open record.

    Identifiers are first aggregated per (type, token) - count and smallest
    party - so the join onto the records cannot fan out."""
    idx = (identifiers.filter(F.col("valid_to").isNull())
           .groupBy("identifier_type", "identifier_value_token")
           .agg(F.count("party_key").alias("_n"), F.min("party_key").alias("_pk")))
    r = _open(records).select(key, ref, "business_date",
                              reference_type(F.col(ref)).alias("_type"),
                              token("IDENTIFIER", F.col(ref)).alias("_tok"))
    j = r.join(idx, (F.col("_type") == F.col("identifier_type")) & (F.col("_tok") == F.col("identifier_value_token")),
               "left")
    n = F.coalesce(F.col("_n"), F.lit(0))
    status = F.when(n == 1, F.lit("CONFIRMED")).when(n == 0, F.lit("UNRESOLVED")).otherwise(F.lit("AMBIGUOUS"))
    ts = F.to_timestamp_ntz(F.lit(resolved_at)) if resolved_at else F.current_timestamp()
    return j.select(
        display_key("IR-", F.concat(F.lit(hash_prefix + "|"), F.col(key)), 16).alias("identity_resolution_key"),
        F.lit(source_system).alias("source_system"), F.lit(source_entity).alias("source_entity"),
        F.col(key).alias("source_business_key"), F.col(ref).alias("customer_ref"),
        F.when(n == 1, F.col("_pk")).alias("candidate_party_key"),
        status.alias("resolution_status"), F.lit("DIRECT_IDENTIFIER").alias("match_method"),
        F.when(n == 1, F.lit(1).cast("decimal(5,4)")).alias("match_confidence"),
        F.when(n == 1, ts).alias("resolved_at"),
        F.concat(F.lit(f"{source_entity}|{key}="), F.col(key), F.lit("|business_date="),
                 F.col("business_date").cast("string")).alias("bronze_record_ref"),
        F.col("business_date"))


def curated(records: DataFrame, resolution: DataFrame, key: str, curated_key: Column, source_system: str,
            columns: list) -> DataFrame:
    """Confirmed records as curated rows: their own key, the party, ``columns``, and where they came from."""
    party = resolution.filter(F.col("resolution_status") == "CONFIRMED").select(
        F.col("source_business_key").alias(key), F.col("candidate_party_key").alias("party_key"), "bronze_record_ref")
    return _open(records).join(party, key).select(
        curated_key, "party_key", *columns, F.lit(source_system).alias("source_system"),
        F.col(key).alias("source_business_key"), "bronze_record_ref")


def unresolved_evidence(resolution: DataFrame, key: str) -> DataFrame:
    """What did not resolve, by its own key and status; the resolution alone says it, no source is read."""
    return resolution.filter(F.col("resolution_status") != "CONFIRMED").select(
        F.col("source_business_key").alias(key), "resolution_status",
        F.concat("resolution_status", F.lit("_CUSTOMER_REFERENCE")).alias("quarantine_reason"), "bronze_record_ref")


def status_by_reference(resolution: DataFrame) -> DataFrame:
    """Records by resolution status and by the format of their customer reference."""
    kind = F.coalesce(reference_type("customer_ref"), F.lit("UNRECOGNISED_FORMAT"))
    return resolution.groupBy("resolution_status", kind.alias("reference_type")).agg(F.count(F.lit(1)).alias("records"))


def curated_checks(rows: DataFrame, key: str) -> DataFrame:
    """Curated rows, those without a party, and keys given twice, in one row."""
    return (rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("party_key").isNull()).alias("lost"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("curated_records"), F.coalesce(F.sum("lost"), F.lit(0)).alias("without_party"),
                 F.count_if(F.col("n") > 1).alias("duplicate_keys")))


def unresolved(records: DataFrame, resolution: DataFrame, key: str, columns: list) -> DataFrame:
    """Records that did not resolve, with the quarantine reason."""
    bad = resolution.filter(F.col("resolution_status") != "CONFIRMED").select(
        F.col("source_business_key").alias(key), "resolution_status")
    j = _open(records).join(bad, key)
    reason = F.when(F.col("resolution_status") == "UNRESOLVED", F.lit("UNRESOLVED_CUSTOMER_REFERENCE")) \
        .otherwise(F.lit("AMBIGUOUS_CUSTOMER_REFERENCE"))
    return j.select(F.col("business_date").alias("as_of_date"), key, "customer_ref", *columns,
                    reason.alias("quarantine_reason"))


def unresolved_reasons(resolution: DataFrame, core_active_keys: DataFrame, crm_active_keys: DataFrame) -> DataFrame:
    """Why UNRESOLVED references failed: present in a source but not mapped,
    missing from the active source, or an unrecognised format.  Presence is
    tested with semi-join flags (distinct keys), so duplicates cannot
    inflate the counts."""
    u = resolution.filter(F.col("resolution_status") == "UNRESOLVED").select("customer_ref")
    core = core_active_keys.select(F.col("source_business_key").alias("_c")).distinct().withColumn("_in_core", F.lit(True))
    crm = crm_active_keys.select(F.col("source_business_key").alias("_r")).distinct().withColumn("_in_crm", F.lit(True))
    j = (u.join(core, F.col("customer_ref") == F.col("_c"), "left")
         .join(crm, F.col("customer_ref") == F.col("_r"), "left"))
    ref = F.col("customer_ref")
    reason = (F.when(ref.like("CB-%") & F.col("_in_core").isNotNull(), F.lit("PRESENT_IN_CORE_BUT_NOT_MAPPED"))
              .when(ref.like("CRM-%") & F.col("_in_crm").isNotNull(), F.lit("PRESENT_IN_CRM_BUT_NOT_MAPPED"))
              .when(ref.like("CB-%"), F.lit("MISSING_FROM_ACTIVE_CORE"))
              .when(ref.like("CRM-%"), F.lit("MISSING_FROM_ACTIVE_CRM"))
              .otherwise(F.lit("UNRECOGNISED_FORMAT")))
    return j.groupBy(reason.alias("unresolved_reason")).agg(F.count(F.lit(1)).alias("record_count"))


def orphan_summary(unresolved_by_entity: dict[str, DataFrame]) -> DataFrame:
    """Three-way orphan overlap: per customer reference, how many UNRESOLVED
    records each entity holds, classified, summarised, plus a grand total
    row (rollup)."""
    names = list(unresolved_by_entity)
    short = {"SERVICE_REQUEST": "request"}
    counts = [f"{short.get(n, n.lower())}_orphan_records" for n in names]
    parts = [df.select("customer_ref", F.lit(n).alias("source_entity")) for n, df in unresolved_by_entity.items()]
    orphans = reduce(lambda a, b: a.unionByName(b), parts)
    per_ref = orphans.groupBy("customer_ref").agg(
        *[F.count_if(F.col("source_entity") == n).alias(c) for n, c in zip(names, counts)])
    k, e, r = (F.col(c) > 0 for c in counts)
    cls = (F.when(k & e & r, "ALL_THREE").when(k & e, "KYC_AND_EMPLOYMENT").when(k & r, "KYC_AND_SERVICE_REQUEST")
           .when(e & r, "EMPLOYMENT_AND_SERVICE_REQUEST").when(k, "KYC_ONLY").when(e, "EMPLOYMENT_ONLY")
           .otherwise("SERVICE_REQUEST_ONLY"))
    classified = per_ref.withColumn("orphan_population", cls)
    summary = classified.rollup("orphan_population").agg(
        F.count(F.lit(1)).alias("distinct_orphan_customer_references"),
        *[F.sum(c).alias(c) for c in counts],
        F.sum(reduce(lambda a, b: a + b, [F.col(c) for c in counts])).alias("total_orphan_records"))
    return summary.select(F.coalesce("orphan_population", F.lit("ALL_ORPHAN_CUSTOMER_REFERENCES"))
                          .alias("orphan_population"), *summary.columns[1:])


# ----------------------------------------------------- as-of-date variant
def crosswalk_as_of(core: DataFrame, crm: DataFrame, as_of_date: str) -> DataFrame:
    """Per snapshot date: source customer key -> party, only where the
    normalised national id has at most one key in each source.  Counts
    come from a grouped aggregate joined back (null-safe on the id)."""
    d = F.to_date(F.lit(as_of_date))

    def one(df, key, system):
        return df.filter(F.col("business_date") == d).select(
            F.col("business_date").alias("as_of_date"), F.lit(system).alias("source_system"),
            F.col(key).alias("source_customer_key"),
            F.upper(F.trim("national_id")).alias("national_id_normalized"))

    keys = one(core, "cust_no", "CORE_BANKING").unionByName(one(crm, "party_id", "CRM"))
    counts = keys.groupBy(F.col("as_of_date").alias("_d"), F.col("national_id_normalized").alias("_n")).agg(
        F.count_if(F.col("source_system") == "CORE_BANKING").alias("core_candidates"),
        F.count_if(F.col("source_system") == "CRM").alias("crm_candidates"))
    j = keys.join(counts, (F.col("as_of_date") == F.col("_d"))
                  & F.col("national_id_normalized").eqNullSafe(F.col("_n")))
    j = j.filter((F.col("core_candidates") <= 1) & (F.col("crm_candidates") <= 1))
    status = (F.when((F.col("core_candidates") == 1) & (F.col("crm_candidates") == 1), F.lit("CONFIRMED_CORE_CRM"))
              .when((F.col("core_candidates") == 1) & (F.col("crm_candidates") == 0), F.lit("CORE_ONLY"))
              .when((F.col("core_candidates") == 0) & (F.col("crm_candidates") == 1), F.lit("CRM_ONLY"))
              .otherwise(F.lit("QUARANTINE_REQUIRED")))
    return j.select("as_of_date", token("CUSTOMER_360", F.col("national_id_normalized")).alias("party_key"),
                    "source_system", "source_customer_key", status.alias("resolution_status"))


def kyc_as_of(kyc: DataFrame, xref: DataFrame) -> DataFrame:
    """KYC rows with their candidate count against the crosswalk of the
    same date (crosswalk pre-aggregated per key: no fan-out)."""
    x = xref.groupBy(F.col("as_of_date").alias("_d"), F.col("source_customer_key").alias("_k")).agg(
        F.count("party_key").alias("candidate_count"), F.min("party_key").alias("party_key"))
    k = kyc.select(F.col("business_date").alias("as_of_date"), "kyc_id", "customer_ref", "id_type", "id_number",
                   "verification_status", "verified_date")
    j = k.join(x, (F.col("as_of_date") == F.col("_d")) & (F.col("customer_ref") == F.col("_k")), "left")
    return j.select("as_of_date", "kyc_id", "customer_ref", "id_type", "id_number", "verification_status",
                    "verified_date", F.when(F.col("candidate_count") == 1, F.col("party_key")).alias("party_key"),
                    F.coalesce("candidate_count", F.lit(0)).alias("candidate_count"))


def customer_360_snapshot(xref: DataFrame, core: DataFrame, crm: DataFrame, kyc_candidates: DataFrame) -> DataFrame:
    """One row per (as_of_date, party): core and CRM attributes side by side,
    latest resolved KYC (verified_date desc nulls last, kyc_id desc) and
    the KYC record count - all per-party aggregates, joined once."""
    resolved = kyc_candidates.filter(F.col("candidate_count") == 1)
    kyc = resolved.groupBy("as_of_date", "party_key").agg(
        F.max_by(F.struct("kyc_id", "id_type", "verification_status", "verified_date"),
                 F.struct(F.col("verified_date").isNotNull(), "verified_date", "kyc_id")).alias("_k"),
        F.count(F.lit(1)).alias("kyc_record_count"))
    spine = xref.select("as_of_date", "party_key").distinct()
    xc = xref.filter(F.col("source_system") == "CORE_BANKING").select("as_of_date", "party_key",
                                                                       F.col("source_customer_key").alias("cust_no"))
    xr = xref.filter(F.col("source_system") == "CRM").select("as_of_date", "party_key",
                                                              F.col("source_customer_key").alias("party_id"))
    c = core.select(F.col("business_date").alias("as_of_date"), "cust_no", "cif_number",
                    F.col("full_name").alias("core_full_name"), "date_of_birth", F.col("address").alias("core_address"))
    r = crm.select(F.col("business_date").alias("as_of_date"), "party_id",
                   F.col("customer_name").alias("crm_customer_name"), F.col("email").alias("crm_email"),
                   "preferred_contact_method")
    out = (spine.join(xc, ["as_of_date", "party_key"], "left").join(c, ["as_of_date", "cust_no"], "left")
           .join(xr, ["as_of_date", "party_key"], "left").join(r, ["as_of_date", "party_id"], "left")
           .join(kyc, ["as_of_date", "party_key"], "left"))
    cov = (F.when(F.col("cust_no").isNotNull() & F.col("party_id").isNotNull(), F.lit("CORE_AND_CRM"))
           .when(F.col("cust_no").isNotNull(), F.lit("CORE_ONLY")).otherwise(F.lit("CRM_ONLY")))
    return out.select("as_of_date", "party_key", "cust_no", "cif_number", "core_full_name", "date_of_birth",
                      "core_address", "party_id", "crm_customer_name", "crm_email", "preferred_contact_method",
                      F.col("_k.kyc_id").alias("latest_kyc_id"), F.col("_k.id_type").alias("latest_kyc_id_type"),
                      F.col("_k.verification_status").alias("latest_kyc_status"),
                      F.col("_k.verified_date").alias("latest_kyc_verified_date"),
                      F.coalesce("kyc_record_count", F.lit(0)).alias("kyc_record_count"), cov.alias("source_coverage"))
