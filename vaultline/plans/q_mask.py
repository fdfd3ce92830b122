"""Masking / governance queries (MK-01..18)."""

from __future__ import annotations

import secrets

from functools import reduce

from pyspark.sql import functions as F

from vaultline.config import TABLES
from vaultline.functions import masking as M
from vaultline.operators import quarantine as QU
from vaultline.operators.access import ALL, Access, Tag
from vaultline.plans import oracle as O
from vaultline.plans import pipeline as P
from vaultline.plans.registry import ORACLE, register

# Which customer column feeds each PII type in the all-types check.
TYPE_SOURCE = {
    "national_id": "national_id", "individual_name": "full_name", "org_name": "full_name", "store_name": "address",
    "dob": "CAST(date_of_birth AS STRING)", "dod": "CAST(created_date AS STRING)", "abn": "cif_number",
    "acn": "cif_number", "tfn": "cif_number", "driver_license": "cust_no", "medicare": "phone",
    "passport": "national_id", "tin": "cif_number", "ein": "cust_no", "birth_certificate": "cust_no",
    "address": "address", "phone": "phone", "email": "full_name", "gps_coordinates": "address",
    "account_short_name": "full_name", "card_number": "national_id", "cheque_number": "phone",
    "swift_code": "cif_number", "iban": "cif_number", "superannuation": "cust_no", "giin": "cust_no",
    "hin": "cif_number", "srn": "phone", "lei": "cif_number", "avid": "cust_no", "key_identifier": "cust_no",
    "narrative": "address", "image": "full_name", "web_address": "full_name", "ip_address": "phone",
    "password": "cust_no", "vin": "cif_number", "security_qa": "full_name", "cookie_session": "cust_no",
    "file_path": "address", "unlisted_type": "full_name",
}

POLICY = {"full_name": "individual_name", "national_id": "national_id", "phone": "phone", "address": "address",
          "date_of_birth": "dob"}


def duck_mask(v: str, t: str) -> str:
    """DuckDB formulation of one masking branch."""
    rule = dict(M.MASK_RULES).get(t)
    if rule is None:
        body = f"'{M.UNKNOWN_TYPE}'"
    else:
        k = rule[0]
        md5 = f"md5({v})"
        dig = f"regexp_replace({v}, '[^0-9]', '', 'g')"
        if k == "const":
            body = "'" + rule[1].replace("'", "''") + "'"
        elif k == "md5":
            f = "upper" if rule[3] == "upper" else "lower"
            body = f"'{rule[1]}' || {f}(left({md5}, {rule[2]}))"
        elif k == "digits_tail":
            body = f"'{rule[1]}' || right({dig}, {rule[2]})"
        elif k == "initial_md5":
            body = f"upper(left(trim({v}), 1)) || '. MASKED_' || upper(left({md5}, {rule[1]}))"
        elif k == "year_start":
            body = f"left({v}, 4) || '-01-01'"
        elif k == "first_md5_digits":
            body = f"left({v}, 1) || right(regexp_replace({md5}, '[^0-9]', '', 'g'), {rule[1]})"
        elif k == "phone":
            body = f"left({dig}, 4) || '11' || right({dig}, 4)"
        elif k == "email":
            body = f"lower(left({md5}, {rule[1]})) || '@{M.EMAIL_DOMAIN}'"
        elif k == "keep":
            _, left, mid, frm, ln, tail = rule
            body = f"left({v}, {left}) || '{mid}'"
            if frm is not None:
                body += f" || substring({v}, {frm}, {ln})"
            if tail == "right1":
                body += f" || right({v}, 1)"
            elif tail:
                body += f" || '{tail}'"
        elif k == "lei":
            body = f"left({v}, {rule[1]}) || upper(left({md5}, {rule[2]})) || '{rule[3]}'"
    return f"CASE WHEN {v} IS NULL OR trim({v}) = '' THEN {v} ELSE {body} END"


def _core(spark, sf):
    return P.bronze(spark, sf, "core_banking_customer")


def _all_types(spark, sf):
    c = _core(spark, sf)
    pairs = ", ".join(f"'{t}', {src}" for t, src in TYPE_SOURCE.items())
    long = c.selectExpr("cust_no", f"stack({len(TYPE_SOURCE)}, {pairs}) AS (pii_type, val)")
    return long.select("cust_no", "pii_type", M.mask("val", "pii_type").alias("masked_value"))


def _all_types_sql() -> str:
    q = O.Q()
    q.normalized("core_banking_customer")
    sels = [f"SELECT cust_no, '{t}' AS pii_type, {duck_mask(src.replace('STRING', 'VARCHAR'), t)} AS masked_value "
            f"FROM r_core_banking_customer" for t, src in TYPE_SOURCE.items()]
    return q.sql(" UNION ALL ".join(sels))


register("mask_all_types", _all_types_sql())(_all_types)


def _pii_sql(cols_only: bool = False) -> str:
    q = O.Q()
    q.normalized("core_banking_customer")
    exprs = []
    for c in ("cust_no", "cif_number", "full_name", "date_of_birth", "national_id", "phone", "address",
              "source_system", "created_date", "business_date"):
        if c in POLICY:
            v = f"CAST({c} AS VARCHAR)" if c == "date_of_birth" else c
            exprs.append(f"{duck_mask(v, POLICY[c])} AS {c}")
        else:
            exprs.append(c)
    return q.sql(f"SELECT {', '.join(exprs)} FROM r_core_banking_customer")


register("mask_pii_columns", _pii_sql())(lambda spark, sf: M.apply_masks(_core(spark, sf), POLICY))


def _sql_function(spark, sf):
    """Same policy through the registered SQL function (inlined by Spark)."""
    M.register_sql_function(spark)
    c = _core(spark, sf)
    exprs = [f"mask_pii(CAST({col} AS STRING), '{POLICY[col]}') AS {col}" if col in POLICY else col
             for col in c.columns]
    return c.selectExpr(*exprs)


register("mask_sql_function", _pii_sql())(_sql_function)


def _redacted(spark, sf):
    P.assess_all(spark, sf, TABLES)
    parts = [QU.redacted_evidence(P.quarantine(spark, sf, t)).drop("quarantine_key") for t in TABLES]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _redacted_sql() -> str:
    q = O.Q()
    sels = []
    for t, spec in TABLES.items():
        f = q.failures(t)
        key = "concat_ws(':', " + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '<NULL>')" for k in spec.keys) + ")"
        sels.append(f"SELECT '{t}' AS source_table_name, '{P.RUN_ID}' AS pipeline_run_id, sha256({key}) "
                    f"AS source_business_key_hash, failed_rule_name, 'VALIDATION_RULE_FAILURE' AS quarantine_reason "
                    f"FROM {f}")
    return q.sql(" UNION ALL ".join(sels))


register("mask_redacted_evidence", _redacted_sql())(_redacted)


def _audit(spark, sf):
    return M.masking_audit(_core(spark, sf), "core_banking_customer", POLICY)


def _audit_sql() -> str:
    q = O.Q()
    q.normalized("core_banking_customer")
    sels = []
    for c, t in POLICY.items():
        v = f"CAST({c} AS VARCHAR)"
        sels.append(f"SELECT 'core_banking_customer' AS table_name, '{c}' AS column_name, '{t}' AS pii_type, "
                    f"'tdm_masking' AS policy_name, count_if({c} IS NOT NULL AND trim({v}) <> '' AND "
                    f"{duck_mask(v, t)} <> {v}) AS records_transformed FROM r_core_banking_customer")
    return q.sql(" UNION ALL ".join(sels))


register("mask_audit", _audit_sql())(_audit)


def _mapping(spark, sf):
    """Reference-mapping masking: each customer's name is replaced by a
    pseudonym from a mapping table (nation names) picked by the customer
    number; unmapped -> rule mask.  No hint: AQE broadcasts the mapping
    only when its runtime size is under the threshold."""
    nation = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_nationkey").cast("bigint").alias("_bucket"),
                                          F.col("n_name").alias("_pseudonym"))
    c = _core(spark, sf).withColumn(
        "_bucket", F.expr("try_cast(regexp_replace(cust_no, '[^0-9]', '') AS BIGINT) % 25"))
    j = c.join(nation, "_bucket", "left")
    return j.select("cust_no", F.coalesce(F.concat(F.lit("CUSTOMER "), F.col("_pseudonym")),
                                          M.mask_as("full_name", "individual_name")).alias("full_name_masked"))


def _mapping_sql() -> str:
    q = O.Q()
    q.normalized("core_banking_customer")
    return q.sql(f"""SELECT c.cust_no, coalesce('CUSTOMER ' || n.n_name, {duck_mask('c.full_name', 'individual_name')})
  AS full_name_masked FROM r_core_banking_customer c LEFT JOIN nation n
  ON CAST(n.n_nationkey AS BIGINT) = TRY_CAST(regexp_replace(c.cust_no, '[^0-9]', '', 'g') AS BIGINT) % 25""")


register("mask_mapping_join", _mapping_sql())(_mapping)


def _roundtrip(spark, sf):
    if not spark.conf.get("vaultline.mask.key", None):
        spark.conf.set("vaultline.mask.key", secrets.token_hex(16))   # a key for this session only
    key = spark.conf.get("vaultline.mask.key")
    c = _core(spark, sf).select("cust_no", "national_id")
    enc = c.withColumn("national_id_enc", M.encrypt("national_id", spark=spark))
    return enc.select("cust_no", M.decrypt("national_id_enc", key).alias("national_id"),
                      (F.col("national_id_enc") != F.col("national_id")).alias("is_encrypted"))


def _roundtrip_sql() -> str:
    q = O.Q()
    q.normalized("core_banking_customer")
    return q.sql("SELECT cust_no, national_id, CASE WHEN national_id IS NULL THEN NULL ELSE TRUE END AS is_encrypted "
                 "FROM r_core_banking_customer")


register("mask_encrypt_roundtrip", _roundtrip_sql())(_roundtrip)


# ------------------------------------------------ readers of silver and gold
# Tagged columns of the published tables and their types.
TAGS = [Tag(*t) for t in (
    ("silver", "party_profile_version", "full_name", "individual_name"),
    ("silver", "party_profile_version", "address", "address"),
    ("silver", "party_identifier", "identifier_value", "national_id"),
    ("silver", "party_kyc_assessment", "id_number", "national_id"),
    ("silver", "party_employment", "employer_name", "org_name"),
    ("silver", "party_service_request", "request_description", "narrative"),
    ("silver", "payment_card", "card_number", "card_number"),
    ("silver", "merchant_location", "store_name", "store_name"),
    ("silver", "merchant_location", "store_address", "address"),
    ("silver", "call_center_contact", "caller_phone", "phone"),
    ("silver", "call_center_contact", "call_reason", "narrative"),
    ("silver", "investigation_note", "note_text", "narrative"),
    ("silver", "watchlist_entry", "entity_name", "individual_name"),
    ("silver", "sanctions_screening", "screened_name", "individual_name"),
    ("silver", "gateway_payment", "payment_reference", "narrative"),
    ("gold", "ai_aml_investigation_context", "latest_note_text", "narrative"),
    ("gold", "ai_customer_360_context", "employer_name", "org_name"),
    ("gold", "ai_customer_360_context", "last_call_reason", "narrative"),
)]
# Roles: engineers see all, fraud desk sees numbers it must dial or block, everyone else sees masks.
ACCESS = Access(TAGS, {"engineer": {ALL}, "fraud_desk": {"card_number", "phone"}, "analyst": set()})
GOLD = {"ai_aml_investigation_context": (P.gold_aml, "gold_aml_investigation"),
        "ai_customer_360_context": (P.gold_customer_360, "gold_customer_360")}
_TAGGED = list(dict.fromkeys((t.layer, t.table) for t in TAGS))


def _seen_by(role: str):
    """Every value of the tagged columns as a role sees it, with how many rows hold it; one pass a table."""
    def build(spark, sf):
        parts = []
        for layer, table in _TAGGED:
            df = GOLD[table][0](spark, sf) if layer == "gold" else P.silver(spark, sf, table)
            view = ACCESS.view(df, layer, table, role)
            values = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in ACCESS.of(layer, table)])
            parts.append(view.select(F.inline(values)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("records"))
                         .select(F.lit(f"{layer}.{table}").alias("table_name"), "*"))
        return reduce(lambda a, b: a.unionByName(b), parts)

    return build


def _seen_sql(masked) -> str:
    """``masked``: the types that the role does not see."""
    q, parts = O.Q(), []
    for t in TAGS:
        source = f"({ORACLE[GOLD[t.table][1]]})" if t.layer == "gold" else q.silver(t.table)
        value = duck_mask(f"CAST({t.column} AS VARCHAR)", t.pii_type) if t.pii_type in masked else f"CAST({t.column} AS VARCHAR)"
        parts.append(f"SELECT '{t.layer}.{t.table}' AS table_name, '{t.column}' AS column_name, value, count(*) AS records "
                     f"FROM (SELECT {value} AS value FROM {source} AS x) GROUP BY value")
    return q.sql(" UNION ALL ".join(parts))


_TYPES = {t.pii_type for t in TAGS}
register("mask_seen_by_analyst", _seen_sql(_TYPES))(_seen_by("analyst"))
register("mask_seen_by_fraud_desk", _seen_sql(_TYPES - {"card_number", "phone"}))(_seen_by("fraud_desk"))
register("mask_seen_by_engineer", _seen_sql(set()))(_seen_by("engineer"))
