"""Deterministic test-data masking as JVM-side Column expressions.

``mask(val, pii_type)`` is one CASE expression (never a Python UDF); when
the PII type of a column is known up front, ``apply_masks`` emits only that
type's branch.  ``register_sql_function`` exposes the same CASE as a SQL
function (``CREATE TEMPORARY FUNCTION ... RETURN``), which Spark inlines.
NULL or blank values are returned unchanged; unknown types become
``***PRIVATIZED***``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EMAIL_DOMAIN = "notreal.example.com.au"
UNKNOWN_TYPE = "***PRIVATIZED***"

# Masking rules per PII type, in policy order.
#   ("const", text)                      constant replacement
#   ("md5", prefix, n, case)             prefix + first n hex chars of md5(val)
#   ("digits_tail", prefix, n)           prefix + last n digits of val
#   ("initial_md5", n)                   upper initial + '. MASKED_' + md5[1..n] upper
#   ("year_start",)                      first 4 chars + '-01-01'
#   ("first_md5_digits", n)              first char + last n digits of md5(val)
#   ("phone",)                           first 4 digits + '11' + last 4 digits
#   ("email", n)                         md5[1..n] lower + '@' + domain
#   ("keep", left, mid, from, len, tail) left(val, left) + mid + substring(val, from, len) + tail
MASK_RULES = [
    ("national_id", ("digits_tail", "011", 7)),
    ("individual_name", ("initial_md5", 6)),
    ("org_name", ("md5", "ORG_", 8, "upper")),
    ("store_name", ("md5", "ORG_", 8, "upper")),
    ("dob", ("year_start",)),
    ("dod", ("year_start",)),
    ("abn", ("const", "10123456789")),
    ("acn", ("const", "012345674")),
    ("tfn", ("const", "123456782")),
    ("driver_license", ("md5", "DL", 7, "upper")),
    ("medicare", ("digits_tail", "2", 9)),
    ("passport", ("md5", "N", 8, "upper")),
    ("tin", ("first_md5_digits", 8)),
    ("ein", ("first_md5_digits", 8)),
    ("birth_certificate", ("md5", "BC", 8, "upper")),
    ("address", ("const", "456 Masked Street, MASKED_SUBURB NSW 2789")),
    ("phone", ("phone",)),
    ("email", ("email", 10)),
    ("gps_coordinates", ("const", "-37.8136, 144.9631")),
    ("account_short_name", ("const", "MASKED ACC SHORTNAME")),
    ("card_number", ("keep", 9, "999999", None, None, "right1")),
    ("cheque_number", ("keep", 1, "999999", 8, 10, "")),
    ("swift_code", ("keep", 7, "0", 9, 10, "")),
    ("iban", ("keep", 4, " 0000 0000 0000 0000", None, None, "")),
    ("superannuation", ("const", "APIR9999AU")),
    ("giin", ("md5", "X", 9, "upper")),
    ("hin", ("md5", "X", 9, "upper")),
    ("srn", ("md5", "X", 9, "upper")),
    ("lei", ("lei", 6, 12, "97")),
    ("avid", ("md5", "", 8, "upper")),
    ("key_identifier", ("md5", "ID_", 8, "upper")),
    ("narrative", ("const", "PRIVATIZED TEXT")),
    ("image", ("const", "IMAGE_PRIVATIZED_BLOB")),
    ("web_address", ("const", "HTTP://www.99999.notreal.com.au")),
    ("ip_address", ("const", "127.0.0.1")),
    ("password", ("const", "********")),
    ("vin", ("keep", 3, "XXXXX", 9, 3, "XXXXXX")),
    ("security_qa", ("const", "PRIVATIZED SECURITY ANSWER")),
    ("cookie_session", ("const", "SESSION_BLANKED_OUT")),
    ("file_path", ("const", "/test_env/masked_filepath.dat")),
]
PII_TYPES = [t for t, _ in MASK_RULES]


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _rule_expr(v: Column, rule: tuple, email_domain: str) -> Column:
    kind = rule[0]
    md5 = F.md5(v)
    if kind == "const":
        return F.lit(rule[1])
    if kind == "md5":
        _, prefix, n, case = rule
        part = F.substring(md5, 1, n)
        return F.concat(F.lit(prefix), F.upper(part) if case == "upper" else F.lower(part))
    if kind == "digits_tail":
        _, prefix, n = rule
        d = _digits(v)
        return F.concat(F.lit(prefix), F.when(F.length(d) >= n, F.substring(d, -n, n)).otherwise(d))
    if kind == "initial_md5":
        return F.concat(F.upper(F.substring(F.trim(v), 1, 1)), F.lit(". MASKED_"), F.upper(F.substring(md5, 1, rule[1])))
    if kind == "year_start":
        return F.concat(F.substring(v, 1, 4), F.lit("-01-01"))
    if kind == "first_md5_digits":
        d = _digits(md5)
        n = rule[1]
        return F.concat(F.substring(v, 1, 1), F.when(F.length(d) >= n, F.substring(d, -n, n)).otherwise(d))
    if kind == "phone":
        d = _digits(v)
        return F.concat(F.substring(d, 1, 4), F.lit("11"), F.when(F.length(d) >= 4, F.substring(d, -4, 4)).otherwise(d))
    if kind == "email":
        return F.concat(F.lower(F.substring(md5, 1, rule[1])), F.lit("@" + email_domain))
    if kind == "keep":
        _, left, mid, frm, ln, tail = rule
        parts = [F.substring(v, 1, left), F.lit(mid)]
        if frm is not None:
            parts.append(F.substring(v, frm, ln))
        if tail == "right1":
            parts.append(F.substring(v, -1, 1))
        elif tail:
            parts.append(F.lit(tail))
        return F.concat(*parts)
    if kind == "lei":
        _, left, n, tail = rule
        return F.concat(F.substring(v, 1, left), F.upper(F.substring(md5, 1, n)), F.lit(tail))
    raise ValueError(kind)


def _blank(v: Column) -> Column:
    return v.isNull() | (F.trim(v) == "")


def mask_as(col, pii_type: str, email_domain: str = EMAIL_DOMAIN) -> Column:
    """Mask a column whose PII type is known (only that branch is emitted)."""
    v = (F.col(col) if isinstance(col, str) else col).cast("string")
    rules = dict(MASK_RULES)
    masked = _rule_expr(v, rules[pii_type], email_domain) if pii_type in rules else F.lit(UNKNOWN_TYPE)
    return F.when(_blank(v), v).otherwise(masked)


def mask(val, pii_type, email_domain: str = EMAIL_DOMAIN) -> Column:
    """Mask with the PII type given per row (full CASE over all rules)."""
    v = (F.col(val) if isinstance(val, str) else val).cast("string")
    t = F.col(pii_type) if isinstance(pii_type, str) else pii_type
    out = F.when(_blank(v), v)
    for name, rule in MASK_RULES:
        out = out.when(t == F.lit(name), _rule_expr(v, rule, email_domain))
    return out.otherwise(F.lit(UNKNOWN_TYPE))


def apply_masks(df: DataFrame, policy: dict[str, str], exempt: bool = False,
                email_domain: str = EMAIL_DOMAIN) -> DataFrame:
    """Publish-time masking: ``{column: pii_type}``; exempt readers see clear values."""
    if exempt:
        return df
    return df.withColumns({c: mask_as(c, t, email_domain) for c, t in policy.items() if c in df.columns})


def masking_audit(original: DataFrame, table: str, policy: dict[str, str], policy_name: str = "tdm_masking") -> DataFrame:
    """One row per masked column: how many records the mask transformed
    (all columns counted in ONE aggregation pass)."""
    cols = [c for c in policy if c in original.columns]
    aggs = [F.count_if(F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
                       & (mask_as(c, policy[c]) != F.col(c).cast("string"))).alias(f"_n{i}")
            for i, c in enumerate(cols)]
    wide = original.agg(*aggs)
    stack = ", ".join(f"'{c}', '{policy[c]}', _n{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, pii_type, records_transformed)").select(
        F.lit(table).alias("table_name"), "column_name", "pii_type", F.lit(policy_name).alias("policy_name"),
        "records_transformed")


def sql_function_body(email_domain: str = EMAIL_DOMAIN) -> str:
    """The masking CASE as Spark SQL text (for a SQL function)."""
    def q(s):
        return "'" + s.replace("'", "''") + "'"

    def r(n):
        return f"substring(val, -{n}, {n})"

    branches = []
    for name, rule in MASK_RULES:
        k = rule[0]
        if k == "const":
            e = q(rule[1])
        elif k == "md5":
            f = "upper" if rule[3] == "upper" else "lower"
            e = f"concat({q(rule[1])}, {f}(substring(md5(val), 1, {rule[2]})))"
        elif k == "digits_tail":
            d = "regexp_replace(val, '[^0-9]', '')"
            e = f"concat({q(rule[1])}, substring({d}, -{rule[2]}, {rule[2]}))"
        elif k == "initial_md5":
            e = f"concat(upper(substring(trim(val), 1, 1)), '. MASKED_', upper(substring(md5(val), 1, {rule[1]})))"
        elif k == "year_start":
            e = "concat(substring(val, 1, 4), '-01-01')"
        elif k == "first_md5_digits":
            e = f"concat(substring(val, 1, 1), substring(regexp_replace(md5(val), '[^0-9]', ''), -{rule[1]}, {rule[1]}))"
        elif k == "phone":
            d = "regexp_replace(val, '[^0-9]', '')"
            e = f"concat(substring({d}, 1, 4), '11', substring({d}, -4, 4))"
        elif k == "email":
            e = f"concat(lower(substring(md5(val), 1, {rule[1]})), {q('@' + email_domain)})"
        elif k == "keep":
            _, left, mid, frm, ln, tail = rule
            parts = [f"substring(val, 1, {left})", q(mid)]
            if frm is not None:
                parts.append(f"substring(val, {frm}, {ln})")
            if tail == "right1":
                parts.append(r(1))
            elif tail:
                parts.append(q(tail))
            e = "concat(" + ", ".join(parts) + ")"
        elif k == "lei":
            e = f"concat(substring(val, 1, {rule[1]}), upper(substring(md5(val), 1, {rule[2]})), {q(rule[3])})"
        branches.append(f"WHEN pii_type = {q(name)} THEN {e}")
    return ("CASE WHEN val IS NULL OR trim(val) = '' THEN val " + " ".join(branches)
            + f" ELSE {q(UNKNOWN_TYPE)} END")


def register_sql_function(spark: SparkSession, name: str = "mask_pii", email_domain: str = EMAIL_DOMAIN) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(val STRING, pii_type STRING) RETURNS STRING "
              f"RETURN {sql_function_body(email_domain)}")


def encrypt(col, key_conf: str = "vaultline.mask.key", spark: SparkSession | None = None,
            default_key: str | None = None) -> Column:
    """Reversible column encryption (AES-GCM); the key comes from the
    session conf, never from code."""
    key = spark.conf.get(key_conf, default_key) if spark is not None else default_key
    if not key:
        raise ValueError(f"encryption key not configured ({key_conf})")
    c = F.col(col) if isinstance(col, str) else col
    return F.base64(F.aes_encrypt(c.cast("string"), F.lit(key), F.lit("GCM")))


def decrypt(col, key: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.try_aes_decrypt(F.unbase64(c), F.lit(key), F.lit("GCM")).cast("string")
