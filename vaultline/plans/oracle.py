"""Independent DuckDB formulations of the registered queries.

The driver checks every Spark query against the SQL returned here.  The
inputs are the same fixture views (shared SQL text); everything downstream
(normalisation, rule evaluation, duplicate checks, keys, joins, latest-row
picks, aggregates) is re-stated in plain ANSI SQL, independently of the
DataFrame code.
"""

from __future__ import annotations

import re

from vaultline.config import TABLES
from vaultline.operators import silver as S
from vaultline.operators.ingest import UPPERCASE_IDENTIFIERS
from vaultline.operators.rules import rules_for
from vaultline.sources import fixtures as fx

RUN_CLOCK = "2026-12-01 00:00:00"
RUN_ID = "run-local"

_TYPES = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
          "date": "DATE", "bigint": "BIGINT", "int": "INTEGER"}


def sql_type(t: str) -> str:
    return _TYPES.get(t.lower(), t.upper())


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def HK(*parts: str) -> str:
    """hash_key in SQL: sha256 of '||'-joined trimmed text, NULL -> ''."""
    inner = ", ".join(f"coalesce(trim(CAST({p} AS VARCHAR)), '')" for p in parts)
    return f"sha256(concat_ws('||', {inner}))"


def SYS(ref: str) -> str:
    return (f"coalesce(CASE upper(split_part(trim({ref}), '-', 1)) WHEN 'CB' THEN 'CORE_BANKING' "
            f"WHEN 'CRM' THEN 'CRM' END, 'UNKNOWN')")


def PK(ref: str) -> str:
    return HK(SYS(ref), ref)


def REF(table: str, col: str) -> str:
    return f"concat_ws(':', '{table}', CAST({col} AS VARCHAR))"


def render(e) -> str:
    if isinstance(e, str):
        return e
    op, *a = e
    if op == "c":
        return f"CAST({render(a[0])} AS {sql_type(a[1])})"
    if op == "k":
        return HK(*[render(x) for x in a])
    if op == "sys":
        return SYS(render(a[0]))
    if op == "pk":
        return PK(render(a[0]))
    if op == "ref":
        return REF(a[0], render(a[1]))
    if op == "l":
        return f"CAST({lit(a[0])} AS {sql_type(a[1])})"
    if op == "nz":
        return f"coalesce({render(a[0])}, {lit(a[1])})"
    if op == "cat":
        return f"concat_ws('{a[0]}', " + ", ".join(f"CAST({render(x)} AS VARCHAR)" for x in a[1:]) + ")"
    if op == "trim":
        return f"trim({render(a[0])})"
    raise ValueError(op)


def fixture_columns(name: str) -> list[str]:
    body = fx.FIXTURES[name].split("UNION ALL")[0]
    return re.findall(r"\bAS\s+(\w+)\s*(?:,|\n)", body)


class Q:
    """Collects CTEs (fixtures first, then derived views) for one query."""

    def __init__(self):
        self.fixtures: list[str] = []
        self.ctes: dict[str, str] = {}

    def add(self, name: str, sql: str) -> str:
        if name not in self.ctes:
            self.ctes[name] = sql
        return name

    def fixture(self, name: str) -> str:
        if name not in self.fixtures:
            self.fixtures.append(name)
        return name

    # -------------------------------------------------------- sources
    def normalized(self, t: str) -> str:
        name = f"n_{t}"
        if name in self.ctes:
            return name
        self.fixture(t)
        cols = fixture_columns(t)
        rep = [f"upper(trim({c})) AS {c}" for c in UPPERCASE_IDENTIFIERS if c in cols]
        if "email" in cols:
            rep.append("lower(trim(email)) AS email")
        if "phone" in cols:
            rep.append("regexp_replace(trim(phone), '[^0-9]', '', 'g') AS phone")
        src = t
        if t == "account_transaction_status_event":
            src = (f"(SELECT * EXCLUDE (_rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY status_event_id, "
                   f"account_txn_id ORDER BY status_timestamp, source_arrival_timestamp, status, sequence_number, "
                   f"business_date) AS _rn FROM {t}) WHERE _rn = 1)")
        extra = ""
        if t == "payment_gateway_status_event":
            extra = (", CASE WHEN account_txn_id IS NOT NULL THEN 'ACCOUNT:' || CAST(account_txn_id AS VARCHAR) "
                     "WHEN card_txn_id IS NOT NULL THEN 'CARD:' || CAST(card_txn_id AS VARCHAR) "
                     "ELSE '<MISSING_PARENT>' END AS event_parent_ref")
        self.add(f"r_{t}", f"SELECT *{extra} FROM {src}")
        star = f"* REPLACE ({', '.join(rep)})" if rep else "*"
        return self.add(name, f"SELECT {star} FROM r_{t}")

    def dup_conditions(self, t: str) -> list[tuple[str, str]]:
        """(rule name, SQL flag) for the cross-row duplicate rules."""
        n = self.normalized(t)
        out = []
        if t in ("core_banking_customer", "crm_customer"):
            out.append((f"{t}__national_id__duplicate",
                        f"coalesce(national_id IN (SELECT national_id FROM {n} WHERE national_id IS NOT NULL "
                        f"GROUP BY national_id HAVING count(*) > 1), FALSE)"))
        spec = TABLES[t]
        if spec.scd == 2:
            k = spec.business_key
            out.append((f"{t}__{k}__duplicate_active",
                        f"coalesce({k} IN (SELECT {k} FROM r_{t} GROUP BY {k} HAVING count(*) > 1), FALSE)"))
        return out

    def rule_sql(self, t: str) -> dict[str, str]:
        return rules_for(t, RUN_CLOCK)

    def validated(self, t: str) -> str:
        name = f"v_{t}"
        if name in self.ctes:
            return name
        n = self.normalized(t)
        rules = self.rule_sql(t)
        conds = [f"coalesce(({' AND '.join(rules.values())}), FALSE)"] if rules else []
        conds += [f"NOT {flag}" for _, flag in self.dup_conditions(t)]
        where = " AND ".join(conds) if conds else "TRUE"
        drop = [c for c in ("event_parent_ref",) if t == "payment_gateway_status_event"]
        star = f"* EXCLUDE ({', '.join(drop)})" if drop else "*"
        return self.add(name, f"SELECT {star}, business_date AS validation_business_date FROM {n} WHERE {where}")

    def failures(self, t: str) -> str:
        """One row per (source row, failed rule name)."""
        name = f"f_{t}"
        if name in self.ctes:
            return name
        n = self.normalized(t)
        parts = [f"SELECT *, '{rn}' AS failed_rule_name FROM {n} WHERE NOT coalesce({p}, FALSE)"
                 for rn, p in self.rule_sql(t).items()]
        parts += [f"SELECT *, '{rn}' AS failed_rule_name FROM {n} WHERE {flag}"
                  for rn, flag in self.dup_conditions(t)]
        if not parts:
            cols = "*"
            parts = [f"SELECT {cols}, CAST(NULL AS VARCHAR) AS failed_rule_name FROM {n} WHERE FALSE"]
        return self.add(name, " UNION ALL ".join(parts))

    def silver(self, name: str) -> str:
        cte = f"s_{name}"
        if cte in self.ctes:
            return cte
        if name in S.SPECS:
            spec = S.SPECS[name]
            v = self.validated(spec.source)
            cols = ", ".join(f"{render(e)} AS {c}" for c, e in spec.cols)
            where = f" WHERE {spec.where}" if spec.where else ""
            return self.add(cte, f"SELECT {cols} FROM {v}{where}")
        return self.add(cte, JOINED[name](self))

    def sql(self, select: str) -> str:
        parts = [f"{n} AS ({fx.FIXTURES[n].strip()})" for n in fx.closure(self.fixtures)]
        parts += [f"{k} AS ({v})" for k, v in self.ctes.items()]
        return ("WITH " + ",\n".join(parts) + "\n" + select) if parts else select


# ------------------------------------------------------ joined silver tables
def _party_account_role(q: Q) -> str:
    ca, core = q.validated("customer_account"), q.validated("core_banking_customer")
    return f"""SELECT {HK("'core_banking'", "'party_account_role'", "link_id")} AS party_account_role_key,
  {HK("'CORE_BANKING'", "c.cust_no")} AS party_key, {HK("'core_banking'", "ca.account_id")} AS account_key,
  ca.relationship_type, CAST(ca.linked_date AS DATE) AS valid_from, CAST(NULL AS DATE) AS valid_to,
  'core_banking' AS source_system, CAST(ca.link_id AS VARCHAR) AS source_business_key,
  {REF('customer_account', 'ca.link_id')} AS bronze_record_ref
FROM {ca} ca LEFT JOIN (SELECT cif_number, min(cust_no) AS cust_no FROM {core} GROUP BY cif_number) c
  ON ca.cif_number = c.cif_number"""


def _party(q: Q) -> str:
    core, crm, at = (q.validated("core_banking_customer"), q.validated("crm_customer"),
                     q.validated("account_transaction"))
    q.add("last_txn", f"SELECT upper(trim(customer_ref)) AS ref, max(txn_timestamp) AS last_txn_at FROM {at} GROUP BY 1")
    as_of = f"TIMESTAMP '{fx.ORDER_AS_OF}'"

    def months(ts):
        # months_between(as_of, ts) in whole-month + day-fraction form
        return (f"((year({as_of}) - year({ts})) * 12 + (month({as_of}) - month({ts})) + "
                f"CASE WHEN day({as_of}) = day({ts}) OR (day({as_of}) = day(last_day({as_of})) AND "
                f"day({ts}) = day(last_day({ts}))) THEN 0 ELSE "
                f"((day({as_of}) - day({ts})) * 86400 + (epoch({as_of}) % 86400) - (epoch({ts}) % 86400)) "
                f"/ (31.0 * 86400) END)")

    def one(src, key, table):
        m = months("l.last_txn_at")
        status = (f"CASE WHEN l.last_txn_at IS NULL THEN 'PENDING' WHEN {m} < 12 THEN 'ACTIVE' "
                  f"WHEN {m} <= 36 THEN 'PENDING' ELSE 'DEACTIVE' END")
        return f"""SELECT {HK(SYS('k.' + key), 'k.' + key)} AS party_key, 'PERSON' AS party_type, {status} AS party_status,
  {SYS('k.' + key)} AS source_system, CAST(k.{key} AS VARCHAR) AS source_business_key,
  {REF(table, 'k.' + key)} AS bronze_record_ref, 'batch_initial' AS load_batch_id, 'VALID' AS data_quality_status
FROM (SELECT DISTINCT {key} FROM {src}) k LEFT JOIN last_txn l ON l.ref = k.{key}"""

    return one(core, "cust_no", "core_banking_customer") + "\nUNION ALL\n" + one(crm, "party_id", "crm_customer")


def _party_identifier(q: Q) -> str:
    core = q.validated("core_banking_customer")

    def one(col, typ, primary):
        return f"""SELECT {HK("'core_banking'", f"'{typ}'", col)} AS party_identifier_key,
  {HK(SYS('cust_no'), 'cust_no')} AS party_key, '{typ}' AS identifier_type, trim({col}) AS identifier_value,
  {SYS('cust_no')} AS source_system, {primary} AS is_primary, CAST(created_date AS TIMESTAMP) AS valid_from,
  CAST(NULL AS TIMESTAMP) AS valid_to, CAST(cust_no AS VARCHAR) AS source_business_key,
  {REF('core_banking_customer', 'cust_no')} AS bronze_record_ref
FROM {core} WHERE {col} IS NOT NULL"""

    return one("national_id", "NATIONAL_ID", "TRUE") + "\nUNION ALL\n" + one("phone", "PHONE", "FALSE")


def _party_profile_version(q: Q) -> str:
    core, crm = q.validated("core_banking_customer"), q.validated("crm_customer")
    return f"""SELECT {HK("'core_banking'", "'profile_version'", 'cust_no', 'business_date')} AS party_profile_version_key,
  {HK(SYS('cust_no'), 'cust_no')} AS party_key, {SYS('cust_no')} AS source_system, {SYS('cust_no')} AS profile_source,
  full_name, CAST(date_of_birth AS DATE) AS date_of_birth, address, CAST(NULL AS VARCHAR) AS preferred_contact_method,
  CAST(business_date AS TIMESTAMP) AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current,
  CAST(cust_no AS VARCHAR) AS source_business_key, {REF('core_banking_customer', 'cust_no')} AS bronze_record_ref
FROM {core}
UNION ALL
SELECT {HK("'crm'", "'profile_version'", 'party_id', 'business_date')}, {HK(SYS('party_id'), 'party_id')},
  {SYS('party_id')}, {SYS('party_id')}, customer_name, CAST(NULL AS DATE), CAST(NULL AS VARCHAR),
  CAST(preferred_contact_method AS VARCHAR), CAST(business_date AS TIMESTAMP), CAST(NULL AS TIMESTAMP), TRUE,
  CAST(party_id AS VARCHAR), {REF('crm_customer', 'party_id')}
FROM {crm}"""


def _financial_event(q: Q) -> str:
    at, ct, atm, gw, card = (q.validated("account_transaction"), q.validated("card_transaction"),
                             q.validated("log_atm"), q.validated("payment_gateway_log"), q.validated("card"))
    role = q.silver("party_account_role")
    q.add("acct_party", f"SELECT account_key, min(party_key) AS pk FROM {role} GROUP BY account_key")
    q.add("card_acct", f"SELECT card_id, min({HK(chr(39) + 'core_banking' + chr(39), 'account_id')}) AS ak "
                       f"FROM {card} GROUP BY card_id")
    q.add("via_acct", f"SELECT account_txn_id, min({HK(chr(39) + 'core_banking' + chr(39), 'account_id')}) AS ak "
                      f"FROM {at} GROUP BY account_txn_id")
    q.add("via_card", f"SELECT t.card_txn_id, min(c.ak) AS ak FROM {ct} t LEFT JOIN card_acct c "
                      f"ON t.card_id = c.card_id GROUP BY t.card_txn_id")
    tail = lambda sys_, table, idc: (
        f"'{sys_}' AS source_system, CAST({idc} AS VARCHAR) AS source_business_key, "
        f"{REF(table, idc)} AS bronze_record_ref, 'VALID' AS data_quality_status")
    return f"""SELECT {HK("'core_banking'", "'ACCOUNT_POSTING'", 'account_txn_id')} AS financial_event_key,
  'ACCOUNT_POSTING' AS event_type, {HK("'core_banking'", 'account_id')} AS account_key,
  CAST(NULL AS VARCHAR) AS payment_card_key, {PK('customer_ref')} AS party_key,
  CAST(NULL AS VARCHAR) AS merchant_location_key, 'VND' AS currency, txn_timestamp AS occurred_at,
  {tail('core_banking', 'account_transaction', 'account_txn_id')}
FROM {at}
UNION ALL
SELECT {HK("'card_system'", "'CARD_PAYMENT'", 't.card_txn_id')}, 'CARD_PAYMENT', ca.ak,
  {HK("'card_system'", 't.card_id')}, ap.pk, CAST(NULL AS VARCHAR), 'VND', t.txn_timestamp,
  {tail('card_system', 'card_transaction', 't.card_txn_id')}
FROM {ct} t LEFT JOIN card_acct ca ON t.card_id = ca.card_id LEFT JOIN acct_party ap ON ap.account_key = ca.ak
UNION ALL
SELECT {HK("'atm_system'", "'ATM_ACTIVITY'", 'a.log_id')}, 'ATM_ACTIVITY', ca.ak,
  {HK("'card_system'", 'a.card_id')}, ap.pk, CAST(NULL AS VARCHAR), 'VND', a.log_timestamp,
  {tail('atm_system', 'log_atm', 'a.log_id')}
FROM {atm} a LEFT JOIN card_acct ca ON a.card_id = ca.card_id LEFT JOIN acct_party ap ON ap.account_key = ca.ak
UNION ALL
SELECT {HK("'payment_gateway'", "'GATEWAY_PAYMENT'", 'g.gateway_txn_id')}, 'GATEWAY_PAYMENT',
  coalesce(va.ak, vc.ak),
  CASE WHEN gc.card_id IS NOT NULL THEN {HK("'card_system'", 'gc.card_id')} END, ap.pk,
  CAST(NULL AS VARCHAR), coalesce(g.currency, 'VND'), g.gateway_timestamp,
  {tail('payment_gateway', 'payment_gateway_log', 'g.gateway_txn_id')}
FROM {gw} g LEFT JOIN via_acct va ON g.account_txn_id = va.account_txn_id
  LEFT JOIN via_card vc ON g.card_txn_id = vc.card_txn_id
  LEFT JOIN {ct} gc ON g.card_txn_id = gc.card_txn_id
  LEFT JOIN acct_party ap ON ap.account_key = coalesce(va.ak, vc.ak)"""


def _status_history(q: Q) -> str:
    a, c = q.validated("account_transaction_status_event"), q.validated("card_transaction_status_event")

    def one(src, system, etype, idc, table):
        return f"""SELECT {HK(f"'{system}'", "'status_event'", 'status_event_id')} AS financial_event_status_history_key,
  {HK(f"'{system}'", f"'{etype}'", idc)} AS financial_event_key, status,
  CAST(status_timestamp AS TIMESTAMP) AS status_timestamp,
  CAST(source_arrival_timestamp AS TIMESTAMP) AS source_arrival_timestamp,
  CAST(sequence_number AS BIGINT) AS sequence_number, CAST(status_event_id AS VARCHAR) AS source_status_event_id,
  CAST(status_event_id AS VARCHAR) AS source_business_key, '{system}' AS source_system,
  {REF(table, 'status_event_id')} AS bronze_record_ref
FROM {src}"""

    return (one(a, "core_banking", "ACCOUNT_POSTING", "account_txn_id", "account_transaction_status_event")
            + "\nUNION ALL\n"
            + one(c, "card_system", "CARD_PAYMENT", "card_txn_id", "card_transaction_status_event"))


def _links(q: Q, acc_t, card_t, acc_link, card_link, parent, extra_acc, extra_card):
    a, c = q.validated(acc_t), q.validated(card_t)
    return (f"SELECT CAST({acc_link} AS VARCHAR) AS link_id, CAST({parent} AS VARCHAR) AS {parent}, "
            f"'core_banking' AS src_sys, 'ACCOUNT_POSTING' AS evt_type, CAST(account_txn_id AS VARCHAR) AS txn_id"
            f"{extra_acc} FROM {a} WHERE account_txn_id <> -1 UNION ALL "
            f"SELECT CAST({card_link} AS VARCHAR), CAST({parent} AS VARCHAR), 'card_system', 'CARD_PAYMENT', "
            f"CAST(card_txn_id AS VARCHAR){extra_card} FROM {c} WHERE card_txn_id <> -1")


def _monitoring_alert_fe(q: Q) -> str:
    u = _links(q, "transaction_monitoring_alert_account_transaction", "transaction_monitoring_alert_card_transaction",
               "alert_account_txn_link_id", "alert_card_txn_link_id", "alert_id",
               ", CAST(is_primary AS BOOLEAN) AS is_primary", ", CAST(is_primary AS BOOLEAN)")
    return f"""SELECT {HK("'fincrime'", "'monitoring_alert_financial_event'", 'link_id')} AS monitoring_alert_financial_event_key,
  {HK("'fincrime'", "'transaction_monitoring_alert'", 'alert_id')} AS monitoring_alert_key,
  {HK('src_sys', 'evt_type', 'txn_id')} AS financial_event_key, is_primary, 'fincrime' AS source_system,
  link_id AS source_business_key FROM ({u})"""


def _case_fe(q: Q) -> str:
    u = _links(q, "investigation_case_account_transaction", "investigation_case_card_transaction",
               "case_account_txn_link_id", "case_card_txn_link_id", "case_id",
               ", link_reason, CAST(linked_timestamp AS TIMESTAMP) AS linked_at",
               ", link_reason, CAST(linked_timestamp AS TIMESTAMP)")
    return f"""SELECT {HK("'fincrime'", "'case_financial_event'", 'link_id')} AS investigation_case_financial_event_key,
  {HK("'fincrime'", "'investigation_case'", 'case_id')} AS investigation_case_key,
  {HK('src_sys', 'evt_type', 'txn_id')} AS financial_event_key, link_reason, linked_at,
  'fincrime' AS source_system, link_id AS source_business_key FROM ({u})"""


def _association(q: Q) -> str:
    g = q.validated("payment_gateway_log")
    gk = HK("'payment_gateway'", "'GATEWAY_PAYMENT'", 'gateway_txn_id')
    return (f"SELECT {gk} AS from_financial_event_key, {HK(chr(39)+'core_banking'+chr(39), chr(39)+'ACCOUNT_POSTING'+chr(39), 'account_txn_id')} "
            f"AS to_financial_event_key, 'SETTLES' AS association_type, gateway_txn_id AS source_business_key "
            f"FROM {g} WHERE account_txn_id IS NOT NULL UNION ALL "
            f"SELECT {gk}, {HK(chr(39)+'card_system'+chr(39), chr(39)+'CARD_PAYMENT'+chr(39), 'card_txn_id')}, 'SETTLES', "
            f"gateway_txn_id FROM {g} WHERE card_txn_id IS NOT NULL")


JOINED = {
    "party_account_role": _party_account_role,
    "party": _party,
    "party_identifier": _party_identifier,
    "party_profile_version": _party_profile_version,
    "financial_event": _financial_event,
    "financial_event_status_history": _status_history,
    "monitoring_alert_financial_event": _monitoring_alert_fe,
    "investigation_case_financial_event": _case_fe,
    "financial_event_association": _association,
}


def silver_sql(name: str) -> str:
    q = Q()
    cte = q.silver(name)
    return q.sql(f"SELECT * FROM {cte}")
