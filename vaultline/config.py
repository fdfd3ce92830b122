"""Source-table registry: domain, business key(s), SCD type, type hints.

Plain data that drives the Spark jobs (snapshot CDC, assessment, quarantine
lineage).  Keys and SCD types are fixed values of the source contract.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    name: str
    domain: str
    keys: tuple[str, ...]
    scd: int = 2
    hints: str = ""
    optional: tuple[tuple[str, str], ...] = field(default_factory=tuple)

    @property
    def business_key(self) -> str:
        return self.keys[0]

    @property
    def lineage_keys(self) -> tuple[str, ...]:
        """Composite identity used in quarantine lineage (status events)."""
        return self.keys


# Fixed values: (table, domain, keys, scd type, schema hints).
_SPECS = [
    ("card", "card", ("card_id",), 2, "account_id BIGINT, issue_date DATE, expiry_date DATE"),
    ("card_transaction", "card", ("card_txn_id",), 2,
     "card_txn_id BIGINT, amount DECIMAL(12,2), txn_timestamp TIMESTAMP, is_fraud BOOLEAN"),
    ("card_fraud_flag", "card", ("flag_id",), 2, "card_txn_id BIGINT, flag_date DATE"),
    ("card_limit_history", "card", ("history_id",), 2, "limit_amount DECIMAL(12,2), effective_date DATE"),
    ("card_transaction_status_event", "card", ("status_event_id", "card_txn_id"), 1,
     "card_txn_id BIGINT, status_timestamp TIMESTAMP, source_arrival_timestamp TIMESTAMP, sequence_number BIGINT"),
    ("core_banking_customer", "customer", ("cust_no",), 2, "date_of_birth DATE, created_date DATE"),
    ("crm_customer", "customer", ("party_id",), 2, "created_date DATE"),
    ("customer_kyc", "customer", ("kyc_id",), 2, "verified_date DATE"),
    ("customer_employment", "customer", ("employment_id",), 2, "monthly_income DECIMAL(12,2)"),
    ("customer_request", "customer", ("request_id",), 2, "request_date DATE, resolution_date DATE"),
    ("customer_account", "customer", ("link_id",), 2, "account_id BIGINT, linked_date DATE"),
    ("account", "customer", ("account_id",), 2, "account_id BIGINT, open_date DATE"),
    ("account_transaction", "transaction", ("account_txn_id",), 2,
     "account_txn_id BIGINT, account_id BIGINT, amount DECIMAL(12,2), txn_timestamp TIMESTAMP"),
    ("transaction_channel", "transaction", ("channel_id",), 2, ""),
    ("merchant", "transaction", ("merchant_id",), 2, ""),
    ("merchant_store", "transaction", ("store_id",), 2, "registered_date DATE"),
    ("balance_snapshot", "transaction", ("balance_id",), 2,
     "account_id BIGINT, balance_date DATE, opening_balance DECIMAL(14,2), "
     "closing_balance DECIMAL(14,2), available_balance DECIMAL(14,2)"),
    ("log_atm", "transaction", ("log_id",), 2,
     "account_txn_id BIGINT, amount DECIMAL(12,2), log_timestamp TIMESTAMP"),
    ("payment_gateway_log", "transaction", ("gateway_txn_id",), 2,
     "account_txn_id BIGINT, card_txn_id BIGINT, amount DECIMAL(12,2), gateway_timestamp TIMESTAMP"),
    ("account_transaction_status_event", "transaction", ("status_event_id", "account_txn_id"), 1,
     "account_txn_id BIGINT, status_timestamp TIMESTAMP, source_arrival_timestamp TIMESTAMP, sequence_number BIGINT"),
    ("atm_transaction_status_event", "transaction", ("status_event_id", "account_txn_id"), 1,
     "account_txn_id BIGINT, status_timestamp TIMESTAMP, source_arrival_timestamp TIMESTAMP, sequence_number BIGINT"),
    ("payment_gateway_status_event", "transaction", ("status_event_id", "gateway_txn_id", "event_parent_ref"), 1,
     "account_txn_id BIGINT, card_txn_id BIGINT, status_timestamp TIMESTAMP, "
     "source_arrival_timestamp TIMESTAMP, sequence_number BIGINT"),
    ("fraud_alert", "fincrime", ("alert_id",), 2, "account_txn_id BIGINT, alert_score DECIMAL(5,2), created_date DATE"),
    ("transaction_monitoring_alert", "fincrime", ("alert_id",), 2,
     "primary_account_txn_id BIGINT, alert_score DECIMAL(5,2), alert_timestamp TIMESTAMP"),
    ("transaction_monitoring_alert_account_transaction", "fincrime", ("alert_account_txn_link_id",), 2,
     "account_txn_id BIGINT, is_primary BOOLEAN"),
    ("transaction_monitoring_alert_card_transaction", "fincrime", ("alert_card_txn_link_id",), 2,
     "card_txn_id BIGINT, is_primary BOOLEAN"),
    ("investigation_case", "fincrime", ("case_id",), 2, "opened_timestamp TIMESTAMP, closed_timestamp TIMESTAMP"),
    ("investigation_case_transaction_monitoring_alert", "fincrime", ("case_alert_link_id",), 2,
     "linked_timestamp TIMESTAMP"),
    ("investigation_case_card_fraud_flag", "fincrime", ("case_flag_link_id",), 2, "linked_timestamp TIMESTAMP"),
    ("investigation_case_account_transaction", "fincrime", ("case_account_txn_link_id",), 2,
     "account_txn_id BIGINT, linked_timestamp TIMESTAMP"),
    ("investigation_case_card_transaction", "fincrime", ("case_card_txn_link_id",), 2,
     "card_txn_id BIGINT, linked_timestamp TIMESTAMP"),
    ("investigation_case_fraud_alert", "fincrime", ("case_alert_link_id",), 2, "linked_timestamp TIMESTAMP"),
    ("investigation_case_sanction_screening", "fincrime", ("case_screening_link_id",), 2,
     "linked_timestamp TIMESTAMP"),
    ("investigation_note", "fincrime", ("note_id",), 2,
     "note_timestamp TIMESTAMP, source_arrival_timestamp TIMESTAMP"),
    ("aml_case", "fincrime", ("case_id",), 2, "opened_date DATE, closed_date DATE"),
    ("sanction_screening", "fincrime", ("screening_id",), 2, "match_score DECIMAL(5,2), screening_date DATE"),
    ("suspicious_activity_report", "fincrime", ("sar_id",), 2, "filed_date DATE"),
    ("watchlist", "fincrime", ("watchlist_id",), 2, "added_date DATE"),
    ("account_transaction_risk_score", "fincrime", ("score_id",), 2,
     "account_txn_id BIGINT, model_score DECIMAL(6,4), scored_date DATE"),
    ("call_center_log", "fincrime", ("call_id",), 2, "call_timestamp TIMESTAMP, call_duration_seconds BIGINT"),
    ("chargeback", "fincrime", ("chargeback_id",), 2,
     "card_txn_id BIGINT, dispute_amount DECIMAL(12,2), filed_date DATE, resolved_date DATE"),
]

# Optional versioned contract columns (absent -> typed NULL).
OPTIONAL_COLUMNS = {
    "crm_customer": (("preferred_contact_method", "STRING"),),
    "card_transaction": (("card_transaction_type", "STRING"),),
}

TABLES: dict[str, TableSpec] = {
    name: TableSpec(name, domain, keys, scd, hints, OPTIONAL_COLUMNS.get(name, ()))
    for name, domain, keys, scd, hints in _SPECS
}

DOMAINS = ("card", "customer", "transaction", "fincrime")

# Technical metadata columns never tracked for history.
UNTRACKED_COLUMNS = (
    "business_date", "domain", "source_file_name", "source_file_modified_at",
    "LOAD_DTTM", "EXTRACT_DTTM", "EXTRACT_DTE",
)


def spec(table: str) -> TableSpec:
    try:
        return TABLES[table]
    except KeyError as error:
        raise ValueError(f"unknown source table: {table!r}") from error
