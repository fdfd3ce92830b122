"""Dataset contracts as data: column metrics per source table.

Metric vocabulary and thresholds follow the source contracts
(nullValues / missingValues / invalidValues with validValues or pattern /
duplicateValues / rowCount, units rows or percent, mustBe /
mustBeLessThan / mustBeGreaterThan).  Patterns, valid-value lists and
thresholds are fixed values of those contracts.
"""

from __future__ import annotations

from vaultline.operators.contract import Check as C

# Contract patterns.
PAN_MASK = r"^[0-9]{6}\*{6}[0-9]{4}$"
CIF = r"^CIF[0-9]{8}$"
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
CUSTOMER_REF = r"^(CB-[0-9]{4,}|CRM-[0-9]{3,})$"

# Reference list of supported chargeback reason codes.
CHARGEBACK_REASON_CODES = ("4837", "4853", "4863", "4808", "4834", "4855")

SANE_FROM = "TIMESTAMP '2020-01-01 00:00:00'"

CHECKS: list[C] = [
    # ---------------------------------------------------------- card
    C("card_card_id_null", "card", "null", "card_id"),
    C("card_card_id_unique", "card", "duplicate", "card_id", dimension="uniqueness"),
    C("card_card_number_mask", "card", "pattern", "card_number", pattern=PAN_MASK, dimension="conformity"),
    C("card_status_valid", "card", "valid_values", "status", values=("ACTIVE", "BLOCKED", "EXPIRED", "CLOSED"),
      dimension="validity"),
    C("card_rows", "card", "row_count", op="mustBeGreaterThan", dimension="completeness"),
    C("card_transaction_card_txn_id_unique", "card_transaction", "duplicate", "card_txn_id",
      dimension="uniqueness"),
    C("card_transaction_amount_null_pct", "card_transaction", "null", "amount", unit="percent",
      op="mustBeLessThan", threshold=1),
    C("card_transaction_status_valid", "card_transaction", "valid_values", "txn_status",
      values=("AUTHORIZED", "SETTLED", "DECLINED", "REVERSED"), dimension="validity"),
    # ------------------------------------------------------ customer
    C("core_customer_cif_pattern", "core_banking_customer", "pattern", "cif_number", pattern=CIF,
      dimension="conformity"),
    C("core_customer_national_id_null_pct", "core_banking_customer", "null", "national_id", unit="percent",
      op="mustBeLessThan", threshold=5),
    C("core_customer_phone_missing", "core_banking_customer", "missing", "phone",
      values=("", "0000000000", "N/A"), unit="percent", op="mustBeLessThan", threshold=5),
    C("core_customer_cust_no_unique", "core_banking_customer", "duplicate", "cust_no", dimension="uniqueness"),
    C("crm_customer_email_pattern", "crm_customer", "pattern", "email", pattern=EMAIL, dimension="conformity"),
    C("crm_customer_email_missing", "crm_customer", "missing", "email", values=("", "malformed-email"),
      unit="percent", op="mustBeLessThan", threshold=5),
    C("kyc_customer_ref_pattern", "customer_kyc", "pattern", "customer_ref", pattern=CUSTOMER_REF,
      dimension="conformity"),
    C("kyc_status_valid", "customer_kyc", "valid_values", "verification_status",
      values=("VERIFIED", "PENDING", "REJECTED"), dimension="validity"),
    C("kyc_id_number_missing", "customer_kyc", "missing", "id_number", values=("", "INVALID-ID")),
    C("kyc_verified_date_structural", "customer_kyc", "condition",
      bad="verified_date IS NULL AND coalesce(verification_status, '') <> 'PENDING'",
      dimension="consistency"),
    C("employment_income_negative_pct", "customer_employment", "condition", "monthly_income",
      bad="monthly_income < 0", unit="percent", op="mustBeLessThan", threshold=2, dimension="validity"),
    C("employment_customer_ref_pattern", "customer_employment", "pattern", "customer_ref", pattern=CUSTOMER_REF,
      dimension="conformity"),
    C("request_resolution_date_structural", "customer_request", "condition",
      bad="(status = 'RESOLVED' AND resolution_date IS NULL) OR (status <> 'RESOLVED' AND resolution_date IS NOT NULL)",
      dimension="consistency"),
    C("customer_account_cif_pattern", "customer_account", "pattern", "cif_number", pattern=CIF,
      dimension="conformity"),
    C("account_status_valid", "account", "valid_values", "status", values=("ACTIVE", "DORMANT", "CLOSED"),
      dimension="validity"),
    # --------------------------------------------------- transaction
    C("account_txn_id_unique", "account_transaction", "duplicate", "account_txn_id", dimension="uniqueness"),
    C("account_txn_direction_valid", "account_transaction", "valid_values", "direction",
      values=("CREDIT", "DEBIT"), dimension="validity"),
    C("account_txn_negative_amount_pct", "account_transaction", "condition", "amount", bad="amount < 0",
      unit="percent", op="mustBeLessThan", threshold=1, dimension="validity"),
    C("account_txn_timestamp_range_pct", "account_transaction", "condition", "txn_timestamp",
      bad="txn_timestamp < TIMESTAMP '1990-01-01 00:00:00' OR txn_timestamp > TIMESTAMP '2026-12-01 00:00:00'",
      unit="percent", op="mustBe", threshold=0, dimension="validity"),
    C("balance_available_gt_closing_pct", "balance_snapshot", "condition", "available_balance",
      bad="available_balance > closing_balance", unit="percent", op="mustBeLessThan", threshold=5,
      dimension="consistency"),
    C("balance_negative_closing", "balance_snapshot", "condition", "closing_balance", bad="closing_balance < 0",
      dimension="validity"),
    C("store_address_structural", "merchant_store", "condition",
      bad="store_address IS NULL AND coalesce(store_type, '') <> 'ONLINE'", dimension="consistency"),
    C("store_risk_valid", "merchant_store", "valid_values", "risk_rating", values=("LOW", "MEDIUM", "HIGH"),
      dimension="validity"),
    C("atm_amount_structural", "log_atm", "condition",
      bad="amount IS NULL AND coalesce(txn_type, '') <> 'BALANCE_INQUIRY'", dimension="consistency"),
    C("atm_card_number_mask", "log_atm", "pattern", "card_number", pattern=PAN_MASK, dimension="conformity"),
    C("gateway_parent_structural", "payment_gateway_log", "condition",
      bad="(payment_method = 'CARD' AND card_txn_id IS NULL) OR "
          "(payment_method = 'ACCOUNT_TRANSFER' AND account_txn_id IS NULL)", dimension="consistency"),
    C("gateway_currency_valid", "payment_gateway_log", "valid_values", "currency", values=("VND", "USD", "EUR"),
      dimension="validity"),
    C("account_status_event_time_range_pct", "account_transaction_status_event", "condition", "status_timestamp",
      bad=f"status_timestamp < TIMESTAMP '1990-01-01 00:00:00' OR status_timestamp > TIMESTAMP '2026-12-01 00:00:00'",
      unit="percent", op="mustBe", threshold=0, dimension="validity"),
    C("card_status_event_time_range_pct", "card_transaction_status_event", "condition", "status_timestamp",
      bad=f"status_timestamp < {SANE_FROM} OR status_timestamp > TIMESTAMP '2026-12-01 00:00:00'",
      unit="percent", op="mustBeLessThan", threshold=1, dimension="validity"),
    C("status_event_arrival_order", "account_transaction_status_event", "condition", "source_arrival_timestamp",
      bad="source_arrival_timestamp < status_timestamp", dimension="timeliness"),
    # ------------------------------------------------------ fincrime
    C("fraud_alert_score_range", "fraud_alert", "condition", "alert_score",
      bad="alert_score < 0 OR alert_score > 100", dimension="validity"),
    C("monitoring_alert_score_range", "transaction_monitoring_alert", "condition", "alert_score",
      bad="alert_score < 0 OR alert_score > 100", dimension="validity"),
    C("screening_result_valid", "sanction_screening", "valid_values", "result",
      values=("CLEAR", "HIT", "FALSE_POSITIVE"), dimension="validity"),
    C("screening_name_truncated", "sanction_screening", "condition", "screened_name",
      bad="screened_name IS NULL OR length(trim(screened_name)) < 3", dimension="validity"),
    C("watchlist_list_type_valid", "watchlist", "valid_values", "list_type", values=("PEP", "OFAC", "UN_SANCTIONS"),
      dimension="validity"),
    C("sar_regulatory_ref_structural", "suspicious_activity_report", "condition",
      bad="status IN ('FILED', 'ACKNOWLEDGED') AND regulatory_ref IS NULL", dimension="consistency"),
    C("chargeback_resolved_date_structural", "chargeback", "condition",
      bad="status = 'RESOLVED' AND resolved_date IS NULL", dimension="consistency"),
    C("call_case_on_wrong_reason", "call_center_log", "condition",
      bad="case_id IS NOT NULL AND call_reason NOT IN ('FRAUD_REPORT', 'DISPUTE')", dimension="consistency"),
    C("call_unidentified_caller", "call_center_log", "condition",
      bad="customer_ref IS NULL AND caller_phone IS NULL", dimension="completeness"),
    C("investigation_case_closed_structural", "investigation_case", "condition",
      bad="case_status IN ('CLOSED', 'RESOLVED') AND closed_timestamp IS NULL", dimension="consistency"),
    C("note_text_null", "investigation_note", "null", "note_text"),
    C("risk_score_range", "account_transaction_risk_score", "condition", "model_score",
      bad="model_score < 0 OR model_score > 1", dimension="validity"),
]

CONDITIONAL_KINDS = {
    "contract_nulls": ("null",),
    "contract_missing": ("missing",),
    "contract_valid_values": ("valid_values",),
    "contract_patterns": ("pattern",),
    "contract_duplicates": ("duplicate",),
    "contract_row_count": ("row_count",),
}

# Name groups of condition checks (one query each).
CONDITION_GROUPS = {
    "contract_timestamp_range": ("account_txn_timestamp_range_pct", "account_status_event_time_range_pct",
                                 "card_status_event_time_range_pct", "status_event_arrival_order"),
    "contract_amounts": ("employment_income_negative_pct", "account_txn_negative_amount_pct",
                         "balance_available_gt_closing_pct", "balance_negative_closing", "fraud_alert_score_range",
                         "monitoring_alert_score_range", "risk_score_range"),
    "contract_structural_nulls": ("kyc_verified_date_structural", "request_resolution_date_structural",
                                  "store_address_structural", "atm_amount_structural", "gateway_parent_structural",
                                  "investigation_case_closed_structural"),
    "contract_conditional": ("sar_regulatory_ref_structural", "chargeback_resolved_date_structural",
                             "call_case_on_wrong_reason", "call_unidentified_caller", "screening_name_truncated"),
}

# Declared foreign keys (child table, column -> parent table, column).
FOREIGN_KEYS = [
    ("card", "account_id", "account", "account_id"),
    ("card_transaction", "card_id", "card", "card_id"),
    ("card_transaction", "merchant_id", "merchant", "merchant_id"),
    ("card_fraud_flag", "card_txn_id", "card_transaction", "card_txn_id"),
    ("card_limit_history", "card_id", "card", "card_id"),
    ("card_transaction_status_event", "card_txn_id", "card_transaction", "card_txn_id"),
    ("customer_account", "account_id", "account", "account_id"),
    ("customer_account", "cif_number", "core_banking_customer", "cif_number"),
    ("account_transaction", "account_id", "account", "account_id"),
    ("account_transaction", "merchant_id", "merchant", "merchant_id"),
    ("account_transaction", "channel", "transaction_channel", "channel_id"),
    ("balance_snapshot", "account_id", "account", "account_id"),
    ("merchant_store", "merchant_id", "merchant", "merchant_id"),
    ("log_atm", "card_id", "card", "card_id"),
    ("payment_gateway_log", "account_txn_id", "account_transaction", "account_txn_id"),
    ("payment_gateway_log", "card_txn_id", "card_transaction", "card_txn_id"),
    ("payment_gateway_log", "merchant_id", "merchant", "merchant_id"),
    ("account_transaction_status_event", "account_txn_id", "account_transaction", "account_txn_id"),
    ("atm_transaction_status_event", "log_id", "log_atm", "log_id"),
    ("payment_gateway_status_event", "gateway_txn_id", "payment_gateway_log", "gateway_txn_id"),
    ("fraud_alert", "account_txn_id", "account_transaction", "account_txn_id"),
    ("account_transaction_risk_score", "account_txn_id", "account_transaction", "account_txn_id"),
    ("transaction_monitoring_alert_account_transaction", "alert_id", "transaction_monitoring_alert", "alert_id"),
    ("transaction_monitoring_alert_account_transaction", "account_txn_id", "account_transaction", "account_txn_id"),
    ("transaction_monitoring_alert_card_transaction", "card_txn_id", "card_transaction", "card_txn_id"),
    ("investigation_case_transaction_monitoring_alert", "alert_id", "transaction_monitoring_alert", "alert_id"),
    ("investigation_case_transaction_monitoring_alert", "case_id", "investigation_case", "case_id"),
    ("investigation_case_card_fraud_flag", "flag_id", "card_fraud_flag", "flag_id"),
    ("investigation_case_account_transaction", "account_txn_id", "account_transaction", "account_txn_id"),
    ("investigation_case_card_transaction", "card_txn_id", "card_transaction", "card_txn_id"),
    ("investigation_case_fraud_alert", "alert_id", "fraud_alert", "alert_id"),
    ("investigation_case_sanction_screening", "screening_id", "sanction_screening", "screening_id"),
    ("investigation_note", "case_id", "investigation_case", "case_id"),
    ("aml_case", "investigation_case_id", "investigation_case", "case_id"),
    ("sanction_screening", "watchlist_id", "watchlist", "watchlist_id"),
    ("suspicious_activity_report", "case_id", "aml_case", "case_id"),
    ("chargeback", "card_txn_id", "card_transaction", "card_txn_id"),
    ("call_center_log", "case_id", "investigation_case", "case_id"),
    ("customer_account", "cif_number", "account", "cif_number"),
    ("account", "customer_ref", "core_banking_customer", "cust_no"),
    ("account", "cif_number", "core_banking_customer", "cif_number"),
    ("account_transaction", "customer_ref", "core_banking_customer", "cust_no"),
    ("log_atm", "account_txn_id", "account_transaction", "account_txn_id"),
    ("atm_transaction_status_event", "account_txn_id", "account_transaction", "account_txn_id"),
    ("payment_gateway_status_event", "account_txn_id", "account_transaction", "account_txn_id"),
    ("payment_gateway_status_event", "card_txn_id", "card_transaction", "card_txn_id"),
    ("transaction_monitoring_alert", "customer_ref", "core_banking_customer", "cust_no"),
    ("transaction_monitoring_alert", "primary_account_txn_id", "account_transaction", "account_txn_id"),
    ("transaction_monitoring_alert_card_transaction", "alert_id", "transaction_monitoring_alert", "alert_id"),
    ("investigation_case_card_fraud_flag", "case_id", "investigation_case", "case_id"),
    ("investigation_case_account_transaction", "case_id", "investigation_case", "case_id"),
    ("investigation_case_card_transaction", "case_id", "investigation_case", "case_id"),
    ("investigation_case_fraud_alert", "case_id", "investigation_case", "case_id"),
    ("investigation_case_sanction_screening", "case_id", "investigation_case", "case_id"),
]

# Declared unique keys beside each source's own key, composite ones as tuples.
UNIQUE_SEQUENCES = [
    ("account_transaction_status_event", ("account_txn_id", "sequence_number")),
    ("payment_gateway_status_event", ("gateway_txn_id", "sequence_number")),
]
