"""Declared layouts of the published context tables."""

from __future__ import annotations

from vaultline.sources.published import Layout

# The columns of the fraud context, their types, and the columns it is ordered by.
FRAUD_CONTEXT = Layout(
    columns=(
        ("financial_event_key", "string", "Key of the event; one row each"),
        ("event_type", "string", "Which of the four subtypes the event is"),
        ("occurred_at", "timestamp_ntz", "When the event took place"),
        ("amount", "decimal(12,2)", "Amount by whichever subtype has it"),
        ("currency", "string", "Currency code"),
        ("transaction_type_detail", "string", "The subtype's own type"),
        ("posting_direction", "string", "Debit or credit; postings only"),
        ("account_key", "string", "Account, for card and ATM events by way of the card"),
        ("payment_card_key", "string", "Card; none for postings"),
        ("party_key", "string", "Customer; none if the reference is not resolved"),
        ("channel_key", "string", "Channel; postings only"),
        ("channel_name", "string", "Name of the channel"),
        ("channel_type", "string", "Kind of channel"),
        ("merchant_key", "string", "Merchant; none for ATM events"),
        ("merchant_name", "string", "Name of the merchant"),
        ("mcc_code", "string", "Category code of the merchant"),
        ("merchant_country", "string", "Country of the merchant"),
        ("merchant_store_count", "bigint", "Stores of the merchant, 0 without a merchant"),
        ("merchant_max_store_risk", "string", "Highest risk among the merchant's stores"),
        ("latest_risk_score", "decimal(6,4)", "Newest model score of the event"),
        ("latest_risk_band", "string", "Band of that score"),
        ("fraud_alert_count", "bigint", "Distinct alerts linked to the event"),
        ("max_fraud_alert_score", "decimal(5,2)", "Highest score among them"),
        ("open_fraud_alert_flag", "boolean", "Whether one of them is not closed"),
        ("card_fraud_flag_count", "bigint", "Distinct card flags linked to the event"),
        ("is_fraud_source_flag", "boolean", "Label of the card source; card payments only"),
        ("source_system", "string", "System that delivered the event"),
        ("source_business_key", "string", "The event's key in that system"),
        ("pipeline_run_id", "string", "Run that made the row"),
        ("dq_status", "string", "Verdict on the row's quality"),
        ("ingested_at", "timestamp", "When the row was made"),
    ),
    order_by=("occurred_at", "party_key"),
    required=("financial_event_key", "ingested_at"),
)
