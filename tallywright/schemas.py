"""Raw source schemas: every column is text until cleaning; ``src_row`` is the row order."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

# The columns of the five sources.
RAW_COLUMNS = {
    "customer_master": [
        "customer_id",
        "customer_name",
        "email",
        "phone",
        "address",
        "city",
        "state",
        "customer_type",
        "created_date",
    ],
    "invoice": [
        "invoice_id",
        "customer_id",
        "invoice_date",
        "invoice_amount",
        "tax",
        "discount",
        "net_amount",
    ],
    "erp_transactions": [
        "transaction_id",
        "invoice_id",
        "customer_id",
        "customer_name",
        "email",
        "phone",
        "transaction_date",
        "amount",
        "currency",
        "payment_status",
        "store_id",
    ],
    "payment_gateway": [
        "gateway_transaction_id",
        "merchant_reference",
        "customer_name",
        "email",
        "transaction_date",
        "amount",
        "payment_status",
        "gateway",
    ],
    "bank_transactions": [
        "bank_transaction_id",
        "transaction_date",
        "value_date",
        "narration",
        "credit_amount",
        "debit_amount",
        "reference_number",
    ],
}

# The twenty columns of the reconciliation table, in order.
RECONCILIATION_COLUMNS = [
    "transaction_id",
    "invoice_id",
    "customer_id",
    "customer_name",
    "store_id",
    "erp_transaction_date",
    "erp_amount",
    "gateway_transaction_id",
    "gateway",
    "payment_transaction_date",
    "payment_amount",
    "payment_difference",
    "bank_transaction_date",
    "bank_amount",
    "bank_difference",
    "bank_status",
    "date_difference_days",
    "entity_match_score",
    "entity_match_confidence",
    "reconciliation_status",
]

# The twenty-nine columns of the exception register, in order.
REGISTER_COLUMNS = [
    "exception_id",
    "transaction_id",
    "invoice_id",
    "customer_id",
    "customer_name",
    "store_id",
    "reconciliation_status",
    "severity",
    "financial_impact",
    "entity_match_score",
    "entity_match_confidence",
    "gateway",
    "erp_amount",
    "payment_amount",
    "payment_difference",
    "bank_amount",
    "bank_difference",
    "bank_status",
    "date_difference_days",
    "owner",
    "status",
    "root_cause",
    "recommended_action",
    "created_date",
    "exception_age_days",
    "sla_days",
    "sla_status",
    "resolution",
    "resolution_date",
]

# What anomaly detection adds to the reconciliation columns.
ANOMALY_COLUMNS = [
    "amount_z_score",
    "amount_z_anomaly",
    "amount_iqr_anomaly",
    "isolation_forest_anomaly",
    "isolation_forest_score",
    "anomaly_methods_triggered",
    "potential_anomaly",
    "anomaly_status",
    "known_exception",
    "investigation_priority",
]

# Row order of reconciliation: ledger rows first (0), then unexpected payments (1).
ORDER_COLUMNS = ["src_branch", "src_row"]


def raw_schema(table: str, with_order: bool = True) -> StructType:
    fields = [StructField(c, StringType()) for c in RAW_COLUMNS[table]]
    if with_order:
        fields.append(StructField("src_row", LongType()))
    return StructType(fields)
