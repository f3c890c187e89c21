"""Reporting tables and the measures over them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ANOMALY_COLUMNS, ORDER_COLUMNS, RECONCILIATION_COLUMNS
from .bloom import bloom_filter, may_hold
from .joins import look_up
from .keys import first_per_key, last_by_priority, one_per_key
from .keystats import KeyStats
from .register import by_status

# Which status represents a transaction; the highest wins, others rank above all.
STATUS_PRIORITY = {
    "MATCHED": 0,
    "DATE_MISMATCH": 1,
    "PARTIAL_PAYMENT": 2,
    "OVERPAYMENT": 3,
    "MISSING_PAYMENT": 4,
    "UNEXPECTED_PAYMENT": 5,
    "DUPLICATE": 6,
    "ENTITY_UNCERTAIN": 7,
    "AMOUNT_MISMATCH": 8,
}
OTHER_PRIORITY = 9

# What the exception table takes from the register and from reconciliation.
FROM_REGISTER = [
    "exception_id",
    "transaction_id",
    "severity",
    "financial_impact",
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
FROM_RECONCILIATION = [
    "invoice_id",
    "customer_id",
    "customer_name",
    "store_id",
    "erp_amount",
    "payment_amount",
    "payment_difference",
    "bank_amount",
    "bank_difference",
    "bank_status",
    "date_difference_days",
    "reconciliation_status",
    "entity_match_score",
    "entity_match_confidence",
    "gateway",
]


def exception_table(
    register: DataFrame,
    reconciliation: DataFrame,
    anomalies: DataFrame,
    stats: KeyStats | None = None,
) -> DataFrame:
    """One row per exception with the first reconciliation and anomaly row of its transaction.

    Only rows whose id may be in the register (a Bloom filter, tested in the scan) are ranked; the
    others are not shuffled, and of a repeated id one row for each task is. ``stats`` are those of the
    register's ids.
    """
    raised = bloom_filter(register, "transaction_id")

    def first_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
        narrow = rows.select("transaction_id", *columns, *ORDER_COLUMNS)
        near = may_hold(narrow, "transaction_id", raised)
        return first_per_key(near, "transaction_id", ORDER_COLUMNS).drop(*ORDER_COLUMNS)

    return join_exceptions(
        register,
        first_rows(reconciliation, FROM_RECONCILIATION),
        first_rows(anomalies, ANOMALY_COLUMNS),
        stats,
    )


def join_exceptions(
    register: DataFrame, context: DataFrame, flags: DataFrame, stats: KeyStats | None = None
) -> DataFrame:
    """The exception table of a register and tables that have one row per ``transaction_id``.

    Both joins are many to one: a second row of an id in ``context`` or ``flags`` fails the job. Rows
    without id match nothing.
    """
    rights = [
        one_per_key(
            df.where(F.col("transaction_id").isNotNull()).select(
                F.col("transaction_id").alias("_key"), *columns
            ),
            "_key",
        )
        for df, columns in ((context, FROM_RECONCILIATION), (flags, ANOMALY_COLUMNS))
    ]
    joined = look_up(
        register.select(*FROM_REGISTER), "transaction_id", rights, ["exception_id"], stats=stats
    )
    return joined.withColumns(
        {
            "financial_impact": F.coalesce("financial_impact", F.lit(0)).cast("decimal(18,2)"),
            "potential_anomaly": F.coalesce("potential_anomaly", F.lit(False)),
            "known_exception": F.lit(True),
            "is_exception": F.lit(True),
        }
    ).select(*FROM_REGISTER, *FROM_RECONCILIATION, *ANOMALY_COLUMNS, "is_exception")


def transaction_table(reconciliation: DataFrame, anomalies: DataFrame) -> DataFrame:
    """One row per transaction id: its row of highest status priority, and its first anomaly row.

    Anomaly columns that clash with reconciliation columns end in ``_anomaly``.
    """
    chosen = last_by_priority(
        reconciliation,
        "transaction_id",
        by_status(STATUS_PRIORITY, OTHER_PRIORITY),
        ORDER_COLUMNS,
    ).select(*RECONCILIATION_COLUMNS)
    clashing = [c for c in RECONCILIATION_COLUMNS if c != "transaction_id"]
    flags = first_per_key(anomalies, "transaction_id", ORDER_COLUMNS).select(
        "transaction_id",
        *[F.col(c).alias(f"{c}_anomaly") for c in clashing],
        *ANOMALY_COLUMNS,
    )
    # both sides hold one row per id, so no id can be heavy
    return chosen.join(flags, "transaction_id", "left").withColumn(
        "is_exception", ~F.col("reconciliation_status").eqNullSafe("MATCHED")
    )


def exception_totals(table: DataFrame) -> DataFrame:
    """Size and totals of the exception table."""
    return table.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(table.columns)).cast("bigint").alias("column_count"),
        F.count_distinct("exception_id").alias("unique_exceptions"),
        F.count_distinct("transaction_id").alias("unique_transactions"),
        F.count_if("potential_anomaly").alias("potential_anomalies"),
        F.coalesce(F.sum("financial_impact"), F.lit(0)).alias("financial_exposure"),
    )


def transaction_totals(table: DataFrame) -> DataFrame:
    return table.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("transaction_id").alias("unique_transactions"),
    )


def _count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _is(column: str, value: str) -> Column:
    return _count(F.col(column) == value)


def _exposure(condition: Column | None = None) -> Column:
    impact = F.col("financial_impact")
    picked = impact if condition is None else F.when(condition, impact)
    return F.coalesce(F.sum(picked), F.lit(0)).cast("decimal(38,2)")


def measure_columns() -> dict[str, Column]:
    """The thirty-six report measures as aggregates over the exception table."""
    severity = lambda value: F.col("severity") == value
    return {
        "total_exceptions": F.count(F.lit(1)),
        "total_financial_exposure": _exposure(),
        "critical_exceptions": _is("severity", "CRITICAL"),
        "high_exceptions": _is("severity", "HIGH"),
        "medium_exceptions": _is("severity", "MEDIUM"),
        "average_exception_impact": F.sum("financial_impact").cast("double")
        / F.count("financial_impact"),
        "potential_anomalies": _count(F.col("potential_anomaly")),
        "high_priority_investigations": _is("investigation_priority", "HIGH"),
        "matched_exceptions": _is("reconciliation_status", "MATCHED"),
        "partial_payments": _is("reconciliation_status", "PARTIAL_PAYMENT"),
        "overpayments": _is("reconciliation_status", "OVERPAYMENT"),
        "duplicate_transactions": _is("reconciliation_status", "DUPLICATE"),
        "missing_payments": _is("reconciliation_status", "MISSING_PAYMENT"),
        "unexpected_payments": _is("reconciliation_status", "UNEXPECTED_PAYMENT"),
        "date_mismatches": _is("reconciliation_status", "DATE_MISMATCH"),
        "entity_uncertain": _is("reconciliation_status", "ENTITY_UNCERTAIN"),
        "critical_exposure": _exposure(severity("CRITICAL")),
        "high_exposure": _exposure(severity("HIGH")),
        "medium_exposure": _exposure(severity("MEDIUM")),
        "open_exceptions": _is("status", "OPEN"),
        "assigned_exceptions": _is("status", "ASSIGNED"),
        "investigating_exceptions": _is("status", "INVESTIGATING"),
        "escalated_exceptions": _is("status", "ESCALATED"),
        "resolved_exceptions": _is("status", "RESOLVED"),
        "closed_exceptions": _is("status", "CLOSED"),
        "false_positives": _is("status", "FALSE POSITIVE"),
        "within_sla": _is("sla_status", "WITHIN_SLA"),
        # a blank SLA status is outside, too
        "outside_sla": F.count_if(~F.col("sla_status").eqNullSafe("WITHIN_SLA")),
        "isolation_forest_anomalies": _count(F.col("isolation_forest_anomaly")),
        "z_score_anomalies": _count(F.col("amount_z_anomaly")),
        "iqr_anomalies": _count(F.col("amount_iqr_anomaly")),
        "matched_statistical_anomalies": _count(
            F.col("potential_anomaly") & (F.col("reconciliation_status") == "MATCHED")
        ),
        "gateway_exposure": _exposure(),
        "average_entity_match_score": F.sum(F.col("entity_match_score").cast("decimal(18,2)")).cast(
            "double"
        )
        / F.count("entity_match_score"),
        "average_date_difference": F.avg("date_difference_days"),
        "average_exception_age": F.avg("exception_age_days"),
    }


def measures(
    table: DataFrame, slicer: list[str] | None = None, names: list[str] | None = None
) -> DataFrame:
    """All measures in one pass, or those in ``names``; per group of ``slicer`` when given.

    An average over no value is null. An empty count or sum is 0.
    """
    columns = measure_columns()
    picked = [columns[n].alias(n) for n in (names or columns)]
    return table.groupBy(*slicer).agg(*picked) if slicer else table.agg(*picked)
