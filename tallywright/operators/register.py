"""The exception register: every row that is not MATCHED, with impact, severity, owner and SLA."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exposure_max
from ..schemas import ORDER_COLUMNS, REGISTER_COLUMNS
from .keys import running_number

# The cause, the action and the owner of each status.
CAUSES = {
    "PARTIAL_PAYMENT": "Potential partial payment",
    "OVERPAYMENT": "Potential overpayment",
    "AMOUNT_MISMATCH": "Payment amount differs from ERP amount",
    "MISSING_PAYMENT": "ERP transaction has no payment gateway record",
    "UNEXPECTED_PAYMENT": "Payment exists without corresponding ERP transaction",
    "MISSING_BANK_SETTLEMENT": "Payment received but bank settlement is missing",
    "DUPLICATE": "Duplicate ERP transaction detected",
    "DATE_MISMATCH": "Transaction dates differ across systems",
    "ENTITY_UNCERTAIN": "Customer/entity relationship requires review",
}
ACTIONS = {
    "PARTIAL_PAYMENT": "Review outstanding payment balance",
    "OVERPAYMENT": "Review excess payment and refund requirements",
    "AMOUNT_MISMATCH": "Compare ERP, gateway and settlement records",
    "MISSING_PAYMENT": "Verify payment gateway processing and payment status",
    "UNEXPECTED_PAYMENT": "Investigate payment origin and identify related transaction",
    "MISSING_BANK_SETTLEMENT": "Review bank settlement file and settlement cycle",
    "DUPLICATE": "Verify duplicate posting and reverse erroneous entry if confirmed",
    "DATE_MISMATCH": "Review transaction and settlement dates",
    "ENTITY_UNCERTAIN": "Perform manual entity verification",
}
OWNERS = {
    "AMOUNT_MISMATCH": "Payments",
    "PARTIAL_PAYMENT": "Payments",
    "OVERPAYMENT": "Payments",
    "ENTITY_UNCERTAIN": "Data Quality",
    "DATE_MISMATCH": "Operations",
}
NO_CAUSE, NO_ACTION, OTHER_OWNER = "No exception", "No action required", "Finance"

# Severity rules and days allowed.
CRITICAL_FROM, HIGH_FROM = 50_000, 10_000
HIGH_STATUSES = [
    "ENTITY_UNCERTAIN",
    "MISSING_PAYMENT",
    "MISSING_BANK_SETTLEMENT",
    "UNEXPECTED_PAYMENT",
]
MEDIUM_STATUSES = [
    "AMOUNT_MISMATCH",
    "PARTIAL_PAYMENT",
    "OVERPAYMENT",
    "DATE_MISMATCH",
    "DUPLICATE",
]
SLA_DAYS = {"CRITICAL": 1, "HIGH": 3, "MEDIUM": 7, "LOW": 14}


def by_status(rules: dict, default, status: Column | None = None) -> Column:
    """A rule table as one CASE expression; a null status takes the default."""
    status = F.col("reconciliation_status") if status is None else status
    chain = F
    for key, value in rules.items():
        chain = chain.when(status == key, F.lit(value))
    return chain.otherwise(F.lit(default))


def severity(
    status: Column,
    impact: Column,
    critical_from: float = CRITICAL_FROM,
    high_from: float = HIGH_FROM,
) -> Column:
    return (
        F.when(impact >= critical_from, "CRITICAL")
        .when((impact >= high_from) | status.isin(HIGH_STATUSES), "HIGH")
        .when(status.isin(MEDIUM_STATUSES), "MEDIUM")
        .otherwise("LOW")
    )


def exceptions_only(reconciliation: DataFrame) -> DataFrame:
    return reconciliation.where("reconciliation_status <> 'MATCHED'")


def assess(exceptions: DataFrame, critical_from=CRITICAL_FROM, high_from=HIGH_FROM) -> DataFrame:
    """Impact, severity, root cause, action, owner and initial workflow status."""
    status = F.col("reconciliation_status")
    impact = exposure_max(F.col("payment_difference"), F.col("bank_difference"))
    return exceptions.withColumns({"financial_impact": impact.cast("decimal(18,2)")}).withColumns(
        {
            "severity": severity(status, F.col("financial_impact"), critical_from, high_from),
            "root_cause": by_status(CAUSES, NO_CAUSE),
            "recommended_action": by_status(ACTIONS, NO_ACTION),
            "owner": by_status(OWNERS, OTHER_OWNER),
            "status": F.when(status != "MATCHED", "OPEN"),
        }
    )


def build_exception_register(
    reconciliation: DataFrame,
    created: str,
    as_of: str | None = None,
    critical_from: float = CRITICAL_FROM,
    high_from: float = HIGH_FROM,
) -> DataFrame:
    """The register, one row per exception, numbered in ledger order.

    ``created`` and ``as_of`` are dates (yyyy-mm-dd) given by the caller; by default the register is
    seen on the day it is made, so every age is 0 and every row is within its SLA.
    """
    created_date = F.lit(created).cast("date")
    age = F.date_diff(F.lit(as_of or created).cast("date"), created_date)
    days = by_status(SLA_DAYS, None, F.col("severity")).cast("int")
    numbered = running_number(
        assess(exceptions_only(reconciliation), critical_from, high_from),
        ORDER_COLUMNS[0],
        ORDER_COLUMNS[1],
        "_number",
    )
    return numbered.withColumns(
        {
            "exception_id": F.format_string("EXC-%06d", F.col("_number")),
            "created_date": created_date,
            "exception_age_days": age,
            "sla_days": days,
            "sla_status": F.when(age > days, "OUTSIDE_SLA").otherwise("WITHIN_SLA"),
            "resolution": F.lit(None).cast("string"),
            "resolution_date": F.lit(None).cast("date"),
        }
    ).select(*REGISTER_COLUMNS, *ORDER_COLUMNS)


def register_totals(register: DataFrame) -> DataFrame:
    return register.agg(
        F.count(F.lit(1)).alias("total_exceptions"),
        F.coalesce(F.sum("financial_impact"), F.lit(0)).alias("financial_exposure"),
    )


def counts_by(register: DataFrame, key: str) -> DataFrame:
    return (
        register.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("exception_count"))
        .orderBy(F.desc("exception_count"), key)
    )


def exposure_by(register: DataFrame, key: str) -> DataFrame:
    return (
        register.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sum("financial_impact").alias("financial_exposure"))
        .orderBy(F.desc("financial_exposure"), key)
    )
