"""What the investigation dashboard and the summary workbook show, as tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of the register view.
REGISTER_VIEW = (
    "exception_id transaction_id severity financial_impact owner status root_cause "
    "recommended_action exception_age_days sla_status"
).split()


def select_exceptions(
    exceptions: DataFrame,
    severities: list[str] | None = None,
    owners: list[str] | None = None,
    statuses: list[str] | None = None,
) -> DataFrame:
    """Rows whose severity, owner and workflow status are all in the lists.

    A list not given selects every value there is; null is never selected.
    """
    for column, allowed in (("severity", severities), ("owner", owners), ("status", statuses)):
        c = F.col(column)
        exceptions = exceptions.where(c.isNotNull() if allowed is None else c.isin(allowed))
    return exceptions


def kpis(transactions: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Transactions, exceptions, exposure, and exceptions per hundred transactions."""
    totals = exceptions.agg(
        F.count_distinct("exception_id").alias("exceptions"),
        F.coalesce(F.sum("financial_impact"), F.lit(0)).alias("financial_exposure"),
    )
    all_transactions = transactions.agg(F.count_distinct("transaction_id")).scalar()
    rate = F.col("exceptions") / F.col("transactions") * 100
    return totals.select(
        all_transactions.alias("transactions"), "exceptions", "financial_exposure"
    ).withColumn(
        "exception_rate", F.when(F.col("transactions") > 0, F.round(rate, 2)).otherwise(0.0)
    )


def value_counts(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), key)
    )


def exposure_per(exceptions: DataFrame, key: str) -> DataFrame:
    return (
        exceptions.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sum("financial_impact").alias("financial_impact"))
        .orderBy(F.desc("financial_impact"), key)
    )


def register_view(exceptions: DataFrame) -> DataFrame:
    """The register for reading, largest impact first."""
    shown = [c for c in REGISTER_VIEW if c in exceptions.columns]
    return exceptions.select(*shown).orderBy(
        F.desc_nulls_last("financial_impact"), "exception_id"
    )


def workbook_summary(register: DataFrame) -> DataFrame:
    return register.agg(
        F.count(F.lit(1)).alias("total_exceptions"),
        F.coalesce(F.sum("financial_impact"), F.lit(0)).alias("financial_exposure"),
        *[
            F.count_if(F.col("severity") == s).alias(f"{s.lower()}_exceptions")
            for s in ("CRITICAL", "HIGH", "MEDIUM")
        ],
    )


def workbook_types(register: DataFrame) -> DataFrame:
    return (
        register.where("reconciliation_status IS NOT NULL")
        .groupBy("reconciliation_status")
        .agg(
            F.count("exception_id").alias("exception_count"),
            F.sum("financial_impact").alias("financial_exposure"),
        )
        .orderBy(F.desc("financial_exposure"), "reconciliation_status")
    )
