"""How sure we are that a payment belongs to a ledger row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lcs_ratio
from .joins import look_up
from .keys import first_per_key
from .keystats import KeyStats

# Weights of the evidence and lower bounds of the bands.
EMAIL_WEIGHT, NAME_WEIGHT, AMOUNT_WEIGHT = 0.50, 0.30, 0.20
HIGH_FROM, MEDIUM_FROM = 95, 80


def exact_match(a: Column, b: Column) -> Column:
    return F.coalesce(a == b, F.lit(False))


def email_score(a: str, b: str) -> Column:
    return F.when(exact_match(F.col(a), F.col(b)), F.lit(100.0)).otherwise(lcs_ratio(a, b))


def name_score(a: str, b: str) -> Column:
    return lcs_ratio(a, b)


def amount_score(a: str, b: str) -> Column:
    return F.when(exact_match(F.col(a), F.col(b)), F.lit(100.0)).otherwise(F.lit(0.0))


def match_score(ledger: dict[str, str], payment: dict[str, str]) -> Column:
    """Weighted score; both sides name their columns for name, email and amount."""
    return F.round(
        EMAIL_WEIGHT * email_score(ledger["email"], payment["email"])
        + NAME_WEIGHT * name_score(ledger["name"], payment["name"])
        + AMOUNT_WEIGHT * amount_score(ledger["amount"], payment["amount"]),
        2,
    )


def match_band(score: Column) -> Column:
    return (
        F.when(score >= HIGH_FROM, "HIGH_CONFIDENCE")
        .when(score >= MEDIUM_FROM, "MEDIUM_CONFIDENCE")
        .otherwise("MANUAL_REVIEW")
    )


def evidence(prefix: str = "") -> dict[str, str]:
    return {
        "name": f"{prefix}customer_name_clean",
        "email": f"{prefix}email_clean",
        "amount": f"{prefix}amount",
    }


# What is taken over from a payment.
PAYMENT_COLUMNS = [
    "gateway_transaction_id",
    "gateway",
    "transaction_date",
    "amount",
    "customer_name",
    "customer_name_clean",
    "email_clean",
    "src_row",
]


def first_payments(payment: DataFrame, others: tuple[str, ...] = ()) -> DataFrame:
    """First payment per merchant reference, its columns prefixed ``p_``, keyed by ``_key``.

    ``others`` are columns to keep under their own names.
    """
    first = first_per_key(payment, "merchant_reference", ["src_row"])
    return first.select(
        F.col("merchant_reference").alias("_key"),
        *[F.col(c).alias(f"p_{c}") for c in PAYMENT_COLUMNS],
        F.lit(True).alias("p_found"),
        *others,
    )


def score_pairs(pairs: DataFrame) -> DataFrame:
    """Ledger rows with the payment found for them: adds ``own_score`` and ``own_band``."""
    found = F.col("p_found").isNotNull()
    score = F.when(found, match_score(evidence(), evidence("p_"))).otherwise(F.lit(0.0))
    band = F.when(found, match_band(F.col("own_score"))).otherwise("NO_MATCH")
    return pairs.withColumn("own_score", score).withColumn("own_band", band)


def match_table(scored: DataFrame) -> DataFrame:
    """The match table's columns of scored pairs."""
    return scored.select(
        "transaction_id",
        F.col("p_gateway_transaction_id").alias("gateway_transaction_id"),
        F.col("customer_id").alias("erp_customer_id"),
        F.col("customer_name").alias("erp_customer_name"),
        F.col("p_customer_name").alias("payment_customer_name"),
        F.col("own_score").alias("entity_match_score"),
        F.col("own_band").alias("entity_match_confidence"),
        F.col("amount").alias("erp_amount"),
        F.col("p_amount").alias("payment_amount"),
        "src_row",
    )


def match_transactions(
    erp: DataFrame, payment: DataFrame, stats: KeyStats | None = None
) -> DataFrame:
    """One row per ledger row: the payment found for it, the score and its band.

    ``stats`` are those of the ledger's ids.
    """
    rights = [first_payments(payment)]
    pairs = look_up(erp, "transaction_id", rights, ["src_row"], stats=stats)
    return match_table(score_pairs(pairs))


def match_bands(matches: DataFrame) -> DataFrame:
    """Rows per band and their mean score."""
    return matches.groupBy("entity_match_confidence").agg(
        F.count(F.lit(1)).alias("match_count"),
        (F.sum(F.col("entity_match_score").cast("decimal(18,2)")).cast("double") / F.count("*")).alias(
            "average_score"
        ),
    )


def mean_score(matches: DataFrame) -> DataFrame:
    return matches.agg(
        F.count(F.lit(1)).alias("match_count"),
        (F.sum(F.col("entity_match_score").cast("decimal(18,2)")).cast("double") / F.count("*")).alias(
            "average_score"
        ),
    )
