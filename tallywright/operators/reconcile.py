"""Ledger to payment to bank: one status per row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import DIFF, MONEY, whole_days_between
from ..schemas import ORDER_COLUMNS, RECONCILIATION_COLUMNS
from .joins import look_up
from .keys import first_per_key, repeated_keys
from .keystats import KeyStats, sketch_keys
from .matching import PAYMENT_COLUMNS, evidence, first_payments, match_band, match_score, score_pairs

# Statistics of the ledger's and the payments' keys, by table.
Stats = dict[str, KeyStats]


def _of(stats: Stats | None, table: str) -> KeyStats | None:
    return None if stats is None else stats.get(table)


def status_of(
    erp_amount: Column,
    payment_amount: Column,
    payment_found: Column,
    bank_found: Column,
    band: Column,
    repeated: Column,
    days: Column,
) -> Column:
    """First rule that holds. A comparison with a null amount holds never and falls through."""
    return (
        F.when(repeated, "DUPLICATE")
        .when(~payment_found, "MISSING_PAYMENT")
        .when(band == "MANUAL_REVIEW", "ENTITY_UNCERTAIN")
        .when(payment_amount < erp_amount, "PARTIAL_PAYMENT")
        .when(payment_amount > erp_amount, "OVERPAYMENT")
        .when(F.abs(days) > 1, "DATE_MISMATCH")
        .when((payment_amount == erp_amount) & ~bank_found, "MISSING_BANK_SETTLEMENT")
        .when(payment_amount == erp_amount, "MATCHED")
        .otherwise("AMOUNT_MISMATCH")
    )


def settled_payments(payment: DataFrame, bank: DataFrame, stats: Stats | None = None) -> DataFrame:
    """First payment per reference with the first bank row of its gateway id, keyed by ``_key``.

    Payments meet the bank before the first are taken: the rows are shuffled by gateway id and by
    reference, and lie by ``_key`` as a join on it needs them.
    """
    paid = payment.where("merchant_reference IS NOT NULL").select("merchant_reference", *PAYMENT_COLUMNS)
    settled = first_per_key(bank, "reference_number", ["src_row"]).select(
        F.col("reference_number").alias("_key"),
        F.col("credit_amount").alias("b_amount"),
        F.col("value_date").alias("b_date"),
        F.lit(True).alias("b_found"),
    )
    key = "gateway_transaction_id"
    mine = _of(stats, "payment_gateway")
    if mine is None:
        mine = KeyStats.of(sketch_keys(payment, [key]), [key])
    banked = look_up(paid, key, [settled], ["src_row"], stats=mine)
    return first_payments(banked, ("b_amount", "b_date", "b_found"))


# What the match table and the reconciliation take from a scored pair.
PAIR_COLUMNS = [
    "transaction_id",
    "invoice_id",
    "customer_id",
    "customer_name",
    "store_id",
    "transaction_date",
    "amount",
    "src_row",
    "copies",
    "p_gateway_transaction_id",
    "p_gateway",
    "p_transaction_date",
    "p_amount",
    "p_customer_name",
    "p_found",
    "b_amount",
    "b_date",
    "b_found",
    "own_score",
    "own_band",
    "entity_match_score",
    "entity_match_confidence",
]


def scored_pairs(
    erp: DataFrame, payment: DataFrame, bank: DataFrame, stats: Stats | None = None
) -> DataFrame:
    """One row per ledger row with its payment, bank row, number of copies and scores.

    ``own_score`` belongs to the row, ``entity_match_score`` to the first copy of its id. The two
    are scored apart only where a copy differs from the first in what is compared.
    """
    compared = list(evidence().values())
    repeated = repeated_keys(erp, "transaction_id", F.struct(*compared))
    rights = [repeated, settled_payments(payment, bank, stats)]
    mine = _of(stats, "erp_transactions")
    rows = look_up(erp, "transaction_id", rights, ["src_row"], keyless=(0,), stats=mine)
    differs = F.lit(False)
    for c in compared:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"lead.{c}"))
    apart = F.col("copies").isNotNull() & F.col("p_found").isNotNull() & differs
    scored = score_pairs(rows).withColumns({f"first_{c}": F.col(f"lead.{c}") for c in compared})
    score = F.when(apart, match_score(evidence("first_"), evidence("p_")))
    band = F.when(apart, match_band(F.col("entity_match_score")))
    return (
        scored.withColumn("entity_match_score", score.otherwise(F.col("own_score")))
        .withColumn("entity_match_confidence", band.otherwise(F.col("own_band")))
        .drop("lead", *[f"first_{c}" for c in compared])
    )


def pairs_from_matches(
    erp: DataFrame,
    payment: DataFrame,
    bank: DataFrame,
    matches: DataFrame,
    stats: Stats | None = None,
) -> DataFrame:
    """The same with the first score per id looked up in a match table."""
    first = first_per_key(matches, "transaction_id", ["src_row"]).select(
        F.col("transaction_id").alias("_key"),
        "entity_match_score",
        "entity_match_confidence",
    )
    rights = [repeated_keys(erp, "transaction_id"), settled_payments(payment, bank, stats), first]
    mine = _of(stats, "erp_transactions")
    return look_up(erp, "transaction_id", rights, ["src_row"], keyless=(0,), stats=mine).fillna(
        {"entity_match_score": 0.0, "entity_match_confidence": "NO_MATCH"}
    )


def reconcile_pairs(pairs: DataFrame) -> DataFrame:
    """The reconciliation columns and the row order of scored pairs."""
    is_copy = F.col("copies").isNotNull()
    paid = F.col("p_found").isNotNull()
    settled = F.col("b_found").isNotNull()
    days = whole_days_between(F.col("transaction_date"), F.col("p_transaction_date"))
    full = pairs.withColumns(
        {
            "erp_transaction_date": F.col("transaction_date"),
            "erp_amount": F.col("amount"),
            "gateway_transaction_id": F.col("p_gateway_transaction_id"),
            "gateway": F.col("p_gateway"),
            "payment_transaction_date": F.col("p_transaction_date"),
            "payment_amount": F.col("p_amount"),
            "payment_difference": (F.col("amount") - F.col("p_amount")).cast(DIFF),
            "bank_transaction_date": F.col("b_date"),
            "bank_amount": F.col("b_amount"),
            "bank_difference": (F.col("p_amount") - F.col("b_amount")).cast(DIFF),
            "bank_status": F.when(settled, "SETTLED").otherwise("MISSING_SETTLEMENT"),
            "date_difference_days": days,
            "reconciliation_status": status_of(
                F.col("amount"),
                F.col("p_amount"),
                paid,
                settled,
                F.col("entity_match_confidence"),
                is_copy,
                days,
            ),
            "src_branch": F.lit(0),
        }
    )
    return full.select(*RECONCILIATION_COLUMNS, *ORDER_COLUMNS)


def reconcile_transactions(
    erp: DataFrame,
    payment: DataFrame,
    bank: DataFrame,
    matches: DataFrame | None = None,
    stats: Stats | None = None,
) -> DataFrame:
    """One row per ledger row, in the twenty reconciliation columns plus the row order.

    Copies of an id share the score of its first copy. Without ``matches`` that score is computed
    here, on the row pair at hand; with it, the first match per id is looked up. With ``stats`` of
    both tables' keys, nothing runs before the result is asked for.
    """
    if matches is None:
        return reconcile_pairs(scored_pairs(erp, payment, bank, stats))
    return reconcile_pairs(pairs_from_matches(erp, payment, bank, matches, stats))


def unexpected_payments(
    payment: DataFrame, erp: DataFrame, stats: Stats | None = None
) -> DataFrame:
    """Every payment whose reference is null or no ledger id, in reconciliation columns."""
    ids = erp.select(F.col("transaction_id").alias("_key")).where("_key IS NOT NULL").distinct()
    mine = _of(stats, "payment_gateway")
    alone = look_up(payment, "merchant_reference", [ids], ["src_row"], "left_anti", stats=mine)
    nothing = {
        "string": ["invoice_id", "customer_id", "store_id"],
        "timestamp_ntz": ["erp_transaction_date", "bank_transaction_date"],
        MONEY: ["erp_amount", "bank_amount"],
        DIFF: ["payment_difference", "bank_difference"],
        "int": ["date_difference_days"],
    }
    return (
        alone.withColumns(
            {
                "transaction_id": F.col("merchant_reference"),
                "payment_transaction_date": F.col("transaction_date"),
                "payment_amount": F.col("amount"),
                "bank_status": F.lit("UNKNOWN"),
                "entity_match_score": F.lit(0.0),
                "entity_match_confidence": F.lit("NO_MATCH"),
                "reconciliation_status": F.lit("UNEXPECTED_PAYMENT"),
                "src_branch": F.lit(1),
            }
        )
        .withColumns({c: F.lit(None).cast(t) for t, cols in nothing.items() for c in cols})
        .select(*RECONCILIATION_COLUMNS, *ORDER_COLUMNS)
    )


def add_unexpected_payments(
    reconciliation: DataFrame, payment: DataFrame, erp: DataFrame, stats: Stats | None = None
):
    return reconciliation.unionByName(unexpected_payments(payment, erp, stats))


def reconcile(
    erp: DataFrame,
    payment: DataFrame,
    bank: DataFrame,
    matches: DataFrame | None = None,
    stats: Stats | None = None,
) -> DataFrame:
    """The whole reconciliation table."""
    return add_unexpected_payments(
        reconcile_transactions(erp, payment, bank, matches, stats), payment, erp, stats
    )


def status_counts(reconciliation: DataFrame) -> DataFrame:
    return (
        reconciliation.groupBy("reconciliation_status")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .orderBy(F.desc("record_count"), "reconciliation_status")
    )


def status_impact(reconciliation: DataFrame) -> DataFrame:
    """Sum of absolute payment differences per status; nothing known counts as 0."""
    total = F.sum(F.abs("payment_difference")).cast("decimal(38,2)")
    return (
        reconciliation.groupBy("reconciliation_status")
        .agg(F.coalesce(total, F.lit(0).cast("decimal(38,2)")).alias("payment_impact"))
        .orderBy(F.desc("payment_impact"), "reconciliation_status")
    )
