"""Typing and normalising the five raw sources."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean_amount, clean_date, clean_email, clean_name, clean_phone

# Per source: columns that get a normalised twin, columns that become dates, and amounts.
_NORMALISE = {"customer_name": clean_name, "email": clean_email, "phone": clean_phone}
_RULES = {
    "customer_master": (["customer_name", "email", "phone"], ["created_date"], []),
    "invoice": ([], ["invoice_date"], ["invoice_amount", "tax", "discount", "net_amount"]),
    "erp_transactions": (["customer_name", "email", "phone"], ["transaction_date"], ["amount"]),
    "payment_gateway": (["customer_name", "email"], ["transaction_date"], ["amount"]),
    "bank_transactions": (
        [],
        ["transaction_date", "value_date"],
        ["credit_amount", "debit_amount"],
    ),
}


def clean(table: str, df: DataFrame, date_formats: tuple[str, ...] = ()) -> DataFrame:
    """Clean one source: typed dates and amounts in place, ``<column>_clean`` twins added.

    Dates are ISO text or in one of ``date_formats``. What does not parse becomes null; see
    ``unparsed``.
    """
    names, dates, amounts = _RULES[table]
    return df.withColumns(
        {f"{c}_clean": _NORMALISE[c](F.col(c)) for c in names}
        | {c: clean_date(F.col(c), date_formats) for c in dates}
        | {c: clean_amount(F.col(c)) for c in amounts}
    )


def unparsed(table: str, df: DataFrame, date_formats: tuple[str, ...] = ()) -> DataFrame:
    """One row per date and amount column of a raw source: how many texts become null, blank ones
    apart."""
    _, dates, amounts = _RULES[table]
    parsed = {c: clean_date(F.col(c), date_formats) for c in dates}
    parsed |= {c: clean_amount(F.col(c)) for c in amounts}
    text = {c: F.trim(F.coalesce(F.col(c), F.lit(""))) for c in parsed}
    lost = df.agg(
        *[F.count_if((text[c] != "") & value.isNull()).alias(c) for c, value in parsed.items()]
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("lost")) for c in parsed]
    )
    return lost.select(F.inline(rows)).select(
        F.lit(table).alias("table_name"), "column_name", "lost"
    )


def clean_customer_master(df: DataFrame) -> DataFrame:
    return clean("customer_master", df)


def clean_invoice(df: DataFrame) -> DataFrame:
    return clean("invoice", df)


def clean_erp(df: DataFrame) -> DataFrame:
    return clean("erp_transactions", df)


def clean_payment_gateway(df: DataFrame) -> DataFrame:
    return clean("payment_gateway", df)


def clean_bank_transactions(df: DataFrame) -> DataFrame:
    return clean("bank_transactions", df)


def clean_all(
    raw: dict[str, DataFrame], date_formats: tuple[str, ...] = ()
) -> dict[str, DataFrame]:
    return {table: clean(table, df, date_formats) for table, df in raw.items()}
