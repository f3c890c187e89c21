"""Money is DECIMAL(18,2) everywhere inside, so sums do not depend on the partitioning."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
DIFF = DecimalType(19, 2)


def clean_amount(c: Column) -> Column:
    """Text to money; what does not parse becomes null, the third decimal rounds half up."""
    return c.try_cast(MONEY)


def exposure_max(payment_difference: Column, bank_difference: Column) -> Column:
    """The larger of the two differences, null counting as 0."""
    zero = F.lit(0).cast(DIFF)
    return F.greatest(
        F.coalesce(F.abs(payment_difference), zero), F.coalesce(F.abs(bank_difference), zero)
    )


def exposure_first(payment_difference: Column, bank_difference: Column) -> Column:
    """The payment difference where known, else the bank difference, else 0."""
    return F.abs(F.coalesce(payment_difference, bank_difference, F.lit(0).cast(DIFF)))
