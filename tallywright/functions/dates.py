"""Dates are wall-clock values (TIMESTAMP_NTZ): no result depends on the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_date(c: Column, formats: tuple[str, ...] = ()) -> Column:
    """Text to timestamp; what does not parse becomes null.

    ISO text is tried first, then each of ``formats`` (Spark's date patterns, such as
    ``dd/MM/yyyy``) in order. A zone in the text is not applied: the clock reading counts.
    """
    return F.coalesce(c.try_cast("timestamp_ntz"), *[_by_pattern(c, f) for f in formats])


def _by_pattern(c: Column, pattern: str) -> Column:
    # read as UTC and counted from 1970, so that no zone's missing hour moves a reading
    instant = F.try_to_timestamp(F.concat(c, F.lit(" +0000")), F.lit(f"{pattern} xx"))
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    zero = F.lit(0)
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return start + F.make_dt_interval(zero, zero, zero, seconds)


def whole_days_between(start: Column, end: Column) -> Column:
    """Floor of (end - start) in days: 22 hours over midnight is 0, one hour back is -1."""
    since_midnight = lambda c: c - F.date_trunc("DAY", c).cast("timestamp_ntz")
    behind = (since_midnight(end) < since_midnight(start)).cast("int")
    return F.date_diff(end, start) - behind
