"""Exact quantiles of a money column, without gathering the values anywhere.

Spark's ``percentile`` builds one map of all distinct values in a single task. Here the order
statistics are found digit by digit instead: a value in cents is three 22-bit digits; per digit one histogram
(at most 2^22 rows per wanted rank, pre-aggregated in the map tasks) tells which digit holds the
rank. Three passes over one column, no value is shuffled, no group is larger than a histogram.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DIGIT = 22
_LEVELS = 3


def _prefix(cents: Column, level: int) -> Column:
    """The first ``level`` digits; arithmetic shifts keep the order of negative values."""
    return F.shiftright(cents, _DIGIT * (_LEVELS - level))


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float]) -> DataFrame:
    """One row with ``q0``, ``q1``, … : linearly interpolated quantiles, null for an empty input."""
    values = df.where(F.col(column).isNotNull()).select(
        (F.col(column) * 100).cast("bigint").alias("cents")
    )

    digits = values.groupBy(_prefix(F.col("cents"), 1).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n")
    )
    ordered = Window.orderBy("prefix")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = []
    for i, p in enumerate(probabilities):
        place = (F.col("total") - 1) * F.lit(float(p))
        for end, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            wanted.append(
                F.struct(
                    F.lit(i).alias("i"),
                    F.lit(end).alias("end"),
                    rank.cast("bigint").alias("rank"),
                    (place - F.floor(place)).alias("part"),
                )
            )
    found = (
        digits.withColumn("total", F.sum("n").over(everything))
        .withColumn("before", F.sum("n").over(ordered) - F.col("n"))
        .withColumn("want", F.explode(F.array(*wanted)))
        .select("want.i", "want.end", "want.part", "prefix", "before", "n", "want.rank")
        .where("rank >= before AND rank < before + n")
        .withColumn("rank", F.col("rank") - F.col("before"))
        .drop("before", "n")
    )
    # ``found`` has two rows per probability at every level
    for level in range(2, _LEVELS + 1):
        narrowed = values.withColumn("prefix", _prefix(F.col("cents"), level - 1)).join(
            F.broadcast(found), "prefix"
        )
        digits = narrowed.groupBy(
            "i", "end", "part", "rank", _prefix(F.col("cents"), level).alias("prefix")
        ).agg(F.count(F.lit(1)).alias("n"))
        ordered = Window.partitionBy("i", "end").orderBy("prefix")
        found = (
            digits.withColumn("before", F.sum("n").over(ordered) - F.col("n"))
            .where("rank >= before AND rank < before + n")
            .withColumn("rank", F.col("rank") - F.col("before"))
            .drop("before", "n")
        )

    def at(i: int, end: str, what: str) -> Column:
        return F.max(F.when((F.col("i") == i) & (F.col("end") == end), F.col(what)))

    quantiles = []
    for i in range(len(probabilities)):
        low, high = at(i, "lo", "prefix") / F.lit(100.0), at(i, "hi", "prefix") / F.lit(100.0)
        quantiles.append((low + (high - low) * at(i, "lo", "part")).alias(f"q{i}"))
    return found.agg(*quantiles)
