"""Statistical flags on the reconciliation table: z-score, quartile range, isolation forest."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..schemas import ANOMALY_COLUMNS, ORDER_COLUMNS, RECONCILIATION_COLUMNS
from .quantile import exact_quantiles

# The seven features, and the bounds of the two amount rules.
FEATURES = [
    "erp_amount",
    "payment_amount",
    "bank_amount",
    "payment_difference",
    "bank_difference",
    "date_difference_days",
    "entity_match_score",
]
Z_FROM, IQR_REACH = 3.0, 1.5


def fill_features(reconciliation: DataFrame) -> DataFrame:
    """The features as numbers, null counting as 0; they replace the columns."""
    return reconciliation.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0).cast(reconciliation.schema[c].dataType)) for c in FEATURES}
    )


def _unit(df: DataFrame, column: str) -> int:
    """Steps of a feature per 1: money and whole numbers have two decimals, scores count by 10^-6."""
    return 1_000_000 if isinstance(df.schema[column].dataType, (DoubleType, FloatType)) else 100


def _steps(df: DataFrame, column: str) -> Column:
    """A feature as a whole number of steps."""
    unit = _unit(df, column)
    exact = F.col(column).cast("decimal(25,6)" if unit > 100 else "decimal(20,2)")
    return (exact * unit).cast("decimal(19,0)")


def _square(deviation: Column) -> Column:
    return (deviation * deviation).cast("decimal(38,0)")


def z_score(df: DataFrame, column: str) -> Column:
    """Deviation from the mean in sample standard deviations; 0 where there is no spread.

    Sums are taken over whole steps (cents), first of the values and then of their distances from the
    rounded mean, so a value at a bound falls on the same side under any partitioning. A sum of
    squares beyond 38 digits raises.
    """
    x = _steps(df, column)
    middle = F.round(F.sum(x).cast("double") / F.count(x)).cast("decimal(19,0)")
    center = df.agg(middle.alias("center")).scalar()
    away = (x - center).cast("decimal(19,0)")
    stats = df.agg(
        F.struct(
            F.count(away).alias("n"),
            F.sum(away).cast("double").alias("sum"),
            F.sum(_square(away)).cast("double").alias("squares"),
        )
    ).scalar()
    n, total = stats["n"], stats["sum"]
    variance = F.when(n > 1, (stats["squares"] - total * total / n) / (n - 1))
    return F.when(
        variance > 0, (away.cast("double") - total / n) / F.sqrt(variance)
    ).otherwise(F.lit(0.0))


def quartile_bounds(df: DataFrame, column: str, approximate: int | None = None) -> DataFrame:
    """One row: the quartiles and the bounds beyond which a value is an outlier.

    Exact by default; ``approximate`` is the accuracy of Spark's ``percentile_approx``.
    """
    if approximate:
        quartiles = df.agg(
            F.percentile_approx(F.col(column).cast("double"), [0.25, 0.75], approximate).alias("q")
        ).select(F.get("q", F.lit(0)).alias("q1"), F.get("q", F.lit(1)).alias("q3"))
    else:
        quartiles = exact_quantiles(df, column, [0.25, 0.75]).toDF("q1", "q3")
    spread = F.col("q3") - F.col("q1")
    return quartiles.select(
        "q1",
        "q3",
        (F.col("q1") - IQR_REACH * spread).alias("lower_bound"),
        (F.col("q3") + IQR_REACH * spread).alias("upper_bound"),
    )


def iqr_flag(df: DataFrame, column: str, approximate: int | None = None) -> Column:
    """Strictly outside the bounds."""
    bounds = (
        quartile_bounds(df, column, approximate)
        .select(F.struct("lower_bound", "upper_bound"))
        .scalar()
    )
    x = F.col(column).cast("double")
    return (x < bounds["lower_bound"]) | (x > bounds["upper_bound"])


@dataclass
class Moments:
    """Rows of a table, and mean and divisor of its columns; a constant is divided by 1."""

    rows: int
    of: dict[str, tuple[float, float]]


def moments(df: DataFrame, columns: list[str]) -> Moments:
    """The moments of some columns, from exact sums in two passes."""
    sums = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"{c}_n") for c in columns],
        *[F.sum(_steps(df, c)).alias(f"{c}_sum") for c in columns],
    ).first()
    centers = {c: round(sums[f"{c}_sum"] / sums[f"{c}_n"]) if sums[f"{c}_n"] else 0 for c in columns}
    away = {
        c: (_steps(df, c) - F.lit(v).cast("decimal(19,0)")).cast("decimal(19,0)")
        for c, v in centers.items()
    }
    squares = df.agg(*[F.sum(_square(d)).alias(c) for c, d in away.items()]).first()
    of = {}
    for c in columns:
        n = sums[f"{c}_n"]
        if not n:
            of[c] = (0.0, 1.0)
            continue
        rest = int(sums[f"{c}_sum"]) - n * centers[c]
        unit = _unit(df, c)
        variance = (int(squares[c]) * n - rest * rest) / (n * n)
        of[c] = (int(sums[f"{c}_sum"]) / (n * unit), variance**0.5 / unit or 1.0)
    return Moments(sums["rows"], of)


def standard_scale(
    df: DataFrame, columns: list[str], fitted: Moments | None = None
) -> DataFrame:
    """Each column as ``<column>_scaled``: mean 0, population deviation 1; constants become 0.

    ``fitted`` are the moments to scale by, by default those of ``df`` itself.
    """
    fitted = fitted or moments(df, columns)
    return df.withColumns(
        {
            f"{c}_scaled": (F.col(c).cast("double") - F.lit(mean)) / F.lit(divisor)
            for c, (mean, divisor) in fitted.of.items()
        }
    )


def amount_flags(
    df: DataFrame, filled: DataFrame | None = None, approximate: int | None = None
) -> DataFrame:
    """z-score and quartile flags of the ledger amount; the statistics are taken over ``filled``."""
    filled = df if filled is None else filled
    return df.withColumns(
        {
            "amount_z_score": z_score(filled, "erp_amount"),
            "amount_iqr_anomaly": iqr_flag(filled, "erp_amount", approximate),
        }
    ).withColumn("amount_z_anomaly", F.abs("amount_z_score") >= Z_FROM)


def combine_flags(flagged: DataFrame) -> DataFrame:
    """How many detectors fired, and what that means together with the status."""
    fired = sum(
        F.coalesce(F.col(c).cast("int"), F.lit(0))
        for c in ("amount_z_anomaly", "amount_iqr_anomaly", "isolation_forest_anomaly")
    )
    potential, known = F.col("potential_anomaly"), F.col("known_exception")
    return (
        flagged.withColumn("anomaly_methods_triggered", fired)
        .withColumns(
            {
                "potential_anomaly": F.col("anomaly_methods_triggered") >= 1,
                "known_exception": ~F.col("reconciliation_status").eqNullSafe("MATCHED"),
            }
        )
        .withColumns(
            {
                "anomaly_status": F.when(potential, "POTENTIAL_ANOMALY").otherwise("NORMAL_RANGE"),
                "investigation_priority": F.when(potential & known, "HIGH")
                .when(potential, "MEDIUM")
                .when(known, "EXCEPTION_REVIEW")
                .otherwise("NORMAL"),
            }
        )
    )


def detect_anomalies(
    reconciliation: DataFrame,
    forest: bool = True,
    seed: int = 42,
    trees: int = 200,
    approximate: int | None = None,
) -> DataFrame:
    """The reconciliation columns (features null → 0), ten detector columns and the row order.

    ``forest=False`` leaves the isolation forest out: its columns are null and do not count.
    """
    filled = fill_features(reconciliation)
    if forest:
        from .forest import fit_forest

        model = fit_forest(filled, FEATURES, ORDER_COLUMNS, trees=trees, seed=seed)
        scored = model.score(filled, "isolation_forest_score").withColumn(
            "isolation_forest_anomaly", F.col("isolation_forest_score") < 0
        )
    else:
        scored = filled.withColumns(
            {
                "isolation_forest_score": F.lit(None).cast("double"),
                "isolation_forest_anomaly": F.lit(None).cast("boolean"),
            }
        )
    flagged = amount_flags(scored, filled, approximate)
    return combine_flags(flagged).select(
        *RECONCILIATION_COLUMNS, *ANOMALY_COLUMNS, *ORDER_COLUMNS
    )


def anomaly_totals(anomalies: DataFrame) -> DataFrame:
    """Flagged rows per detector."""
    return anomalies.agg(
        F.count_if("amount_z_anomaly").alias("z_score_anomalies"),
        F.count_if("amount_iqr_anomaly").alias("iqr_anomalies"),
        F.count_if("isolation_forest_anomaly").alias("isolation_forest_anomalies"),
        F.count_if("potential_anomaly").alias("potential_anomalies"),
    )


def anomaly_counts(anomalies: DataFrame) -> DataFrame:
    """Rows per anomaly status and investigation priority."""
    return anomalies.groupBy("anomaly_status", "investigation_priority").agg(
        F.count(F.lit(1)).alias("record_count")
    )
