"""One row per key, repeated keys, uniqueness checks and running numbers."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import look_up
from .keystats import KeyStats


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each non-null key.

    Rank 1 is pruned inside each map task before the shuffle, so a heavy key sends one row per
    task, not its whole group.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(w))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def last_by_priority(df: DataFrame, key: str, priority: Column, order: list[str]) -> DataFrame:
    """Per key (null is one key) the row of highest priority; ties go to the last row."""
    w = Window.partitionBy(key).orderBy(
        F.col("_priority").desc(), *[F.col(c).desc() for c in order]
    )
    return (
        df.withColumn("_priority", priority)
        .withColumn("_rank", F.row_number().over(w))
        .where(F.col("_rank") == 1)
        .drop("_rank", "_priority")
    )


def repeated_keys(df: DataFrame, key: str, keep: Column | None = None) -> DataFrame:
    """The keys held by more than one row (null is one key): ``_key``, ``copies``, ``lead``.

    ``lead`` is ``keep`` of the first row by ``src_row``.
    """
    lead = F.lit(None).cast("string") if keep is None else F.min_by(keep, F.col("src_row"))
    return (
        df.groupBy(F.col(key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("copies"), lead.alias("lead"))
        .where("copies > 1")
    )


def flag_repeated(
    df: DataFrame,
    key: str,
    row_id: list[str],
    name: str = "is_repeated",
    stats: KeyStats | None = None,
):
    """Mark every row whose key occurs more than once."""
    copies = repeated_keys(df, key).select("_key", F.lit(True).alias("_many"))
    return (
        look_up(df, key, [copies], row_id, keyless=(0,), stats=stats)
        .withColumn(name, F.coalesce("_many", F.lit(False)))
        .drop("_many")
    )


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Return ``df``, or raise when a key combination occurs twice."""
    twice = df.groupBy(*keys).count().where("count > 1").limit(1).take(1)
    if twice:
        raise ValueError(f"{keys} is not unique: {twice[0].asDict()}")
    return df


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """``df``, with a check inside the plan: where a key (null is one) has two rows, the job that reads
    them fails. Rows are aggregated on the key, which a join on it would bring together anyway."""
    others = [c for c in df.columns if c != key]
    held = F.first(F.struct(*others) if others else F.lit(True))
    problem = F.concat(
        F.lit(f"{key} is not unique: "), F.coalesce(F.col(key).cast("string"), F.lit("null"))
    )
    single = F.when(F.col("_rows") > 1, F.raise_error(problem)).otherwise(F.col(key))
    return (
        df.groupBy(key)
        .agg(held.alias("_held"), F.count(F.lit(1)).alias("_rows"))
        .select(*[single.alias(c) if c == key else F.col(f"_held.{c}").alias(c) for c in df.columns])
    )


def running_number(
    df: DataFrame, branch: str, row: str, name: str, width: int = 1 << 20
) -> DataFrame:
    """Number the rows 1..n in (branch, row) order without a one-task sort.

    ``row`` is unique within ``branch``, so a bucket of ``width`` consecutive values holds at most
    ``width`` rows. Buckets are themselves put in buckets of ``width``, and those again: no window
    sees more than ``width`` rows, however far the values of ``row`` are apart. Borders are plain
    arithmetic, so a retried task sees the same ones.
    """
    levels = ["_b1", "_b2", "_b3"]
    bucketed = df
    for above, level in zip([row, *levels], levels):
        bucketed = bucketed.withColumn(level, F.floor(F.col(above) / F.lit(width)))
    sizes = bucketed.groupBy(branch, *levels).agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select(branch, *levels, F.lit(0).cast("bigint").alias("_start"))
    for at, level in enumerate(levels):
        outer = levels[at + 1 :]
        if at:
            sizes = sizes.groupBy(branch, *levels[at:]).agg(F.sum("_size").alias("_size"))
        # the last window runs over the few outermost buckets of all branches
        w = Window.partitionBy(branch, *outer).orderBy(level) if outer else Window.orderBy(branch, level)
        before = F.sum("_size").over(w.rowsBetween(Window.unboundedPreceding, -1))
        offsets = sizes.select(
            branch, *levels[at:], F.coalesce(before, F.lit(0)).alias("_offset")
        )
        starts = (
            starts.join(offsets, [branch, *levels[at:]])
            .withColumn("_start", F.col("_start") + F.col("_offset"))
            .drop("_offset")
        )
    inside = Window.partitionBy(branch, *levels).orderBy(row)
    return (
        bucketed.join(starts, [branch, *levels])
        .withColumn(name, F.col("_start") + F.row_number().over(inside))
        .drop(*levels, "_start")
    )


def distinct_count(df: DataFrame, key: str) -> DataFrame:
    """Exact number of distinct non-null keys."""
    return df.agg(F.count_distinct(key).alias("distinct_count"))
