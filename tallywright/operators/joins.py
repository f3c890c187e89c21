"""Equi joins that survive a key holding a large share of the rows.

Every lookup here joins many left rows to at most one right row per key. The heavy keys of the left
side are taken from the statistics stored with its table (``keystats``), so that building a lookup runs
nothing; without them, one pass over the key column finds them first. Left rows of a heavy key, and
those without a key, are dealt over all partitions and find their right row in a broadcast of the heavy
keys' right rows: ``MAX_HEAVY`` and one at most, whatever the tables hold. All others meet their right
row on the plain key, so a right side that is one row per key by an aggregation or a window keeps the
partitioning that this left. Statistics only decide which way a row goes: results do not depend on
them.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keystats import LISTED as MAX_HEAVY
from .keystats import KeyStats, sketch_keys

MIN_ROWS = 10_000
_DEALT = 1 << 20


def heavy_keys(df: DataFrame, key: str, stats: KeyStats | None = None) -> list:
    """The heavy keys, ``MAX_HEAVY`` at most. Without ``stats`` a pass over the column finds them.

    Heavy is a key with at least ``MIN_ROWS`` rows that fill a quarter of a mean shuffle partition,
    or a ``MAX_HEAVY``th of the table where partitions are very many.
    """
    if stats is None:
        stats = KeyStats.of(sketch_keys(df, [key]), [key])
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stats.above(key, MIN_ROWS, min(MAX_HEAVY, 4 * parts))


def deal(df: DataFrame, key: str, heavy: list, row_id: list[str]) -> DataFrame:
    """Add ``_dealt``, whether the key is heavy or null, and ``_key``, which is the key or, for
    dealt rows, a number from ``row_id``, which names a unique row number."""
    dealt = F.col(key).isNull() | F.col(key).isin(heavy)
    spread = F.pmod(F.xxhash64(*row_id), F.lit(_DEALT)).cast(df.schema[key].dataType)
    return df.withColumn("_dealt", dealt).withColumn(
        "_key", F.when(F.col("_dealt"), spread).otherwise(F.col(key))
    )


def _named(right: DataFrame, prefix: str) -> DataFrame:
    """All columns under names of their own, and whether there is a row."""
    named = [F.col(c).alias(f"{prefix}{c}") for c in right.columns]
    return right.select(*named, F.lit(True).alias(f"{prefix}_found"))


def look_up(
    left: DataFrame,
    key: str,
    rights: list[DataFrame],
    row_id: list[str],
    how: str = "left",
    keyless: tuple[int, ...] = (),
    stats: KeyStats | None = None,
) -> DataFrame:
    """Join ``left`` to each of ``rights``; each right has a unique column ``_key``.

    ``keyless`` numbers the rights that may hold a row whose ``_key`` is null; null keys match it, and
    match nothing in the others, which must hold none. ``how`` is left, inner or
    left_anti (found in none of ``rights``). All joins use the same key, so ``left`` is shuffled once.
    ``stats`` are statistics of ``key`` in ``left`` or in the table that it was taken from.
    """
    if how not in ("left", "inner", "left_anti"):
        raise ValueError(f"how must be left, inner or left_anti, not {how}")
    heavy = heavy_keys(left, key, stats)
    rows = deal(left, key, heavy, row_id)
    found: list[Column] = []
    columns: list[Column] = []
    for i, right in enumerate(rights):
        plain = _named(right, f"_p{i}_")
        meets = (F.col("_key") == F.col(f"_p{i}__key")) & ~F.col("_dealt")
        rows = rows.join(plain, meets, "left")
    for i, right in enumerate(rights):
        here = [F.col(f"_p{i}__found").isNotNull()]
        few = [F.col("_key").isin(heavy)] if heavy else []
        few += [F.col("_key").isNull()] if i in keyless else []
        names = [c for c in right.columns if c != "_key"]
        if few:
            rest = _named(right.where(reduce(lambda a, b: a | b, few)), f"_h{i}_")
            rows = rows.join(F.broadcast(rest), F.col(key).eqNullSafe(F.col(f"_h{i}__key")), "left")
            here.append(F.col(f"_h{i}__found").isNotNull())
            columns += [F.coalesce(f"_p{i}_{c}", f"_h{i}_{c}").alias(c) for c in names]
        else:
            columns += [F.col(f"_p{i}_{c}").alias(c) for c in names]
        found.append(reduce(lambda a, b: a | b, here))
    if how == "left_anti":
        return rows.where(~reduce(lambda a, b: a | b, found)).select(*left.columns)
    if how == "inner":
        rows = rows.where(reduce(lambda a, b: a & b, found))
    return rows.select(*left.columns, *columns)
