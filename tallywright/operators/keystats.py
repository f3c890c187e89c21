"""Frequent keys as statistics of a table: sketched once, stored beside it, merged, read by lookups.

For each key column one mergeable frequent-items sketch (some kilobytes) and the number of rows that
have the key. The sketches of parts of a table, such as of one load a day, combine to those of the whole.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LISTED = 1024
_TRACKED = 8192
_MERGERS = 256


def sketch_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: for each of ``keys`` its sketch, and the rows that have it as ``<key>_rows``.

    One narrow pass for all keys; two rounds, so that no task merges the sketches of all scan tasks.
    """
    # one row more, as sketches of no rows cannot be merged; nulls are left out of the estimate
    nothing = [F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys]
    rows = df.select(*keys).union(df.sparkSession.range(1).select(*nothing))
    parts = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(_MERGERS)).alias("_merger")).agg(
        *[F.expr(f"approx_top_k_accumulate(`{k}`, {_TRACKED})").alias(k) for k in keys],
        *[F.count(k).alias(f"{k}_rows") for k in keys],
    )
    return combine_sketches(parts, keys)


def combine_sketches(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``parts``, sketches of parts of a table, as one."""
    # grouped, as an ungrouped sketch of a partition without rows cannot be merged
    return (
        parts.withColumn("_all", F.lit(True))
        .groupBy("_all")
        .agg(
            *[F.expr(f"approx_top_k_combine(`{k}`, {_TRACKED})").alias(k) for k in keys],
            *[F.sum(f"{k}_rows").alias(f"{k}_rows") for k in keys],
        )
        .drop("_all")
    )


@dataclass(frozen=True)
class KeyStats:
    """Rows per key column, and its frequent keys with their estimated rows, most frequent first."""

    rows: dict[str, int]
    top: dict[str, list[tuple[object, int]]]

    @staticmethod
    def of(sketches: DataFrame, keys: list[str]) -> "KeyStats":
        """Read the one row of ``sketch_keys`` or ``combine_sketches``."""
        found = sketches.select(
            *[F.expr(f"approx_top_k_estimate(`{k}`, {LISTED + 1})").alias(k) for k in keys],
            *[f"{k}_rows" for k in keys],
        ).first()
        top = {k: [(x["item"], x["count"]) for x in found[k] if x["item"] is not None] for k in keys}
        return KeyStats({k: found[f"{k}_rows"] for k in keys}, top)

    def above(self, key: str, rows: int, share: int) -> list:
        """The keys of at least ``rows`` rows that are a ``share``-th of all; ``LISTED`` at most."""
        bar = max(rows, self.rows[key] / share)
        return [item for item, n in self.top[key][:LISTED] if n >= bar]


def write_sketches(df: DataFrame, keys: list[str], path: str) -> None:
    sketch_keys(df, keys).write.mode("overwrite").parquet(path)


def read_sketches(spark: SparkSession, paths: list[str], like: DataFrame, keys: list[str]) -> KeyStats:
    """The statistics of a table whose parts have their sketches at ``paths``."""
    schema = sketch_keys(like, keys).schema
    parts = reduce(DataFrame.union, [spark.read.schema(schema).parquet(p) for p in paths])
    return KeyStats.of(parts if len(paths) == 1 else combine_sketches(parts, keys), keys)
