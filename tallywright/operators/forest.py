"""Isolation forest as a Spark job (Liu, Ting, Zhou 2008).

Each tree is grown by its own task from a sample of at most 256 rows, so the whole model is at most
``trees * 511`` nodes whatever the table holds; that is what is sent to the scoring tasks. Samples
are drawn by the md5 of the row id, and rows are sorted before a tree is grown: the same seed gives the
same forest under any partitioning and after any task retry.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .anomaly import Moments, moments, standard_scale
from .trees import NODES, decide, grow_tree

SAMPLE = 256
POOL = 65_536  # rows that the trees of a larger table draw from
PRIME = (1 << 31) - 1


def _draw(df: DataFrame, row_id: list[str], seed: int, at: int) -> Column:
    """A number from 0 to ``PRIME`` - 1 that eight digits of the row's md5 give, from digit ``at`` on."""
    text = F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in row_id])
    return F.conv(F.substring(F.md5(text), at, 8), 16, 10).cast("bigint") % PRIME


def draw_samples(
    df: DataFrame, row_id: list[str], rows: int, trees: int, seed: int
) -> DataFrame:
    """``df`` with a column ``tree``: ``min(256, rows)`` rows per tree, without replacement.

    One way for every size. Three numbers of a row come from the md5 of the seed and its id. Rows whose
    third number is below a share of them form a pool of about ``POOL`` rows (all rows of a smaller
    table). A tree takes the 256 rows of the pool with the least (first + tree * second) modulo
    ``PRIME``: in every tree these are independent uniform numbers, and those of two trees do not depend
    on each other. They are cut at four times the share that a tree needs, so few rows are ranked.
    Other systems that have md5 can draw the same rows.
    """
    pooled = df.withColumn("_third", _draw(df, row_id, seed, 17)).where(
        F.col("_third") < math.ceil(min(1.0, POOL / max(rows, 1)) * PRIME)
    )
    share = min(1.0, 4.0 * SAMPLE / max(1, min(rows, POOL)))
    drawn = (
        pooled.withColumn("_first", _draw(df, row_id, seed, 1))
        .withColumn("_second", _draw(df, row_id, seed, 9))
        .withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        .withColumn("_h", (F.col("_first") + F.col("tree") * F.col("_second")) % PRIME)
        .where(F.col("_h") < math.ceil(share * PRIME))
    )
    w = Window.partitionBy("tree").orderBy("_h", *row_id)
    ranked = drawn.withColumn("_rank", F.row_number().over(w))
    return ranked.where(F.col("_rank") <= SAMPLE).drop("_first", "_second", "_third", "_h", "_rank")


@dataclass
class Forest:
    """A fitted forest; each tree is the arrays feature, cut, children and depth."""

    scaling: Moments
    trees: list[tuple[np.ndarray, ...]]
    levels: int
    sample: int

    def score(self, df: DataFrame, name: str) -> DataFrame:
        """Add the decision as column ``name``; only the features travel to Python."""
        features = list(self.scaling.of)
        scaled = standard_scale(df, features, self.scaling)
        trees, levels, sample = self.trees, self.levels, self.sample

        @F.pandas_udf(DoubleType())
        def decision(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
                yield pd.Series(decide(trees, levels, sample, x))

        inputs = [f"{c}_scaled" for c in features]
        return scaled.withColumn(name, decision(*inputs)).drop(*inputs)


def fit_forest(
    df: DataFrame, features: list[str], row_id: list[str], trees: int = 200, seed: int = 42
) -> Forest:
    """Grow the forest; ``row_id`` names the columns that identify a row."""
    scaling = moments(df, features)
    rows = scaling.rows
    sample = min(SAMPLE, rows)
    inputs = [f"{c}_scaled" for c in features]
    drawn = draw_samples(df.select(*row_id, *features), row_id, rows, trees, seed)
    scaled = standard_scale(drawn, features, scaling).select("tree", *row_id, *inputs)
    # the samples are small, but growing a tree takes its time: spread the trees over the cores
    tasks = min(trees, df.sparkSession.sparkContext.defaultParallelism)
    scaled = scaled.repartition(tasks, "tree")

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(row_id)[inputs].to_numpy(dtype=float)
        return grow_tree(int(pdf["tree"].iloc[0]), x, seed)

    # at most trees * (2 * 256 - 1) nodes, whatever the table holds
    nodes = scaled.groupBy("tree").applyInPandas(grow, NODES).toPandas()
    grown = []
    for _, tree in nodes.sort_values(["tree", "node"]).groupby("tree"):
        children = np.empty(2 * len(tree), dtype=np.int64)
        children[0::2], children[1::2] = tree["low"], tree["high"]
        grown.append(
            (
                tree["feature"].to_numpy(dtype=np.int64),
                tree["cut"].to_numpy(dtype=float),
                children,
                tree["depth"].to_numpy(dtype=float),
            )
        )
    levels = math.ceil(math.log2(max(sample, 2)))
    return Forest(scaling, grown, levels, sample)
