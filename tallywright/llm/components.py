"""Connected components of an edge table by alternating large-star and small-star rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` can reach.

    Nodes may be of any ordered type. Null ends and loops are ignored; repeated edges and both
    directions are fine; no edges give no rows. Each round is two aggregations by node and two
    joins, none of which gathers a neighbourhood in one task, and its edges are written to the
    shared folder. Rounds grow with the logarithm of the longest path.
    """
    now = scratch(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    seen = _digest(now)
    while seen[0]:
        now = scratch(_small_star(_large_star(now)), "edges")
        before, seen = seen, _digest(now)
        if seen == before:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)


def _digest(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to its smallest neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u != v").union(least.select("u", F.col("m").alias("v"))).distinct()
