"""Benchmark decontamination: size-partitioned MinHash containment search.

A benchmark item is found in a document that holds at least a given share of its word shingles,
whatever the document's length. Items are partitioned by size. An item's signature is its least
shingle hashes, as many as its partition needs for a document that holds enough of the item to
hold one of them at least: the search loses nothing. Documents are first joined with the signatures
alone, which gives the candidates; only these are verified, by the exact share of shingles that they
hold. An item of fewer words than a shingle is one shingle of all its words.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY, scratch, with_key

SHINGLE = 5
CONTAINMENT = 0.8
BROADCAST_ROWS = 100_000  # item shingles up to which they are sent to every executor


def word_list(text: Column) -> Column:
    """Words in lower case: runs of letters, marks and digits of any script."""
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " ")), " ")


def shingles(df: DataFrame, size: int) -> DataFrame:
    """Every shingle of every row, repeats included: the other columns, ``s`` (words joined by a
    blank) and ``h``, its hash. Rows with fewer words than ``size`` have none."""
    others = [c for c in df.columns if c != "text"]
    words = df.select(*others, word_list(F.col("text")).alias("w")).where(F.size("w") >= size)
    starts = F.slice(F.col("w"), F.lit(1), F.size("w") - size + 1)
    shifted = [starts] + [
        F.slice(F.col("w"), F.lit(i + 1), F.size("w") - size + 1) for i in range(1, size)
    ]
    zipped = F.arrays_zip(*[c.alias(f"w{i}") for i, c in enumerate(shifted)])
    names = [f"w{i}" for i in range(size)]
    rows = words.select(*others, F.inline(zipped).alias(*names))
    return rows.select(*others, F.xxhash64(*names).alias("h"), F.concat_ws(" ", *names).alias("s"))


def item_shingles(items: DataFrame, size: int) -> DataFrame:
    """Distinct shingles of the items: item, k (words of a shingle), h, s. Items without words have
    none."""
    words = F.size(word_list(F.col("text"))).alias("words")
    measured = items.select("item", "text", words).where(F.regexp_like("text", F.lit(r"[\p{L}\p{M}\p{N}]")))
    parts = [
        shingles(measured.where(F.least("words", F.lit(size)) == k).select("item", "text"), k)
        .withColumn("k", F.lit(k))
        .select("item", "k", "h", "s")
        for k in range(1, size + 1)
    ]
    return reduce(DataFrame.union, parts).distinct()


def item_index(items: DataFrame, size: int, containment: float) -> DataFrame:
    """Distinct shingles of the items: item key, k, n (how many it has), h, s, signed.

    Partitions by size hold items of 2^i to 2^(i+1) - 1 shingles. With n shingles, a document that
    holds ceil(c n) of them lacks n - ceil(c n) at most; one more of the least hashes cannot all be
    lacking. Each partition takes what its largest size needs.
    """
    by_item = Window.partitionBy("item")
    ranked = (
        item_shingles(items, size)
        .withColumn("n", F.count(F.lit(1)).over(by_item))
        .withColumn("place", F.row_number().over(by_item.orderBy("h", "s")))
    )
    top = F.pow(F.lit(2), F.floor(F.log2("n")) + 1) - 1
    needed = top - F.ceil(top * containment - 1e-9) + 1
    return ranked.select("item", "k", "n", "h", "s", (F.col("place") <= needed).alias("signed"))


def _hits(docs: DataFrame, index: DataFrame, sizes: list[int]) -> DataFrame:
    """A row for every shingle of ``docs`` that is in ``index``, sent to all executors up to
    ``BROADCAST_ROWS`` rows."""
    if index.count() <= BROADCAST_ROWS:
        index = F.broadcast(index)
    found = [
        shingles(docs, k)
        .select(KEY, F.lit(k).alias("dk"), F.col("h").alias("dh"), F.col("s").alias("ds"))
        .join(index, (F.col("dh") == F.col("h")) & (F.col("ds") == F.col("s")) & (F.col("dk") == F.col("k")))
        for k in sizes
    ]
    return reduce(DataFrame.union, found)


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = SHINGLE,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Pairs of document and benchmark item where the document holds at least ``containment`` of the
    item's distinct shingles.

    Columns: __row_key, doc_id, item_id, n_shingles, n_held, containment. Null texts, and texts without
    words, are in no pair. An item of fewer words than ``size`` is found where its words stand in a row.
    Items with the same id are searched one by one and may give repeated pairs, as may documents; row
    keys tell documents apart. Empty tables give no rows. Indexes of up to ``BROADCAST_ROWS`` item
    shingles, counted first, are sent to all executors; beyond, the same rows come from a shuffled join.
    """
    numbered = scratch(
        benchmark.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()),
        "benchmark",
    )
    index = scratch(item_index(numbered.select("item", "text"), size, containment), "items")
    # ``size`` at most
    sizes = sorted(r.k for r in index.select("k").distinct().collect()) or [size]
    keyed = with_key(docs)
    texts = keyed.select(KEY, "text")
    signed = index.where("signed").select("item", "k", "h", "s")
    candidates = scratch(
        _hits(texts, signed, sizes).select(F.col(KEY).alias("c_key"), F.col("item").alias("c_item")).distinct(),
        "candidates",
    )
    near = texts.join(candidates.select("c_key").distinct(), F.col(KEY) == F.col("c_key"), "left_semi")
    wanted = index.join(candidates.select("c_item").distinct(), F.col("item") == F.col("c_item"), "left_semi")
    # one row per document, item and shingle, before they are counted
    found = (
        _hits(near, scratch(wanted, "candidate-items"), sizes)
        .join(candidates, (F.col(KEY) == F.col("c_key")) & (F.col("item") == F.col("c_item")), "left_semi")
        .select(KEY, "item", "n", "h", "s")
        .distinct()
        .groupBy(KEY, "item", "n")
        .agg(F.count(F.lit(1)).alias("n_held"))
        .where(F.col("n_held") >= F.col("n") * containment - 1e-9)
    )
    ids = keyed.select(F.col(KEY).alias("k2"), "doc_id")
    return (
        found.join(numbered.select(F.col("item").alias("i2"), "item_id"), F.col("item") == F.col("i2"))
        .join(ids, F.col(KEY) == F.col("k2"))
        .select(
            KEY,
            "doc_id",
            "item_id",
            F.col("n").alias("n_shingles"),
            "n_held",
            (F.col("n_held") / F.col("n")).alias("containment"),
        )
    )
