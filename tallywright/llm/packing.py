"""Packing token sequences: shortest-pack-first over the histogram of piece lengths.

Documents are tokenised once, cut at the sequence length, and only the histogram of piece lengths
reaches the driver. Lengths are placed longest first, always into the shortest pack that is open, as
counts of packing patterns; so the work there depends on the sequence length, not on the number of
documents. Patterns are joined back to the pieces by each piece's rank among those of its length.
"""

import base64
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY, scratch, texts, with_key

MAX_TOKENS = 2048
END_ID = 1
ROWS_PER_BUCKET = 50_000
_SPECIAL = "<|endoftext|>"
_LONG_RUN = 2_000  # characters without white space


class Tokens:
    """Ids of a text by the byte-level vocabulary file. The rank file beside it holds the same
    vocabulary, and its encoder gives the same ids several times faster; texts that hold the special
    token, or a very long run without white space, go to the vocabulary file's own encoder."""

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(vocabulary)
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )

    def ids(self, text: str) -> list[int]:
        odd = _SPECIAL in text or (
            len(text) > _LONG_RUN and max(map(len, text.split())) > _LONG_RUN
            if text.strip()
            else len(text) > _LONG_RUN
        )
        if odd:
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def pack_lengths(histogram: dict[int, int], limit: int) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns as (number of packs, piece lengths), which place every piece of the histogram."""
    # packs by fill: pattern -> count. Shortest pack first, so the emptiest fill comes up first.
    open_packs: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)

    def put(pattern, count):
        at = open_packs[sum(pattern)]
        at[pattern] = at.get(pattern, 0) + count

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            fill = min(open_packs, default=limit)
            if fill + length > limit:
                # a new pack takes as many of this length as fit, while there are enough
                each = min(limit // length, left)
                packs = left // each
                put((length,) * each, packs)
                left -= packs * each
                continue
            pattern, count = open_packs[fill].popitem()
            if not open_packs[fill]:
                del open_packs[fill]
            each = min((limit - fill) // length, max(1, left // count))
            packs = min(count, left // each)
            if packs < count:
                put(pattern, count - packs)
            put(pattern + (length,) * each, packs)
            left -= packs * each
    return [(n, p) for packs in open_packs.values() for p, n in packs.items()]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, sequence of the first rank, offset) for every place of every
    pattern; ranks of a length are dealt out in turn."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for count, pattern in sorted(patterns, key=lambda p: p[1], reverse=True):
        offset = 0
        for length in pattern:
            rows.append((length, used[length], used[length] + count - 1, sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    return rows


def pieces(
    docs: DataFrame, vocabulary: str, ranks: str, pattern: str, limit: int, end_id: int, keep_ids: bool
) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()

    class Cutter:
        def __init__(self):
            self.tokens = Tokens(vocabulary, ranks, pattern)

        def __call__(self, key, text, doc_id):
            ids = np.array([*self.tokens.ids(text), end_id], dtype="<u4")
            for at in range(0, len(ids), limit):
                part = ids[at : at + limit]
                row = (key, doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids))
                yield (*row, part.tolist()) if keep_ids else row

    schema = (
        f"{KEY} bigint, doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint,"
        " doc_tokens bigint" + (", ids array<bigint>" if keep_ids else "")
    )
    return texts(
        docs.select(KEY, "text", F.col("doc_id").alias("__id")), Cutter, schema, ("__id",)
    )


def pack(
    docs: DataFrame,
    vocabulary: str,
    ranks: str,
    pattern: str,
    limit: int = MAX_TOKENS,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """Place the tokens of every row of ``docs`` (doc_id, text) in sequences of at most ``limit``.

    One row per piece: __row_key, doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    and the ids if asked for. Null and empty texts are one end id. Repeated rows are packed each; an
    empty table gives no rows. A retried task gives the same places, as ranks are fixed by key and
    start.
    """
    spark = docs.sparkSession
    cut = scratch(
        pieces(with_key(docs), vocabulary, ranks, pattern, limit, end_id, keep_ids), "pieces"
    )
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.createDataFrame(
        slots(pack_lengths(counts, limit)),
        "p_length bigint, first bigint, last bigint, sequence bigint, offset bigint",
    )

    # rank among the pieces of a length, without gathering a length in one task
    buckets = max(16, sum(counts.values()) // ROWS_PER_BUCKET)
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64(KEY, "start"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select(
        F.col("length").alias("b_length"),
        F.col("bucket").alias("b_bucket"),
        (
            F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")
        ).alias("before"),
    )
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(KEY, "start"))
    ranked = (
        dealt.withColumn("inside", inside)
        .join(before, (F.col("length") == F.col("b_length")) & (F.col("bucket") == F.col("b_bucket")))
        .withColumn("rank", F.col("before") + F.col("inside") - 1)
    )
    # the table of places is bounded by the square of the sequence length, in practice far below
    return ranked.join(
        F.broadcast(places),
        (F.col("length") == F.col("p_length")) & F.col("rank").between(F.col("first"), F.col("last")),
    ).select(
        *cut.columns,
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"),
        "offset",
    )
