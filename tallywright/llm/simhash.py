"""SimHash near duplicates found with tables of pivot distances.

A pivot is a reference fingerprint. Every distinct fingerprint gets its Hamming distances to the zero
pivot and to pivots whose bits lie in one of four segments. What a segment's pivots give beyond the
zero pivot depends on the bits of that segment alone, so two fingerprints that differ in at most two
bits agree in all coordinates of at least two segments. Fingerprints meet on those coordinates; a
pair whose coordinates differ by more than the limit anywhere is discarded, and the rest is verified
bit by bit. Where a great many fingerprints meet on one key, they are linked without pairs: each
stands under its own code and those one bit away, and those under one code are two bits apart at most.
"""

import random
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KEY, scratch, texts, with_key
from .components import connected_components

SHINGLE = 3
MAX_BITS = 2
CROWD = 64  # fingerprints under one key beyond which they are linked by codes
_SEGMENTS, _PER_SEGMENT = 4, 12


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text, as a signed number; 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    line = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends - 1).tolist()
    if len(words) < size:
        spans = [(0, len(line))]
    else:
        spans = zip(starts, stops[size - 1 :], strict=False)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], 42) for a, b in spans], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65_536):
        bits = np.unpackbits(h[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0]
    return int(value.astype("<i8"))


def pivots() -> list[list[int]]:
    """Reference fingerprints by segment, all their bits inside the segment."""
    draw, width = random.Random(7), 64 // _SEGMENTS
    return [
        [draw.randrange(1, 1 << width) << (s * width) for _ in range(_PER_SEGMENT)]
        for s in range(_SEGMENTS)
    ]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _coordinates(fp: Column) -> list[list[Column]]:
    zero = F.bit_count(fp)
    return [[F.bit_count(fp.bitwiseXOR(F.lit(_signed(p)))) - zero for p in s] for s in pivots()]


def links(prints: DataFrame, max_bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``), enough to join all that differ in
    at most ``max_bits`` bits (1 or 2): within crowds a star instead of every pair."""
    if max_bits not in (1, 2):
        raise ValueError("max_bits must be 1 or 2")
    by_segment = _coordinates(F.col("fp"))
    keys = [
        F.xxhash64(F.lit(n), *by_segment[i], *by_segment[j])
        for n, (i, j) in enumerate(combinations(range(_SEGMENTS), 2))
    ]
    met = prints.select("fp", F.explode(F.array(*keys)).alias("k"))
    sizes = met.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = met.join(sizes, "k")
    few, many = met.where(F.col("n") <= crowd), met.where(F.col("n") > crowd)

    a, b = F.col("a"), F.col("b")
    pairs = few.select("k", F.col("fp").alias("a")).join(few.select("k", F.col("fp").alias("b")), "k")
    far = F.greatest(
        F.abs(F.bit_count(a) - F.bit_count(b)),
        *[
            F.abs(F.bit_count(a.bitwiseXOR(F.lit(_signed(p)))) - F.bit_count(b.bitwiseXOR(F.lit(_signed(p)))))
            for s in pivots()
            for p in s
        ],
    )
    near = (
        pairs.where(a < b)
        .where(far <= max_bits)
        .where(F.bit_count(a.bitwiseXOR(b)) <= max_bits)
        .select("a", "b")
    )

    codes = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)]
    coded = many.select("fp").distinct().select("fp", F.explode(F.array(*codes)).alias("code"))
    if max_bits == 1:  # only the own code of one side may meet a code of the other
        own = coded.where("fp = code").select("code")
        starred = coded.join(own, "code").select(F.col("code").alias("a"), F.col("fp").alias("b"))
    else:
        starred = (
            coded.groupBy("code")
            .agg(F.sort_array(F.collect_set("fp")).alias("all"))  # 65 at most
            .where(F.size("all") > 1)
            .select(F.col("all")[0].alias("a"), F.explode(F.slice("all", 2, 64)).alias("b"))
        )
    return near.union(starred.where("a != b"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Fingerprint and component per row of ``docs`` (doc_id, text).

    Columns: __row_key, doc_id, fingerprint (16 hexadecimal digits), component_id (the least id that
    links reach), is_first (one row of each component, that of the least row key). Null and empty texts have fingerprint zero and are linked like others.
    Rows with the same text always share a component. An empty table gives no rows.
    """
    keyed = with_key(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    hashed = scratch(
        texts(
            keyed.select(KEY, "text", F.col("doc_id").alias("__id")),
            lambda key, text, doc: [(key, doc, fingerprint(text, shingle))],
            f"{KEY} bigint, doc_id {id_type}, fp bigint",
            ("__id",),
        ),
        "fingerprints",
    )
    prints = hashed.groupBy("fp").agg(F.min(F.struct(KEY, "doc_id")).alias("first"))
    parts = connected_components(links(prints.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    least = (
        prints.join(parts, "fp")
        .groupBy("component")
        .agg(F.min("first").alias("least"))
        .join(parts, "component")
        .select("fp", "least")
    )
    # written, so that the join of a fingerprint with very many rows can be split
    classes = scratch(
        prints.join(least, "fp", "left").select("fp", F.coalesce("least", "first").alias("least")),
        "classes",
    )
    return hashed.join(classes, "fp").select(
        KEY,
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least")["doc_id"].alias("component_id"),
        (F.col(KEY) == F.col("least")[KEY]).alias("is_first"),
    )
