"""Shared by the operators on vectors: which rows count, whole-number vectors, matrices of batches."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_finite(vector: str) -> Column:
    """Whether a vector is there and has no null, NaN or infinite entry."""
    inside = F.forall(
        vector, lambda v: F.coalesce(F.abs(v.cast("double")) < F.lit(float("inf")), F.lit(False))
    )
    return F.coalesce(F.col(vector).isNotNull() & inside, F.lit(False))


def whole(vector: str, scale: int) -> Column:
    """floor(scale * entry) of each entry, as BIGINT."""
    return F.transform(vector, lambda v: F.floor(v.cast("double") * F.lit(float(scale))))


def longest(rows: DataFrame, vector: str) -> tuple[int, int]:
    """Rows, and the length of the longest vector (0 where there is none)."""
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("d")).first()
    return found.n, found.d or 0


def matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """One row per list, ended by zeros where a list is shorter."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(len(lists), width)
    out = np.zeros((len(lists), width), dtype=np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def largest(values: np.ndarray) -> int:
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0


def exact_type(bound: int):
    """The cheapest type whose sums of products up to ``bound`` are exact."""
    for bits, kind in ((24, np.float32), (53, np.float64), (63, np.int64)):
        if bound < 1 << bits:
            return kind
    return object
