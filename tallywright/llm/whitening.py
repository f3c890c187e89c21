"""Whitening of vectors by the exact spectrum of their scatter.

Entries are whole numbers, so counts, sums and sums of products are exact whatever the partitioning, and
the scatter n * sum(x x') - sum(x) sum(x)' is a whole-number matrix, the covariance times n^2. Its
characteristic polynomial is found modulo one prime per row of a small table, its greatest roots
and their vectors one per row of another (``spectrum``); the driver holds one matrix and one polynomial,
whose size follows the dimension and not the table.
"""

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spectrum
from .common import pa_schema, scratch
from .vectors import exact_type, is_finite, largest, longest, matrix, whole

COMPONENTS = 16
PRIMES_PER_TASK = 16


def sums_of_products(fit: DataFrame, width: int) -> np.ndarray:
    """Sums over all rows of the products of (1, x): count, sums and products, as whole numbers."""
    schema = "i int, j int, v decimal(38,0)"
    out = pa_schema(fit.sparkSession, schema)
    i, j = np.triu_indices(width + 1)

    def run(batches):
        total = np.zeros((width + 1, width + 1), dtype=object)
        for batch in batches:
            x = matrix(batch.column("__x"), width)
            x = np.column_stack([np.ones(len(x), dtype=np.int64), x])
            x = x.astype(exact_type(largest(x) ** 2 * max(1, len(x))))
            products = x.T @ x
            total = total + (products if products.dtype == object else products.astype(np.int64)).astype(object)
        values = [Decimal(int(v)) for v in total[i, j]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values, out.field("v").type)],
            schema=out,
        )

    # every task gives one row per entry, which are added up before and after the shuffle
    sums = fit.mapInArrow(run, schema).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((width + 1, width + 1), dtype=object)
    for r in sums:
        total[r.i, r.j] = total[r.j, r.i] = int(r.v)
    return total


def characteristic(spark, scatter: np.ndarray) -> list[int]:
    """Coefficients of the characteristic polynomial of a whole-number scatter, lowest power first."""
    bits = spectrum.coefficient_bits(int(np.trace(scatter)), len(scatter))
    primes = spectrum.primes_below(1 << 31, bits // 30 + 1)
    schema = "prime bigint, residues array<bigint>"
    out = pa_schema(spark, schema)
    tasks = -(-len(primes) // PRIMES_PER_TASK)

    def run(batches):
        for batch in batches:
            mine = batch.column("prime").to_pylist()
            if mine:
                found = spectrum.polynomials(scatter, mine).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mine), pa.array(found, out.field("residues").type)], schema=out
                )

    table = spark.createDataFrame([(i % tasks, q) for i, q in enumerate(primes)], "part int, prime bigint")
    dealt = table.repartitionById(tasks, F.col("part")).select("prime")
    found = dealt.mapInArrow(run, schema).collect()
    return spectrum.combine([r.prime for r in found], [r.residues for r in found])


def principal_components(spark, scatter: np.ndarray, most: int) -> tuple[list[Fraction], np.ndarray]:
    """The greatest ``most`` positive eigenvalues of a scatter and their vectors, one per column."""
    size = len(scatter)
    trace = int(np.trace(scatter)) if size else 0
    if trace == 0:
        return [], np.zeros((size, 0))
    coefficients = characteristic(spark, scatter)
    places = max(32, spectrum.BITS - trace.bit_length())
    positive = size - next(k for k, c in enumerate(coefficients) if c)
    wanted = min(most, positive)
    schema = "component int, cell string, vector array<double>"
    out = pa_schema(spark, schema)

    def run(batches):
        roots = spectrum.Roots(coefficients, places)
        for batch in batches:
            rows = []
            for place in batch.column("component").to_pylist():
                cell, before, count = roots.locate(place)
                # equal roots share a space, which the first of them finds for all
                if place == before + 1:
                    found = spectrum.null_vectors(scatter, cell, places, count, place)
                    rows += [(place + k, str(cell), found[:, k].tolist()) for k in range(count)]
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out
            )

    table = spark.createDataFrame([(i, i + 1) for i in range(wanted)], "part int, component int")
    dealt = table.repartitionById(wanted, F.col("part")).select("component")
    found = sorted(r for r in dealt.mapInArrow(run, schema).collect() if r.component <= wanted)
    values = [Fraction(2 * int(r.cell) + 1, 1 << (places + 1)) for r in found]
    return values, np.array([r.vector for r in found]).T


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exact; in the cheapest type that the sum of its squares fits."""
    bound = n * max(1, largest(x)) + max((abs(int(s)) for s in sums), default=0)
    kind = np.int64 if bound * bound * max(1, x.shape[1]) < 1 << 63 else object
    return x.astype(kind) * kind(n) - sums.astype(kind) if kind is np.int64 else x.astype(object) * n - sums


def identity_error(fit: DataFrame, width: int, n: int, sums: np.ndarray, weights: np.ndarray) -> float:
    """Largest entry of the covariance of the whitened fit list less the identity."""
    size = weights.shape[1] + 1
    out = pa_schema(fit.sparkSession, "i int, j int, v double")
    i, j = np.triu_indices(size)

    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            x = centred(matrix(batch.column("__x"), width), n, sums).astype(np.float64) / n
            w = np.column_stack([np.ones(len(x)), x @ weights])
            total += w.T @ w
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], schema=out
        )

    found = fit.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((size, size))
    for r in found.collect():
        total[r.i, r.j] = total[r.j, r.i] = r.v
    total /= n
    covariance = total[1:, 1:] - np.outer(total[0, 1:], total[0, 1:])
    return float(np.abs(covariance - np.eye(size - 1)).max())


def whiten(
    vectors: DataFrame,
    vector: str = "embedding",
    id_col: str = "vec_id",
    scale: int = 64,
    components: int = COMPONENTS,
) -> DataFrame:
    """Vectors as uncorrelated components of unit variance, those of greatest variance first.

    Each entry c becomes the whole number floor(``scale`` * c) + 1000000; the fit list holds each
    distinct vector once. Means, covariance (divisor n) and components are of the fit list; a constant
    that is added to all entries changes none of the results, so it is left out. One row per row of
    ``vectors`` and component: the id, component (from 1), n (length of the fit list), deviation (sum
    of (n * x - sums)^2, exact, DECIMAL(38,0)), whitened, explained (share of the variance) and
    identity_error (of the whitened fit list's covariance, the same everywhere).

    Rows with a null vector or a null or non-finite entry give none. Shorter vectors count as ended by
    entries of 0. Only components of positive variance are there: none for an empty table, one distinct
    vector, or empty vectors. Components of equal variance are any orthonormal basis of their space, the
    same for all rows; the greatest entry of a component is positive. Repeated rows and null ids are
    rows as any; extra columns do not matter.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = (
        "id " + id_type + ", component int, n bigint, deviation decimal(38,0), whitened double,"
        " explained double, identity_error double"
    )
    rows = vectors.where(is_finite(vector)).select(
        F.col(id_col).alias("__id"), whole(vector, scale).alias("__x")
    )
    _, width = longest(rows, "__x")
    padded = F.concat("__x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("__x")))
    rows = rows.withColumn("__x", padded)
    fit = scratch(rows.select("__x").distinct(), "distinct-vectors")
    products = sums_of_products(fit, width)
    n, sums = int(products[0, 0]), products[0, 1:]
    scatter = n * products[1:, 1:] - np.outer(sums, sums)
    values, axes = principal_components(spark, scatter, components)
    names = [id_col, *[part.split()[0] for part in schema.split(", ")[1:]]]
    if not values:
        return spark.createDataFrame([], schema).toDF(*names)

    trace = int(np.trace(scatter))
    weights = axes / np.sqrt([float(v / n**2) for v in values])
    explained = np.array([float(v / trace) for v in values])
    error = identity_error(fit, width, n, sums, weights)
    size = len(values)
    out = pa_schema(spark, schema)

    def run(batches):
        for batch in batches:
            x = centred(matrix(batch.column("__x"), width), n, sums)
            squares = (x * x).sum(axis=1)
            if squares.dtype == object:
                deviation = pa.array([Decimal(int(v)) for v in squares], pa.decimal128(38, 0))
            else:
                deviation = pa.array(squares).cast(pa.decimal128(38, 0))
            whitened = (x.astype(np.float64) / n) @ weights
            take = np.repeat(np.arange(len(x)), size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__id").take(pa.array(take)),
                    pa.array(np.tile(np.arange(1, size + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(take), n)),
                    deviation.take(pa.array(take)),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(take), error)),
                ],
                schema=out,
            )

    return rows.mapInArrow(run, schema).toDF(*names)
