"""Hard negatives and whitening against plain results."""

import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.llm import spectrum
from tallywright.llm.hard_negatives import Block, hard_negatives, window_of
from tallywright.llm.queries import QUERIES
from tallywright.llm.whitening import whiten

SMALL = "/root/testdata/sf0.001"
TABLE = "vec_id bigint, embedding array<float>, label int, n int, id string, score string, __row_key int, rank int"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def odd_vectors(spark):
    draw = np.random.default_rng(4)
    rows = [
        (i, draw.normal(0, 0.2, 6).astype(np.float32).tolist(), int(draw.integers(0, 3))) for i in range(300)
    ]
    rows += [(400 + i, rows[100][1], i % 3) for i in range(30)]  # copies of an anchor
    rows += [(200, rows[5][1], 1), (200, rows[5][1], 1), (7, rows[9][1], 2)]  # repeated ids
    rows += [(500, [0.0] * 6, 1), (600, [], 0), (700, [0.5, -0.25], 2), (800, [3e4] * 6, 0)]
    rows += [(900, None, 1), (901, [0.1, None, 0.2, 0.0, 0.0, 0.0], 1), (1000, [float("nan")] * 6, 1)]
    rows += [(1100, [float("inf")] * 6, 1), (1200, rows[3][1], None), (None, rows[8][1], 1)]
    return spark.createDataFrame([(*r, 1, "x", "y", 3, 4) for r in rows], TABLE)


def plain_negatives(rows, width, most=5):
    """Brute force; rows of one id count in the order of their whole-number vectors."""
    kept = []
    for i, v, label in rows:
        if label is not None and usable(v):
            x = [math.floor(256 * float(c)) for c in v]
            kept.append((i is not None, i if i is not None else 0, x + [0] * (width - len(x)), label))
    place = {k: n for n, k in enumerate(sorted(range(len(kept)), key=lambda k: kept[k][:2]))}
    ids = [k[1] if k[0] else None for k in kept]
    out = []
    for a, (there, i, x, label) in enumerate(kept):
        if not there or i % 100:
            continue
        scores = [sum(p * q for p, q in zip(x, k[2])) for k in kept]
        ranked = sorted((b for b in range(len(kept)) if b != a), key=lambda b: (-scores[b], place[b]))
        for p in [b for b in ranked if kept[b][3] == label][:most]:
            inside = [b for b in ranked if kept[b][3] != label
                      and 80 * scores[p] <= 100 * scores[b] <= 100 * scores[p]]
            out += [(i, ids[p], r + 1, ids[b], scores[p], scores[b]) for r, b in enumerate(inside[:most])]
    return out


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("block_rows", [4096, 37])
def test_negatives_of_odd_rows(spark, block_rows):
    df = odd_vectors(spark)
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = hard_negatives(df, F.col("vec_id") % 100 == 0, block_rows=block_rows).select(*COLUMNS)
    want = plain_negatives(rows, 6)
    # rows of one id and one vector may change places
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert len(want) > 20


def test_no_vectors(spark):
    df = odd_vectors(spark)
    for few in (df.limit(0), df.where("vec_id = 100"), df.where("vec_id = 900")):
        assert hard_negatives(few, F.col("vec_id") % 100 == 0).count() == 0
        assert whiten(few.where("vec_id IS NULL OR vec_id <> 0")).count() == 0


@pytest.mark.parametrize("scale", [1, 10**4, 10**7, 31 * 10**7])
def test_threshold_walk(scale):
    draw = np.random.default_rng(scale)
    rows = draw.integers(-5 * scale, 5 * scale, (500, 4)) * draw.integers(0, 2, (500, 4))
    block = Block(np.arange(500), list(range(500)), draw.integers(0, 3, 500), rows)
    exact = rows.astype(object)
    for a in range(60):
        scores = [int(s) for s in exact @ exact[a]]
        ranked = sorted((b for b in range(500) if b != a), key=lambda b: (-scores[b], b))
        same = [(b, b, scores[b]) for b in ranked if block.labels[b] == block.labels[a]][:5]
        assert block.positives(a, block.labels[a], rows[a], 5) == same
        windows = [window_of(s, 80, 100) for _, _, s in same if s >= 0]
        want = [
            (w, *one)
            for w, (low, high) in enumerate(windows)
            for one in [(b, b, scores[b]) for b in ranked
                        if block.labels[b] != block.labels[a] and low <= scores[b] <= high][:5]
        ]
        assert block.negatives(block.labels[a], rows[a], windows, 5) == want


def test_threshold_stops_early():
    draw = np.random.default_rng(1)
    rows = np.round(1000 / np.arange(1, 4001)[:, None] * draw.uniform(0.8, 1, (4000, 3))).astype(np.int64)
    block = Block(np.arange(4000), list(range(4000)), np.zeros(4000), rows)
    assert [r[0] for r in block.positives(-1, 0, rows[0], 2)][:1] == [0]
    assert block.scored < 400


def test_windows():
    assert window_of(100, 80, 100) == (80, 100)
    assert window_of(101, 80, 100) == (81, 101)
    assert window_of(0, 80, 100) == (0, 0)
    low, high = window_of(-10, 80, 100)
    assert low > high


# --- spectrum ------------------------------------------------------------------------------------


def test_primes():
    for limit, count in ((30, 10), (1 << 20, 300), (1 << 31, 50)):
        found = spectrum.primes_below(limit, count)
        assert found == sorted(found, reverse=True)[:count] and len(found) == count
        assert all(p < limit and all(p % q for q in range(2, min(p, math.isqrt(p) + 1))) for p in found[:20])
    assert spectrum.primes_below(30, 10) == [29, 23, 19, 17, 13, 11, 7, 5, 3, 2]
    with pytest.raises(ValueError):
        spectrum.primes_below(30, 11)


def plain_polynomial(m):
    """Faddeev-LeVerrier in fractions, lowest power first."""
    size = len(m)
    c, k = [Fraction(1)], np.array([[Fraction(0)] * size for _ in range(size)], dtype=object)
    eye = np.array([[Fraction(int(i == j)) for j in range(size)] for i in range(size)], dtype=object)
    for n in range(1, size + 1):
        k = m @ k + c[-1] * eye
        c.append(-sum((m @ k)[i, i] for i in range(size)) / n)
    return [int(x) for x in reversed(c)]


def scatters():
    draw = np.random.default_rng(3)
    for size, rows in ((1, 4), (2, 7), (5, 40), (7, 4), (9, 30)):
        x = draw.integers(-9, 9, (rows, size))
        if size == 5:
            x[:, 3] = x[:, 1]
        if size == 9:
            x[:, 4] = 0
        yield (rows * (x.T @ x) - np.outer(x.sum(0), x.sum(0))).astype(object)
    yield np.diag([5, 5, 5, 2, 2, 0]).astype(object)


def test_characteristic_polynomial_and_roots():
    for m in scatters():
        trace, size = int(np.trace(m)), len(m)
        primes = spectrum.primes_below(1 << 31, spectrum.coefficient_bits(trace, size) // 30 + 1)
        c = spectrum.combine(primes, spectrum.polynomials(m, primes).tolist())
        assert c == plain_polynomial(m)
        roots = spectrum.Roots(c, 100)
        values = np.linalg.eigvalsh(m.astype(float))[::-1]
        place = 1
        while place <= size - roots.zeros:
            cell, before, count = roots.locate(place)
            assert before == place - 1
            value = (2 * cell + 1) / 2**101
            assert np.allclose(values[before : before + count], value, rtol=1e-9)
            v = spectrum.null_vectors(m, cell, 100, count, place)
            assert np.abs(v.T @ v - np.eye(count)).max() < 1e-14
            assert np.abs(m.astype(float) @ v - value * v).max() < 1e-13 * trace
            place += count


# --- whitening -----------------------------------------------------------------------------------


def check_whitened(got, rows, width, scale=64, most=16):
    kept = []
    for i, v in rows:
        if usable(v):
            x = [math.floor(scale * float(c)) + 1_000_000 for c in v]
            kept.append((i, tuple(x + [1_000_000] * (width - len(x)))))
    fit = np.array(sorted({x for _, x in kept}), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values = np.linalg.eigvalsh(covariance)[::-1]
    size = min(most, int((values > 1e-9).sum()))
    assert len(got) == size * len(kept)
    by_id = {}
    for r in got:
        by_id.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-9
    w = []
    for i, x in kept:
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))
        mine = by_id[i, deviation]
        assert sorted(mine) == list(range(1, size + 1))
        w.append([mine[c][0].whitened for c in range(1, size + 1)])
    first = [{x: k for k, (_, x) in enumerate(kept)}[tuple(f)] for f in fit]
    fitted = np.array(w)[first]
    assert np.abs(fitted.T @ fitted / n - np.eye(size)).max() < 1e-9
    # components are eigenvectors: whitened values are linear in x, with these axes
    axes = np.linalg.lstsq(centred, fitted, rcond=None)[0] * np.sqrt(values[:size])
    if n > width:
        assert np.abs(covariance @ axes - axes * values[:size]).max() < 1e-8 * values[0]


def test_whitening_of_odd_rows(spark):
    df = odd_vectors(spark)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    check_whitened(whiten(df).collect(), rows, 6)
    check_whitened(whiten(df, components=2).collect(), rows, 6, most=2)


def test_whitening_of_few_and_of_equal_variances(spark):
    few = spark.createDataFrame(
        [(1, [0.1, 0.2, 0.3]), (2, [0.5, -0.2, 0.3]), (3, [0.5, -0.2, 0.3])],
        "vec_id bigint, embedding array<double>",
    )
    check_whitened(whiten(few).collect(), [(r.vec_id, r.embedding) for r in few.collect()], 3)
    cross = [(k, [s * float(a == b) for b in range(3)]) for k, (a, s) in enumerate((a, s) for a in range(3) for s in (1.0, -1.0))]
    equal = spark.createDataFrame(cross, "vec_id bigint, embedding array<double>")
    check_whitened(whiten(equal).collect(), cross, 3)


def test_whitening_query(spark):
    got = QUERIES["op12_whitening"](spark, SMALL)
    assert got.schema["deviation"].dataType.simpleString() == "bigint"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check_whitened(got.collect(), rows, 64)


def test_great_sums_are_exact():
    from tallywright.llm.whitening import centred

    x = np.array([[10**9, -(10**9)], [3, 4]], dtype=np.int64)
    sums = np.array([10**9 + 3, 4 - 10**9], dtype=object)
    found = centred(x, 2 * 10**6, sums)
    assert (found * found).sum(axis=1).tolist() == [
        sum((2 * 10**6 * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x
    ]
