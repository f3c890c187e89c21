"""Eigenvalues and eigenvectors of a whole-number symmetric matrix, by its exact characteristic
polynomial.

The polynomial is found modulo many primes (reduction to Hessenberg form, then the recurrence over its
leading minors) and put together by Chinese remaindering. All its roots are real, so the number of roots
above a point is exactly the number of sign changes in the coefficients of the polynomial shifted to
that point; this isolates every root, and bisection by sign makes it as precise as wanted. Vectors are
solved for in the null space of the matrix less the root, by inverse iteration in fixed-point numbers.
"""

from fractions import Fraction
from math import comb

import numpy as np

BITS = 192  # of a root, whole and fractional digits together


def primes_below(limit: int, count: int) -> list[int]:
    """The ``count`` greatest primes under ``limit`` (2^31 at most)."""
    small = np.ones(1 << 16, dtype=bool)
    small[:2] = False
    for i in range(2, 1 << 8):
        if small[i]:
            small[i * i :: i] = False
    small = np.flatnonzero(small)
    found: list[int] = []
    top, span = limit, 1 << 18
    while len(found) < count and top > 2:
        low = max(2, top - span)
        sieve = np.ones(top - low, dtype=bool)
        for p in small[small.astype(np.int64) ** 2 < top].tolist():
            sieve[max(p * p, -(-low // p) * p) - low :: p] = False
        found += (np.flatnonzero(sieve)[::-1] + low).tolist()
        top = low
    if len(found) < count:
        raise ValueError("more primes are needed than there are below the limit")
    return found[:count]


def coefficient_bits(trace: int, size: int) -> int:
    """Bits that hold any coefficient of the characteristic polynomial of a matrix without negative
    eigenvalues: the kth is at most comb(size, k) * (trace / size)^k."""
    most = max(comb(size, k) * Fraction(trace, size) ** k for k in range(size + 1)) if size else 1
    return int(most).bit_length() + 2


def polynomials(matrix: np.ndarray, primes: list[int]) -> np.ndarray:
    """Coefficients, lowest power first, of the characteristic polynomial modulo each prime."""
    size = len(matrix)
    p = np.array(primes, dtype=np.int64)
    a = np.stack([(matrix % q).astype(np.int64) for q in primes]) if size else np.zeros((len(p), 0, 0))
    wide, every = p[:, None], np.arange(len(p))
    for k in range(1, size - 1):
        # the first row from k on that is not zero in column k - 1 is brought to place k
        pivot = k + np.argmax(a[:, k:, k - 1] != 0, axis=1)
        rows = a[every, pivot].copy()
        a[every, pivot], a[:, k] = a[:, k].copy(), rows
        columns = a[every, :, pivot].copy()
        a[every, :, pivot], a[:, :, k] = a[:, :, k].copy(), columns
        lead = a[:, k, k - 1]
        inverse = np.array([pow(int(v), -1, q) if v else 0 for v, q in zip(lead, primes)], dtype=np.int64)
        factor = a[:, k + 1 :, k - 1] * inverse[:, None] % wide
        a[:, k + 1 :] = (a[:, k + 1 :] - factor[:, :, None] * a[:, k, None, :]) % p[:, None, None]
        added = (a[:, :, k + 1 :] * factor[:, None, :] % p[:, None, None]).sum(axis=2)
        a[:, :, k] = (a[:, :, k] + added) % wide

    done = np.zeros((size + 1, len(p), size + 1), dtype=np.int64)
    done[0, :, 0] = 1
    for k in range(1, size + 1):
        last = done[k - 1]
        new = np.zeros_like(last)
        new[:, 1:] = last[:, :-1]
        new = (new - a[:, k - 1, k - 1, None] * last) % wide
        below = np.ones(len(p), dtype=np.int64)
        for i in range(1, k):
            below = below * a[:, k - i, k - i - 1] % p
            weight = a[:, k - i - 1, k - 1] * below % p
            new = (new - weight[:, None] * done[k - i - 1]) % wide
        done[k] = new
    return done[size]


def combine(primes: list[int], residues: list[list[int]]) -> list[int]:
    """Whole numbers between minus and plus half the product of ``primes`` with these residues."""
    product = 1
    for q in primes:
        product *= q
    weights = [product // q * pow(product // q, -1, q) for q in primes]
    values = [sum(w * r for w, r in zip(weights, column)) % product for column in zip(*residues)]
    return [v - product if v > product // 2 else v for v in values]


class Roots:
    """The real roots of a polynomial without other ones, on a grid of 2^-``places``."""

    def __init__(self, coefficients: list[int], places: int):
        size = len(coefficients) - 1
        self.places, self.size = places, size
        self.scaled = [c << (places * (size - k)) for k, c in enumerate(coefficients)]
        self.zeros = next((k for k, c in enumerate(coefficients) if c), size)
        # no root is beyond the sum, which is the next coefficient but for its sign
        self.top = (-coefficients[size - 1] + 1) << places if size else 0

    def above(self, point: int) -> int:
        """How many roots are above a grid point, each as often as it occurs."""
        c = list(self.scaled)
        for i in range(self.size):
            for k in range(self.size - 1, i - 1, -1):
                c[k] += point * c[k + 1]
        signs = [v > 0 for v in c if v]
        return sum(a != b for a, b in zip(signs, signs[1:]))

    def sign(self, point: int) -> int:
        value = 0
        for c in reversed(self.scaled):
            value = value * point + c
        return (value > 0) - (value < 0)

    def locate(self, place: int) -> tuple[int, int, int]:
        """(grid point, roots above the next one, roots in the grid cell) of the root at ``place``,
        from 1 for the greatest on: the root lies above the point, and not above the next one."""
        low, high = -1, self.top
        more, fewer = self.size, 0  # roots above low, above high
        while high - low > 1 and more - fewer > 1:
            middle = (low + high) // 2
            count = self.above(middle)
            if count >= place:
                low, more = middle, count
            else:
                high, fewer = middle, count
        above = -1 if fewer % 2 else 1
        while high - low > 1:
            middle = (low + high) // 2
            sign = self.sign(middle)
            if sign == above or not sign:
                high = middle
            else:
                low = middle
        return low, fewer, more - fewer


def null_vectors(matrix: np.ndarray, cell: int, places: int, count: int, seed: int) -> np.ndarray:
    """``count`` orthonormal vectors for the eigenvalue in the middle of a grid cell, one per column.

    Two rounds of inverse iteration from pseudo-random vectors. A cell is far narrower than the gap to
    other eigenvalues, so each round removes their share but for 2^-places or so.
    """
    size = len(matrix)
    digits = places + 65
    a = np.array([[int(v) << digits for v in row] for row in matrix], dtype=object)
    for i in range(size):
        a[i, i] -= (2 * cell + 1) << (digits - places - 1)
    order = list(range(size))
    for k in range(size):
        best = max(range(k, size), key=lambda i: abs(a[i, k]))
        if best != k:
            a[[k, best]] = a[[best, k]]
            order[k], order[best] = order[best], order[k]
        if a[k, k] == 0:
            a[k, k] = 1
        for i in range(k + 1, size):
            factor = (a[i, k] << digits) // a[k, k]
            if factor:
                a[i, k + 1 :] -= (a[k, k + 1 :] * factor) >> digits
            a[i, k] = factor
    vectors = np.random.default_rng(seed).standard_normal((size, count))
    for _ in range(2):
        solved = []
        for column in vectors.T:
            b = np.array([int(v * (1 << 60)) for v in column], dtype=object)[order] << (digits - 60)
            for k in range(size):
                b[k + 1 :] -= (a[k + 1 :, k] * b[k]) >> digits
            for k in reversed(range(size)):
                b[k] = (b[k] << digits) // a[k, k]
                b[:k] -= (a[:k, k] * b[k]) >> digits
            longest = max(abs(v) for v in b) or 1
            solved.append([float(Fraction(v, longest)) for v in b])
        vectors = np.linalg.qr(np.array(solved).T)[0]
    peak = np.argmax(np.abs(vectors), axis=0)
    return vectors * np.sign(vectors[peak, np.arange(count)])
