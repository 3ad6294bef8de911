"""Exact characteristic polynomial of an integer matrix, its real roots and
the null spaces at them.

Residues of the polynomial come from a reduction to Hessenberg form modulo
many 31-bit primes (all primes of a call at once, numpy); Chinese remaindering
gives the integer coefficients. For a polynomial with real roots only, the
number of roots above x is the number of sign changes among its Taylor
coefficients at x, multiple roots counted, so halving isolates every root
exactly.
"""

from __future__ import annotations

from decimal import Context, Decimal, localcontext
from math import comb

import numpy as np

ROOT_BITS = 256  # a root is known to 2**-ROOT_BITS of the bound on all roots
CLUSTER_BITS = 128  # roots nearer than 2**-CLUSTER_BITS of it count as one root, repeated
DIGITS = 180  # of the inverse iteration
STEPS = 3


def _is_prime(n: int) -> bool:
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 3, 5, 7):  # decides all n < 3,215,031,751
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_above(bound: int) -> list[int]:
    """31-bit primes, largest first, whose product exceeds ``bound``."""
    out, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def coefficient_bound(trace: int, d: int) -> int:
    """Above every coefficient's absolute value, for non-negative roots that
    sum to ``trace`` (Maclaurin's inequality)."""
    return max(comb(d, k) * (-(-trace ** k // d ** k)) for k in range(d + 1))


def _hessenberg(h: np.ndarray, p: np.ndarray) -> np.ndarray:
    """``h [primes, d, d]`` reduced modulo ``p [primes]``, by similarity."""
    d, q = h.shape[1], p[:, None, None]
    every = np.arange(len(p))
    for k in range(1, d - 1):
        pivot = k + (h[:, k:, k - 1] != 0).argmax(axis=1)
        swap, own = h[every, pivot].copy(), h[every, k].copy()
        h[every, k], h[every, pivot] = swap, own
        swap, own = h[every, :, pivot].copy(), h[every, :, k].copy()
        h[every, :, k], h[every, :, pivot] = swap, own
        # a column of zeros needs no step: pow() is not asked for its inverse
        inverse = np.array([pow(int(v), -1, int(m)) if v else 0 for v, m in zip(h[:, k, k - 1], p)])
        u = h[:, k + 1:, k - 1] * inverse[:, None] % p[:, None]
        h[:, k + 1:] = (h[:, k + 1:] - u[:, :, None] * h[:, k][:, None, :] % q) % q
        h[:, :, k] = (h[:, :, k] + (h[:, :, k + 1:] * u[:, None, :] % q).sum(axis=2)) % p[:, None]
    return h


def residues(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Coefficients (lowest first) of ``det(x - matrix)`` modulo each prime."""
    d, p = len(matrix), np.array(primes, dtype=np.int64)
    h = _hessenberg(np.array([[[v % m for v in row] for row in matrix] for m in primes], dtype=np.int64).reshape(len(primes), d, d), p)
    poly = np.zeros((len(primes), d + 1, d + 1), np.int64)
    poly[:, 0, 0] = 1
    q = p[:, None]
    for k in range(1, d + 1):
        new = np.zeros((len(primes), d + 1), np.int64)
        new[:, 1:] = poly[:, k - 1, :-1]
        new -= h[:, k - 1, k - 1][:, None] * poly[:, k - 1] % q
        below, factors = np.ones(len(primes), np.int64), []
        for i in range(k - 1, 0, -1):  # product of the subdiagonal times the column above it
            below = below * h[:, i, i - 1] % p
            factors.append(h[:, i - 1, k - 1] * below % p)
        if factors:
            f = np.stack(factors[::-1], axis=1)
            new -= (f[:, :, None] * poly[:, : k - 1] % q[:, :, None]).sum(axis=1)
        poly[:, k] = new % q
    return poly[:, d]


def combine(primes: list[int], rows: list[list[int]]) -> list[int]:
    """Integers of least absolute value with the given residues."""
    value, product = [0] * len(rows[0]), 1
    for p, row in zip(primes, rows):
        inverse = pow(product % p, -1, p)
        value = [v + product * ((r - v) * inverse % p) for v, r in zip(value, row)]
        product *= p
    return [v - product if 2 * v > product else v for v in value]


class Roots:
    """Roots of an integer polynomial (lowest coefficient first) whose roots
    are all real, non-negative and at most ``bound``. A root is ``y * 2**e``."""

    def __init__(self, coefficients: list[int], bound: int):
        zeros = next(k for k, c in enumerate(coefficients) if c)
        self.coefficients = coefficients[zeros:]  # roots at zero are left out
        self.positive = len(self.coefficients) - 1
        self.e = bound.bit_length() - ROOT_BITS
        d = self.positive
        self.scaled = [c << (self.e * k) if self.e >= 0 else c << (-self.e * (d - k)) for k, c in enumerate(self.coefficients)]

    def above(self, y: int) -> int:
        """Number of roots above ``y``, repeated ones counted."""
        c = list(self.scaled)
        for low in range(len(c) - 1):  # Taylor shift by repeated Horner steps
            for k in range(len(c) - 2, low - 1, -1):
                c[k] += c[k + 1] * y
        signs = [v > 0 for v in c if v]
        return sum(a != b for a, b in zip(signs, signs[1:]))

    def _sign(self, y: int) -> int:
        v = 0
        for c in reversed(self.scaled):
            v = v * y + c
        return (v > 0) - (v < 0)

    def locate(self, k: int) -> tuple[int, int, int]:
        """(y of the ``k``-th largest root, roots above its cluster, roots in it)."""
        low, high = 0, 1 << ROOT_BITS
        n_low, n_high = self.positive, 0
        while n_low - n_high > 1 and high - low > 1 << (ROOT_BITS - CLUSTER_BITS):
            mid = (low + high) // 2
            n = self.above(mid)
            if n >= k:
                low, n_low = mid, n
            else:
                high, n_high = mid, n
        if n_low - n_high == 1:
            while high - low > 1:  # one simple root: the sign's parity tells the side
                mid = (low + high) // 2
                sign = self._sign(mid)
                if not sign:
                    return mid, n_high, 1
                if sign == (-1) ** (n_high + 1):
                    low = mid
                else:
                    high = mid
            return high, n_high, 1
        return (low + high) // 2, n_high, n_low - n_high


def null_space(matrix: list[list[int]], y: int, e: int, size: int) -> list[list[Decimal]]:
    """``size`` orthonormal vectors near the null space of ``matrix - y * 2**e``,
    by inverse iteration with one factorisation, in ``DIGITS`` digits."""
    with localcontext(Context(prec=DIGITS, Emax=10 ** 9, Emin=-10 ** 9)):
        d = len(matrix)
        root = Decimal(y) * Decimal(2) ** e
        a = np.array([[Decimal(v) for v in row] for row in matrix], dtype=object).reshape(d, d)
        for i in range(d):
            a[i, i] -= root
        tiny = max(abs(v) for v in a.ravel()) * Decimal(10) ** (5 - DIGITS) or Decimal(1)
        rows = np.arange(d)
        for k in range(d):
            best = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            if best != k:
                a[[k, best]], rows[[k, best]] = a[[best, k]], rows[[best, k]]
            if abs(a[k, k]) < tiny:  # exactly singular: any small pivot points into the null space
                a[k, k] = tiny
            if k + 1 < d:
                a[k + 1:, k] = a[k + 1:, k] / a[k, k]
                a[k + 1:, k + 1:] -= a[k + 1:, k][:, None] * a[k, k + 1:][None, :]
        state, x = 1, np.empty((d, size), dtype=object)
        for i in range(d):
            for j in range(size):  # fixed, irregular start vectors
                state = state * 6364136223846793005 + 1442695040888963407 & (1 << 64) - 1
                x[i, j] = Decimal((state >> 33) - (1 << 30))
        for _ in range(STEPS):
            x = x[rows]
            for k in range(d):
                x[k + 1:] -= a[k + 1:, k][:, None] * x[k][None, :]
            for k in range(d - 1, -1, -1):
                x[k] = x[k] / a[k, k]
                x[:k] -= a[:k, k][:, None] * x[k][None, :]
            for j in range(size):
                for _ in range(2):  # orthogonal to the vectors before it
                    for i in range(j):
                        x[:, j] = x[:, j] - x[:, i] * (x[:, i] * x[:, j]).sum()
                    x[:, j] = x[:, j] / (x[:, j] * x[:, j]).sum().sqrt()
        return [list(x[:, j]) for j in range(size)]
