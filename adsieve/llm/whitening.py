"""Embedding whitening by the exact characteristic polynomial.

1. *Integers.* Every entry becomes ``floor(64 c)`` (plus a constant shift of
   ``SHIFT`` that no centred figure depends on). Tasks sum the integers and
   their products exactly, and Spark sums these by matrix place in 32-bit
   limbs, so no sum is ever rounded. ``n * sum(x x') - S S'`` is ``n**2`` times
   the covariance, in integers.
2. *Polynomial.* Its characteristic polynomial is taken modulo 31-bit primes,
   a few primes a Spark task, by reduction to Hessenberg form; Chinese
   remaindering gives the exact coefficients (`charpoly`).
3. *Roots, components.* One Spark task a component isolates its root in
   high precision and finds the component by inverse iteration in the null
   space. The multiplicity of the root zero is read off the polynomial, so the
   rank is exact. Repeated roots get an orthonormal basis of their space.
4. *Whitening.* Vectors are centred exactly, projected, and divided by the
   root's square root. A pass over the fit list measures the largest entry of
   the whitened covariance minus the identity.

Only sums by matrix place, residues and components reach the driver: their
number depends on the vectors' length, not on the rows.

Defined results: rows whose vector is null or holds a null or non-finite entry
are dropped; rows without id and repeated ids count each for itself. Entries
whose integer leaves the 64-bit range stand at its end. Vectors of different
lengths are fitted and whitened apart, each length with an ``n`` of its own;
empty vectors have no component. Components with eigenvalue zero do not exist,
so fewer than ``COMPONENTS`` may come. A deviation beyond 64 bits is null.
Other columns are ignored. A component's sign is that of its largest entry.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsieve.llm import charpoly as P

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
PRIMES_PER_TASK = 8
_LIMB = 32
_EXACT = 1 << 53
_SUMS = "dim long, i long, j long, limb long, v long"


@dataclass
class Whitening:
    """Fit of the vectors of one length: ``n``, integer sums, unit components
    (rows), eigenvalues of the covariance and their share of its trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray


def fine(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & ~bad)


def _by_length(rb: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, integers without the shift)."""
    col = rb.column("v")
    size = np.diff(np.frombuffer(col.buffers()[1], np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)) if len(col) else np.empty(0, int)
    flat = col.flatten().to_numpy(zero_copy_only=False)
    first = np.cumsum(size) - size
    for d in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == d)
        yield int(d), rows, _integers(flat[first[rows][:, None] + np.arange(d)])


def _integers(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        y = np.floor(SCALE * x)
    if not y.size or np.abs(y).max() < _EXACT:
        return y.astype(np.int64)
    low, high = -(1 << 63) - SHIFT, (1 << 63) - 1 - SHIFT  # Python integers, exact at any size
    return np.array([low if v <= low else high if v >= high else min(max(int(v), low), high) for v in y.ravel().tolist()], dtype=object).reshape(y.shape)


def _limbs(v: int) -> list[int]:
    """32-bit limbs, lowest first; the last one bears the sign."""
    out = []
    while not -(1 << 62) <= v < 1 << 62:
        out.append(v & (1 << _LIMB) - 1)
        v >>= _LIMB
    return [*out, v & (1 << _LIMB) - 1, v >> _LIMB]


def _sum_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list] = {}
    for rb in batches:
        for d, rows, y in _by_length(rb):
            if d not in total:
                total[d] = [0, np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)]
            t = total[d]
            t[0] += len(rows)
            if y.dtype != object and int(np.abs(y).max()) ** 2 * len(rows) < _EXACT:
                f = y.astype(float)  # every product and partial sum is a whole number below 2**53
                t[1] += y.sum(axis=0).astype(object)
                t[2] += (f.T @ f).astype(np.int64).astype(object)
            else:
                y = y.astype(object)
                t[1] += y.sum(axis=0)
                t[2] += y.T @ y
    for d, (n, s, m) in total.items():
        rows = [(d, -1, -1, k, v) for k, v in enumerate(_limbs(n))]
        rows += [(d, -1, j, k, v) for j in range(d) for k, v in enumerate(_limbs(int(s[j])))]
        rows += [(d, i, j, k, v) for i in range(d) for j in range(i, d) for k, v in enumerate(_limbs(int(m[i, j])))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["dim", "i", "j", "limb", "v"])


def scatter(rows: DataFrame) -> dict[int, tuple[int, list[int], list[list[int]]]]:
    """Per vector length: (n, sums, ``n * sum(y y') - S S'``), exact."""
    out: dict[int, dict] = {}
    told = rows.select("v").mapInArrow(_sum_task, _SUMS).groupBy("dim", "i", "j", "limb").agg(F.sum("v").alias("v"))
    for r in told.collect():
        place = out.setdefault(r["dim"], {})
        place[r["i"], r["j"]] = place.get((r["i"], r["j"]), 0) + (r["v"] << _LIMB * r["limb"])
    fits = {}
    for d, at in out.items():
        n, s = at[-1, -1], [at[-1, j] for j in range(d)]
        fits[d] = n, s, [[n * at[min(i, j), max(i, j)] - s[i] * s[j] for j in range(d)] for i in range(d)]
    return fits


def _residue_task(matrix: list[list[int]], primes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            own = [primes[i] for i in rb.column("id").to_pylist()]
            for a in range(0, len(own), PRIMES_PER_TASK):
                some = own[a: a + PRIMES_PER_TASK]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(P.residues(matrix, some).tolist(), pa.list_(pa.int64()))], ["p", "c"])
    return run


def characteristic(spark, matrix: list[list[int]]) -> list[int]:
    """Coefficients (lowest first) of the characteristic polynomial of a
    positive semidefinite integer matrix."""
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    primes = P.primes_above(2 * P.coefficient_bound(trace, len(matrix)))
    tasks = -(-len(primes) // PRIMES_PER_TASK)
    rows = spark.range(0, len(primes), 1, tasks).mapInArrow(_residue_task(matrix, primes), "p long, c array<long>").collect()
    return P.combine([r["p"] for r in rows], [r["c"] for r in rows])


def _component_task(matrix: list[list[int]], coefficients: list[int], trace: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = P.Roots(coefficients, trace)
        for rb in batches:
            for i in rb.column("id").to_pylist():
                y, above, size = roots.locate(i + 1)
                # components of one repeated root all take their own vector of the same basis
                basis = P.null_space(matrix, y, roots.e, min(size, most - above))
                v = np.array([float(x) for x in basis[i - above]])
                v *= np.sign(v[np.abs(v).argmax()])
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([str(y)]), pa.array([v], pa.list_(pa.float64()))], ["i", "y", "v"])
    return run


def _fit_one(spark, n: int, sums: list[int], matrix: list[list[int]], most: int) -> Whitening:
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    if not trace:  # all vectors are equal
        return Whitening(n, sums, np.empty((0, d)), np.empty(0), np.empty(0))
    common = gcd(*(v for row in matrix for v in row))
    small = [[v // common for v in row] for row in matrix]
    coefficients = characteristic(spark, small)
    roots = P.Roots(coefficients, trace // common)
    k = min(most, roots.positive)
    found = spark.range(0, k, 1, k).mapInArrow(_component_task(small, coefficients, trace // common, k), "i long, y string, v array<double>").collect()
    found.sort(key=lambda r: r["i"])
    exact = [Fraction(int(r["y"])) * Fraction(2) ** roots.e * common for r in found]
    return Whitening(n, sums, np.array([r["v"] for r in found]), np.array([float(e / n ** 2) for e in exact]), np.array([float(e / trace) for e in exact]))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """Whitening of ``vectors (vec_id, embedding)``, by vector length."""
    rows = fine(vectors)
    return {d: _fit_one(rows.sparkSession, *told, components) for d, told in scatter(rows).items()}


def _centred(model: Whitening, y: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
    """(vectors minus the mean, exact deviations)."""
    bound = model.n * (int(np.abs(y).max()) + 1) + max(map(abs, model.sums))
    if y.dtype != object and bound ** 2 * y.shape[1] < 1 << 63:
        t = model.n * y - np.array(model.sums, dtype=np.int64)
        return t / model.n, (t * t).sum(axis=1).tolist()
    t = model.n * y.astype(object) - np.array(model.sums, dtype=object)
    total = (t * t).sum(axis=1).tolist()
    return np.array([[int(v) / model.n for v in row] for row in t], dtype=float), [v if v < 1 << 63 else None for v in total]


def _whiten(model: Whitening, centred: np.ndarray) -> np.ndarray:
    return centred @ model.components.T / np.sqrt(model.values)


def _transform_task(models: dict[int, Whitening]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            ids = rb.column("vec_id")
            for d, rows, y in _by_length(rb):
                model = models[d]
                k = len(model.values)
                if not k:
                    continue
                centred, deviation = _centred(model, y)
                each = lambda values: pa.array(values).take(pa.array(np.repeat(np.arange(len(rows)), k)))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                     pa.array(np.full(len(rows) * k, model.n)), each(pa.array(deviation, pa.int64())), pa.array(_whiten(model, centred).ravel()),
                     pa.array(np.tile(model.explained, len(rows))), pa.array(np.full(len(rows) * k, d))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "dim"])
    return run


def transform(vectors: DataFrame, models: dict[int, Whitening]) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, dim``: a row for
    each fine vector of a fitted length and each of its components."""
    rows = fine(vectors).where(F.size("v").isin(list(models)) if models else F.lit(False))
    return rows.mapInArrow(_transform_task(models), "vec_id long, component int, n long, deviation long, whitened double, explained double, dim long")


def _moment_task(models: dict[int, Whitening]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for rb in batches:
            for d, _, y in _by_length(rb):
                if len(models[d].values):
                    w = _whiten(models[d], _centred(models[d], y)[0])
                    total[d] = total.get(d, 0) + w.T @ w
        for d, m in total.items():
            i, j = np.triu_indices(len(m))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d)), pa.array(i), pa.array(j), pa.array(m[i, j])], ["dim", "i", "j", "v"])
    return run


def identity_error(vectors: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """By vector length, the largest absolute entry of the whitened covariance
    minus the identity. Whitened vectors are centred, as the vectors were."""
    rows = fine(vectors).select("v").mapInArrow(_moment_task(models), "dim long, i long, j long, v double")
    out: dict[int, float] = {}
    for r in rows.groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect():
        error = abs(r["v"] / models[r["dim"]].n - (r["i"] == r["j"]))
        out[r["dim"]] = max(out.get(r["dim"], 0.0), error)
    return out


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Fit and transform, with the fit's ``identity_error``."""
    models = fit(vectors, components)
    errors = identity_error(vectors, models)
    error = F.lit(None).cast("double")
    for d, e in errors.items():
        error = F.when(F.col("dim") == d, F.lit(e)).otherwise(error)
    return transform(vectors, models).withColumn("identity_error", error)
