"""Embedding whitening by shifted CholeskyQR.

The centred vectors are a tall matrix Y that is never gathered.  Each pass over the
table multiplies every row by the inverses of the triangular factors found so far
(triangular solves, one after the other) and adds up the Gram matrix of the result;
its Cholesky factor is the next one.  The first factor is shifted, so that it exists
however ill-conditioned Y is; passes repeat until the rows' Gram matrix is the
identity.  Y = Q R with R the product of the factors, and the singular values and
right vectors of R are those of Y: the components of the covariance, found without
squaring its condition.

Directions in which Y does not vary at all keep a zero column in Q.  The last factor
is then the symmetric root of the last Gram matrix, so R has the same zero singular
values, and such components are left out: they cannot be scaled to unit variance.

Numbers: entries become integers, so sums are exact and each centred entry
(n x - S) / n is one rounding away from its exact value.

Bounds: the driver holds d x d matrices, d the number of dimensions; tasks add up
one such matrix each, merged by position in a shuffle, never all on the driver.

Defined results: vectors that are null, or hold null or non-finite entries, or
entries whose integer does not fit 53 bits, are dropped; so are vectors of another
length than the most frequent one (of equally frequent ones the longest).  With no
vectors, or none that vary, the result is empty.  ``deviation`` is null where it
does not fit a long.  Repeated rows count each.  Null ids stay.  Only the id and
vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine.llm.common import prepare

SCALE, OFFSET = 64, 1_000_000   # x = floor(64 c) + 1000000
COMPONENTS = 32
# Entries from which 64 c is not held exactly any more.
LARGEST = float(1 << 46)

UNIT = np.finfo(np.float64).eps / 2
# Q is taken as orthonormal when its Gram matrix is that near the identity.
ORTHONORMAL = 1e-12
# Directions below this part of the largest singular value carry no variance.
NULL_DIRECTION = 1e-10
MOST_PASSES = 12


def _matrix(column: pa.Array, length: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``column`` (lists of numbers) that are kept, and their integer vectors
    (all of ``length``; None takes rows of any one length, see ``_lengths``)."""
    sizes = np.asarray(column.value_lengths().fill_null(-1))
    rows = np.flatnonzero(sizes == length)
    taken = column.take(pa.array(rows)).flatten()
    c = np.asarray(taken.cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64).reshape(len(rows), length)
    with np.errstate(invalid="ignore"):
        fine = (np.abs(c) < LARGEST).all(axis=1)  # false for nan and null, too
    return rows[fine], np.floor(c[fine] * SCALE).astype(np.int64) + OFFSET


def _valid_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(length, n) of the vectors that are kept, of each length."""
    for b in batches:
        sizes = np.asarray(b.column(1).value_lengths().fill_null(0))
        found = [(int(k), len(_matrix(b.column(1), int(k))[0])) for k in np.unique(sizes) if k > 0]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()),
                                          pa.array([n for _, n in found], pa.int64())], ["length", "n"])


def _sums(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length, np.int64)
        for b in batches:
            total += _matrix(b.column(1), length)[1].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(length), pa.int64()), pa.array(total)], ["at", "value"])
    return run


@dataclass(frozen=True)
class Centre:
    """Vectors and exact sums of each dimension."""

    n: int
    sums: np.ndarray

    @property
    def length(self) -> int:
        return len(self.sums)

    def numerators(self, x: np.ndarray) -> np.ndarray | None:
        """n x - S, exact; None if it could exceed 63 bits."""
        top = max(int(np.abs(x).max(initial=0)) * self.n, int(np.abs(self.sums).max(initial=0)))
        return None if top >= 1 << 62 else x * np.int64(self.n) - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        exact = self.numerators(x)
        if exact is not None:
            return exact / self.n
        # Whole and fractional part of the mean apart: the whole part leaves no error.
        whole, rest = np.divmod(self.sums, self.n)
        return (x - whole).astype(np.float64) - rest / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        exact = self.numerators(x)
        if exact is None:
            return pa.nulls(len(x), pa.int64())
        rough = (exact.astype(np.float64) ** 2).sum(axis=1)
        if rough.max(initial=0) < 2 ** 62:
            return pa.array((exact * exact).sum(axis=1))
        whole = [sum(int(v) ** 2 for v in row) for row in exact]
        return pa.array([v if v < 1 << 63 else None for v in whole], pa.int64())


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverses of the upper triangular ``factors``, in turn."""
    for r in factors:
        rows = np.linalg.solve(r.T, rows.T).T
    return rows


def _gram(centre: Centre, factors: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = centre.length
        total = np.zeros((d, d))
        for b in batches:
            x = _matrix(b.column(1), d)[1]
            if len(x):
                q = solved(centre.centred(x), factors)
                total += q.T @ q
        upper = total[np.triu_indices(d)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper))), pa.array(upper)], ["at", "value"])
    return run


def _whitened_gram(model: "Whitening"):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.eigenvalues)
        total = np.zeros((k, k))
        for b in batches:
            x = _matrix(b.column(1), model.centre.length)[1]
            w = model.apply(x)
            total += w.T @ w
        upper = total[np.triu_indices(k)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper))), pa.array(upper)], ["at", "value"])
    return run


def _merged(parts: DataFrame, size: int) -> np.ndarray:
    """The symmetric matrix whose upper triangles the tasks give."""
    out = np.zeros((size, size))
    at = np.triu_indices(size)
    values = np.zeros(len(at[0]))
    for r in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():  # size^2 / 2 numbers
        values[r["at"]] = r["value"]
    out[at] = values
    return out + np.triu(out, 1).T


@dataclass(frozen=True)
class Whitening:
    """Components (rows, unit length) and eigenvalues of the fit list, falling."""

    centre: Centre
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    passes: int
    identity_error: float = 0.0

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer vectors."""
        return (self.centre.centred(x) @ self.components.T) / np.sqrt(self.eigenvalues)


def centre_of(rows: DataFrame) -> Centre | None:
    """Count and exact sums of the kept vectors of ``rows`` (id, vector)."""
    lengths = (rows.mapInArrow(_valid_lengths, "length long, n long").where("n > 0")
                   .groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("length")).first())
    if lengths is None:
        return None
    d = lengths["length"]
    sums = np.zeros(d, np.int64)
    for r in rows.mapInArrow(_sums(d), "at long, value long").groupBy("at").agg(F.sum("value").alias("v")).collect():
        sums[r["at"]] = r["v"]  # d numbers
    return Centre(lengths["n"], sums)


def triangular_factors(gram, n: int, d: int) -> tuple[list[np.ndarray], int]:
    """Factors R1, R2, ... with Q = Y R1^-1 R2^-1 ... orthonormal; ``gram(factors)``
    is the Gram matrix of Y after the solves with ``factors``.  The last factor is a
    symmetric root if Y has directions without variance."""
    factors: list[np.ndarray] = []
    for _ in range(MOST_PASSES):
        g = gram(factors)
        w, v = np.linalg.eigh(g)
        if w[-1] <= 0:
            break
        live = w > w[-1] * NULL_DIRECTION ** 2
        if factors and np.abs(w[live] - 1).max() < ORTHONORMAL:
            break
        # Cholesky is safe on its own once Q is nearly orthonormal in all directions.
        shift = 0.0 if factors and live.all() and w[0] > 0.01 * w[-1] else 11 * (n * d + d * (d + 1)) * UNIT * w[-1]
        # Beyond a part of the norm a shift would only slow the passes down.
        shift = min(shift, w[-1] * 1e-3)
        factors.append(np.linalg.cholesky(g + shift * np.eye(d)).T)
    root = (v * np.sqrt(np.maximum(w, 0.0))) @ v.T
    return [*factors, root], len(factors) + 1


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``rows`` (id, vector); None if nothing varies."""
    centre = centre_of(rows)
    if centre is None:
        return None
    d = centre.length

    def gram(factors: list[np.ndarray]) -> np.ndarray:
        return _merged(rows.mapInArrow(_gram(centre, list(factors)), "at long, value double"), d)

    factors, passes = triangular_factors(gram, centre.n, d)
    r = factors[0]
    for f in factors[1:]:
        r = f @ r
    _, s, vt = np.linalg.svd(r)
    live = int(np.count_nonzero(s > s[0] * NULL_DIRECTION)) if s[0] > 0 else 0
    k = min(components, live)
    if not k:
        return None
    e = s ** 2 / centre.n
    model = Whitening(centre, vt[:k], e[:k], float(e.sum()), passes)
    cov = _merged(rows.mapInArrow(_whitened_gram(model), "at long, value double"), k) / centre.n
    return Whitening(centre, vt[:k], e[:k], float(e.sum()), passes, float(np.abs(cov - np.eye(k)).max()))


WHITENED = ("id long, component int, n long, deviation long, whitened double, explained double, "
            "identity_error double")


def _whiten(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.eigenvalues)
        explained = model.eigenvalues / model.trace
        for b in batches:
            rows, x = _matrix(b.column(1), model.centre.length)
            m = len(rows)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, model.centre.n)), model.centre.deviations(x).take(each),
                 pa.array(model.apply(x).ravel()), pa.array(np.tile(explained, m)),
                 pa.array(np.full(m * k, model.identity_error))],
                [f.split()[0] for f in WHITENED.split(", ")])
    return run


def whitened(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
             vector: str = "embedding") -> DataFrame:
    """One row per kept vector and component; see the module's docstring."""
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.col(vector).cast("array<double>").alias("vector"))
    model = fit(rows, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], WHITENED).withColumnRenamed("id", id_col)
    return rows.mapInArrow(_whiten(model), WHITENED).withColumnRenamed("id", id_col)
