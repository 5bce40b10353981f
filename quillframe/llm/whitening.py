"""Whitening of embeddings along the leading eigenvectors of their covariance.

Entries are read as integers, so sums and products over all rows are exact whatever the order
in which tasks finish. Eigenvalues are isolated by spectrum slicing: Sylvester's law of inertia
counts the eigenvalues below a shift from the signs of an LDLᵀ factorisation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut_lineage

COMPONENTS = 8
SCALE = 1024  # the shift by 100,000 drops out of everything that is centred
# Entries beyond this have no place in the arithmetic below; see :func:`whiten`.
LARGEST = 1 << 52
_EXACT = 1 << 53  # sums of integers up to here are exact in a double
_LOW = (1 << 60) - 1
_MOMENTS = "i int, j int, high decimal(38,0), low decimal(38,0)"


def usable(vector: Column) -> Column:
    """Not null, not empty, all entries known and finite, none too large to be read."""
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float(LARGEST // SCALE)))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, fine)


def _integers(column: pa.Array, dimension: int, base: np.ndarray) -> np.ndarray:
    """floor(SCALE * c) - base, exact: scaling by a power of two does not round."""
    values = np.asarray(column.flatten(), np.float64).reshape(-1, dimension)
    return np.floor(values * SCALE).astype(np.int64) - base


def _gram(y: np.ndarray) -> np.ndarray:
    """Sums of products of the columns with each other as Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), object)
    largest = int(np.abs(y).max(initial=0))
    if largest * largest >= _EXACT:  # cut into halves that multiply exactly
        low = y & ((1 << 26) - 1)
        high = (y - low) >> 26
        cross = _products(high, low)
        return _gram(high) * (1 << 52) + (cross + cross.T) * (1 << 26) + _gram(low)
    rows = max(1, _EXACT // max(1, largest * largest) - 1)
    for at in range(0, len(y), rows):
        block = y[at : at + rows].astype(np.float64)
        total = total + (block.T @ block).astype(np.int64).astype(object)
    return total


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros((a.shape[1], b.shape[1]), object)
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    rows = max(1, _EXACT // max(1, largest) - 1)
    for at in range(0, len(a), rows):
        total = total + (a[at : at + rows].astype(np.float64).T @ b[at : at + rows].astype(np.float64)).astype(np.int64).astype(object)
    return total


def _cells(cells: list[tuple[int, int, int]]) -> pa.RecordBatch:
    number = pa.decimal128(38, 0)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _, _ in cells], pa.int32()),
            pa.array([j for _, j, _ in cells], pa.int32()),
            pa.array([v >> 60 for _, _, v in cells], number),
            pa.array([v & _LOW for _, _, v in cells], number),
        ],
        names=["i", "j", "high", "low"],
    )


def _counts(dimension: int):
    """Rows and sums of a task: cell (-1, -1) is the number of rows, (i, -1) a dimension's sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zero, n, total = np.zeros(dimension, np.int64), 0, np.zeros(dimension, object)
        for batch in batches:
            y = _integers(batch["vector"], dimension, zero)
            n += len(y)
            for at in range(0, len(y), 1024):  # 2**52 * 2**10 fits
                total = total + y[at : at + 1024].sum(axis=0).astype(object)
        yield _cells([(-1, -1, n), *((i, -1, int(v)) for i, v in enumerate(total))])

    return run


def _moments(dimension: int, base: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension), object)
        for batch in batches:
            total = total + _gram(_integers(batch["vector"], dimension, base))
        yield _cells([(i, j, int(total[i, j])) for i in range(dimension) for j in range(i + 1)])

    return run


def _summed(cells: DataFrame) -> dict[tuple[int, int], int]:
    rows = cells.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return {(r["i"], r["j"]): (int(r["high"]) << 60) + int(r["low"]) for r in rows}


@dataclass
class Fit:
    """Exact moments of the integers ``y = floor(SCALE * c) - base`` over all rows."""

    n: int
    base: np.ndarray  # the mean, rounded
    sums: list[int]  # of y, so each is less than n
    covariance: np.ndarray
    trace: Fraction

    @property
    def dimension(self) -> int:
        return len(self.sums)


def fit(rows: DataFrame, dimension: int) -> Fit | None:
    """Two passes: means, then products of entries centred at the rounded means. What rounding
    leaves is taken off in exact fractions, so the covariance is that of centred entries, each
    cell rounded once. At most dimension * (dimension + 1) / 2 numbers reach the driver."""
    sums = _summed(rows.mapInArrow(_counts(dimension), _MOMENTS))
    n = sums.get((-1, -1), 0)
    if not n:
        return None
    base = [(2 * sums[i, -1] + n) // (2 * n) for i in range(dimension)]
    rest = [sums[i, -1] - n * base[i] for i in range(dimension)]
    products = _summed(rows.mapInArrow(_moments(dimension, np.array(base, np.int64)), _MOMENTS))
    covariance = np.zeros((dimension, dimension))
    trace = Fraction(0)
    for (i, j), total in products.items():
        exact = Fraction(n * total - rest[i] * rest[j], n * n)
        covariance[i, j] = covariance[j, i] = float(exact)
        trace += exact if i == j else 0
    return Fit(n, np.array(base, np.int64), rest, covariance, trace)


def inertia(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix that are below ``shift``: negative ones in the D of
    P(A - shift I)Pᵀ = LDLᵀ, with blocks of one or two rows (Bunch and Kaufman's pivots)."""
    a = matrix - shift * np.eye(len(matrix))
    alpha = (1 + 17**0.5) / 8
    below, k, n = 0, 0, len(a)
    while k < n:
        size = 1
        if k + 1 < n:
            column = np.abs(a[k + 1 :, k])
            r = k + 1 + int(column.argmax())
            most = column[r - k - 1]
            if abs(a[k, k]) < alpha * most:
                other = np.abs(a[k:, r])
                other[r - k] = 0
                if abs(a[k, k]) * other.max() >= alpha * most * most:
                    pass
                elif abs(a[r, r]) >= alpha * other.max():
                    _swap(a, k, r)
                else:
                    size = 2
                    _swap(a, k + 1, r)
        rest = slice(k + size, n)
        if size == 1:
            pivot = a[k, k]
            below += pivot < 0
            if pivot:
                a[rest, rest] -= np.outer(a[rest, k], a[rest, k] / pivot)
        else:
            block, side = a[k : k + 2, k : k + 2], a[rest, k : k + 2]
            below += 1  # such a block has one eigenvalue of either sign
            a[rest, rest] -= side @ np.linalg.solve(block, side.T)
        k += size
    return int(below)


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


def leading_eigenpairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns.

    An eigenvalue's interval is halved by inertia counts until it holds no other, then Rayleigh
    quotient iteration runs from a vector that inverse iteration at its middle has turned
    towards the eigenvector. A quotient that leaves the interval means another halving.
    Eigenvalues that no double parts share an interval; their vectors are made orthogonal.
    Counts on both sides of the values found certify that value number k is the k-th largest.
    Eigenvalues that rounding cannot tell from zero are left out.
    """
    n = len(matrix)
    bound = float(np.abs(matrix).sum(axis=1).max(initial=0))  # Gershgorin
    if not bound:
        return np.zeros(0), np.zeros((n, 0))
    a = matrix / bound
    blur = 8 * n * np.finfo(float).eps
    counted: dict[float, int] = {}

    def at_least(x: float) -> int:
        if x not in counted:
            counted[x] = n - inertia(a, x)
        return counted[x]

    values: list[float] = []
    vectors = np.zeros((n, 0))
    wanted = min(wanted, at_least(blur))
    while len(values) < wanted:
        k = len(values)  # the next is number k + 1
        low = max([x for x, c in counted.items() if c > k], default=blur)
        high = min([x for x, c in counted.items() if c <= k], default=1 + blur)
        while True:
            inside = at_least(low) - at_least(high)
            alone = inside == 1 or high - low <= blur
            if alone:
                found = _polished(a, low, high, inside, vectors)
                if found is not None:
                    break
            middle = (low + high) / 2
            if at_least(middle) > k:
                low = middle
            else:
                high = middle
        theirs, own = found
        values += list(theirs)
        vectors = np.hstack([vectors, own])
    for k, value in enumerate(values):
        if at_least(value - 4 * blur) < k + 1 or at_least(value + 4 * blur) > k:
            if not any(abs(value - other) <= 8 * blur for i, other in enumerate(values) if i != k):
                raise ArithmeticError(f"eigenvalue {k + 1} could not be certified")
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    return np.array(values)[order] * bound, vectors[:, order]


def _polished(a: np.ndarray, low: float, high: float, many: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The eigenpairs inside (low, high], or None if the iteration left the interval."""
    n, eps = len(a), np.finfo(float).eps
    draw = np.random.default_rng(n)
    small = 8 * n * eps
    # Where no double parts the ends, rounding may put the quotient just outside of them.
    margin = small if high - low <= small else 0.0
    values, vectors = [], known
    for _ in range(many):
        have = vectors

        def unit(x: np.ndarray) -> np.ndarray:
            for _ in range(2):  # twice is enough for orthogonality to double precision
                x = x - have @ (have.T @ x)
            return x / np.sqrt(x @ x)

        x = unit(draw.standard_normal(n))
        shift = (low + high) / 2
        for _ in range(3):
            x = unit(_solved(a, shift, x))
        value = float(x @ a @ x)
        for _ in range(12):
            residual = a @ x - value * x
            if np.sqrt(residual @ residual) <= 4 * eps:
                break
            x = unit(_solved(a, value, x))
            value = float(x @ a @ x)
        if not low - margin <= value <= high + margin:
            return None
        residual = a @ x - value * x
        if np.sqrt(residual @ residual) > small:
            return None
        values.append(value)
        vectors = np.column_stack([vectors, x])
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], vectors[:, known.shape[1] :][:, order]


def _solved(a: np.ndarray, shift: float, x: np.ndarray) -> np.ndarray:
    """(A - shift I)⁻¹ x; a shift that is an eigenvalue to the last digit is moved by one."""
    for _ in range(4):
        try:
            out = np.linalg.solve(a - shift * np.eye(len(a)), x)
            if np.isfinite(out).all():
                return out
        except np.linalg.LinAlgError:
            pass
        shift += np.finfo(float).eps * max(1.0, abs(shift))
    raise ArithmeticError("no solution near an eigenvalue")


def _deviations(y: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n * y - sum)², exact; null beyond 38 digits."""
    number = pa.decimal128(38, 0)
    reach = n * (int(np.abs(y).max(initial=0)) + 1)  # a sum is less than n
    if reach * reach * y.shape[1] < 1 << 63:
        v = n * y - np.array(sums, np.int64)
        return pa.array((v * v).sum(axis=1)).cast(number)
    if reach < 1 << 62 and y.shape[1] < 1 << 14:
        v = n * y - np.array(sums, np.int64)
        mask = (1 << 24) - 1
        parts = [v & mask, (v >> 24) & mask, v >> 48]
        total = np.zeros(len(y), object)
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                total = total + ((a * b).sum(axis=1).astype(object) << (24 * (i + j)))
    else:
        v = n * y.astype(object) - np.array(sums, object)
        total = (v * v).sum(axis=1)
    return pa.array([t if t < 10**38 else None for t in total], number)


def _projected(f: Fit, components: np.ndarray, values: np.ndarray):
    mean = np.array([float(Fraction(s, f.n)) for s in f.sums])
    axes = components / np.sqrt(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = _integers(batch["vector"], f.dimension, f.base)
            white = (y - mean) @ axes
            offsets = np.arange(len(y) + 1, dtype=np.int32) * len(values)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch["id"], _deviations(y, f.n, f.sums), lists], names=["id", "deviation", "white"])

    return run


def _identity_error(white: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of the whitened columns minus the identity."""
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    cells = [F.covar_pop(F.col("white")[i], F.col("white")[j]).alias(f"c{i}_{j}") for i, j in pairs]
    found = white.agg(*cells).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Each row's whitened coordinates: ``id_col``, component, n, deviation, whitened, explained,
    identity_error.

    An entry c counts as the integer x = floor(1024 c) + 100000. Components are the unit
    eigenvectors of the covariance of x over all rows (divisor n), numbered from 1 by falling
    eigenvalue e; ``whitened`` is the projection of x less its mean over sqrt(e), ``explained``
    e over the trace, ``deviation`` the exact sum over dimensions of (n x - S)² with S the sum of
    x (decimal; null beyond 38 digits), ``identity_error`` the largest absolute entry of the
    covariance of ``whitened`` minus the identity, one value for all rows.

    A row takes no part if its vector is null, empty, has null or non-finite entries or any of
    2**42 or more, or has another length than most vectors (the longest of equally frequent).
    Rows count as often as they occur, also with equal or null ids. Components without spread
    are left out, so equal vectors, a single one or an empty table give no rows. Other columns
    play no part.
    """
    vector = F.col(f"`{vector_col}`")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), vector.cast("array<double>").alias("vector")).filter(usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    kind = dict(rows.dtypes)["id"]
    empty = df.sparkSession.createDataFrame(
        [], f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    ).withColumnRenamed("id", id_col)
    if lengths is None:
        return empty
    rows = rows.filter(F.size("vector") == lengths["n"])
    f = fit(rows.select("vector"), lengths["n"])
    values, vectors = leading_eigenpairs(f.covariance, components)
    if not len(values):
        return empty
    white = cut_lineage(rows.mapInArrow(_projected(f, vectors, values), f"id {kind}, deviation decimal(38,0), white array<double>"))
    explained = F.array(*[F.lit(float(Fraction(float(e)) / f.trace)) for e in values])
    error = _identity_error(white, len(values))
    return white.select("id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
        F.col("id").alias(id_col),
        (F.col("at") + 1).alias("component"),
        F.lit(f.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
