"""Whitening of embeddings: leading principal components, each scaled to variance one.

Tasks sum up entries and then centred products; only sums over rows reach the driver, whose size depends
on the number of dimensions alone. There the covariance is brought to tridiagonal form by Householder
reflections, its leading eigenvalues are found by bisection on Sturm counts, and their vectors by inverse
iteration, where vectors of close eigenvalues are made orthogonal to each other. The components go back to the
tasks as a broadcast of (dimensions x components) numbers.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
STEP, SHIFT = 1024, 100_000  # the grid on which entries become whole numbers
REACH = float(1 << 62)
LOW_BITS = 31
NUMBERS = 1 << 20  # entries handled at a time
CLUSTER = 1e-3  # eigenvalues nearer than this part of the norm share a cluster
EPS = np.finfo(float).eps


def grid_rows(column: pa.Array, dims: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Vectors as whole numbers: (dimensions, row numbers, floor(1024 c) + 100000 as one matrix).

    Left out are null vectors, vectors with null or non-finite entries or entries beyond 64 bits, and, with
    ``dims``, vectors of another length.
    """
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    for length in [dims] if dims is not None else np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        at_once = max(1, NUMBERS // length)
        for start in range(0, len(rows), at_once):
            here = rows[start : start + at_once]
            flat = column.take(pa.array(here)).flatten()
            steps = np.floor(flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, length) * STEP)
            with np.errstate(invalid="ignore"):
                fine = (np.abs(steps) < REACH).all(axis=1)  # nulls have become not-a-number
            if fine.any():
                yield length, here[fine], steps[fine].astype(np.int64) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length of vectors: number, and the sum of each dimension in two parts that cannot overflow."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for length, _, x in grid_rows(batch.column(0)):
            parts = np.stack([np.full(length, len(x)), (x >> LOW_BITS).sum(axis=0), (x & (1 << LOW_BITS) - 1).sum(axis=0)])
            total[length] = total.get(length, 0) + parts
    for length, (n, high, low) in total.items():
        columns = [np.full(length, length, np.int32), np.arange(length, dtype=np.int32), n, high, low]
        yield pa.record_batch([pa.array(c) for c in columns], ["dims", "place", "n", "high", "low"])


def _products(matrices, size: int):
    """A function for mapInArrow: the sums of products of all pairs of columns over a task's rows."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        seen = False
        for batch in batches:
            for centred in matrices(batch):
                total += centred.T @ centred
                seen = True
        if seen:
            a, b = np.triu_indices(size)
            yield pa.record_batch([pa.array(c) for c in (a.astype(np.int32), b.astype(np.int32), total[a, b])], ["a", "b", "v"])

    return summed


def covariance_of(df: DataFrame, matrices, size: int, n: int) -> np.ndarray:
    """Sums of products of centred columns, divided by n; ``matrices`` makes them of an Arrow batch."""
    cells = df.mapInArrow(_products(matrices, size), "a int, b int, v double")
    found = cells.groupBy("a", "b").agg(F.sum("v").alias("v")).toArrow()
    matrix = np.zeros((size, size))
    a, b, v = (found.column(c).to_numpy() for c in ("a", "b", "v"))
    matrix[a, b] = matrix[b, a] = v / n
    return matrix


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the Householder vectors that lead there."""
    a, mirrors = matrix.copy(), []
    size = len(a)
    off = np.zeros(max(size - 1, 0))
    for k in range(size - 2):
        column = a[k + 1 :, k]
        length = -np.copysign(np.linalg.norm(column), column[0])
        mirror = column.copy()
        mirror[0] -= length
        norm = np.linalg.norm(mirror)
        if norm == 0:  # nothing below the diagonal
            mirrors.append(mirror)
            continue
        mirror /= norm
        turned = a[k + 1 :, k + 1 :] @ mirror
        turned -= (mirror @ turned) * mirror
        a[k + 1 :, k + 1 :] -= 2 * (np.outer(mirror, turned) + np.outer(turned, mirror))
        off[k] = length
        mirrors.append(mirror)
    if size > 1:
        off[-1] = a[-1, -2]
    return np.diag(a).copy(), off, mirrors


def count_below(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues are below each x: the negative terms of a Sturm sequence."""
    tiny = EPS * EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), 1e-290)
    term = diagonal[0] - x
    count = (term < 0).astype(int)
    for d, square in zip(diagonal[1:], off**2):
        term = d - x - square / np.where(np.abs(term) < tiny, -tiny, term)
        count += term < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each halved down to neighbouring doubles."""
    around = np.zeros(len(diagonal))
    around[:-1] += np.abs(off)
    around[1:] += np.abs(off)
    number = len(diagonal) - np.arange(k)  # this many eigenvalues are at most the value looked for
    low, high = np.full(k, (diagonal - around).min()), np.full(k, (diagonal + around).max())
    high += EPS * np.abs(high) * len(diagonal) + np.finfo(float).tiny
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high) | (high - low <= EPS * EPS * np.abs(high).max())).all():
            return middle
        enough = count_below(diagonal, off, middle) >= number
        low, high = np.where(enough, low, middle), np.where(enough, middle, high)


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) y = right, by elimination with row exchanges; pivots are at least ``least``."""
    size = len(diagonal)
    first, second, third = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * size
    y = right.tolist()
    for i in range(size - 1):
        below = [float(off[i]), first[i + 1], second[i + 1]]
        if abs(below[0]) > abs(first[i]):
            first[i], second[i], third[i], below = *below, [first[i], second[i], third[i]]
            y[i], y[i + 1] = y[i + 1], y[i]
        if abs(first[i]) < least:
            first[i] = least
        part = below[0] / first[i]
        first[i + 1], second[i + 1] = below[1] - part * second[i], below[2] - part * third[i]
        y[i + 1] -= part * y[i]
    if abs(first[-1]) < least:
        first[-1] = least
    for i in range(size - 1, -1, -1):
        after = y[i + 1] * second[i] if i + 1 < size else 0.0
        far = y[i + 2] * third[i] if i + 2 < size else 0.0
        y[i] = (y[i] - after - far) / first[i]
    return np.array(y)


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit eigenvectors of the given falling eigenvalues, as columns.

    Eigenvalues whose neighbours are close form a cluster. Inside it, shifts are kept apart and each
    vector is made orthogonal to those before it, twice in each round.
    """
    size = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny / EPS)
    start = np.random.default_rng(0)
    vectors = np.zeros((size, len(values)))
    first, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        shift = min(value, shift - 4 * EPS * norm) if j > first else value
        x = start.standard_normal(size)
        for _ in range(rounds):
            x = solve_shifted(diagonal, off, shift, x / np.linalg.norm(x), EPS * norm)
            x /= np.abs(x).max()
            for _ in range(2):
                for earlier in vectors[:, first:j].T:
                    x -= (earlier @ x) * earlier
        vectors[:, j] = x / np.linalg.norm(x)
    return vectors


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns.

    The entry of largest size of each vector is positive.
    """
    scale = np.abs(matrix).max(initial=0)
    if scale == 0:
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    diagonal, off, mirrors = tridiagonal(matrix / scale)
    vectors = inverse_iteration(diagonal, off, leading_values(diagonal, off, k))
    for at, mirror in reversed(list(enumerate(mirrors, 1))):
        vectors[at:] -= 2 * np.outer(mirror, mirror @ vectors[at:])
    vectors /= np.linalg.norm(vectors, axis=0)
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
    return np.einsum("ij,ij->j", vectors, matrix @ vectors), vectors


@dataclass
class Whitening:
    """A fitted whitening: the mean as whole and broken part, components as columns, their variances."""

    n: int
    totals: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def dims(self) -> int:
        return len(self.totals)

    def explained(self) -> np.ndarray:
        return self.values / self.trace

    def transform(self, vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
        """(key, deviation, whitened): one row per vector that can be whitened, whatever else the table holds.

        ``deviation`` is the exact sum over dimensions of (n x - S)^2, null beyond 64 bits.
        """
        key_type = vectors.schema[key].dataType.simpleString()
        fitted = vectors.sparkSession.sparkContext.broadcast(self)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = fitted.value
            scaled = own.components / np.sqrt(own.values)
            base, rest = _mean_parts(own.n, own.totals)
            for batch in batches:
                for _, here, x in grid_rows(batch.column(1), own.dims):
                    white = pa.array(list((x - base - rest / own.n) @ scaled), pa.list_(pa.float64()))
                    far = _deviations(own.n, x - base, rest)
                    yield pa.record_batch([batch.column(0).take(pa.array(here)), far, white], [key, "deviation", "whitened"])

        return vectors.select(key, column).mapInArrow(rows, f"`{key}` {key_type}, deviation long, whitened array<double>")


def _mean_parts(n: int, totals: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean S / n as whole numbers, and what is left of S."""
    return np.array([s // n for s in totals], np.int64), np.array([s % n for s in totals], np.int64)


def _deviations(n: int, x: np.ndarray, rest: np.ndarray) -> pa.Array:
    """Sums of (n x - rest)^2 per row; rows too large for 64 bits are summed by Python, and null if beyond them."""
    most = n * (int(np.abs(x).max(initial=0)) + 1)
    if most**2 * x.shape[1] < 1 << 63:
        return pa.array(((n * x - rest) ** 2).sum(axis=1), pa.int64())
    exact = (sum((n * a - r) ** 2 for a, r in zip(row, rest.tolist())) for row in x.tolist())
    return pa.array([s if s < 1 << 63 else None for s in exact], pa.int64())


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Learn from all vectors that have entries, none of them null or non-finite; None if there are none.

    Vectors of one table have one length; if not, the most frequent one counts (of several, the largest), and
    vectors of other lengths are left out as not of that space. A component without variance cannot be brought
    to variance one, so there are only as many components as dimensions with variance. The driver
    holds dimensions^2 numbers, whatever the number of rows.
    """
    only = vectors.select(column)
    sums = only.mapInArrow(_sums, "dims int, place int, n long, high long, low long")
    entry = F.struct("place", "n", "high", "low")
    per_place = sums.groupBy("dims", "place").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")])
    of_length = per_place.groupBy("dims").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(entry)).alias("places"))
    row = of_length.orderBy(F.desc("n"), F.desc("dims")).first()
    if row is None:
        return None
    n, dims = row["n"], row["dims"]
    totals = [(place["high"] << LOW_BITS) + place["low"] for place in row["places"]]
    base, rest = _mean_parts(n, totals)

    def centred(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, x in grid_rows(batch.column(0), dims):
            yield x - base - rest / n

    covariance = covariance_of(only, centred, dims, n)
    values, basis = leading_components(covariance, min(components, dims))
    varied = values > EPS * dims * max(values.max(initial=0), 0)
    return Whitening(n, totals, values[varied], basis[:, varied], float(np.trace(covariance)))


def identity_error(whitened: DataFrame, components: int, n: int) -> float:
    """The largest entry by which the covariance of the whitened rows differs from the identity."""

    def rows(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        # Centred before they were projected.
        yield batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, components)

    found = covariance_of(whitened.select("whitened"), rows, components, n)
    return float(np.abs(found - np.eye(components)).max(initial=0))


LONG_FORM = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened_components(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component, by falling variance from 1 on.

    Null vectors and those with null or non-finite entries are left out; null keys, repeated rows and
    further columns do not matter. A table without vectors, or without variance, gives no rows.
    """
    model = fit(vectors, column, components)
    if model is None or not len(model.values):
        key_type = vectors.schema[key].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"`{key}` {key_type}, {LONG_FORM}")
    white = model.transform(vectors, key, column)
    error = identity_error(white, len(model.values), model.n)
    shares = F.array(*[F.lit(float(share)) for share in model.explained()])
    return white.select(key, "deviation", F.posexplode("whitened").alias("_place", "_value")).select(
        key,
        (F.col("_place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("_value").alias("whitened"),
        F.element_at(shares, F.col("_place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
