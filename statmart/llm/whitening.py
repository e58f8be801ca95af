"""Whitening of embeddings, with the principal components found by spectrum slicing.

Entries become integers, so counts, sums and the sums of products of the centred entries
are exact: each task adds them up for its rows, one row per pair of dimensions is
shuffled, and the covariance is rounded once. Everything the driver holds has the size of
that matrix, whatever the number of rows.

The leading eigenvalues are isolated by counting: by Sylvester's law of inertia the
positive pivots of an LDL' factorisation of the shifted matrix are the eigenvalues above
the shift. Bisection on these counts leaves one eigenvalue in an interval, Rayleigh
quotient iteration converges to it cubically, and two more counts right below and above
certify its number. Eigenvalues that rounding cannot part are taken as one cluster, whose
vectors are made orthogonal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.llm.common import stored, table

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = float(2 ** 52)  # an entry from here on has no integer form in a long
EXACT = 2 ** 53  # doubles are exact integers below
LOW = 60  # bits in the lower half of a sum
EPS = np.finfo(float).eps


# ---- eigenvalues by counting -------------------------------------------------------------

def positive_pivots(matrix: np.ndarray) -> int:
    """Number of positive eigenvalues of a symmetric matrix, from the pivots of LDL'.

    Pivots of one or two rows are chosen by their size, so no division is by a small number;
    a pivot pair of two rows has one eigenvalue of each sign.
    """
    a, bound, found = matrix.copy(), (1 + np.sqrt(17)) / 8, 0
    while len(a):
        column = np.abs(a[1:, 0])
        r = int(column.argmax()) + 1 if len(column) else 0
        top = column[r - 1] if len(column) else 0.0
        if max(abs(a[0, 0]), top) == 0:
            a = a[1:, 1:]
            continue
        single, swap = True, 0
        if abs(a[0, 0]) < bound * top:
            other = np.abs(a[r])
            other[r] = 0
            if abs(a[0, 0]) * other.max() < bound * top * top:
                single = bool(abs(a[r, r]) >= bound * other.max())
                swap = r
        into = 0 if single else 1
        if swap != into and swap:
            a[[into, swap]] = a[[swap, into]]
            a[:, [into, swap]] = a[:, [swap, into]]
        if single:
            found += a[0, 0] > 0
            a = a[1:, 1:] - np.outer(a[1:, 0] / a[0, 0], a[0, 1:])
        else:
            found += 1
            a = a[2:, 2:] - a[2:, :2] @ np.linalg.solve(a[:2, :2], a[:2, 2:])
    return int(found)


class Spectrum:
    """The eigenvalues of a symmetric matrix, numbered from the largest, by counts."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.size = len(matrix)
        self.norm = float(np.abs(matrix).sum(axis=1).max()) if len(matrix) else 0.0
        self.rounding = 4 * EPS * max(1, self.size) * self.norm
        edge = self.norm * 1.01 + self.rounding
        self.counts: dict[float, int] = {-edge: self.size, edge: 0}

    def above(self, shift: float) -> int:
        """How many eigenvalues are larger than ``shift``."""
        if shift not in self.counts:
            self.counts[shift] = positive_pivots(self.matrix - shift * np.eye(self.size))
        return self.counts[shift]

    def interval(self, k: int) -> tuple[float, float]:
        """The narrowest counted interval that holds eigenvalue ``k`` (from 1)."""
        return max(s for s, c in self.counts.items() if c >= k), min(s for s, c in self.counts.items() if c < k)

    def halve(self, k: int) -> tuple[float, float]:
        low, high = self.interval(k)
        self.above((low + high) / 2)
        return self.interval(k)

    def isolate(self, k: int) -> tuple[float, float, int, int]:
        """Interval around eigenvalue ``k`` and the first and last number of those it holds."""
        low, high = self.interval(k)
        while self.above(low) - self.above(high) > 1 and high - low > self.rounding:
            low, high = self.halve(k)
        return low, high, self.above(high) + 1, self.above(low)

    def _step(self, shift: float, x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
        try:
            y = np.linalg.solve(self.matrix - shift * np.eye(self.size), x)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            y = np.linalg.solve(self.matrix - (shift + self.rounding) * np.eye(self.size), x)
        y /= np.abs(y).max()
        for _ in range(2):
            for v in found:
                y = y - v * (v @ y)
        return y / np.linalg.norm(y)

    def vector(self, k: int, found: list[np.ndarray]) -> tuple[float, np.ndarray]:
        """Eigenvalue ``k`` and its unit vector; ``found`` are the vectors before it."""
        start = np.random.default_rng(k).normal(size=self.size)
        while True:
            low, high, first, last = self.isolate(k)
            x = self._step((low + high) / 2, start, found)
            best, left = None, np.inf
            for _ in range(30):
                value = float(x @ self.matrix @ x)
                rest = float(np.linalg.norm(self.matrix @ x - value * x))
                if rest < left:
                    best, left = (value, x), rest
                if rest >= left and rest <= self.rounding or not low <= value <= high and first == last:
                    break
                x = self._step(value, x, found)
            value, x = best
            if first < last:  # numerically equal: any orthogonal vectors of the cluster do
                return value, x
            if left <= self.rounding and low <= value <= high:
                room = left + self.rounding
                if self.above(value - room) >= k > self.above(value + room):
                    return value, x
            if high - low <= self.rounding:
                return value, x
            self.halve(k)


def leading_components(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``wanted`` positive eigenvalues, falling, and their unit vectors as rows.

    Eigenvalues that are zero up to rounding are left out: nothing can be divided by them.
    """
    spectrum, values, vectors = Spectrum(matrix), [], []
    for k in range(1, min(wanted, len(matrix)) + 1 if spectrum.norm else 1):
        value, x = spectrum.vector(k, vectors)
        if value <= spectrum.rounding:
            break
        values.append(value)
        vectors.append(x)
    return np.array(values), np.array(vectors).reshape(len(vectors), len(matrix))


# ---- exact sums --------------------------------------------------------------------------

def usable(entries: Column) -> Column:
    """Whether a vector takes part: entries are there, none null, not finite or beyond a long."""
    fine = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)))
    return F.coalesce(entries.isNotNull() & (F.size(entries) > 0) & fine, F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _halves(totals: list[int]) -> list[pa.Array]:
    """Sums of any size as two decimals each, which Spark adds without loss."""
    from decimal import Decimal
    kind = pa.decimal128(38, 0)
    return [pa.array([Decimal(t >> LOW) for t in totals], kind),
            pa.array([Decimal(t & ((1 << LOW) - 1)) for t in totals], kind)]


def _whole(row) -> int:
    return (int(row["high"]) << LOW) + int(row["low"])


def _column_sums(x: np.ndarray) -> np.ndarray:
    small = len(x) == 0 or int(np.abs(x).max()) * len(x) < 2 ** 62
    return x.sum(axis=0).astype(object) if small else x.astype(object).sum(axis=0)


class ProductSum:
    """Exact sum of products of the columns of integers; a matrix of longs as long as they hold it."""

    def __init__(self, width: int):
        self.now = np.zeros((width, width), dtype=np.int64)
        self.room = 2 ** 62
        self.full: np.ndarray | None = None

    def add(self, y: np.ndarray) -> None:
        largest = max(1, int(np.abs(y).max())) if len(y) else 1
        rows = EXACT // largest ** 2  # so many rows' sums are exact in doubles
        if not rows:
            wide = y.astype(object)
            self.full = wide.T @ wide + (0 if self.full is None else self.full)
            return
        for at in range(0, len(y), rows):
            part = y[at:at + rows].astype(np.float64)
            if self.room < EXACT:
                self.full, self.now, self.room = self.total(), np.zeros_like(self.now), 2 ** 62
            self.now += (part.T @ part).astype(np.int64)
            self.room -= len(part) * largest ** 2

    def total(self) -> np.ndarray:
        return self.now.astype(object) + (0 if self.full is None else self.full)


def _first_moments(x: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums per dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(width, dtype=object)
        for batch in batches:
            m = _matrix(batch.column(0), width)
            n, sums = n + len(m), sums + _column_sums(m)
        if n:
            yield pa.record_batch([pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()),
                                   *_halves([int(s) for s in sums])], names=["i", "n", "high", "low"])

    rows = x.select("x").mapInArrow(add, "i int, n long, high decimal(38,0), low decimal(38,0)") \
        .groupBy("i").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")) \
        .orderBy("i").collect()
    return (rows[0]["n"] if rows else 0), [_whole(r) for r in rows]


def covariance(x: DataFrame, width: int, n: int, sums: list[int]) -> tuple[np.ndarray, float]:
    """Covariance matrix of the integer vectors (divisor n) and its trace, each rounded once.

    Entries are centred at the integer next to their mean before they are multiplied; what
    that leaves of the mean is taken off exactly.
    """
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    i, j = np.triu_indices(width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, some = ProductSum(width), False
        for batch in batches:
            m = _matrix(batch.column(0), width)
            own.add(m - centre)
            some = some or len(m) > 0
        if some:
            total = own.total()
            yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                   *_halves([int(t) for t in total[i, j]])], names=["i", "j", "high", "low"])

    rows = x.select("x").mapInArrow(add, "i int, j int, high decimal(38,0), low decimal(38,0)") \
        .groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    rest = [s - n * int(c) for s, c in zip(sums, centre)]
    out, trace = np.zeros((width, width)), 0
    for r in rows:
        exact = n * _whole(r) - rest[r["i"]] * rest[r["j"]]
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = exact / n ** 2  # division of integers rounds once
        trace += exact if r["i"] == r["j"] else 0
    return out, trace / n ** 2


def deviations(y: np.ndarray, n: int, rest: np.ndarray) -> list[int | None]:
    """Sums over the dimensions of (n*y - rest)^2, exact; none where a long cannot hold it."""
    about = ((float(n) * y - rest.astype(np.float64)) ** 2).sum(axis=1)
    with np.errstate(over="ignore"):  # arithmetic modulo 2^64 is exact where the result fits
        d = np.uint64(n) * y.astype(np.uint64) - np.array([int(r) % 2 ** 64 for r in rest], dtype=np.uint64)
        exact = (d * d).sum(axis=1).tolist()
    limit = 2.0 ** 63
    out: list[int | None] = [e if a < limit * 0.999 else None for e, a in zip(exact, about)]
    for at in np.flatnonzero((about >= limit * 0.999) & (about < limit * 1.001)):
        full = sum((n * int(a) - int(b)) ** 2 for a, b in zip(y[at], rest))
        out[at] = full if full < 2 ** 63 else None
    return out


# ---- the operator ------------------------------------------------------------------------

RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, " \
         "identity_error double, distance double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every usable row of ``embeddings`` (vec_id, embedding).

    Rows whose vector is null, empty or holds null, non-finite or too large entries (2^52
    on) take no part, nor do vectors of another length than most have (of lengths equally
    common, the shortest counts). Floats and doubles are taken alike. Repeated rows, equal
    vectors and null ids each count and give rows. There are as many components as the
    covariance has positive eigenvalues, ``components`` at most: equal vectors, a single one
    or an empty table give no rows. ``deviation`` is null where no long can hold it;
    ``distance``, the same sum over (x - S/n)^2, is always given.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("embedding").cast("array<double>").alias("e")).where(usable(F.col("e")))
    width = rows.groupBy(F.size("e").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if width is None:
        return spark.createDataFrame([], RESULT)
    width = width["width"]
    x = rows.where(F.size("e") == width).select(
        "vec_id", F.transform("e", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))
    n, sums = _first_moments(x, width)
    matrix, trace = covariance(x, width, n, sums)
    values, vectors = leading_components(matrix, components)
    k = len(values)
    if not k:
        return spark.createDataFrame([], RESULT)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    rest = np.array([s - n * int(c) for s, c in zip(sums, centre)], dtype=object)
    left = np.array([int(r) / n for r in rest])
    onto = (vectors / np.sqrt(values)[:, None]).T

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch.column(1), width) - centre
            if len(y):
                own = y - left
                white = own @ onto
                yield pa.record_batch([
                    batch.column(0), pa.array(deviations(y, n, rest), pa.int64()), pa.array((own * own).sum(axis=1)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * k, pa.int32()), pa.array(white.ravel()))],
                    names=["vec_id", "deviation", "distance", "white"])

    done = stored(x.mapInArrow(project, "vec_id long, deviation long, distance double, white array<double>"), "whitened")
    error = identity_error(done, k)
    share = F.array(*[F.lit(float(v / trace)) for v in values])
    return done.select("*", F.posexplode("white").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"), "distance")


def identity_error(done: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of ``white`` minus the identity."""
    w = [F.element_at("white", c + 1) for c in range(k)]
    means = done.agg(*[F.avg(c) for c in w]).first()
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    cov = done.agg(*[F.avg((w[a] - F.lit(means[a])) * (w[b] - F.lit(means[b]))) for a, b in pairs]).first()
    return max(abs(c - (a == b)) for c, (a, b) in zip(cov, pairs))


def op12_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in their first eight whitened components."""
    return whiten(table(spark, sf_dir, "embeddings"))
