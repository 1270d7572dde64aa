"""Embedding whitening: leading components of a covariance by spectrum slicing.

Vectors become integers (``floor(64 * c) + 1000000``), so the fit is exact: sums, then products of what is left after
the rounded mean is taken off, are added up as whole numbers, and the rest of the mean is taken off exactly. No order
of tasks changes a digit. The covariance V (divisor n) is as wide as a vector and goes to the driver. There:

1. V is brought to tridiagonal form by Householder reflections, which keeps its eigenvalues. The signs of the pivots of
   an LDL' factorisation of ``V - shift`` tell how many eigenvalues lie above a shift; halving intervals by these
   counts isolates each leading eigenvalue.
2. Rayleigh quotient iteration from the middle of each interval finds its eigenvector, with cubic convergence.
   Eigenvalues closer than counts can tell apart keep their vectors apart by orthogonalising.
3. Counts just above and below each Rayleigh quotient certify that it is the k-th one.

The input is read five times (width, sums, products, a check of the outcome, the outcome itself) and never shuffled:
what tasks send on is one row for each sum.

Defined cases: vectors that are null or empty, or hold null, NaN or infinity, are dropped; so are vectors of another
length than the most frequent one (the greater of equally frequent ones). Beyond 2**62 an entry's integer stays there.
Repeated rows count and come out as often as they occur; a null id stays null. An empty table gives no rows, nor do
directions without spread (a table of one vector has none). Equal eigenvalues are numbered in the order they are found, the
same for all rows. ``deviation`` is null where it does not fit a long (from some 5 * 10**7 rows on); ``deviation_digits`` always
has it. Columns other than the id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import query, table

SCALE, OFFSET = 64, 1_000_000
LARGEST = 2 ** 62
COMPONENTS = 32
LIMBS = 5  # of 32 bits: what a whole number is sent in, so that Spark may add it up as longs
EPS = float(np.finfo(float).eps)

CELLS = "cell bigint, " + ", ".join(f"l{k} bigint" for k in range(LIMBS))


@dataclass
class Whitening:
    """What a fit has found; ``sums`` are whole numbers, one for each dimension."""

    n: int
    sums: list[int]
    values: np.ndarray      # eigenvalues, falling
    components: np.ndarray  # a row for each, of length 1
    trace: float

    @property
    def middle(self) -> list[int]:
        """The mean, rounded down."""
        return [s // self.n for s in self.sums]

    @property
    def rest(self) -> list[int]:
        """What the sums have beyond n times the middle."""
        return [s % self.n for s in self.sums]


def whole(df: DataFrame, vector: str, size: int) -> DataFrame:
    """The rows whose vector has ``size`` finite entries."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.where(F.col(vector).isNotNull() & (F.size(vector) == size) & ~odd)


def width(df: DataFrame, vector: str) -> int:
    """The most frequent length among usable vectors, 0 without any."""
    length = F.size(vector)
    usable = df.where(F.col(vector).isNotNull() & (length > 0)).withColumn("w", length)
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    found = usable.where(~odd).groupBy("w").count().orderBy(F.desc("count"), F.desc("w")).first()
    return found["w"] if found else 0


def integers(column: pa.Array, size: int) -> np.ndarray:
    """The integers of a column of lists, a row for each."""
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, size)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * values), -LARGEST, LARGEST).astype(np.int64) + OFFSET


def exact_sums(x: np.ndarray) -> np.ndarray:
    """Sums of the columns as whole numbers of any size."""
    return (x >> 32).sum(axis=0).astype(object) * 2 ** 32 + (x & 0xFFFFFFFF).sum(axis=0).astype(object)


def exact_products(y: np.ndarray) -> np.ndarray:
    """y'y as whole numbers: floating point is exact as long as no sum leaves 53 bits."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < 2 ** 53:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    big = y.astype(object)
    return big.T @ big


def cells(numbers: dict[int, int]) -> pa.RecordBatch:
    columns: list[list[int]] = [[] for _ in range(LIMBS + 1)]
    for cell, v in numbers.items():
        columns[0].append(cell)
        for k in range(1, LIMBS):
            columns[k].append(v & 0xFFFFFFFF)
            v >>= 32
        columns[LIMBS].append(v)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                      names=["cell", *(f"l{k}" for k in range(LIMBS))])


def summed(rows: DataFrame) -> dict[int, int]:
    """The total of each cell."""
    totals = rows.groupBy("cell").agg(*(F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS))).collect()
    return {r["cell"]: sum(r[f"l{k}"] << (32 * k) for k in range(LIMBS)) for r in totals}


def fit(df: DataFrame, vector: str = "embedding", count: int = COMPONENTS) -> Whitening | None:
    """The leading components of all usable vectors; None without any."""
    size = width(df, vector)
    if not size:
        return None
    rows = whole(df, vector, size).select(vector)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(size, object)
        for batch in batches:
            n += batch.num_rows
            sums += exact_sums(integers(batch.column(0), size))
        if n:
            yield cells({-1: n} | {i: int(s) for i, s in enumerate(sums)})

    found = summed(rows.mapInArrow(add, CELLS))
    n, sums = found[-1], [found[i] for i in range(size)]
    centre = np.array([s // n for s in sums], np.int64)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((size, size), object), False
        for batch in batches:
            if batch.num_rows:
                total += exact_products(integers(batch.column(0), size) - centre)
                seen = True
        if seen:
            yield cells({i * size + j: int(total[i, j]) for i in range(size) for j in range(i, size)})

    products = summed(rows.mapInArrow(multiply, CELLS))
    rest = [s % n for s in sums]
    covariance = np.empty((size, size))
    for i in range(size):
        for j in range(i, size):
            # whole numbers up to here; this division is the first that rounds
            covariance[i, j] = covariance[j, i] = (n * products[i * size + j] - rest[i] * rest[j]) / (n * n)
    values, components = leading(covariance, count)
    return Whitening(n, sums, values, components, float(np.trace(covariance)))


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squares beside it of a tridiagonal matrix with the eigenvalues of symmetric ``v``."""
    a, d = v.copy(), len(v)
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if not norm:
            continue
        x[0] += norm if x[0] >= 0 else -norm
        x /= np.linalg.norm(x)
        block = a[k + 1:, k + 1:]
        p = block @ x
        w = p - (x @ p) * x
        block -= 2 * (np.outer(x, w) + np.outer(w, x))
        a[k + 1:, k] -= 2 * x * (x @ a[k + 1:, k])
    return np.diag(a).copy(), np.square(np.diag(a, -1))


def above(diagonal: np.ndarray, squares: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues are greater than each shift: the positive pivots of LDL' of the shifted matrix."""
    least = 1e-290 * max(1.0, float(squares.max(initial=0)))
    pivot = diagonal[0] - shifts
    found = (pivot > 0).astype(int)
    for d, s in zip(diagonal[1:], squares, strict=True):
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        pivot = d - shifts - s / pivot
        found += pivot > 0
    return found


def slices(diagonal: np.ndarray, squares: np.ndarray, count: int, finest: float) -> tuple[np.ndarray, np.ndarray]:
    """For each of the greatest ``count`` eigenvalues an interval, by halving.

    It ends when the interval holds this one alone and is short against the distance of its neighbours, or at
    ``finest``.
    """
    beside = np.sqrt(np.concatenate(([0], squares))) + np.sqrt(np.concatenate((squares, [0])))
    order = np.arange(count)
    low = np.full(count, (diagonal - beside).min() - finest)
    high = np.full(count, (diagonal + beside).max() + finest)
    while True:
        apart = low[:-1] - high[1:]
        room = np.minimum(np.concatenate(([np.inf], apart)), np.concatenate((apart, [np.inf])))
        open_ = (high - low > finest) & ((high - low) * 16 > room)
        if count == 1:
            open_ = high - low > max(finest, 1e-6 * (np.abs(high) + np.abs(low))[0])
        if not open_.any():
            return low, high
        middle = (low + high) / 2
        more = above(diagonal, squares, middle) > order
        low = np.where(open_ & more, middle, low)
        high = np.where(open_ & ~more, middle, high)


def rayleigh(v: np.ndarray, shift: float, beside: np.ndarray, start: np.ndarray, scale: float
             ) -> tuple[float, np.ndarray, float]:
    """Rayleigh quotient iteration: eigenvalue, unit eigenvector apart from ``beside``, residual."""
    def unit(x: np.ndarray) -> np.ndarray:
        for _ in range(2 if len(beside) else 0):
            x = x - beside.T @ (beside @ x)
        return x / np.linalg.norm(x)

    def solved(rho: float, x: np.ndarray) -> np.ndarray:
        for push in (0, 1, 4, 16):
            try:
                y = np.linalg.solve(v - (rho + push * EPS * scale) * np.eye(len(v)), x)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(y).all():
                return unit(y)
        return x

    x = unit(start)
    for _ in range(2):  # with the shift held, towards the eigenvalue nearest to it
        x = solved(shift, x)
    best = None
    for _ in range(12):
        rho = float(x @ v @ x)
        residual = float(np.linalg.norm(v @ x - rho * x))
        if best is not None and residual >= best[2] / 2:
            return best if best[2] <= residual else (rho, x, residual)
        best = rho, x, residual
        x = solved(rho, x)
    return best


def leading(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues of symmetric ``v`` that differ from 0, and their unit eigenvectors as rows.

    Raises ``ArithmeticError`` if the counts do not certify the numbering.
    """
    scale = float(np.abs(v).sum(axis=1).max())
    if not scale:
        return np.empty(0), np.empty((0, len(v)))
    v, unit = v / scale, scale
    fine = 16 * len(v) * EPS
    diagonal, squares = tridiagonal(v)
    rank = int(above(diagonal, squares, np.array([fine]))[0])
    count = min(count, rank)
    if not count:
        return np.empty(0), np.empty((0, len(v)))
    low, high = slices(diagonal, squares, min(count + 1, len(v)), fine)
    draws = np.random.default_rng(0)
    values, vectors = np.empty(0), np.empty((0, len(v)))
    for k in range(count):
        a, b = low[k], high[k]
        for _ in range(60):
            near = vectors[values < b + 1e-3]
            rho, x, residual = rayleigh(v, (a + b) / 2, near, draws.standard_normal(len(v)), 1.0)
            if a - fine <= rho <= b + fine and residual <= fine:
                break
            middle = (a + b) / 2
            a, b = (middle, b) if above(diagonal, squares, np.array([middle]))[0] > k else (a, middle)
        x = x * (1 if x[np.argmax(np.abs(x))] > 0 else -1)
        values, vectors = np.append(values, rho), np.vstack((vectors, x))
    order = np.arange(count)
    over, under = (above(diagonal, squares, values + d) for d in (2 * fine, -2 * fine))
    apart = float(np.abs(vectors @ vectors.T - np.eye(count)).max())
    if not ((over <= order).all() and (under > order).all() and apart < 1e-8):
        raise ArithmeticError("the counts do not certify the numbering of the components")
    order = np.argsort(-values, kind="stable")
    return values[order] * unit, vectors[order]


def projection(model: Whitening) -> np.ndarray:
    return model.components.T / np.sqrt(model.values)


def centred(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """Integers less the rounded mean, and the same less the whole mean as doubles."""
    y = x - np.array(model.middle, np.int64)
    return y, y.astype(float) - np.array([r / model.n for r in model.rest])


def deviations(y: np.ndarray, n: int, rest: list[int]) -> list[int]:
    """sum((n * y - rest) ** 2) of each row, as whole numbers."""
    most, d = int(np.abs(y).max(initial=0)), y.shape[1]
    high, low = np.array([r >> 20 for r in rest], object), np.array([r & 0xFFFFF for r in rest], np.int64)
    if most * most * d < LARGEST and most * max(int(high.max()), 2 ** 20) * d < LARGEST:
        squares = (y * y).sum(axis=1).tolist()
        mixed = zip((y @ high.astype(np.int64)).tolist(), (y @ low).tolist(), strict=True)
        fixed = sum(r * r for r in rest)
        return [n * n * s - 2 * n * ((a << 20) + b) + fixed for s, (a, b) in zip(squares, mixed, strict=True)]
    big = y.astype(object) * n - np.array(rest, object)
    return (big * big).sum(axis=1).tolist()


def whitened(df: DataFrame, model: Whitening, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, deviation, deviation_digits, whitened array<double>) of every usable row."""
    size = len(model.sums)
    rows = whole(df, vector, size).select(F.col(vec_id).alias("id"), vector)
    kind = rows.schema["id"].dataType.simpleString()
    weights = projection(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, t = centred(integers(batch.column(1), size), model)
            out = t @ weights
            exact = deviations(y, model.n, model.rest) if len(y) else []
            ends = pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([e if e < 2 ** 63 else None for e in exact], pa.int64()),
                 pa.array([str(e) for e in exact], pa.string()), pa.ListArray.from_arrays(ends, pa.array(out.reshape(-1)))],
                names=["id", "deviation", "deviation_digits", "whitened"])

    return rows.mapInArrow(project, f"id {kind}, deviation bigint, deviation_digits string, whitened array<double>"
                           ).withColumnRenamed("id", vec_id)


def identity_error(df: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """The largest entry of the covariance of whitened rows less the identity, from a pass over all of them."""
    size, count, weights = len(model.sums), len(model.values), projection(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows are centred already; what rounding leaves of their mean is summed as row ``count``
        total, seen = np.zeros((count + 1, count)), False
        for batch in batches:
            if batch.num_rows:
                out = centred(integers(batch.column(0), size), model)[1] @ weights
                total += np.vstack((out.T @ out, out.sum(axis=0)))
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.reshape(-1))],
                                             names=["cell", "v"])

    found = whole(df, vector, size).select(vector).mapInArrow(add, "cell bigint, v double")
    total = np.zeros((count + 1) * count)
    for r in found.groupBy("cell").agg(F.sum("v").alias("v")).collect():
        total[r["cell"]] = r["v"] / model.n
    total = total.reshape(count + 1, count)
    mean = total[count]
    return float(np.abs(total[:count] - np.outer(mean, mean) - np.eye(count)).max())


@query("op11_embedding_whitening")
def op11(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    model = fit(vectors)
    if model is None or not len(model.values):
        return spark.createDataFrame([], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
                                         "explained double, identity_error double, deviation_digits string")
    explained = F.array(*(F.lit(float(e / model.trace)) for e in model.values))
    rows = whitened(vectors, model).select("vec_id", "deviation", "deviation_digits", F.posexplode("whitened").alias("k", "w"))
    return rows.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
                       F.col("w").alias("whitened"), F.element_at(explained, F.col("k") + 1).alias("explained"),
                       F.lit(identity_error(vectors, model)).alias("identity_error"), "deviation_digits")
