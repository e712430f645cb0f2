"""Embedding whitening: exact covariances from variances of sums of two dimensions, components by eigh."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries become floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Rows of an Arrow batch worked on together.
ROWS = 2048
#: Whole numbers up to here are summed in 64 bits, larger ones as Python integers.
SAFE = 1 << 62
#: Components whose variance is below this share of the total are rounding errors and have no whitened values.
NO_VARIANCE = 1e-12


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with the sums ``total`` of each dimension; ``axes`` holds the unit components as rows,
    ``variance`` their variances, ``trace`` the sum of all."""

    n: int
    total: list[int]
    axes: np.ndarray
    variance: np.ndarray
    trace: float


def _clean(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the vectors without null and non-finite entries."""
    v = F.col(vec_col).cast("array<double>")
    sound = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(sound).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def _whole(column: pa.Array, d: int) -> np.ndarray:
    """Rows of x = floor(SCALE * entry) + OFFSET, as 64-bit integers or, where these do not suffice, Python's."""
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)
    with np.errstate(over="ignore"):
        scaled = np.floor(c * SCALE)
    if len(c) == 0 or np.abs(scaled).max(initial=0.0) < 2.0**60:
        return scaled.astype(np.int64) + OFFSET
    exact = [[(a * SCALE) // b + OFFSET for a, b in (float(x).as_integer_ratio() for x in row)] for row in c]
    return np.array(exact, object)


def _pieces(batches: Iterator[pa.RecordBatch], d: int, at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole in batches:
        for lo in range(0, whole.num_rows, ROWS):
            batch = whole.slice(lo, ROWS)
            yield batch, _whole(batch.column(at), d)


def _magnitude(x: np.ndarray) -> int:
    return int(abs(x).max()) if x.size else 0


def _text(values) -> list[str]:
    return [str(int(x)) for x in values]


def _add_up(rows: DataFrame, width: int) -> list[int]:
    """Sums of the positions of arrays of whole numbers (as text), one array a task, exact up to 38 digits. The
    driver gets ``width`` numbers."""
    each = rows.select(F.posexplode("sums").alias("at", "x"))
    found = each.groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
    out = [0] * width
    for r in found:
        out[r["at"]] = int(r["x"])
    return out


def dimension_sums(clean: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of x in every dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * d
        for _, x in _pieces(batches, d, 0):
            n += len(x)
            part = x if _magnitude(x) * ROWS < SAFE else x.astype(object)
            sums = [a + int(b) for a, b in zip(sums, part.sum(axis=0))]
        if n:
            yield pa.RecordBatch.from_pydict({"sums": pa.array([_text([n, *sums])], pa.list_(pa.string()))})

    out = _add_up(clean.select("v").mapInArrow(run, "sums array<string>"), d + 1)
    return out[0], out[1:]


def pair_squares(clean: DataFrame, d: int, n: int, total: list[int]) -> dict[tuple[int, int], int]:
    """For every dimension i, at (i, i), and every pair i < j: the sum of (n * x - S)^2, x being the dimension
    or the sum of the two, S its sum over all vectors.

    Tasks add up squares of y = x - m for the whole number m nearest to the mean, and each y itself stays small.
    As n * x - S = n * y - T with T = S - n * m, the sum wanted is n^2 * sum(y^2) - n * T^2, without rounding."""
    mid = [(2 * s + n) // (2 * n) for s in total]
    size = d * (d + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, some = np.zeros(size, object), False
        for _, x in _pieces(batches, d, 0):
            some = True
            y = x - np.array(mid, x.dtype if max(map(abs, mid), default=0) < SAFE else object)
            if 4 * _magnitude(y) ** 2 * ROWS >= SAFE:
                y = y.astype(object)
            part = []
            for i in range(d):
                pair = y[:, i:] + y[:, i : i + 1]
                pair[:, 0] = y[:, i]
                part.append((pair * pair).sum(axis=0))
            sums = sums + np.concatenate(part).astype(object)
        if some:
            yield pa.RecordBatch.from_pydict({"sums": pa.array([_text(sums)], pa.list_(pa.string()))})

    squares = _add_up(clean.select("v").mapInArrow(run, "sums array<string>"), size)
    rest, out, at = [s - n * m for s, m in zip(total, mid)], {}, 0
    for i in range(d):
        for j in range(i, d):
            t = rest[i] if i == j else rest[i] + rest[j]
            out[i, j] = n * n * squares[at] - n * t * t
            at += 1
    return out


def fit_whitening(clean: DataFrame, d: int, components: int) -> Whitening | None:
    """The components of (vec_id, v), vectors of ``d`` entries; None without vectors.

    Cross-covariances follow by polarisation: 2 * Cov(i, j) = Var(x_i + x_j) - Var(x_i) - Var(x_j), on exact whole
    numbers, rounded once. The driver holds d * (d + 1) / 2 of them and the d x d matrix for eigh."""
    n, total = dimension_sums(clean, d)
    if n == 0:
        return None
    square = pair_squares(clean, d, n, total)
    v = np.zeros((d, d))
    for i, j in square:
        both = square[i, i] if i == j else (square[i, j] - square[i, i] - square[j, j]) // 2  # always even
        v[i, j] = v[j, i] = both / n**3
    e, axes = np.linalg.eigh(v)
    trace = sum(square[i, i] for i in range(d)) / n**3
    e, axes = e[::-1][:components], axes[:, ::-1].T[:components]
    good = e > NO_VARIANCE * trace
    axes = axes[good]
    sign = np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])
    return Whitening(n, total, axes * sign[:, None], e[good], trace)


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - S, exact."""
    bound = model.n * max(_magnitude(x), max(map(abs, model.total), default=0) // max(1, model.n) + 1) * 2
    if bound >= SAFE:
        x = x.astype(object)
    return x * model.n - np.array(model.total, x.dtype)


def _project(d: np.ndarray, model: Whitening) -> np.ndarray:
    return (d / model.n).astype(np.float64) @ model.axes.T / np.sqrt(model.variance)


def identity_error(clean: DataFrame, d: int, model: Whitening) -> float:
    """Largest absolute entry of (covariance of the whitened values - identity), measured over all vectors. The
    tasks add up products of values whose mean is 0 by construction; what rounding left of it is taken off."""
    k = len(model.axes)
    if k == 0:
        return 0.0
    shared = clean.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, some = np.zeros(k + k * k), False
        for _, x in _pieces(batches, d, 0):
            w = _project(_centred(x, shared.value), shared.value)
            sums += np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))
            some = True
        if some:
            yield pa.RecordBatch.from_pydict({"sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})

    each = clean.select("v").mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("at", "x"))
    sums = np.zeros(k + k * k)
    for r in each.groupBy("at").agg(F.sum("x").alias("x")).collect():
        sums[r["at"]] = r["x"]
    mean = sums[:k] / model.n
    return float(np.abs(sums[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): for every vector without null or
    non-finite entries one row a component, 1 to ``components``.

    Entries become x = floor(1024 * entry) + 100000. n: number of vectors; deviation: the exact sum over the
    dimensions of (n * x - S)^2, S being a dimension's sum, as decimal(38,0), null beyond 38 digits; whitened:
    x - S / n projected on the unit component, over the root of its variance (divisor n); explained: the component's
    share of the total variance; identity_error: how far the covariance of all whitened values is from
    the identity at most. Components are ordered by falling variance and signed so that the largest
    entry is positive; of equal variances any basis may stand.

    Dimensions that do not vary add nothing; there are as many components as the vectors' rank
    allows, so that a single vector, or copies of one, have no row. Vectors whose length is not the most frequent
    one (of equally frequent lengths the largest) are left out like faulty ones. Repeated rows count each;
    a null id stays null. Other columns are not read; an empty table gives no rows. The table is read five times;
    nothing but sums is shuffled."""
    spark = vectors.sparkSession
    clean = _clean(vectors, id_col, vec_col)
    top = clean.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    d = top["d"] if top else 0
    if d == 0:
        return spark.createDataFrame([], schema)
    clean = clean.where(F.size("v") == d)
    model = fit_whitening(clean, d, components)
    if model is None or len(model.axes) == 0:
        return spark.createDataFrame([], schema)
    error = identity_error(clean, d, model)
    shared = spark.sparkContext.broadcast(model)
    k, limit = len(model.axes), 10**38

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch, x in _pieces(batches, d, 1):
            far = _centred(x, m)
            big = far if _magnitude(far) ** 2 * d < SAFE else far.astype(object)
            deviation = [str(y) if y < limit else None for y in (int(s) for s in (big * big).sum(axis=1))]
            rows = len(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                 pa.array(deviation, pa.string()).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(_project(far, m).ravel())],
                ["vec_id", "component", "deviation", "whitened"])

    made = clean.mapInArrow(run, "vec_id long, component int, deviation string, whitened double")
    share: Column = F.element_at(F.array(*(F.lit(float(v / model.trace)) for v in model.variance)), F.col("component"))
    return made.select("vec_id", "component", F.lit(model.n).cast("long").alias("n"), F.col("deviation").cast("decimal(38,0)").alias("deviation"),
                       "whitened", share.alias("explained"), F.lit(error).alias("identity_error"))


def whitening_digest(result: DataFrame) -> DataFrame:
    """The query's columns: the deviation in 64 bits, null where these do not hold it."""
    return result.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))
