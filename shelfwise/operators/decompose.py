"""Principal components, truncated SVD and matrix factorisation."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.clean import relevel_ids
from shelfwise.operators.joins import gram_join
from shelfwise.session import delete_path, materialize, scratch_path, written


def covariance_long(book_tag_set: DataFrame, item: str = "tag_id", group: str = "book_id", all_pairs: bool = False) -> DataFrame:
    """Sample covariance of the 0/1 columns in long form without densifying:
    cov_ij = (n_ij - n_i n_j / N) / (N - 1), N = rows (books) of the matrix.
    Output (ti, tj, cov) over pairs that co-occur or i = j; with ``all_pairs`` over every pair of columns, those that never
    co-occur (cov = -n_i n_j / (N (N-1))) included."""
    n = book_tag_set.agg(F.count_distinct(group)).scalar()
    ni = book_tag_set.groupBy(item).agg(F.count(F.lit(1)).alias("_n"))
    co = gram_join(book_tag_set, group, item, left="ti", right="tj", include_diagonal=True)
    a = ni.select(F.col(item).alias("ti"), F.col("_n").alias("_ni"))
    b = ni.select(F.col(item).alias("tj"), F.col("_n").alias("_nj"))
    if all_pairs:
        pairs = a.crossJoin(b).join(co, ["ti", "tj"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    else:
        pairs = co.join(a, "ti").join(b, "tj")
    return pairs.select("ti", "tj", ((F.col("n") - F.col("_ni") * F.col("_nj") / n) / (n - 1)).alias("cov"))


def _orient(pc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Make the largest-magnitude entry of every component (column) positive: (pc, signs)."""
    idx = np.argmax(np.abs(pc), axis=0)
    signs = np.sign(pc[idx, np.arange(pc.shape[1])])
    signs[signs == 0] = 1
    return pc * signs, signs


class PcaFit:
    """Spark ML PCA on centred features (StandardScaler withMean, withStd=False: Spark's PCA
    transform does not centre). The covariance is one distributed pass; the p x p eigen problem
    is local. Components are oriented so their largest-magnitude entry is positive."""

    def __init__(self, vectors: DataFrame, k: int, vec: str = "vec"):
        self.vec = vec
        df = vectors.withColumn("_f", array_to_vector(vec))
        self.scaler = StandardScaler(inputCol="_f", outputCol="_c", withMean=True, withStd=False).fit(df)
        self.model = PCA(k=k, inputCol="_c", outputCol="_pca").fit(self.scaler.transform(df))
        self.pc, self.signs = _orient(self.model.pc.toArray())
        self.ratios = np.array(self.model.explainedVariance.toArray())

    def scores(self, vectors: DataFrame, n_comp: int, key: str = "book_id") -> DataFrame:
        """Centred scores on the first ``n_comp`` components: (key, vec array<double>); a map-only pass."""
        df = vectors.withColumn("_f", array_to_vector(self.vec))
        out = self.model.transform(self.scaler.transform(df))
        signs = F.array(*[F.lit(float(x)) for x in self.signs[:n_comp]])
        arr = F.slice(vector_to_array("_pca"), 1, n_comp)
        return out.select(key, F.zip_with(arr, signs, lambda x, sgn: x * sgn).alias(self.vec))


def variance_table(spark: SparkSession, ratios: np.ndarray) -> DataFrame:
    """(component 1..k, ratio)."""
    return spark.createDataFrame([(i + 1, float(r)) for i, r in enumerate(ratios)], "component int, ratio double")


def select_components(ratios: np.ndarray, threshold: float = 0.015) -> int:
    """Number of components whose explained-variance share exceeds ``threshold``."""
    return int(np.sum(ratios > threshold))


def loadings_table(spark: SparkSession, pc: np.ndarray, terms: Sequence[int], n_comp: int) -> DataFrame:
    """(tag_id, component, loading) for the first ``n_comp`` components (p x n_comp rows)."""
    rows = [(int(terms[i]), j + 1, float(pc[i, j])) for i in range(pc.shape[0]) for j in range(n_comp)]
    return spark.createDataFrame(rows, "tag_id long, component int, loading double")


class SvdResult(NamedTuple):
    """u: (row, vec), s: singular values (descending), v: (col, vec), products: block products made."""

    u: DataFrame
    s: np.ndarray
    v: DataFrame
    products: int


#: Numbers that the table of the SVD's basis may hold before the basis, and then the block, get narrower.
BASIS_NUMBERS = 6_000_000
#: Columns of the matrix in one block of the SVD's tables, entries of one cell, and entries that are worth a cell of their own.
BLOCK_COLS, CELL_ENTRIES, FEW_ENTRIES = 4_096, 262_144, 16_384


def svd_krylov(entries: DataFrame, k: int = 10, block: int | None = None, basis: int | None = None, tol: float = 1e-6,
               max_products: int | None = None, seed: int = 7) -> SvdResult:
    """The ``k`` leading singular triplets of the sparse matrix in ``entries`` (row, col, value), iterated
    until ||A^T u - s v|| <= tol * s for each (A v = s u holds by construction). Raises RuntimeError when
    ``max_products`` block products do not suffice. The residual is read off Gram matrices, which cannot
    tell less than about 1e-8 s, so ``tol`` must be 1e-7 at least. A matrix of lower rank gives fewer triplets.

    Thick-restart block Krylov on A^T A, two products a step. The table X holds, per block of A's columns, their rows of the
    orthonormal basis V (the newest block last) and of what A^T A and (A^T A)^2 made of that block; what A^T A made of the
    other blocks lies in the span of V, so small matrices of coefficients stand for it. Vectors travel as blocks of many
    rows (:class:`_Cells`); all else is block-local NumPy, except Gram matrices of at most (basis + 2 block)^2
    numbers, which are added up on executors before they reach the driver. When V would pass ``basis`` columns it shrinks to
    the leading Ritz vectors, and the next block, orthogonal to all of V, follows on. Before the end the leading Ritz vectors
    are written and multiplied once more, and their residuals count. The table is written once per step and its
    forerunner removed, so lineage and disk stay short. By default ``basis`` is 300 columns of V,
    fewer (six blocks at least) where V would hold more than BASIS_NUMBERS numbers, and ``block`` a tenth of it (``k`` at
    least). Vectors are signed so that the entry of v with the largest magnitude is positive (ties: the smallest column)."""
    if tol < 1e-7:
        raise ValueError("svd: tol must be 1e-7 at least")
    spark = entries.sparkSession
    e = written(entries.select(F.col("row").cast("long"), F.col("col").cast("long"), F.col("value").cast("double")), "entries")
    cells = _Cells(e.dropna())
    n_col = cells.n_col
    basis = basis or min(300, max(6 * k, BASIS_NUMBERS // max(n_col, 1)))
    block = min(block or max(k, basis // 10), n_col)
    max_products = max_products or 3600 // max(block, 1)
    limit = max(basis, 2 * block + k)
    full, path = _kept(cells.stacked(_gaussian(cells.cols, seed, block)), "svd")
    # y: the next V in terms of the columns of the table; held: what A^T A makes of V's older columns in terms of that V
    y, width = _whiten(_gram(full, ["x"]))
    held, done, last_step = np.zeros((width, 0)), 0, False
    while done < max_products:
        n, steps = y.shape[1], min(1 if last_step else 2, max_products - done)
        made = [_kept(cells.product(_times(full, y[:, n - width :])), "product")]
        if steps == 2:
            made.append(_kept(cells.product(made[0][0]), "product"))
        done += steps
        old, (full, path) = path, _kept(_beside([_times(full, y), *[df for df, _ in made]]), "svd")
        for gone in [old, *[at for _, at in made]]:
            delete_path(spark, gone)
        x = _gram(full, ["x"])
        # U = X e_v is V and the products but the last, A^T A U = X e_w; g is the Gram matrix of both
        size = len(x) - width
        e_v, e_w = np.eye(len(x), size), np.zeros((len(x), size))
        e_w[:n, : n - width], e_w[n:, n - width :] = held, np.eye(steps * width)
        g = np.hstack([e_v, e_w]).T @ x @ np.hstack([e_v, e_w])
        # t makes U orthonormal: V is but for the rounding of the projections
        t, m = _whiten(g[:size, :size], least=1e-12)
        both = np.kron(np.eye(2), t)
        g = both.T @ g @ both
        ritz, z = np.linalg.eigh((g[:m, m:] + g[:m, m:].T) / 2)
        ritz, z = ritz[::-1], z[:, ::-1]
        lead, sq = z[:, :k], np.clip(ritz[:k], 0, None)
        dot = lambda q: np.einsum("ij,ij->j", lead, q @ lead)
        off = np.sqrt(np.clip(dot(g[m:, m:]) - 2 * sq * dot(g[:m, m:]) + sq**2, 0, None))
        good = m >= min(k, n_col) and (off <= tol * sq + 1e-12 * sq[0]).all()
        # the next block: the last product, less its part in U, orthonormal
        last, h = x[size:, size:], t.T @ x[:size, size:]
        t1, more = _whiten(last - h.T @ h, np.diag(last))
        if last_step and (good or not more):
            break
        last_step = bool(good or not more)  # if there is no more, U spans all that A^T A reaches
        if last_step:
            y = e_v @ (t @ z[:, : k + block])
            held, width = np.zeros((y.shape[1], 0)), y.shape[1]
            continue
        keep = t @ z[:, : k + block] if m + more > limit else t
        y = np.hstack([e_v @ keep, np.eye(len(x))[:, size:] @ t1 - e_v @ (t @ (h @ t1))])
        held, width = np.linalg.solve(y.T @ x @ y, y.T @ x @ (e_w @ keep)), more
    else:
        for gone in [path, *cells.paths]:
            delete_path(spark, gone)
        raise RuntimeError(f"svd: not converged to {tol} in {max_products} block products")
    lead = e_v @ (t @ lead)
    some = sq > 1e-13 * max(float(sq[0]), 1e-300)  # what is smaller is rounding of A^T A
    lead, s = lead[:, some], np.sqrt(sq[some])
    v = materialize(cells.unstacked(_times(full, lead)))
    for gone in [path, *cells.paths]:
        delete_path(spark, gone)
    top = v.select("col", F.posexplode("vec").alias("i", "x")).groupBy("i").agg(
        F.max(F.struct(F.abs("x").alias("a"), (-F.col("col")).alias("c"), "x")).alias("b")).collect()
    sign = np.array([np.sign(r["b"]["x"]) or 1.0 for r in sorted(top, key=lambda r: r["i"])])
    v = materialize(_rows(v, "col", ["vec"], ["vec"], lambda x: (x * sign,)))
    u = materialize(_rows(_multiply(e, v, "col", "row", len(s)), "row", ["vec"], ["vec"], lambda x: (x / s,)))
    return SvdResult(u, s, v, done)


#: Tables of blocks: the number ``b`` of a block of columns of A, their number ``m``, and a matrix of ``m`` rows as bytes.
BLOCKS = "b int, m int, x binary"


def _kept(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`written`, with the folder, which the caller removes."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def _bytes(*columns: np.ndarray) -> list[pa.Array]:
    return [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in columns]


def _one_block(b: int, x: np.ndarray) -> pa.Table:
    return pa.Table.from_arrays([pa.array([b], pa.int32()), pa.array([len(x)], pa.int32()), *_bytes(x)], ["b", "m", "x"])


def _read(cell: pa.Scalar, kind=np.float64) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), kind)


def _times(blocks: DataFrame, c: np.ndarray) -> DataFrame:
    """The matrix times a small one, block by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, m, x in zip(batch.column("b").to_pylist(), batch.column("m").to_pylist(), batch.column("x")):
                yield from _one_block(b, _read(x).reshape(m, -1) @ c).to_batches()

    return blocks.select("b", "m", "x").mapInArrow(run, BLOCKS)


def _beside(parts: Sequence[DataFrame], kind=np.float64) -> DataFrame:
    """The matrices side by side, block by block."""
    def run(rows: pa.Table) -> pa.Table:
        m, order = rows.column("m")[0].as_py(), np.argsort(rows.column("i").to_numpy())
        x = rows.column("x")
        return _one_block(rows.column("b")[0].as_py(), np.hstack([_read(x[int(i)], kind).reshape(m, -1) for i in order]))

    numbered = [df.select("b", "m", F.lit(i).alias("i"), "x") for i, df in enumerate(parts)]
    return functools.reduce(DataFrame.unionByName, numbered).groupBy("b").applyInArrow(run, BLOCKS)


def _cell(rows: pa.Table) -> pa.Table:
    """The entries (c, row, id, value) of some rows of A, in the order of the rows and in that of the columns, with the
    numbers ``items`` of the columns and the ``ids`` of the rows; ``values`` are those of both orders, or one that all share."""
    row, col, value = (rows.column(x).to_numpy() for x in ("row", "id", "value"))
    order = np.lexsort((col, row))
    row, col, value = row[order], col[order], value[order]
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]).astype(np.int32)
    items, col = np.unique(col, return_inverse=True)
    other = np.argsort(col, kind="stable")
    ids = row[starts]
    row = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.r_[starts, len(row)]))
    col_starts = np.searchsorted(col[other], np.arange(len(items))).astype(np.int32)
    value = value[:1] if (value == value[0]).all() else np.concatenate([value, value[other]])
    return pa.Table.from_arrays(
        [pa.array([rows.column("c")[0].as_py()], pa.int32()), *_bytes(starts, col.astype(np.int32), col_starts, row[other], value, items, ids)],
        ["c", "starts", "cols", "col_starts", "rows", "value", "items", "ids"])


def _sums(x: np.ndarray, at: np.ndarray, starts: np.ndarray, value: np.ndarray, kind=np.float64, most: int = 65_536) -> np.ndarray:
    """Per run of entries (from ``starts``) the sum of value * x[at], about ``most`` entries at once."""
    out, ends = np.empty((len(starts), x.shape[1]), kind), np.r_[starts, len(at)]
    cuts = np.unique(np.r_[np.searchsorted(starts, np.arange(0, len(at), most)), len(starts)])
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        some = slice(ends[lo], ends[hi])
        part = x[at[some]]
        if len(value) > 1 or value[0] != 1:
            part = part * (value[some, None] if len(value) > 1 else value[0])
        out[lo:hi] = np.add.reduceat(part, starts[lo:hi] - ends[lo], axis=0, dtype=kind)
    return out


class _Cells:
    """A sparse matrix A for products A^T A x: the entries of a share of the rows form a cell, held as a few arrays. A block of
    x sends every cell the rows of the columns that stand in it, the cell multiplies, and sends the same rows back.
    ``cols``: (col) rows that take the place of the columns of ``e``; ``entries``: those of a cell."""

    def __init__(self, e: DataFrame, cols: DataFrame | None = None, entries: int | None = None):
        self.size = size = BLOCK_COLS
        numbered = relevel_ids(e if cols is None else cols, "col", "id").withColumn("b", F.floor(F.col("id") / size).cast("int"))
        self.cols, path = _kept(numbered, "columns")
        self.n_col, n = self.cols.count(), e.count()
        count = max(1, -(-n // (entries or CELL_ENTRIES)), min(16, n // FEW_ENTRIES))
        cell = F.pmod(F.xxhash64("row"), F.lit(count)).cast("int").alias("c")
        dealt = e.join(self.cols, "col").select(cell, "row", "id", "value").groupBy("c")
        self.cells, cells_path = _kept(dealt.applyInArrow(_cell, "c int, starts binary, cols binary, col_starts binary, "
                                                          "rows binary, value binary, items binary, ids binary"), "cells")

        def routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for c, items in zip(batch.column("c").to_pylist(), batch.column("items")):
                    ids = _read(items, np.int64)
                    blocks, first = np.unique(ids // size, return_index=True)
                    at = [x.astype(np.int32).tobytes() for x in np.split(ids % size, first[1:])]
                    yield pa.RecordBatch.from_pydict({"b": pa.array(blocks, pa.int32()), "c": pa.array([c] * len(blocks), pa.int32()),
                                                      "at": pa.array(at, pa.binary())})

        self.routes, routes_path = _kept(self.cells.select("c", "items").mapInArrow(routes, "b int, c int, at binary"), "routes")
        self.paths = [path, cells_path, routes_path]

    def stacked(self, rows: DataFrame) -> DataFrame:
        """The rows (col, id, b, vec) as a table of blocks."""
        def run(rows: pa.Table) -> pa.Table:
            x = rows.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
            return _one_block(rows.column("b")[0].as_py(), x[np.argsort(rows.column("id").to_numpy())])

        return rows.select("b", "id", "vec").groupBy("b").applyInArrow(run, BLOCKS)

    def unstacked(self, blocks: DataFrame) -> DataFrame:
        """The table of blocks as rows (col, vec)."""
        size = self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for b, m, x in zip(batch.column("b").to_pylist(), batch.column("m").to_pylist(), batch.column("x")):
                    yield pa.RecordBatch.from_arrays([pa.array(b * size + np.arange(m)), _lists(_read(x).reshape(m, -1))], ["id", "vec"])

        return blocks.mapInArrow(run, "id long, vec array<double>").join(self.cols, "id").select("col", "vec")

    def product(self, blocks: DataFrame) -> DataFrame:
        """The table of blocks of A^T A x."""
        n_col, size = self.n_col, self.size

        def send(block: pa.Table, routes: pa.Table) -> pa.Table:
            x = _read(block.column("x")[0]).reshape(block.column("m")[0].as_py(), -1)
            rows = [x[_read(at, np.int32)].tobytes() for at in routes.column("at")]
            return pa.table({"c": routes.column("c"), "b": routes.column("b"), "x": pa.array(rows, pa.binary())})

        def multiply(parts: pa.Table, cell: pa.Table) -> pa.Table:
            starts, cols, col_starts, rows = (_read(cell.column(x)[0], np.int32) for x in ("starts", "cols", "col_starts", "rows"))
            items, value = _read(cell.column("items")[0], np.int64), _read(cell.column("value")[0])
            both = np.split(value, 2) if len(value) > 1 else [value, value]
            parts = parts.sort_by("b")
            x = np.concatenate([_read(x) for x in parts.column("x")]).reshape(len(items), -1)
            x = _sums(_sums(x, cols, starts, both[0]), rows, col_starts, both[1])
            blocks, first = np.unique(items // size, return_index=True)
            at = [y.astype(np.int32).tobytes() for y in np.split(items % size, first[1:])]
            return pa.table({"b": pa.array(blocks, pa.int32()), "at": pa.array(at, pa.binary()),
                             "x": pa.array([y.tobytes() for y in np.split(x, first[1:])], pa.binary())})

        def add(parts: pa.Table) -> pa.Table:
            b = parts.column("b")[0].as_py()
            m, total = min(size, n_col - b * size), None
            for at, x in zip(parts.column("at"), parts.column("x")):
                at = _read(at, np.int32)
                x = _read(x).reshape(len(at), -1)
                total = np.zeros((m, x.shape[1])) if total is None else total
                total[at] += x
            return _one_block(b, total)

        sent = blocks.groupBy("b").cogroup(self.routes.groupBy("b")).applyInArrow(send, "c int, b int, x binary")
        back = sent.groupBy("c").cogroup(self.cells.groupBy("c")).applyInArrow(multiply, "b int, at binary, x binary")
        return back.groupBy("b").applyInArrow(add, BLOCKS)


def svd_certificate(entries: DataFrame, svd: SvdResult) -> DataFrame:
    """(component, s, res_left, res_right, ortho_u, ortho_v): ||A v - s u|| / s, ||A^T u - s v|| / s and the
    largest deviation of the component's row of U^T U and V^T V from the identity, all recomputed."""
    k, scale = len(svd.s), svd.s  # the closures below must not hold the tables
    e = entries.select(F.col("row").cast("long"), F.col("col").cast("long"), F.col("value").cast("double"))

    def residual(block: DataFrame, key: str, other: DataFrame, out: str) -> np.ndarray:
        made = _multiply(e, block, key, out, k).withColumnRenamed("vec", "a").join(other, out)
        diff = _rows(made, out, ["a", "vec"], ["d"], lambda a, x: (a - x * scale,))
        return np.sqrt(np.clip(np.diag(_gram(diff, ["d"])), 0, None)) / scale

    left, right = residual(svd.v, "col", svd.u, "row"), residual(svd.u, "row", svd.v, "col")
    off = [np.abs(_gram(x, ["vec"]) - np.eye(k)).max(axis=1) for x in (svd.u, svd.v)]
    rows = [(i + 1, *(float(c[i]) for c in (scale, left, right, *off))) for i in range(k)]
    return entries.sparkSession.createDataFrame(
        rows, "component int, s double, res_left double, res_right double, ortho_u double, ortho_v double")


def _gaussian(cols: DataFrame, seed: int, width: int) -> DataFrame:
    """A hash-seeded normal test matrix (Box-Muller on xxhash64): the same rows on every run."""
    def u01(j, salt):
        h = F.xxhash64(F.col("col"), F.lit(seed), F.lit(j), F.lit(salt))
        return (F.pmod(h, F.lit(1 << 30)).cast("double") + 0.5) / float(1 << 30)

    vals = [F.sqrt(-2.0 * F.log(u01(j, 0))) * F.cos(2 * np.pi * u01(j, 1)) for j in range(width)]
    return cols.withColumn("vec", F.array(*vals))


def _multiply(e: DataFrame, block: DataFrame, key: str, out: str, width: int) -> DataFrame:
    """(out, vec) = sum over key of value * block[key]: sparse x tall-skinny, one group-by."""
    j = e.join(block, key)
    sums = [F.sum(F.col("vec")[i] * F.col("value")).alias(f"_{i}") for i in range(width)]
    return j.groupBy(out).agg(*sums).select(out, F.array(*[F.col(f"_{i}") for i in range(width)]).alias("vec"))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    if pa.types.is_binary(batch.schema.field(name).type):  # blocks
        return np.concatenate([_read(x).reshape(m, -1) for m, x in zip(batch.column("m").to_pylist(), batch.column(name))])
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _lists(x: np.ndarray) -> pa.Array:
    ends = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(x, dtype=np.float64).ravel()))


def _rows(df: DataFrame, key: str, ins: Sequence[str], outs: Sequence[str], fn) -> DataFrame:
    """Row-local map of array columns: ``fn`` takes one matrix per input column and returns one per output."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = [_lists(x) for x in fn(*[_matrix(batch, c) for c in ins])]
                yield pa.RecordBatch.from_arrays([batch.column(key), *lists], [key, *outs])

    return df.select(key, *ins).mapInArrow(run, ", ".join([f"{key} long", *(f"{c} array<double>" for c in outs)]))


def _gram(df: DataFrame, names: Sequence[str], gather: int = 8) -> np.ndarray:
    """X^T X of the array columns side by side, or of a table of blocks. Tasks sum their rows' products, ``gather`` tasks add these
    up, and so many partial matrices reach the driver."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.concatenate([_matrix(batch, c) for c in names], axis=1)
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield pa.RecordBatch.from_pydict({"g": pa.array([total.ravel()], pa.list_(pa.float64()))})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, "g").sum(axis=0)
                total = x if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_pydict({"g": pa.array([total], pa.list_(pa.float64()))})

    parts = df.select(*names, *[c for c in df.columns if c == "m"]).mapInArrow(partial, "g array<double>").repartition(gather).mapInArrow(add, "g array<double>")
    total = np.sum([np.array(r["g"]) for r in parts.collect()], axis=0)
    n = math.isqrt(total.size)
    return total.reshape(n, n)


def _whiten(gram: np.ndarray, size: np.ndarray | None = None, least: float = 1e-11) -> tuple[np.ndarray, int]:
    """T that makes X T orthonormal for X^T X = ``gram``, and its number of columns: directions that are
    nothing but rounding next to ``size`` (squared lengths before a projection) are left out."""
    scale = np.sqrt(np.maximum(np.diag(gram) if size is None else size, 1e-300))
    lam, z = np.linalg.eigh(gram / np.outer(scale, scale))
    good = lam > least
    return (z[:, good] / np.sqrt(lam[good])) / scale[:, None], int(good.sum())


#: Ratings of one of ALS's blocks, beyond the ten that there are at least, and iterations until their shuffled factors are removed.
ALS_RATINGS, ALS_KEPT = 8_000_000, 2


class AlsFit:
    """Regularised factorisation of the observed ratings (ALS) with ids of any size.

    Spark's ALS takes 32-bit ids, so users and items are numbered densely first. Spark scales lambda by
    each user's and item's number of ratings (weighted-lambda regularisation). The numbered ratings are written
    once: the fit reads them more than once, and so do the predictions for them. A task of the fit holds a whole block of
    ratings, so large tables get more than Spark's ten blocks (the random start then differs from that of ten)."""

    def __init__(self, ratings: DataFrame, rank: int = 10, reg: float = 0.1, seed: int = 7, max_iter: int = 10):
        self.users = materialize(relevel_ids(ratings, "user_id", "_u"))
        self.items = materialize(relevel_ids(ratings, "book_id", "_i"))
        self.rated = written(self._numbered(ratings).select("_u", "_i", "rating"), "rated")
        blocks = max(10, -(-self.rated.count() // ALS_RATINGS))
        als = ALS(rank=rank, regParam=reg, maxIter=max_iter, seed=seed, userCol="_u", itemCol="_i", ratingCol="rating",
                  coldStartStrategy="drop", nonnegative=False, numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=ALS_KEPT)
        self.model, self.reg = als.fit(self.rated), reg

    def _numbered(self, ratings: DataFrame) -> DataFrame:
        j = ratings.join(self.users, "user_id").join(self.items, "book_id")
        return j.withColumns({"_u": F.col("_u").cast("int"), "_i": F.col("_i").cast("int")})

    def predict(self, ratings: DataFrame) -> DataFrame:
        """The rows with a known user and item, with ``prediction``."""
        return self.model.transform(self._numbered(ratings)).drop("_u", "_i")

    def predict_fitted(self) -> DataFrame:
        """(rating, prediction) of the rows that were fitted."""
        return self.model.transform(self.rated).select("rating", "prediction")

    def user_factors(self, kind: str = "double") -> DataFrame:
        """(user_id, vec)"""
        f = self.model.userFactors.select(F.col("id").alias("_u"), F.col("features").cast(f"array<{kind}>").alias("vec"))
        return f.join(self.users, "_u").select("user_id", "vec")

    def item_factors(self, kind: str = "double") -> DataFrame:
        """(book_id, vec)"""
        f = self.model.itemFactors.select(F.col("id").alias("_i"), F.col("features").cast(f"array<{kind}>").alias("vec"))
        return f.join(self.items, "_i").select("book_id", "vec")

    def user_gradients(self, ratings: DataFrame) -> DataFrame:
        """(user_id, n, gradient): certificate of the last half-step, which solves every user's normal equations
        sum (x.v - r) v + reg n x = 0 for the final item factors. ``gradient`` is the largest entry of the left side
        relative to the largest of sum |r v|; what remains is the rounding of the factors to single precision."""
        # by book first: the rows then move once more, by user and in single precision, for the user's factors and the sums alike
        rows = ratings.select("user_id", "book_id", "rating").join(self.item_factors("float"), "book_id").join(
            self.user_factors("float").withColumnRenamed("vec", "_x"), "user_id")
        rows = rows.withColumns({c: F.col(c).cast("array<double>") for c in ("vec", "_x")})
        err = F.aggregate(F.zip_with("_x", "vec", lambda x, v: x * v), F.lit(0.0), lambda s, x: s + x) - F.col("rating")
        rows = rows.withColumn("_e", err)
        k = range(self.model.rank)
        sums = [F.sum(F.col("_e") * F.col("vec")[j]).alias(f"_g{j}") for j in k]
        sizes = [F.sum(F.abs(F.col("rating") * F.col("vec")[j])).alias(f"_s{j}") for j in k]
        out = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.first("_x").alias("_x"), *sums, *sizes)
        off = [F.abs(F.col(f"_g{j}") + F.lit(self.reg) * F.col("n") * F.col("_x")[j]) for j in k]
        most = lambda cols: F.array_max(F.array(*cols))
        return out.select("user_id", "n", F.try_divide(most(off), most([F.col(f"_s{j}") for j in k])).alias("gradient"))


__all__ = ["covariance_long", "PcaFit", "variance_table", "select_components", "loadings_table",
           "svd_krylov", "svd_certificate", "SvdResult", "AlsFit", "vector_to_array"]
