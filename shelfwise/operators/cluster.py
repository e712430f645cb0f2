"""Clustering users by their 0/1 rating vectors: Lloyd's k-means in long form.

Neither the vocabulary of books nor a center ever stands on the driver or in one vector: single steps are rows of
joins, and the rounds of a fit move blocks of books (the centers' counts, whole numbers) to cells of users and
back. Several values of k run together, and one round serves all that still move."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators import decompose as dec
from shelfwise.session import delete_path, materialize

#: Good ratings of one cell of users.
CELL_ENTRIES = 65_536


def first_users_as_centers(good: DataFrame, ks: Sequence[int]) -> DataFrame:
    """(k, cluster, book_id, v): for each k the vectors of the k users with the smallest ids."""
    firsts = good.select("user_id").distinct().orderBy("user_id").limit(max(ks))
    ranked = firsts.withColumn("cluster", F.row_number().over(Window.orderBy("user_id")))  # max(ks) rows
    runs = F.filter(F.array(*[F.lit(k) for k in ks]), lambda k: k >= F.col("cluster"))
    seeds = ranked.withColumn("k", F.explode(runs))
    return good.join(F.broadcast(seeds), "user_id").select("k", "cluster", "book_id", F.lit(1.0).alias("v"))


def assign(good: DataFrame, users: DataFrame, centers: DataFrame) -> DataFrame:
    """(k, user_id, cluster, d2): every user's nearest center, ties to the lowest cluster.

    good: (user_id, book_id) rows with value 1; users: (user_id), those without a good row included;
    centers: (k, cluster, book_id, v). Squared distances are |x|^2 + |c|^2 - 2 x.c. A user without a
    book in common with a center has x.c = 0, so only common books are joined; the nearest of the
    centers without one is that with the smallest |c|^2, which is read from the table of norms."""
    norms = centers.groupBy("k", "cluster").agg(F.sum(F.col("v") * F.col("v")).alias("_c2"))
    dots = good.join(centers, "book_id").groupBy("user_id", "k", "cluster").agg(F.sum("v").alias("_dot"))
    n_u = good.groupBy("user_id").agg(F.count(F.lit(1)).alias("_nu"))
    per_user = users.select("user_id").join(n_u, "user_id", "left").select("user_id", F.coalesce("_nu", F.lit(0)).alias("_nu"))
    # every user meets every center; there are as many centers as the ks add up to, a parameter
    listed = [F.struct(F.lit(r["k"]).cast("int").alias("k"), F.lit(r["cluster"]).alias("cluster"), F.lit(r["_c2"]).alias("_c2"))
              for r in norms.orderBy("k", "cluster").collect()]
    if not listed:
        raise ValueError("k-means: no user has a good book to start from")
    grid = per_user.select("user_id", "_nu", F.inline(F.array(*listed)))
    d = grid.join(dots, ["user_id", "k", "cluster"], "left").select(
        "k", "user_id", "cluster", F.round(F.col("_nu") + F.col("_c2") - 2 * F.coalesce("_dot", F.lit(0.0)), 9).alias("d2"))
    best = d.groupBy("k", "user_id").agg(F.min(F.struct("d2", "cluster")).alias("_b"))
    return best.select("k", "user_id", F.col("_b.cluster").alias("cluster"), F.col("_b.d2").alias("d2"))


def means(good: DataFrame, assigned: DataFrame) -> DataFrame:
    """(k, cluster, book_id, v): the mean vector of every cluster, zeros left out. A cluster whose users
    have no good book keeps no row; the next assignment leaves it out."""
    sizes = assigned.groupBy("k", "cluster").agg(F.count(F.lit(1)).alias("_size"))
    n = good.join(assigned.select("k", "user_id", "cluster"), "user_id").groupBy("k", "cluster", "book_id").agg(
        F.count(F.lit(1)).alias("_n"))
    return n.join(sizes, ["k", "cluster"]).select("k", "cluster", "book_id", (F.col("_n") / F.col("_size")).alias("v"))


class _Lloyd:
    """The rounds of k-means. A center is the counts of its users' books over its number of users; the counts of all centers
    are the columns of a table of blocks of books (see :class:`dec._Cells`). A cell holds the good books of some
    users: it gets the counts of its books, finds every user's nearest center and sends back the new counts."""

    def __init__(self, good: DataFrame, users: DataFrame):
        low = good.agg(F.min("book_id").alias("low"), F.count_if(F.col("book_id").isNull()).alias("nulls")).first()
        # a rating without a book counts in the squared lengths, but never as a book in common
        self.null = (low["low"] or 0) - 1 if low["nulls"] else None
        book = F.col("book_id") if self.null is None else F.coalesce("book_id", F.lit(self.null))
        good = good.withColumn("col", book.cast("long"))
        e = good.join(users.select("user_id"), "user_id", "left_semi").select(
            F.col("user_id").cast("long").alias("row"), "col", F.lit(1.0).alias("value"))
        self.cells = dec._Cells(e, good.select("col"), CELL_ENTRIES)
        self.users = users

    def blocks(self, centers: DataFrame, at: dict[tuple[int, int], int]) -> DataFrame:
        """The table of blocks of the rows (k, cluster, book_id), each once, in the columns ``at``; blocks of zeros are left out."""
        base = max(c for _, c in at) + 1
        place = F.create_map(*[F.lit(x) for (k, c), i in at.items() for x in (k * base + c, i)])
        book = F.col("book_id") if self.null is None else F.coalesce("book_id", F.lit(self.null))
        rows = centers.select(book.cast("long").alias("col"), place[F.col("k") * base + F.col("cluster")].alias("i")).join(self.cells.cols, "col")
        n_col, size, width = self.cells.n_col, self.cells.size, len(at)

        def run(rows: pa.Table) -> pa.Table:
            b = rows.column("b")[0].as_py()
            x = np.zeros((min(size, n_col - b * size), width), np.int32)
            np.add.at(x, (rows.column("id").to_numpy() % size, rows.column("i").to_numpy()), 1)
            return dec._one_block(b, x)

        return rows.select("b", "id", "i").groupBy("b").applyInArrow(run, dec.BLOCKS)

    def _sent(self, blocks: DataFrame, width: int) -> DataFrame:
        size = self.cells.size

        def send(block: pa.Table, routes: pa.Table) -> pa.Table:
            x = dec._read(block.column("x")[0], np.int32).reshape(-1, width) if block.num_rows else np.zeros((size, width), np.int32)
            rows = [x[dec._read(at, np.int32)].tobytes() for at in routes.column("at")]
            return pa.table({"c": routes.column("c"), "b": routes.column("b"), "x": pa.array(rows, pa.binary())})

        return blocks.groupBy("b").cogroup(self.cells.routes.groupBy("b")).applyInArrow(send, "c int, b int, x binary")

    def _nearest(self, sizes: np.ndarray, c2: np.ndarray, ends: Sequence[int]):
        """Function of a cell's parts: (arrays of the cell, the nearest center per k, its rounded squared distance)."""
        nearest, null, width = _nearest, self.null is not None, len(sizes)

        def run(parts: pa.Table, cell: pa.Table):
            held = {x: dec._read(cell.column(x)[0], np.int32) for x in ("starts", "cols", "col_starts", "rows")}
            held |= {x: dec._read(cell.column(x)[0], np.int64) for x in ("items", "ids")}
            x = np.concatenate([dec._read(x, np.int32) for x in parts.sort_by("b").column("x")]).reshape(-1, width)
            if null:
                x[held["items"] == 0] = 0
            dots = dec._sums(x, held["cols"], held["starts"], np.ones(1, np.int64), kind=np.int64) / np.maximum(sizes, 1)
            n = np.diff(np.r_[held["starts"], len(held["cols"])])
            return held, *nearest(n, dots, c2, ends)

        return run

    def round(self, blocks: DataFrame, sizes: np.ndarray, c2: np.ndarray, ends: Sequence[int]) -> DataFrame:
        """(b, m, x, squares, marks): the new counts per block, their squares summed, and a mark of the columns of every k.
        The row of b = -1 holds the new numbers of users with a good book."""
        near, n_col, size, width = self._nearest(sizes, c2, ends), self.cells.n_col, self.cells.size, len(sizes)

        def multiply(parts: pa.Table, cell: pa.Table) -> pa.Table:
            held, best, _ = near(parts, cell)
            z = np.zeros((len(best), width), np.int32)
            i, j = np.nonzero(best >= 0)
            z[i, best[i, j]] = 1
            x = dec._sums(z, held["rows"], held["col_starts"], np.ones(1, np.int32), kind=np.int32)
            blocks, first = np.unique(held["items"] // size, return_index=True)
            at = [y.astype(np.int32).tobytes() for y in np.split(held["items"] % size, first[1:])]
            x = [y.tobytes() for y in np.split(x, first[1:])]
            return pa.table({"b": pa.array([-1, *blocks], pa.int32()), "at": pa.array([b"", *at], pa.binary()),
                             "x": pa.array([z.sum(axis=0, dtype=np.int64).tobytes(), *x], pa.binary())})

        def add(parts: pa.Table) -> pa.Table:
            b = parts.column("b")[0].as_py()
            if b < 0:
                total = sum(dec._read(x, np.int64) for x in parts.column("x"))
                squares, marks = total, []
            else:
                total = np.zeros((min(size, n_col - b * size), width), np.int32)
                for at, x in zip(parts.column("at"), parts.column("x")):
                    total[dec._read(at, np.int32)] += dec._read(x, np.int32).reshape(-1, width)
                squares = (total.astype(np.float64) ** 2).sum(axis=0)
                marks = [hashlib.blake2b(np.ascontiguousarray(x).tobytes(), digest_size=16).digest() for x in np.split(total, ends[:-1], axis=1)]
            return pa.table({"b": pa.array([b], pa.int32()), "m": pa.array([len(total)], pa.int32()), "x": pa.array([total.tobytes()], pa.binary()),
                             "squares": pa.array([squares.astype(np.float64)], pa.list_(pa.float64())), "marks": pa.array([marks], pa.list_(pa.binary()))})

        back = self._sent(blocks, width).groupBy("c").cogroup(self.cells.cells.groupBy("c")).applyInArrow(multiply, "b int, at binary, x binary")
        return back.groupBy("b").applyInArrow(add, dec.BLOCKS + ", squares array<double>, marks array<binary>")

    def assigned(self, blocks: DataFrame, sizes: np.ndarray, c2: np.ndarray, ends: Sequence[int], names: Sequence[tuple[int, int]]) -> DataFrame:
        """(k, user_id, cluster, d2) of all users."""
        near = self._nearest(sizes, c2, ends)
        ks, clusters = (np.array(x, np.int32) for x in zip(*names))

        def rows(parts: pa.Table, cell: pa.Table) -> pa.Table:
            held, best, d = near(parts, cell)
            i, j = np.nonzero(best >= 0)
            return pa.table({"k": ks[best[i, j]], "user_id": held["ids"][i], "cluster": clusters[best[i, j]], "d2": d[i, j]})

        some = self._sent(blocks, len(sizes)).groupBy("c").cogroup(self.cells.cells.groupBy("c")).applyInArrow(
            rows, "k int, user_id long, cluster int, d2 double")
        best, d = _nearest(np.zeros(1, int), np.zeros((1, len(sizes))), c2, ends)
        at = [F.struct(F.lit(int(ks[b])).cast("int").alias("k"), F.lit(int(clusters[b])).cast("int").alias("cluster"), F.lit(float(x)).alias("d2"))
              for b, x in zip(best[0], d[0]) if b >= 0]
        ids = self.cells.cells.select("ids").mapInArrow(_ids, "user_id long")
        rest = self.users.select(F.col("user_id").cast("long")).join(ids, "user_id", "left_anti").select("user_id", F.inline(F.array(*at)))
        return some.unionByName(rest.select("k", "user_id", "cluster", "d2"))

    def centers(self, blocks: DataFrame, sizes: np.ndarray, c2: np.ndarray, names: Sequence[tuple[int, int]]) -> DataFrame:
        """(k, cluster, book_id, v); clusters whose users have no good book stand at the origin, a row of book -1 and value 0."""
        size, width = self.cells.size, len(sizes)
        ks, clusters = (np.array(x, np.int32) for x in zip(*names))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for b, x in zip(batch.column("b").to_pylist(), batch.column("x")):
                    x = dec._read(x, np.int32).reshape(-1, width)
                    i, j = np.nonzero(x)
                    yield pa.RecordBatch.from_pydict({"id": b * size + i, "k": ks[j], "cluster": clusters[j], "v": x[i, j] / sizes[j]})

        book = F.col("col") if self.null is None else F.when(F.col("col") != self.null, F.col("col"))
        rows = blocks.select("b", "x").mapInArrow(run, "id long, k int, cluster int, v double").join(self.cells.cols, "id").select(
            "k", "cluster", book.alias("book_id"), "v")
        origin = [(int(ks[i]), int(clusters[i]), -1, 0.0) for i in range(width) if sizes[i] and not c2[i]]
        return rows.unionByName(rows.sparkSession.createDataFrame(origin, "k int, cluster int, book_id long, v double"))


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x in batch.column("ids"):
            yield pa.RecordBatch.from_pydict({"user_id": dec._read(x, np.int64)})


def _nearest(n: np.ndarray, dots: np.ndarray, c2: np.ndarray, ends: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """(column of the nearest center per k, or -1 where k has none, its squared distance), ties to the lowest cluster; ``ends``: of
    the columns of every k, ``c2``: squared lengths, infinite for centers that are left out."""
    d = np.round(n[:, None] + c2 - 2 * dots, 9)
    first = [0, *ends[:-1]]
    best = np.stack([lo + d[:, lo:hi].argmin(axis=1) for lo, hi in zip(first, ends)], axis=1)
    least = np.take_along_axis(d, best, axis=1)
    return np.where(np.isinf(least), -1, best), least


def kmeans(good: DataFrame, users: DataFrame, ks: Sequence[int], max_iter: int = 100) -> tuple[DataFrame, DataFrame]:
    """Lloyd's algorithm for every k of ``ks`` until no user changes its cluster: (assignment, centers).

    The start is :func:`first_users_as_centers`. Every user's nearest center is found as in :func:`assign`, the centers are
    then the :func:`means`; a k whose counts stay the same is done and takes no part in later rounds. Each round's
    counts are written once. Raises RuntimeError when ``max_iter`` rounds do not suffice."""
    lloyd = _Lloyd(good, users)
    seeds = materialize(first_users_as_centers(good, ks))
    names = sorted((r["k"], r["cluster"], r["n"]) for r in seeds.groupBy("k", "cluster").agg(F.count(F.lit(1)).alias("n")).collect())
    if not names:
        raise ValueError("k-means: no user has a good book to start from")
    c2, names = np.array([float(n) for *_, n in names]), [(k, c) for k, c, _ in names]
    sizes, none = np.ones(len(names), np.int64), users.count() - int(sum(r["n"] for r in lloyd.cells.cells.select(
        (F.length("ids") / 8).cast("long").alias("n")).collect()))
    blocks, done, marks, path, kept = lloyd.blocks(seeds, {x: i for i, x in enumerate(names)}), [], None, None, []
    spark = good.sparkSession
    for _ in range(max_iter):
        ends = [i + 1 for i in range(len(names)) if i + 1 == len(names) or names[i + 1][0] != names[i][0]]
        old, (made, path) = path, dec._kept(lloyd.round(blocks, sizes, c2, ends), "centers")
        if old:
            delete_path(spark, old)
        told = made.select("b", "squares", "marks").collect()  # a row per block of books
        new = sum((np.array(r["squares"]) for r in told if r["b"] < 0), np.zeros(len(names))).astype(np.int64)
        squares = sum((np.array(r["squares"]) for r in told if r["b"] >= 0), np.zeros(len(names)))
        if none:
            best, _ = _nearest(np.zeros(1, int), np.zeros((1, len(names))), c2, ends)
            new[best[0][best[0] >= 0]] += none
        was, marks = marks, {(r["b"], k): m for r in told if r["b"] >= 0 for k, m in zip([names[e - 1][0] for e in ends], r["marks"])}
        moved = {k for k, _ in names} if was is None else {k for (b, k), m in marks.items() if was[b, k] != m}
        moved |= {k for (k, _), x, y in zip(names, sizes, new) if x != y} if was is not None else set()
        sizes, c2 = new, np.where(new > 0, squares / np.maximum(new, 1).astype(np.float64) ** 2, np.inf)
        stay = [i for i, (k, _) in enumerate(names) if k in moved]
        counts = made.where(F.col("b") >= 0).select("b", "m", "x")
        if len(stay) < len(names):
            end = [i for i in range(len(names)) if i not in stay]
            final, at = dec._kept(_columns(counts, len(names), end), "centers")
            done.append((final, [names[i] for i in end], sizes[end], c2[end]))
            kept.append(at)
        if not stay:
            break
        blocks = _columns(counts, len(names), stay) if len(stay) < len(names) else counts
        names, sizes, c2 = [names[i] for i in stay], sizes[stay], c2[stay]
        marks = {(b, k): m for (b, k), m in marks.items() if k in moved}
    else:
        raise RuntimeError(f"k-means: users still move after {max_iter} rounds")
    names = [x for _, some, *_ in done for x in some]
    sizes, c2 = np.concatenate([x[2] for x in done]), np.concatenate([x[3] for x in done])
    blocks = materialize(dec._beside([x[0] for x in done], np.int32))
    for x in [path, *kept]:
        delete_path(spark, x)
    ends = [i + 1 for i in range(len(names)) if i + 1 == len(names) or names[i + 1][0] != names[i][0]]
    return materialize(lloyd.assigned(blocks, sizes, c2, ends, names)), lloyd.centers(blocks, sizes, c2, names)


def _columns(blocks: DataFrame, width: int, some: Sequence[int]) -> DataFrame:
    """The table of blocks of some columns of whole numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, x in zip(batch.column("b").to_pylist(), batch.column("x")):
                yield from dec._one_block(b, dec._read(x, np.int32).reshape(-1, width)[:, some]).to_batches()

    return blocks.select("b", "x").mapInArrow(run, dec.BLOCKS)


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


def inertia(assigned: DataFrame) -> DataFrame:
    """(k, inertia): the within-cluster sum of squares of each run."""
    return assigned.groupBy("k").agg(F.sum("d2").alias("inertia"))


def total_ss_binary(good: DataFrame, n_users) -> DataFrame:
    """k = 1 inertia for 0/1 user vectors: sum ||x - mean||^2 = nnz - sum_b n_b^2 / n_users."""
    per_book = good.groupBy("book_id").agg(F.count(F.lit(1)).alias("nb"))
    return per_book.agg((F.sum("nb") - F.sum(F.col("nb") * F.col("nb")) / n_users).alias("inertia"))


def certificate(good: DataFrame, users: DataFrame, assigned: DataFrame, centers: DataFrame) -> DataFrame:
    """(n_users, n_nearest, max_center_error): users, those whose cluster is the nearest center when all
    distances are computed again, and the largest deviation of a center's entry from its users' mean."""
    again = assign(good, users, centers).select("k", "user_id", F.col("cluster").alias("_again"))
    near = assigned.join(again, ["k", "user_id"]).agg(
        F.count(F.lit(1)).alias("n_users"), F.count_if(F.col("cluster") == F.col("_again")).alias("n_nearest"))
    diff = means(good, assigned).withColumnRenamed("v", "_m").join(centers.where(F.col("book_id") >= 0), ["k", "cluster", "book_id"], "full")
    worst = diff.agg(F.max(F.abs(F.coalesce("_m", F.lit(0.0)) - F.coalesce("v", F.lit(0.0)))).alias("e"))
    return near.select("n_users", "n_nearest", worst.scalar().alias("max_center_error"))
