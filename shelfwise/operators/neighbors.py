"""Exact k-nearest neighbours and voting.

Plan: query and training rows are dealt into blocks by a hash of their id, as many as their counts
ask for, and every query block meets every training block in one task of a cogroup, where NumPy keeps
each query's ``k`` best (a partial top-k over the whole block). A final ``row_number() <= k`` per query
merges the partial lists. Nothing passes through the driver but the two counts, and no pair of rows is
written that is not among a query's k best of a block.
Ties: distance, then the lowest training id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.hashing import hash_u32

#: Rows of a query block and of a training block; a task holds their distance matrix.
QUERY_ROWS, TRAIN_ROWS = 1024, 8192


def block_topk(q_ids: np.ndarray, q: np.ndarray, t_ids: np.ndarray, t: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(qid, tid, d2) of each query's k nearest rows of one block, exact, ties by id.

    Candidates come from the BLAS expansion |q|^2 + |t|^2 - 2 q.t with a safety margin; the survivors of
    all queries are re-scored together with the exact sum of squared differences and ranked."""
    k = min(k, len(t_ids))
    q_sq, t_sq = (q * q).sum(axis=1), (t * t).sum(axis=1)
    approx = q_sq[:, None] + t_sq[None, :] - 2.0 * (q @ t.T)
    margin = 1e-9 * (q_sq[:, None] + t_sq.max()) + 1e-12
    row, col = np.nonzero(approx <= np.partition(approx, k - 1, axis=1)[:, k - 1 : k] + margin)
    exact = np.empty(len(row))
    for a in range(0, len(row), 1 << 18):  # bounds the memory of the differences
        part = slice(a, a + (1 << 18))
        exact[part] = ((t[col[part]] - q[row[part]]) ** 2).sum(axis=1)
    order = np.lexsort((t_ids[col], exact, row))
    row, col, exact = row[order], col[order], exact[order]
    place = np.arange(len(row)) - np.searchsorted(row, row, "left")
    best = place < k
    return q_ids[row[best]], t_ids[col[best]], exact[best]


def _block(id_col: str, blocks: int):
    return F.pmod(hash_u32(id_col, 3), F.lit(blocks)).cast("int")


def _all_blocks(blocks: int):
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def _vectors(t: pa.Table) -> np.ndarray:
    return t.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(t.num_rows, -1)


def knn_neighbors(queries: DataFrame, train: DataFrame, k: int, qid: str = "qid", tid: str = "tid",
                  vec: str = "vec", query_rows: int = QUERY_ROWS, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The ``k`` nearest training rows of every query row (euclidean).

    queries: (qid, vec array<double>), train: (tid, vec array<double>), equal lengths; both are read
    more than once. Output (qid, tid, dist, rank) with rank 1..k.
    """
    q = queries.select(F.col(qid).cast("long").alias("qid"), F.col(vec).alias("vec"))
    t = train.select(F.col(tid).cast("long").alias("tid"), F.col(vec).alias("vec"))
    nq, nt = (max(1, -(-df.count() // rows)) for df, rows in ((q, query_rows), (t, train_rows)))
    left = q.select("qid", "vec", _block("qid", nq).alias("qb"), _all_blocks(nt).alias("tb"))
    right = t.select("tid", "vec", _block("tid", nt).alias("tb"), _all_blocks(nq).alias("qb"))

    def best(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({"qid": pa.array([], pa.int64()), "tid": pa.array([], pa.int64()), "d2": pa.array([], pa.float64())})
        found = block_topk(a.column("qid").to_numpy(), _vectors(a), b.column("tid").to_numpy(), _vectors(b), k)
        return pa.table(dict(zip(("qid", "tid", "d2"), found)))

    nb = left.groupBy("qb", "tb").cogroup(right.groupBy("qb", "tb")).applyInArrow(best, "qid long, tid long, d2 double")
    w = Window.partitionBy("qid").orderBy("d2", "tid")
    ranked = nb.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select(
        F.col("qid").alias(qid), F.col("tid").alias(tid), F.sqrt("d2").alias("dist"), "rank"
    )


def vote(neighbors: DataFrame, labels: DataFrame, qid: str = "qid", tid: str = "tid", label: str = "label",
         weights: str = "uniform") -> DataFrame:
    """Majority vote per query: (qid, pred, dist = mean neighbour distance).

    uniform: most frequent label; distance: weights 1/d, and if any neighbour is at distance 0
    only those vote. Ties go to the lowest label.
    """
    nb = neighbors.join(labels.select(F.col(tid), F.col(label).alias("_label")), tid)
    per_q = nb.groupBy(qid).agg(F.max((F.col("dist") == 0).cast("int")).alias("_hz"), F.avg("dist").alias("_mdist"))
    nb = nb.join(per_q, qid)
    if weights == "distance":
        w = F.when(F.col("_hz") == 1, (F.col("dist") == 0).cast("double")).otherwise(F.lit(1.0) / F.col("dist"))
    else:
        w = F.lit(1.0)
    scores = nb.groupBy(qid, "_label").agg(F.sum(w).alias("_score"))
    best = scores.groupBy(qid).agg(F.min(F.struct((-F.col("_score")).alias("neg"), F.col("_label").alias("lab"))).alias("_b"))
    return best.join(per_q, qid).select(qid, F.col("_b.lab").alias("pred"), F.col("_mdist").alias("dist"))


def prefix_accuracy(neighbors: DataFrame, train_labels: DataFrame, test_labels: DataFrame, max_k: int,
                    qid: str = "qid", tid: str = "tid", label: str = "label") -> DataFrame:
    """Accuracy of the uniform vote for every k = 1..max_k from one ranked neighbour table
    (no refit per k): (k, accuracy)."""
    nb = neighbors.join(train_labels.select(F.col(tid), F.col(label).alias("_l")), tid)
    # a neighbour at rank r votes for every k >= r
    votes = nb.withColumn("k", F.explode(F.sequence(F.col("rank"), F.lit(max_k)))).groupBy(qid, "k", "_l").agg(
        F.count(F.lit(1)).alias("_n"))
    pred = votes.groupBy(qid, "k").agg(F.min(F.struct((-F.col("_n")).alias("neg"), F.col("_l").alias("lab"))).alias("_b"))
    truth = test_labels.select(F.col(qid), F.col(label).alias("_y"))
    j = pred.join(truth, qid)
    return j.groupBy("k").agg(F.avg((F.col("_b.lab") == F.col("_y")).cast("double")).alias("accuracy"))
