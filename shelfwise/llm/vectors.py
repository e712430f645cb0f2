"""Near-duplicate vectors: cross-polytope hashing, multiprobe buckets, verified pairs."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import block_pairs, local_roots, map_groups, mix64, saved, sized
from shelfwise.llm.graph import components

#: Largest coordinates of a rotated vector that probes may choose from.
TOP = 4
#: Rows of a bucket, or of a cluster's block, that meet in one task.
BLOCK = 128


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (their length is a power of two), orthonormal."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def padded(d: int) -> int:
    return max(8, 1 << (d - 1).bit_length())


def polytope(x: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, size) of the ``TOP`` nearest cross-polytope vertices after three rounds of random signs
    and Hadamard transform: coordinate and sign, the largest coordinate first."""
    signs = np.random.default_rng(seed)
    for _ in range(3):
        x = hadamard(x * signs.choice([-1.0, 1.0], x.shape[1]))
    order = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :TOP]
    value = np.take_along_axis(x, order, 1)
    return order * 2 + (value < 0), np.abs(value)


def probe_codes(x: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """Codes of the ``probes`` buckets of a table nearest to each unit row of ``x`` (padded to a power of
    two): the joint vertices of ``hashes`` rotations that lose the least of the largest coordinates."""
    found = [polytope(x, 1_000_003 * table + k) for k in range(hashes)]
    choice = np.array(list(itertools.product(range(TOP), repeat=hashes)))
    loss = sum((size[:, :1] - size[:, choice[:, k]]) ** 2 for k, (_, size) in enumerate(found))
    best = np.argsort(loss, axis=1, kind="stable")[:, :probes]
    code = np.zeros(best.shape, np.uint64)
    for k, (vertex, _) in enumerate(found):
        code = mix64(code + np.take_along_axis(vertex, choice[:, k][best], 1).astype(np.uint64) + np.uint64(1 + k))
    return code


def tables_for(d: int, threshold: float, hashes: int, probes: int, miss: float, samples: int = 4000) -> int:
    """Tables after which a pair at the threshold shares no bucket with probability ``miss`` at most, from
    the share of random pairs at that cosine that meet in one table."""
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(2, samples, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
    b = threshold * a + math.sqrt(max(0.0, 1 - threshold**2)) * b
    x, y = (np.pad(v, ((0, 0), (0, padded(d) - d))) for v in (a, b))
    meet = (probe_codes(x, 0, hashes, probes)[:, :, None] == probe_codes(y, 0, hashes, probes)[:, None, :]).any((1, 2)).mean()
    return max(1, math.ceil(math.log(miss) / math.log(max(1e-9, 1 - min(meet, 1 - 1e-9)))))


def hashes_for(rows: int, d: int, probes: int, bucket: int) -> int:
    """Rotations joined in a code, so that buckets of unrelated vectors stay near ``bucket`` rows; 2 at least."""
    return max(2, math.ceil(math.log(max(1.0, rows * probes / bucket)) / math.log(2 * padded(d))))


def _unit(col) -> tuple[np.ndarray, np.ndarray]:
    """(rows scaled by their largest value, norms) of a list column of equally long vectors."""
    v = col.values.to_numpy(zero_copy_only=False)[col.offsets[0].as_py() : col.offsets[-1].as_py()].reshape(len(col), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v, np.sqrt((v * v).sum(axis=1))


def describe(reps: DataFrame, hashes: int, tables: int, probes: int) -> DataFrame:
    """(rep, codes, q, err): buckets of (rep, label, v), the unit vector in 8 bits and the rounding's length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = np.array([len(x) for x in batch.column(2)])
            for d in np.unique(length).tolist():
                part = batch.take(pa.array(np.flatnonzero(length == d)))
                v, norm = _unit(part.column(2))
                v = v / norm[:, None]
                x = np.pad(v, ((0, 0), (0, padded(d) - d)))
                own = mix64(part.column(1).to_numpy().astype(np.int64).view(np.uint64) * np.uint64(1 << 16) + np.uint64(d))
                codes = [mix64(probe_codes(x, t, hashes, probes) ^ own[:, None] + np.uint64(t)) >> np.uint64(1) for t in range(tables)]
                codes = np.concatenate(codes, axis=1).view(np.int64)
                top = np.abs(v).max(axis=1, keepdims=True) / 127
                q = np.round(v / top).astype(np.int8)
                err = np.sqrt(((q * top - v) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(list(codes), pa.list_(pa.int64())),
                     pa.array([r.tobytes() for r in q], pa.binary()), pa.array(top[:, 0]), pa.array(err)],
                    ["rep", "codes", "q", "top", "err"])

    return reps.select("rep", "label", "v").mapInArrow(run, "rep long, codes array<long>, q binary, top double, err double")


def bucket_candidates(made: DataFrame, threshold: float) -> DataFrame:
    """(a, b): in every bucket a spanning forest of the pairs that may reach the threshold. The cosine of
    the rounded vectors is off by no more than both roundings, so no pair of a bucket is lost."""
    def compare(t: pa.Table) -> pa.RecordBatch | None:
        if t.num_rows < 2:
            return None
        rep = t.column("rep").to_numpy()
        order = np.argsort(rep, kind="stable")
        rep = rep[order]
        raw = t.column("q").take(pa.array(order)).to_pylist()
        top, err = (t.column(c).to_numpy()[order] for c in ("top", "err"))
        adj = np.zeros((len(rep), len(rep)), bool)
        length = np.array([len(r) for r in raw])
        for d in np.unique(length).tolist():  # one length, but for a collision of codes
            own = np.flatnonzero(length == d)
            v = np.frombuffer(b"".join(raw[i] for i in own), np.int8).reshape(len(own), d) * top[own, None]
            slack = err[own, None] + err[None, own] + err[own, None] * err[None, own] + 1e-9
            adj[np.ix_(own, own)] = v @ v.T >= threshold - slack
        root = local_roots(adj)
        far = np.flatnonzero(root != np.arange(len(rep)))
        return pa.RecordBatch.from_pydict({"a": rep[far], "b": rep[root[far]]}) if len(far) else None

    rows = sized(saved(made.select(F.explode("codes").alias("path"), "rep").distinct()))
    rows = block_pairs(rows.join(made.select("rep", "q", "top", "err"), "rep"), "path", "rep", "size", BLOCK)
    return map_groups(rows.select("path", "_i", "_j", "rep", "q", "top", "err"), ["path", "_i", "_j"], compare, "a long, b long")


def verify(clusters: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """(rep, add, root): all pairs of each cluster of (node, component), once, in double precision. Pairs
    are counted, not written: ``add`` rows are linked to ``rep`` here, ``root`` is the smallest of them."""
    def compare(t: pa.Table) -> pa.RecordBatch | None:
        if t.num_rows < 2:
            return None
        t = t.sort_by("rep").combine_chunks()
        rep, weight, part, label = (t.column(c).to_numpy() for c in ("rep", "m", "_b", "label"))
        adj = np.zeros((len(rep), len(rep)), bool)
        col = t.column("v").chunk(0)
        length = np.array([len(x) for x in col])
        for d in np.unique(length).tolist():
            own = np.flatnonzero(length == d)
            v, norm = _unit(col.take(pa.array(own)))
            adj[np.ix_(own, own)] = (v @ v.T) / np.outer(norm, norm) >= threshold
        adj &= (rep[:, None] != rep[None, :]) & (label[:, None] == label[None, :])
        if t.column("_i")[0].as_py() != t.column("_j")[0].as_py():
            adj &= part[:, None] != part[None, :]
        linked = np.flatnonzero(adj.any(axis=1))
        add = (adj.astype(np.float64) @ weight).astype(np.int64)
        return pa.RecordBatch.from_pydict({"rep": rep[linked], "add": add[linked], "root": rep[local_roots(adj)[linked]]})

    size = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    rows = clusters.join(size, "component").withColumnRenamed("node", "rep").join(reps, "rep")
    rows = block_pairs(rows, "component", "rep", "size", BLOCK)
    rows = rows.select("component", "_i", "_j", "rep", "_b", "m", "label", "v")
    return map_groups(rows, ["component", "_i", "_j"], compare, "rep long, add long, root long")


def near_vectors(vectors: DataFrame, threshold: float = 0.93, probes: int = 4, miss: float = 1e-5,
                 id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Two vectors of one label and length are linked when their cosine in double precision is at least
    ``threshold``. n_links: other rows linked directly. component_id: the smallest id reachable over
    links, the own one included; kept: it is the own.

    Equal vectors of a label form a class that takes part once. Classes meet in the buckets of
    :func:`tables_for` tables, ``probes`` buckets a table; a pair at the threshold meets nowhere with
    probability ``miss``. Pairs that may reach the threshold join clusters, and in a cluster all pairs
    are compared exactly. Large buckets and clusters are dealt over pairs of blocks.

    A vector that is null, empty or zero, that holds a null or non-finite value, or whose label or id
    is null links with nothing and is its own component (null for a null id, kept true). Rows that
    repeat an id and vector count as copies. Other columns are not read; no rows give no rows."""
    v = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x + F.lit(0.0))  # -0.0 becomes 0.0
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), v.alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    ok = F.coalesce(sound & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    rows = rows.select("*", ok.alias("_ok"), F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), "v").alias("h2"))
    good = rows.where("_ok")
    classes = good.groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m"))
    member = saved(good.select("vec_id", "label", "h1", "h2").join(classes, ["label", "h1", "h2"]))
    own = member.where(F.col("vec_id") == F.col("rep")).select("rep", "label", "h1", "h2", "m").distinct()
    first = good.select(F.col("vec_id").alias("rep"), "label", "h1", "h2", "v").dropDuplicates(["rep", "label", "h1", "h2"])
    reps = saved(own.join(first, ["rep", "label", "h1", "h2"]).select("rep", "label", "m", "v"))
    most = reps.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d"))
    n, d = most.agg(F.max("n"), F.max("d")).first()
    if n is None:
        n, d = 1, 8
    hashes = hashes_for(n, d, probes, BLOCK)
    made = saved(describe(reps, hashes, tables_for(d, threshold, hashes, probes, miss), probes))
    checked = saved(verify(components(bucket_candidates(made, threshold)), reps, threshold))
    links = checked.groupBy("rep").agg(F.sum("add").alias("_add"))
    joined = components(checked, "rep", "root").select(F.col("node").alias("rep"), "component")
    out = member.join(links, "rep", "left").join(joined, "rep", "left").select(
        "vec_id", (F.col("m") - 1 + F.coalesce("_add", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    alone = rows.where(~F.col("_ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
