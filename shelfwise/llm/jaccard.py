"""Near-duplicate texts: a chosen-path similarity join on word shingles."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import (Meeting, block_pairs, label_edges, local_roots, map_groups, meet_blocks, mix64, saved, sized,
                                  string_buffer)
from shelfwise.llm.graph import components
from shelfwise.llm.shingles import common_counts, fingerprints, shingle_sets

#: Smallest shingle hashes kept of every set, 32 bits each: they choose the deeper paths and rule out
#: dissimilar pairs before whole sets are compared.
SKETCH = 64
#: A pair is ruled out below this share of the threshold; about five standard errors of the estimate.
SURE = 0.68
#: Rows of a bucket, or of a cluster's block, that meet in one task.
BUCKET, CLUSTER = 256, 128


def runs_for(threshold: float, branching: float, target_recall: float) -> int:
    """Runs after which a pair at the threshold has met with probability ``target_recall``.

    Two sets of similarity t share a sampled token at each step with a Poisson number of mean
    branching * t at least (one set is part of the other); the chance that their common path survives any
    number of steps is the root of q = 1 - exp(-mean q)."""
    mean, q = branching * threshold, 1.0
    if mean <= 1:
        raise ValueError("chosen path: the branching is too small for the threshold")
    for _ in range(200):
        q = 1 - math.exp(-mean * q)
    return math.ceil(math.log(1 - target_recall) / math.log(1 - q))


def _lists(owner: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    order = np.argsort(owner, kind="stable")
    ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values[order].view(np.int64)))


def _below(rate: np.ndarray) -> np.ndarray:
    """Rates as bounds on a 64-bit hash."""
    return (np.minimum(rate, 1 - 2**-53) * 2.0**64).astype(np.uint64)


def describe(docs: DataFrame, n: int, runs: int, branching: float, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, fp1, fp2, n, paths, sk) per row: set fingerprint, shingles, first steps of all runs, sketch.

    In each run a token is sampled when its run hash lies below branching / |set|, the same for every
    document that holds it; each sampled token opens a bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sets = shingle_sets(*string_buffer(batch.column(1)), n)
                size = np.array([len(s) for s in sets], np.int64)
                flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
                bound = _below(branching / np.maximum(size, 1))[owner]
                rows, paths = [], []
                for r in range(runs):
                    hit = np.flatnonzero(mix64(flat ^ np.uint64(0xA5A5 + 7919 * r)) < bound)
                    rows.append(owner[hit])
                    paths.append(mix64(flat[hit] + np.uint64((r + 1) << 40)) >> np.uint64(1))
                fp1, fp2 = fingerprints(sets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(fp1), pa.array(fp2), pa.array(size),
                     _lists(np.concatenate(rows), np.concatenate(paths), len(sets)),
                     pa.array([(s[:SKETCH] >> np.uint64(31)).astype(np.uint32).tobytes() for s in sets], pa.binary())],
                    ["doc_id", "fp1", "fp2", "n", "paths", "sk"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, fp1 long, fp2 long, n long, paths array<long>, sk binary")


def _sketches(col) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint32) for x in col.to_pylist()]


def _children(rows: DataFrame, branching: float) -> DataFrame:
    """Next step of (path, size, rep, sk): (path, parent, psize, rep), one row per sampled sketch token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = _sketches(batch.column("sk"))
            size = np.array([len(s) for s in sets])
            owner = np.repeat(np.arange(len(sets)), size)
            token = np.concatenate(sets).astype(np.uint64) if len(sets) else np.empty(0, np.uint64)
            path = batch.column("path").to_numpy().view(np.uint64)
            hit = np.flatnonzero(mix64(token * np.uint64(0x2545F4914F6CDD1D) ^ mix64(path)[owner])
                                 < _below(branching / np.maximum(size, 1))[owner])
            own = owner[hit]
            new = mix64(path[own] + mix64(token[hit] + np.uint64(1))) >> np.uint64(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(new.view(np.int64)), *(batch.column(c).take(pa.array(own)) for c in ("path", "size", "rep"))],
                ["path", "parent", "psize", "rep"])

    return rows.select("path", "size", "rep", "sk").mapInArrow(run, "path long, parent long, psize long, rep long")


def choose_paths(reps: DataFrame, branching: float, bucket: int, max_depth: int) -> DataFrame:
    """(path, size, rep): the buckets in which representatives are compared.

    A bucket of up to ``bucket`` rows is final. A larger one is split on further sampled tokens, unless
    splitting does not help: where at least as many rows as it has stand in large children again, its
    sets are alike, and it is compared as it is. So are buckets left at ``max_depth``."""
    rows = saved(sized(saved(reps.select(F.explode("paths").alias("path"), "rep")))).select("path", "size", "rep")
    final, large = rows.where(F.col("size") <= bucket), rows.where(F.col("size") > bucket)
    deep = None  # sketches of the representatives in large buckets
    for _ in range(max_depth):
        if large.isEmpty():
            return final
        if deep is None:
            deep = saved(reps.select("rep", "sk").join(large.select("rep").distinct(), "rep", "left_semi"))
        below = saved(sized(saved(_children(large.join(deep, "rep"), branching))))
        dense = below.where(F.col("size") > bucket).groupBy("parent").agg(
            F.count(F.lit(1)).alias("_in"), F.max("psize").alias("_of")).where(F.col("_in") >= F.col("_of"))
        dense = saved(dense.select("parent"))
        final = final.union(large.join(dense, F.col("path") == F.col("parent"), "left_semi"))
        below = below.join(dense, "parent", "left_anti").select("path", "size", "rep")
        final, large = final.union(below.where(F.col("size") <= bucket)), below.where(F.col("size") > bucket)
    return final.union(large)


def _edges(reps: np.ndarray, adj: np.ndarray, names: tuple[str, str]) -> pa.RecordBatch | None:
    """A spanning star of every linked group: each row to the smallest representative it reaches."""
    root = local_roots(adj)
    own = np.flatnonzero(root != np.arange(len(reps)))
    return pa.RecordBatch.from_pydict({names[0]: reps[own], names[1]: reps[root[own]]}) if len(own) else None


def sketch_candidates(buckets: DataFrame, reps: DataFrame, threshold: float, bucket: int) -> DataFrame:
    """(a, b): within every bucket links that join all pairs whose sketches do not rule them out.

    A bucket of several blocks is dealt over pairs of blocks. A block met with itself returns a spanning star of
    its linked rows, two blocks a spanning forest of the groups that are linked within either
    (:func:`label_edges`): n alike rows give n links and one for each pair of blocks."""
    least = SURE * threshold

    def compare(t: pa.Table) -> pa.RecordBatch | None:
        if t.num_rows < 2:
            return None
        rep = t.column("rep").to_numpy()
        order = np.argsort(rep, kind="stable")
        sets = [s for s in _sketches(t.column("sk").take(pa.array(order)))]
        size = np.array([len(s) for s in sets])
        reach = np.array([int(s[-1]) if len(s) == SKETCH else 1 << 32 for s in sets], np.int64)
        part = np.stack([np.searchsorted(s, reach, "right") for s in sets])  # tokens up to the other's last
        part = np.minimum(part, size[:, None])
        both = common_counts(sets)
        union = part + part.T - both
        adj = (both >= least * np.maximum(union, 1)) & (both > 0)
        if t.column("_i")[0].as_py() == t.column("_j")[0].as_py():
            return _edges(rep[order], adj, ("a", "b"))
        found = label_edges(adj, rep[order], t.column("_b").to_numpy()[order] == t.column("_i")[0].as_py())
        return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    rows = block_pairs(buckets.join(reps.select("rep", "sk"), "rep"), "path", "rep", "size", bucket)
    return map_groups(rows.select("path", "_i", "_j", "_b", "rep", "sk"), ["path", "_i", "_j"], compare, "a long, b long")


class _Block(Meeting):
    """A block of a cluster: exact similarities of its texts with all texts of the cluster, counted."""

    def __init__(self, rows: pa.Table, threshold: float, n: int):
        self.threshold, self.n = threshold, n
        self.rep, self.weight, self.sets = self._texts(rows)
        adj = self._adjacent(self.sets, self.rep)
        root = local_roots(adj)
        self.add = adj.astype(np.float64) @ self.weight
        self.edges = [(int(self.rep[i]), int(self.rep[r])) for i, r in enumerate(root.tolist()) if r != i]

    def _texts(self, rows: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(rep, weight, set) of the texts, one each, ordered by rep."""
        rows = rows.combine_chunks()
        sets = shingle_sets(*string_buffer(rows.column("text").chunk(0)), self.n)
        rep, fp1, weight = (rows.column(c).to_numpy() for c in ("rep", "fp1", "m"))
        at = np.flatnonzero(fingerprints(sets)[0] == fp1)  # not the text of another row with this id
        at = at[np.lexsort((fp1[at], rep[at]))]
        again = np.zeros(len(at), bool)  # a row that stands several times
        again[1:] = (rep[at][1:] == rep[at][:-1]) & (fp1[at][1:] == fp1[at][:-1])
        at = at[~again]
        return rep[at], weight[at], [sets[i] for i in at]

    def _adjacent(self, sets: list[np.ndarray], rep: np.ndarray) -> np.ndarray:
        size = np.array([len(s) for s in sets])
        both = common_counts(sets)
        adj = (both >= self.threshold * (size[:, None] + size[None, :] - both) - 1e-6) & (both > 0)
        return adj & (rep[:, None] != rep[None, :])

    def meet(self, other: pa.Table, later: bool) -> None:
        rep, weight, sets = self._texts(other)
        k = len(self.rep)
        names = np.concatenate((self.rep, rep))
        adj = self._adjacent(self.sets + sets, names)
        self.add += adj[:k, k:].astype(np.float64) @ weight
        if later:  # each pair of blocks once
            order = np.argsort(names, kind="stable")
            self.edges += label_edges(adj[np.ix_(order, order)], names[order], order < k)

    def result(self) -> pa.RecordBatch:
        has = np.flatnonzero(self.add)
        none, some = len(has), len(self.edges)
        return pa.RecordBatch.from_arrays(
            [pa.array([*self.rep[has].tolist(), *(a for a, _ in self.edges)], pa.int64()),
             pa.array([*self.add[has].astype(np.int64).tolist(), *[0] * some], pa.int64()),
             pa.array([*[None] * none, *(b for _, b in self.edges)], pa.int64())], ["rep", "add", "root"])


def verify(clusters: DataFrame, reps: DataFrame, docs: DataFrame, threshold: float, n: int, block: int, id_col: str,
           text_col: str) -> DataFrame:
    """(rep, add, root): exact Jaccard similarities inside every cluster of (node, component).

    Whole texts are brought together by cluster; every block of a cluster meets all its texts
    (:func:`meet_blocks`). A representative that has links gets one row with ``add``, the number of rows of the
    representatives linked to it. Rows with a ``root`` (and add 0) are links that join all linked
    representatives; pairs are not written out."""
    size = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    rows = clusters.join(size, "component").withColumnRenamed("node", "rep")
    rows = rows.join(reps.select("rep", "m", "fp1"), "rep")
    text = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(text, "rep").select("component", "rep", "size", "m", "fp1", "text")
    return meet_blocks(rows, "component", "rep", "size", block, lambda own: _Block(own, threshold, n), "rep long, add long, root long")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, n: int = 5, target_recall: float = 0.9999,
                    branching: float = 2.5, bucket: int = BUCKET, max_depth: int = 6, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_links, class_id, kept) for every row of ``docs``.

    Two documents are linked when the Jaccard similarity of their sets of ``n``-word shingles (words as
    they stand, between ASCII white space) is at least ``threshold``. n_links: other rows linked
    directly. class_id: smallest doc_id reachable over links, the own one included. kept: it is the own.

    Rows with equal sets form a class and only its smallest id takes part; its copies get its links plus
    the rest of the class, so copies are never paired. Representatives meet by chosen paths
    (:func:`choose_paths`), repeated :func:`runs_for` times; pairs that their sketches do not rule out
    join clusters, and within a cluster all pairs are compared on whole sets (:func:`verify`).

    A text without words (or null) is linked with nothing; fewer than ``n`` words form one shingle. A
    row without an id is linked with nothing and has class_id null, kept true. Rows that repeat an id
    and text count as copies. Other columns are not read; an empty table gives no rows."""
    made = saved(describe(docs, n, runs_for(threshold, branching, target_recall), branching, id_col, text_col))
    usable = made.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = usable.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("m"))
    member = saved(usable.select("doc_id", "fp1", "fp2").join(classes, ["fp1", "fp2"]).select("doc_id", "fp1", "rep", "m"))
    own = member.where(F.col("doc_id") == F.col("rep")).select("rep", "m", "fp1").distinct()
    reps = saved(own.join(made.select(F.col("doc_id").alias("rep"), "fp1", "n", "paths", "sk").dropDuplicates(["rep", "fp1"]),
                          ["rep", "fp1"]))
    found = sketch_candidates(choose_paths(reps, branching, bucket, max_depth), reps, threshold, bucket)
    checked = saved(verify(components(found), reps, docs, threshold, n, CLUSTER, id_col, text_col))
    links = checked.groupBy("rep").agg(F.sum("add").alias("_add"))
    joined = components(checked, "rep", "root").select(F.col("node").alias("rep"), "component")
    out = member.join(links, "rep", "left").join(joined, "rep", "left").select(
        "doc_id", (F.col("m") - 1 + F.coalesce("_add", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("class_id"))
    alone = made.where((F.col("n") == 0) | F.col("doc_id").isNull()).select(
        "doc_id", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id"))
    return out.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))
