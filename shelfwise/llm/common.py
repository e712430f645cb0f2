"""Shared helpers of the text operators: reading, grouping rows into bounded blocks, string buffers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import ensure_checkpoint_dir

#: ASCII white space that separates words: space and \t \n \v \f \r.
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage with a copy in the shared checkpoint folder; a lost executor re-reads it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a uint64 (public splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def string_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, n + 1 offsets) of a string column without copying; a null has length 0."""
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        col, kind = col.cast(pa.string()), np.int32
    _, off, data = col.buffers()
    if off is None or len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(off, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def block_of(item: str, size: Column, block: int) -> list[Column]:
    """(_nb, _b): how many blocks a group of ``size`` rows is cut into and this row's block."""
    nb = F.ceil(size / F.lit(block)).cast("int")
    return [nb.alias("_nb"), F.pmod(F.xxhash64(item), nb.cast("long")).cast("int").alias("_b")]


def block_pairs(df: DataFrame, group: str, item: str, size: str, block: int) -> DataFrame:
    """Deal the rows of every group over pairs of blocks: adds _i <= _j (the pair) and _b (own block).

    Two rows of a group meet in exactly one pair (_i, _j): that of their blocks. A group of n rows
    becomes ceil(n / block) blocks, so that no task holds more than about two blocks of one group,
    however large the group is."""
    cut = df.select("*", *block_of(item, F.col(size), block))
    other = F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))
    out = cut.withColumn("_o", other)
    return out.withColumn("_i", F.least("_b", "_o")).withColumn("_j", F.greatest("_b", "_o")).drop("_nb", "_o")


def map_groups(df: DataFrame, keys: Sequence[str], fn: Callable[[pa.Table], pa.RecordBatch | None],
               schema: str) -> DataFrame:
    """Apply ``fn`` to the rows of each key (a pyarrow table). Keys are integer columns without null.

    The rows are shuffled and sorted by key and stream through the task; only the rows of one key
    and of the current Arrow batch are held, which suits many small groups."""
    keys = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in _runs(batches, keys):
            out = fn(part)
            if out is not None and out.num_rows:
                yield out

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def meet_blocks(df: DataFrame, group: str, item: str, size: str, block: int, start: Callable[[pa.Table], "Meeting"],
                schema: str) -> DataFrame:
    """Let every block of a group meet all rows of the group, and return what each block's ``Meeting`` finds.

    A group of n rows is cut into ceil(n / block) blocks. Each is held by one task, to which the group's
    other blocks come one after another, sorted by their number, so that about two blocks are in memory
    however large the group is. A row is shipped once a block; what comes back is up to the
    meeting, which can return one row for each of its own rows. ``group`` is an integer column without null."""
    cut = df.select("*", *block_of(item, F.col(size), block))
    rows = cut.withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
    rows = rows.withColumn("_b", F.when(F.col("_b") == F.col("_t"), -1).otherwise(F.col("_b"))).drop("_nb")
    keys = [group, "_t", "_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Meeting | None = None
        last: tuple | None = None
        for key, part in _runs(batches, keys):
            if key[:2] != last:
                if held is not None:
                    yield held.result()
                held, last = start(part) if key[2] < 0 else None, key[:2]
            elif held is not None:  # a block without rows holds nothing
                held.meet(part, key[2] > key[1])
        if held is not None:
            yield held.result()

    return rows.repartition(group, "_t").sortWithinPartitions(*keys).mapInArrow(run, schema)


class Meeting:
    """What :func:`meet_blocks` does with a block: made from its rows, then shown the other blocks."""

    def meet(self, other: pa.Table, later: bool) -> None:
        raise NotImplementedError

    def result(self) -> pa.RecordBatch:
        raise NotImplementedError


def _runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The runs of rows with equal keys, in their order."""
    carry: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        first = tuple(c[0] for c in cols)
        cut = np.zeros(batch.num_rows, bool)
        cut[0] = last is not None and last != first
        for c in cols:
            cut[1:] |= c[1:] != c[:-1]
        at = 0
        for p in np.flatnonzero(cut).tolist():
            if p > at:
                carry.append(batch.slice(at, p - at))
            yield (last if p == 0 else tuple(c[p - 1] for c in cols)), pa.Table.from_batches(carry)
            carry, at = [], p
        carry.append(batch.slice(at))
        last = tuple(c[-1] for c in cols)
    if carry:
        yield last, pa.Table.from_batches(carry)


def label_edges(adj: np.ndarray, name: np.ndarray, own: np.ndarray) -> list[tuple[int, int]]:
    """Links between two blocks, thinned out: rows that are linked within their block count as one (named by its
    smallest), and of these a spanning forest is returned. ``own`` marks the rows of the first block; the rows
    are ordered by ``name``."""
    same = own[:, None] == own[None, :]
    label = local_roots(adj & same)
    a, b = np.nonzero(adj & ~same & own[:, None])
    pairs = np.unique(np.stack([label[a], label[b]], axis=1), axis=0)
    root = np.arange(len(name))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = int(root[x])
        return x

    out = []
    for x, y in pairs.tolist():
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((int(name[x]), int(name[y])))
    return out


def local_roots(adj: np.ndarray) -> np.ndarray:
    """Per row of a small symmetric adjacency matrix the smallest row index that links reach."""
    n = len(adj)
    lab = np.arange(n)
    adj = adj | np.eye(n, dtype=bool)
    while True:
        new = np.where(adj, lab[None, :], n).min(axis=1)
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def sized(rows: DataFrame, key: str = "path") -> DataFrame:
    """The rows of the keys that two or more rows share, with the number of rows as ``size``."""
    size = rows.groupBy(key).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    return rows.join(size, key)
