"""Joins: id normalisation, membership, semi/anti, and the skew-safe self-join (A^T A)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import materialize

# Rows per side of one (group, bucket, bucket) cell of the salted self-join; a cell
# emits at most CELL_ROWS**2 pairs before map-side aggregation.
CELL_ROWS = 1024
#: Items a side of one cell of :func:`_gram_cells`, rows of its counts that are held at once, and cells that give all tasks work.
CELL_ITEMS, STRIP, MIN_CELLS = 8192, 512, 64


def normalize_ids(book_tags: DataFrame, books: DataFrame, ext_col: str = "goodreads_book_id") -> DataFrame:
    """Replace the external book id by the internal one (inner join; dangling ids vanish).

    ``book_tags`` carries ``ext_col`` (already cast to long) and ``books`` carries
    ``id`` (internal) and ``book_id`` (external). The planner picks broadcast from
    the measured size of ``books``; no hint is forced because books may be large.
    """
    b = books.select(F.col("id").alias("_int_id"), F.col("book_id").alias("_ext_id"))
    j = book_tags.join(b, book_tags[ext_col] == b["_ext_id"])
    return j.drop(ext_col, "_ext_id").withColumnRenamed("_int_id", "book_id")


def semi_join(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(keys, on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows whose key is absent from ``keys`` (NULL-safe, unlike NOT IN)."""
    return df.join(keys, on, "left_anti")


def membership_flag(df: DataFrame, keys: DataFrame, col: str, key_col: str | None = None, name: str = "is_member") -> DataFrame:
    """Per row of ``df``: is ``col`` among ``keys[key_col]``? (left join to distinct keys)."""
    key_col = key_col or col
    k = keys.select(F.col(key_col).alias("_key")).distinct().withColumn("_hit", F.lit(True))
    j = df.join(k, df[col] == k["_key"], "left")
    return j.withColumn(name, F.col("_hit").isNotNull()).drop("_key", "_hit")


def gram_join(df: DataFrame, group_col: str, item_col: str, left: str = "item_a", right: str = "item_b",
              include_diagonal: bool = False, cell_rows: int = CELL_ROWS, only_left: DataFrame | None = None,
              in_cells: bool = False, carry: str | None = None, cell_items: int = CELL_ITEMS) -> DataFrame:
    """Co-incidence counts ``(left, right, n)`` = number of groups holding both items (A^T A for 0/1 A).

    Groups are salted by their size: a group with n rows is split into s = ceil(n / cell_rows)
    buckets and the self-join runs on (group, bucket_a, bucket_b), so a hot group (say a third of
    all rows) spreads over s^2 tasks instead of one. Every pair is still produced exactly once and
    is counted by a partial (map-side) aggregate before the shuffle on the pair key. Counts are
    symmetric, so only pairs with left < right are joined and counted; they are mirrored afterwards.
    Input rows must be distinct per (group, item).

    ``only_left``: (item_col) rows; only pairs whose left item is among them are formed.

    ``in_cells``: items and groups are whole numbers, items in few groups each. They come once with all their groups; blocks of ``cell_items`` items meet
    each other and count their pairs as a whole, so that no row of pairs is shuffled, however many there are. ``carry``:
    whole-number column of the item, passed on for the right one (in cells only).
    """
    if in_cells:
        return _gram_cells(df, group_col, item_col, left, right, include_diagonal, carry, cell_items)
    base = df.select(F.col(group_col).alias("_g"), F.col(item_col).alias("_i"))
    sizes = base.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    # only groups above one cell need salting; that table is small (at most rows / cell_rows
    # groups), so AQE can broadcast it from its measured size and the base rows are not
    # reshuffled for the lookup. Every other group keeps a single bucket.
    heavy = sizes.where(F.col("_n") > cell_rows).select(
        "_g", F.ceil(F.col("_n") / F.lit(cell_rows)).cast("int").alias("_hs"))
    salted = base.join(heavy, "_g", "left").select(
        "_g", "_i", F.coalesce(F.col("_hs"), F.lit(1)).alias("_s"))
    salted = salted.withColumn("_b", F.pmod(F.xxhash64("_i"), F.col("_s")).cast("int"))
    lhs = salted.select(
        "_g", F.col("_b").alias("_ba"), F.explode(F.sequence(F.lit(0), F.col("_s") - 1)).alias("_bb"),
        F.col("_i").alias(left),
    )
    rhs = salted.select(
        "_g", F.explode(F.sequence(F.lit(0), F.col("_s") - 1)).alias("_ba"), F.col("_b").alias("_bb"),
        F.col("_i").alias(right),
    )
    if only_left is not None:
        wanted = lhs.join(only_left.select(F.col(item_col).alias(left)).distinct(), left, "left_semi")
        pairs = wanted.join(rhs, ["_g", "_ba", "_bb"])
        if not include_diagonal:
            pairs = pairs.where(F.col(left) != F.col(right))
        return pairs.groupBy(left, right).agg(F.count(F.lit(1)).alias("n"))
    upper = lhs.join(rhs, ["_g", "_ba", "_bb"]).where(F.col(left) < F.col(right))
    counts = upper.groupBy(left, right).agg(F.count(F.lit(1)).alias("n"))
    # each counted pair in both directions, from one pass over the counts
    both = F.array(F.struct(F.col(left).alias("_l"), F.col(right).alias("_r")), F.struct(F.col(right).alias("_l"), F.col(left).alias("_r")))
    out = counts.select(F.explode(both).alias("_p"), "n").select(F.col("_p._l").alias(left), F.col("_p._r").alias(right), "n")
    if include_diagonal:
        own = base.groupBy(F.col("_i").alias(left)).agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(own.select(left, F.col(left).alias(right), "n"))
    return out


def _offsets(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, number of the row of each value) of an array column."""
    lists = col.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))


def _gram_cells(df: DataFrame, group_col: str, item_col: str, left: str, right: str, include_diagonal: bool, carry: str | None,
                cell_items: int) -> DataFrame:
    """The pairs of :func:`gram_join`, each counted as a whole in one cell: blocks of items by hash, every block meeting every block."""
    more = [] if carry is None else [carry]
    rows = df.where(F.col(group_col).isNotNull() & F.col(item_col).isNotNull())
    items = materialize(rows.groupBy(F.col(item_col).cast("long").alias("_i")).agg(
        F.collect_list(F.col(group_col).cast("long")).alias("_gs"),
        *[F.first(c).cast("long").alias(c) for c in more]))
    n = items.count()
    blocks = max(1, -(-n // cell_items), min(math.isqrt(MIN_CELLS), -(-n // STRIP)))
    block, all_ = F.pmod(F.xxhash64("_i"), F.lit(blocks)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    lhs, rhs = items.select(block.alias("a"), all_.alias("b"), "_i", "_gs"), items.select(
        all_.alias("a"), block.alias("b"), F.col("_i").alias("_j"), F.col("_gs").alias("_hs"), *more)
    schema = pa.schema([(c, pa.int64()) for c in (left, right, "n", *more)])

    def count(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out = [schema.empty_table()]
        if not mine.num_rows or not theirs.num_rows:
            return out[0]
        ids, others = mine.column("_i").to_numpy(), theirs.column("_j").to_numpy()
        values, at = _offsets(theirs.column("_hs"))
        order = np.argsort(values, kind="stable")
        groups, first = np.unique(values[order], return_index=True)
        members = np.split(at[order], first[1:])
        mine_values, mine_at = _offsets(mine.column("_gs"))
        place = np.minimum(np.searchsorted(groups, mine_values), max(len(groups) - 1, 0))
        known = groups[place] == mine_values if len(groups) else np.zeros(len(mine_values), bool)
        place, mine_at = place[known], mine_at[known]
        ends = np.searchsorted(mine_at, np.arange(0, len(ids) + STRIP, STRIP))
        for k, lo in enumerate(range(0, len(ids), STRIP)):
            part = slice(ends[k], ends[k + 1])
            order = np.argsort(place[part], kind="stable")
            met, start = np.unique(place[part][order], return_index=True)
            n = np.zeros((min(STRIP, len(ids) - lo), len(others)), np.int32)
            for g, row in zip(met, np.split(mine_at[part][order] - lo, start[1:])):
                n[row[:, None], members[g]] += 1
            if not include_diagonal:
                n[ids[lo : lo + STRIP, None] == others] = 0
            i, j = np.nonzero(n)
            out.append(pa.table([ids[lo + i], others[j], n[i, j].astype(np.int64), *[theirs.column(c).to_numpy()[j] for c in more]], schema=schema))
        return pa.concat_tables(out)

    parts = min(blocks * blocks, 20_000)
    keys = ["a", "b"]
    cells = lhs.repartition(parts, *keys).groupBy(*keys).cogroup(rhs.repartition(parts, *keys).groupBy(*keys))
    return cells.applyInArrow(count, ", ".join(f"{c} long" for c in schema.names))


def twin_classes(df: DataFrame, group_col: str, item_col: str) -> DataFrame:
    """(item_col, rep, groups): items that stand in the same groups are one class, named by its smallest item.

    Their rows of :func:`gram_join` are the same but for the items themselves, so a table of pairs of representatives and
    this membership hold the whole table of pairs. Rows need not be distinct; null groups and items are left out."""
    rows = df.where(F.col(group_col).isNotNull() & F.col(item_col).isNotNull())
    sets = rows.groupBy(F.col(item_col).alias("_i")).agg(F.sort_array(F.collect_set(group_col)).alias("groups"))
    sets = materialize(sets)
    reps = sets.groupBy("groups").agg(F.min("_i").alias("rep"))
    return sets.join(reps, "groups").select(F.col("_i").alias(item_col), "rep", "groups")


def gram_classes(df: DataFrame, group_col: str, item_col: str, cell_items: int = CELL_ITEMS) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): :func:`gram_join` in a form that is not expanded to all pairs of twins.

    members: (item_col, rep), as in :func:`twin_classes`. pairs: (rep, other, n, others), the counts of two representatives
    in both directions and on the diagonal, with the number ``others`` of items in the other's class."""
    members = materialize(twin_classes(df, group_col, item_col))
    reps = members.groupBy("rep").agg(F.first("groups").alias("groups"), F.count(F.lit(1)).alias("others"))
    rows = reps.select("rep", "others", F.explode("groups").alias("_group"))
    pairs = gram_join(rows, "_group", "rep", left="rep", right="other", include_diagonal=True, in_cells=True, carry="others",
                      cell_items=cell_items)
    return pairs, members.select(item_col, "rep")


def pair_cost_preview(df: DataFrame, group_col: str, top: int = 5, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Exact number of ordered pairs a self-join on ``group_col`` emits, plus the heaviest groups.

    Output: one row per reported group (the ``top`` heaviest, ties by id) with the global totals
    repeated: (group, n_rows, n_pairs, share_of_pairs, total_pairs, n_groups, salt_buckets).
    """
    sizes = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("n_rows"))
    sizes = sizes.withColumn("n_pairs", F.col("n_rows") * (F.col("n_rows") - 1))
    total_pairs = sizes.agg(F.sum("n_pairs")).scalar()
    n_groups = sizes.agg(F.count(F.lit(1))).scalar()
    heavy = sizes.orderBy(F.desc("n_pairs"), F.asc(group_col)).limit(top)
    return heavy.select(
        group_col,
        "n_rows",
        "n_pairs",
        F.round(F.try_divide(F.col("n_pairs").cast("double"), total_pairs), 6).alias("share_of_pairs"),
        total_pairs.alias("total_pairs"),
        n_groups.alias("n_groups"),
        F.greatest(F.lit(1), F.ceil(F.col("n_rows") / F.lit(cell_rows))).cast("long").alias("salt_buckets"),
    )
