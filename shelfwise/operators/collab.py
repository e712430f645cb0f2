"""Collaborative filtering on the long rating table: item-item (IBCF) and user-user (UBCF)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.joins import CELL_ROWS, gram_join
from shelfwise.operators.topk import top_n
from shelfwise.session import materialize

#: Pairs of rows that a round of :func:`closest_items` may form; smaller tiers share a round.
ROUND_PAIRS = 2_000_000


def good_rows(flagged: DataFrame) -> DataFrame:
    """(user_id, book_id) with good = 1. Zeros add nothing to UI^T UI, so they never enter the self-join."""
    return flagged.where(F.col("good") == 1).select("user_id", "book_id")


def item_similarity(flagged: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """sim(i, j) = n(users liking i and j) / n(users liking i), diagonal removed (asymmetric).

    Output (book_id, other_id, n_both, n_good, sim). Books without a good rating, or without any
    partner, have no rows. ``only``: (book_id) rows; only their rows of the table are formed.
    """
    good = good_rows(flagged)
    diag = good.groupBy("book_id").agg(F.count(F.lit(1)).alias("n_good"))
    pairs = gram_join(good, "user_id", "book_id", left="book_id", right="other_id", only_left=only).withColumnRenamed("n", "n_both")
    return pairs.join(diag, "book_id").withColumn("sim", F.col("n_both") / F.col("n_good"))


def item_closest(similarity: DataFrame) -> DataFrame:
    """Most similar other item per item: (book_id, closest, sim). Ties go to the lowest id.

    Within one row the denominator is constant, so the argmax is taken on the integer co-count: first
    the lowest partner of every (book, count), then the one with the largest count. Both steps are
    hash aggregates on longs.
    """
    best = _argmax(similarity, "book_id", "other_id", "n_both", "n_good")
    return best.select("book_id", F.col("other_id").alias("closest"), (F.col("n_both") / F.col("n_good")).alias("sim"))


@dataclass(frozen=True)
class ClosestItems:
    """``rows``: (book_id, closest, n_both, n_good). ``pairs``: pairs of rating rows that were formed, of ``total``
    that the whole self-join has; ``rounds``: joins that formed them."""

    rows: DataFrame
    rounds: int
    pairs: int
    total: int


def partner_rounds(tiers: list[tuple[int, int, int]], round_pairs: int) -> list[tuple[int, int, int]]:
    """(lowest tier, highest tier, bound) of each round, from (tier, pairs, largest n_good) rows: partners of
    falling tiers, as many as fit ``round_pairs``, one at least. ``bound``: largest n_good of the partners left."""
    out, at = [], 0
    tiers = sorted(tiers, reverse=True)
    while at < len(tiers):
        to, pairs = at + 1, tiers[at][1]
        while to < len(tiers) and pairs + tiers[to][1] <= round_pairs:
            pairs += tiers[to][1]
            to += 1
        out.append((tiers[to - 1][0], tiers[at][0], tiers[to][2] if to < len(tiers) else 0))
        at = to
    return out


def closest_items(flagged: DataFrame, only: DataFrame | None = None, round_pairs: int = ROUND_PAIRS,
                  cell_rows: int = CELL_ROWS) -> ClosestItems:
    """Most similar other item per item without the table of all pairs; ties go to the lowest id.

    n_both(i, j) is at most n_good(i) and at most n_good(j). Partners are met by falling n_good, in tiers of powers
    of two. After a round an item is settled once its best count exceeds what any partner left can reach,
    min(n_good(i), largest n_good left); a partner that can only draw level might have a lower id, so such items stay
    open. Only rows of open items enter the next join, so rare items are not paired with each other once each has a
    better partner. Rows of large users are dealt over cells as in :func:`gram_join`.

    The driver holds one line per tier (64 at most); best partners and open items are written tables. ``only``:
    (book_id) rows, the items wanted. Input rows must be distinct per (user_id, book_id)."""
    good = good_rows(flagged)
    n_good = good.groupBy("book_id").agg(F.count(F.lit(1)).alias("n_good"))
    n_user = good.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_user"))
    cells = F.ceil(F.col("n_user") / F.lit(cell_rows)).cast("int")
    base = good.join(n_good, "book_id").join(n_user, "user_id").select(
        "user_id", "book_id", "n_good", (F.col("n_user") - 1).alias("pairs"), F.floor(F.log2("n_good")).cast("int").alias("tier"),
        cells.alias("cells"), F.pmod(F.xxhash64("book_id"), cells).cast("int").alias("cell"))
    base = materialize(base)
    tiers = base.groupBy("tier").agg(F.sum("pairs").alias("pairs"), F.max("n_good").alias("most")).collect()
    total = sum(r["pairs"] for r in tiers)
    plan = partner_rounds([(r["tier"], r["pairs"], r["most"]) for r in tiers], round_pairs)
    left = base if only is None else base.join(only.select("book_id").distinct(), "book_id", "left_semi")
    other = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    best, formed, rounds = None, 0, 0
    for low, high, bound in plan:
        mine = left.select("user_id", "book_id", "n_good", F.col("cell").alias("a"), other.alias("b"))
        theirs = base.where(F.col("tier").between(low, high)).select(
            "user_id", F.col("book_id").alias("closest"), other.alias("a"), F.col("cell").alias("b"))
        pairs = mine.join(theirs, ["user_id", "a", "b"]).where(F.col("book_id") != F.col("closest"))
        found = pairs.groupBy("book_id", "closest").agg(F.count(F.lit(1)).alias("n_both"), F.first("n_good").alias("n_good"))
        found = found.withColumn("formed", F.col("n_both"))
        best = materialize(_best(found if best is None else found.unionByName(best.withColumn("formed", F.lit(0).cast("long")))))
        formed += best.agg(F.sum("formed")).first()[0] or 0
        rounds += 1
        if not bound:
            break
        known = best.select("book_id", F.col("n_both").alias("_best"))
        still = left.join(known, "book_id", "left").where(F.coalesce("_best", F.lit(0)) <= F.least("n_good", F.lit(bound))).drop("_best")
        left = materialize(still)
        if left.isEmpty():
            break
    if best is None:
        best = base.select("book_id", F.col("book_id").alias("closest"), F.lit(0).cast("long").alias("n_both"), "n_good").limit(0)
    return ClosestItems(best.select("book_id", "closest", "n_both", "n_good"), rounds, formed, total)


def _best(found: DataFrame) -> DataFrame:
    """Each item's partner of the highest count, ties to the lowest id; ``formed`` is added up."""
    low = found.groupBy("book_id", "n_both").agg(
        F.min("closest").alias("closest"), F.max("n_good").alias("n_good"), F.sum("formed").alias("formed"))
    return low.groupBy("book_id").agg(F.max_by("closest", "n_both").alias("closest"), F.max("n_both").alias("n_both"),
                                      F.max("n_good").alias("n_good"), F.sum("formed").alias("formed"))


def _argmax(df: DataFrame, row: str, col: str, value: str, carry: str) -> DataFrame:
    """(row, col, value, carry) at the largest value of each row, ties to the lowest col; ``carry`` is
    constant within a row."""
    low = df.groupBy(row, value).agg(F.min(col).alias(col), F.max(carry).alias(carry))
    return low.groupBy(row).agg(F.max_by(col, value).alias(col), F.max(value).alias(value), F.max(carry).alias(carry))


def row_neighbors(similarity: DataFrame, book: Column | int, k: int = 5) -> DataFrame:
    """One item's row of the similarity table, top ``k`` by sim (ties by id)."""
    row = similarity.where(F.col("book_id") == book)
    return top_n(row.select("book_id", "other_id", "sim"), [F.desc("sim"), F.asc("other_id")], k)


def ibcf_recommend(flagged: DataFrame, closest: DataFrame, user: Column) -> DataFrame:
    """For the user's good books, their closest item and its similarity, best first."""
    mine = flagged.where((F.col("user_id") == user) & (F.col("good") == 1)).select("book_id")
    return mine.join(closest, "book_id").orderBy(F.desc("sim"), F.asc("book_id"))


def user_similarity(flagged: DataFrame, user: Column, value: str = "good") -> DataFrame:
    """Row of U = UI UI^T for one query user: co-liked book counts with every other user.

    One side is a single user's rows (at most one per book after the dedup), so the join emits at
    most one row per rating: linear, not quadratic. Output (user_id, other_user, n_common).
    """
    good = flagged.where(F.col(value) == 1).select("user_id", "book_id")
    mine = good.where(F.col("user_id") == user).select("book_id", F.col("user_id").alias("_me"))
    others = good.where(F.col("user_id") != user)
    co = others.join(mine, "book_id").groupBy("_me", "user_id").agg(F.count(F.lit(1)).alias("n_common"))
    return co.select(F.col("_me").alias("user_id"), F.col("user_id").alias("other_user"), "n_common")


def ubcf_recommend(flagged: DataFrame, user: Column, k_users: int = 10, n: int = 10) -> DataFrame:
    """Books rated best by the ``k_users`` users most similar to ``user`` and not rated by ``user``.

    Output (book_id, mean_rating, n_raters), top ``n`` by mean then raters then id.
    """
    sim = user_similarity(flagged, user)
    peers = top_n(sim, [F.desc("n_common"), F.asc("other_user")], k_users).select(F.col("other_user").alias("user_id"))
    # peers holds at most k_users rows: bounded broadcast
    theirs = flagged.join(F.broadcast(peers), "user_id")
    mine = flagged.where(F.col("user_id") == user).select("book_id")
    fresh = theirs.join(mine, "book_id", "left_anti")
    scored = fresh.groupBy("book_id").agg(F.avg("rating").alias("mean_rating"), F.count(F.lit(1)).alias("n_raters"))
    return top_n(scored, [F.desc("mean_rating"), F.desc("n_raters"), F.asc("book_id")], n)


def user_compare(ratings: DataFrame, user: Column, other: Column) -> DataFrame:
    """Ratings of two users side by side over the union of their books (full outer join):
    (book_id, rating_x, rating_y); NULL where one of them has not rated the book."""
    a = ratings.where(F.col("user_id") == user).select("book_id", F.col("rating").alias("rating_x"))
    b = ratings.where(F.col("user_id") == other).select("book_id", F.col("rating").alias("rating_y"))
    return a.join(b, "book_id", "full")


def idxmax_per_row(df: DataFrame, row: str, col: str, value: str, carry: str) -> DataFrame:
    """Best column, its value and ``carry`` (constant within a row) per row of a long matrix (ties:
    lowest column id)."""
    best = _argmax(df, row, col, value, carry)
    return best.select(row, F.col(col).alias(f"best_{col}"), F.col(value).alias(f"max_{value}"), carry)
