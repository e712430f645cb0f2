"""Sorts, limits and top-k, always with a total order (value, id) so results are deterministic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sort_rows(df: DataFrame, by: Sequence, ascending: bool | Sequence[bool] = True) -> DataFrame:
    return df.orderBy(*by, ascending=ascending)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Global top-n (TakeOrderedAndProject: per-partition top-n, then a merge of n x partitions rows)."""
    return df.orderBy(*order).limit(n)


def topk_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """``row_number() <= k`` per group; Spark inserts a partial WindowGroupLimit before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def topk_abs_per_group(df: DataFrame, group: str, value: str, label: str, k: int = 5) -> DataFrame:
    """Per group, the ``k`` rows with the largest |value| (ties by label)."""
    return topk_per_group(df, [group], [F.desc(F.abs(F.col(value))), F.asc(label)], k)


def top_unread_books(flagged: DataFrame, user_books: DataFrame, n: int = 1000) -> DataFrame:
    """Books the user has not rated, by mean ``good`` over all users, top ``n`` (ties by book id)."""
    means = flagged.groupBy("book_id").agg(F.avg("good").alias("mean_good"))
    unread = means.join(user_books.select("book_id"), "book_id", "left_anti")  # whole books go, so one row each is enough
    return top_n(unread, [F.desc("mean_good"), F.asc("book_id")], n)
