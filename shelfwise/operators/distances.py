"""Distances on the long 0/1 book x tag matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_overlap(book_tag_set: DataFrame, first_n: int | None = None) -> DataFrame:
    """Mean overlap of each book with all books of the matrix (itself included, absent pairs = 0).
    With ``first_n`` the matrix is that of the first so many book ids.

    sum_b |tags(a) & tags(b)| = sum over a's tags of the tag's document frequency, so the mean
    row of A A^T comes from one aggregate and one join: no pair of books is ever formed.
    Output (book_id, mean_overlap).
    """
    if first_n is not None:
        first = book_tag_set.select("book_id").distinct().orderBy("book_id").limit(first_n)
        book_tag_set = book_tag_set.join(first, "book_id", "left_semi")
    dfreq = book_tag_set.groupBy("tag_id").agg(F.count(F.lit(1)).alias("_df"))
    n_books = book_tag_set.agg(F.count_distinct("book_id")).scalar()
    per = book_tag_set.join(dfreq, "tag_id").groupBy("book_id").agg(F.sum("_df").alias("_s"))
    return per.select("book_id", (F.col("_s") / n_books).alias("mean_overlap"))
