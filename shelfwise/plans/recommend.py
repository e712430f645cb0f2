"""Content-based recommendation for one user: kNN over book feature vectors, and its validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import neighbors as nbrs
from shelfwise.operators.aggregates import tag_share
from shelfwise.operators.joins import membership_flag
from shelfwise.operators.topk import top_n, top_unread_books
from shelfwise.session import materialize


def with_vectors(books: DataFrame, vectors: DataFrame, width: Column | int, missing: str = "zero") -> DataFrame:
    """Left join book ids to their vectors; a book without features gets a zero vector
    (``missing="drop"`` removes it instead)."""
    j = books.join(vectors, "book_id", "left")
    if missing == "drop":
        return j.where(F.col("vec").isNotNull())
    w = width if isinstance(width, Column) else F.lit(width)
    return j.withColumn("vec", F.coalesce("vec", F.array_repeat(F.lit(0.0), w.cast("int"))))


def knn_scores(flagged: DataFrame, books: DataFrame, vectors: DataFrame, width, user: Column,
               k: int = 2, weights: str = "distance", n_candidates: int = 1000, mine: DataFrame | None = None) -> DataFrame:
    """Score the user's ``n_candidates`` best unread books with a kNN fitted on the user's own
    good/not-good labels: (book_id, pred, dist) for every candidate. ``mine``: the user's rows of ``flagged``, if known."""
    mine = (flagged.where(F.col("user_id") == user) if mine is None else mine).select("book_id", "good")
    cands = top_unread_books(flagged, mine, n_candidates).select("book_id")
    cands = books.select(F.col("id").alias("book_id")).join(cands, "book_id", "left_semi")
    # the user's rows and the (at most n_candidates) candidates are read by several jobs
    train = materialize(with_vectors(mine, vectors, width))
    queries = materialize(with_vectors(cands, vectors, width))
    nb = nbrs.knn_neighbors(queries.withColumnRenamed("book_id", "qid"), train.withColumnRenamed("book_id", "tid"), k)
    scored = nbrs.vote(nb, train.select(F.col("book_id").alias("tid"), F.col("good").alias("label")), weights=weights)
    return scored.withColumnRenamed("qid", "book_id")


def knn_recommend(scores: DataFrame, books: DataFrame, n: int = 10) -> DataFrame:
    """Predicted-good candidates nearest to the user's books: top ``n`` by mean neighbour
    distance (ties by id), with titles: (book_id, pred, dist, title)."""
    good = scores.where(F.col("pred") == 1)
    best = top_n(good, [F.asc(F.round("dist", 9)), F.asc("book_id")], n)
    titles = books.select(F.col("id").alias("book_id"), "title")
    return best.join(titles, "book_id").select("book_id", "pred", "dist", "title")


def validate_tag_shares(rec: DataFrame, mine: DataFrame, long_tags: DataFrame, top: int = 10) -> DataFrame:
    """Tag shares of the user's books (act) against the recommended books (pred), full outer:
    (tag_name, share_act, share_pred)."""
    act = tag_share(mine.select("book_id"), long_tags, mine.agg(F.count(F.lit(1))).scalar(), top)
    pred = tag_share(rec.select("book_id"), long_tags, rec.agg(F.count(F.lit(1))).scalar(), top)
    return act.select("tag_name", F.col("share").alias("share_act")).join(
        pred.select("tag_name", F.col("share").alias("share_pred")), "tag_name", "full"
    )


def validate_membership(rec: DataFrame, to_read: DataFrame, top_books: DataFrame, user: Column, n_top: int = 100) -> DataFrame:
    """Per recommended book: is it on the user's to-read list, and among the ``n_top`` best candidates?"""
    mine_to_read = to_read.where(F.col("user_id") == user).select("book_id")
    best = top_n(top_books, [F.desc("mean_good"), F.asc("book_id")], n_top).select("book_id")
    r = membership_flag(rec.select("book_id"), mine_to_read, "book_id", name="in_to_read")
    return membership_flag(r, best, "book_id", name="in_top100")
