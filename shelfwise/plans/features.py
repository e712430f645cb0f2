"""Book x tag features: normalised book tags -> frequent tags -> kept tags -> long 0/1 matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.ml.feature import CountVectorizerModel

from shelfwise.operators.aggregates import tag_frequency
from shelfwise.operators.clean import cast_ids, exclude_regex
from shelfwise.operators.joins import normalize_ids
from shelfwise.operators.topk import top_n

# Parameters for the fixture tables (the fixture has 97 tags, so 60 stands in for 100).
FIXTURE_TOP_TAGS = 60
FIXTURE_TAG_PATTERN = "Brand#1|PROMO"


def book_tags_norm(book_tags_raw: DataFrame, books: DataFrame) -> DataFrame:
    """String ids cast to long (strict), external id replaced by the internal one: (book_id, tag_id, cnt)."""
    typed = cast_ids(book_tags_raw, ["goodreads_book_id", "tag_id"])
    return normalize_ids(typed, books).select("book_id", "tag_id", "cnt")


def top_tags(book_tags: DataFrame, tags: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` most used tags (ties by tag id) with names: (tag_id, tag_name, count, n_books)."""
    best = top_n(tag_frequency(book_tags), [F.desc("count"), F.asc("tag_id")], n)
    # ``best`` holds at most n rows: a proven bound for the broadcast
    return tags.join(F.broadcast(best), "tag_id").select("tag_id", "tag_name", "count", "n_books")


def kept_tags(book_tags: DataFrame, tags: DataFrame, n: int = FIXTURE_TOP_TAGS, pattern: str = FIXTURE_TAG_PATTERN) -> DataFrame:
    return exclude_regex(top_tags(book_tags, tags, n), "tag_name", pattern)


def book_tag_long(book_tags: DataFrame, kept: DataFrame) -> DataFrame:
    """Filtering join onto the kept tags (at most n rows, broadcast): (book_id, tag_id, tag_name)."""
    return book_tags.join(F.broadcast(kept.select("tag_id", "tag_name")), "tag_id").select("book_id", "tag_id", "tag_name")


def book_tag_set(long: DataFrame) -> DataFrame:
    """Distinct (book_id, tag_id): the 0/1 matrix, with repeated pairs collapsed."""
    return long.select("book_id", "tag_id").distinct()


def vocabulary(kept: DataFrame) -> list[str]:
    """Kept tag ids in id order; bounded by the top-n limit, so it may come to the driver."""
    return [str(r["tag_id"]) for r in kept.select("tag_id").orderBy("tag_id").collect()]


def multi_hot_vectors(long: DataFrame, vocab: list[str]) -> DataFrame:
    """One binary SparseVector per book over the vocabulary: (book_id, features)."""
    tokens = long.groupBy("book_id").agg(F.collect_set(F.col("tag_id").cast("string")).alias("_tokens"))
    model = CountVectorizerModel.from_vocabulary(vocab, inputCol="_tokens", outputCol="features", binary=True)
    return model.transform(tokens).select("book_id", "features")


def resolve_kept(kept: DataFrame) -> list[tuple[int, str]]:
    """The kept tags as (tag_id, tag_name) in id order. Bounded by the top-n limit, so fetching
    them once lets every later plan use a literal list instead of recomputing the ranking."""
    return [(int(r["tag_id"]), r["tag_name"]) for r in kept.select("tag_id", "tag_name").orderBy("tag_id").collect()]


def dense_tag_arrays(book_tags: DataFrame, kept_list: list[tuple[int, str]]) -> DataFrame:
    """Per book with at least one kept tag, a dense 0/1 array over the kept tags in id order:
    (book_id, vec array<double>). The tag filter is a literal IN list (pushed to the scan side)."""
    ids = [tid for tid, _ in kept_list]
    width = len(ids)
    pos = F.array_position(F.array(*[F.lit(i).cast("long") for i in ids]), F.col("tag_id")) - 1
    hits = book_tags.where(F.col("tag_id").isin(ids)).select("book_id", pos.alias("_p"))
    per_book = hits.groupBy("book_id").agg(F.collect_set("_p").alias("_ps"))
    return per_book.select(
        "book_id",
        F.transform(F.sequence(F.lit(0), F.lit(width - 1)),
                    lambda i: F.when(F.array_contains("_ps", i), 1.0).otherwise(0.0)).alias("vec"),
    )
