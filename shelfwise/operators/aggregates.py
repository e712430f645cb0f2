"""Group-by summaries: frequencies, duplicates, describe, histograms, argmax, shares, pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import materialize


def tag_frequency(book_tags: DataFrame, tag_col: str = "tag_id", count_col: str = "cnt") -> DataFrame:
    """Per tag: total uses (sum of counts) and number of book rows carrying it."""
    return book_tags.groupBy(tag_col).agg(
        F.sum(count_col).cast("long").alias("count"),
        F.count(F.lit(1)).alias("n_books"),
    )


def ratings_per_user(ratings: DataFrame, user_col: str = "user_id") -> DataFrame:
    """Group size per user, ascending (ties by user id)."""
    return ratings.groupBy(user_col).agg(F.count(F.lit(1)).alias("ratings")).orderBy("ratings", user_col)


def rating_distribution(ratings: DataFrame, col: str = "rating") -> DataFrame:
    return ratings.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def duplicate_ratings(ratings: DataFrame, keys: Sequence[str] = ("user_id", "book_id")) -> DataFrame:
    """Rows whose key occurs more than once, with the group size ``dups`` (one pass: a count over a window)."""
    counted = ratings.withColumn("dups", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    rest = [c for c in ratings.columns if c not in keys]
    return counted.where(F.col("dups") > 1).select(*keys, "dups", *rest)


def duplicate_check(ratings: DataFrame, keys: Sequence[str] = ("user_id", "book_id")) -> DataFrame:
    """Number of keys still holding more than one row (0 after a dedup)."""
    sizes = ratings.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(F.count_if(F.col("_n") > 1).alias("n_duplicated_keys"))


def distinct_count(df: DataFrame, col: str, name: str) -> DataFrame:
    return df.agg(F.count_distinct(col).alias(name))


def mean_per_group(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(name))


def value_ranks(df: DataFrame, col: str) -> DataFrame:
    """(v, n, last): the distinct non-null values of ``col`` as doubles, how often each occurs, and how
    many rows hold it or a smaller one.

    Values are counted (partial aggregation), range-sorted and written once; the running count is a
    window inside each range partition plus the counts of the partitions before it, so no task holds
    more than its own range, however many distinct values there are."""
    v = F.col(col).cast("double")
    counts = df.where(v.isNotNull()).groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ordered = materialize(counts.orderBy("v").withColumn("_p", F.spark_partition_id()))
    inside = Window.partitionBy("_p").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    per = ordered.groupBy("_p").agg(F.sum("n").alias("_t"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    off = per.select("_p", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    running = ordered.withColumn("_run", F.sum("n").over(inside))
    return running.join(F.broadcast(off), "_p").select("v", "n", (F.col("_run") + F.col("_off")).alias("last"))


def describe_column(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """pandas-style describe in long form: one row per column with count, mean, sample std,
    min, 25/50/75 % and max.

    Quartiles are exact (linear interpolation between the two ranks around (count - 1) p), read off
    :func:`value_ranks`; count and mean come first, as the ranks asked for depend on the count."""
    parts = []
    for c in cols:
        ranks = materialize(value_ranks(df, c))
        total, mean = ranks.agg(F.sum("n"), F.sum(F.col("v") * F.col("n")) / F.sum("n")).first()
        total = int(total or 0)

        def rank(i: int) -> Column:
            return F.min(F.when(F.col("last") > i, F.col("v")))

        def quantile(p: float) -> Column:
            h = max(0, total - 1) * p
            return rank(int(h)) + (rank(min(int(h) + 1, max(0, total - 1))) - rank(int(h))) * F.lit(h - int(h))

        mu = F.lit(mean).cast("double")
        spread = F.sqrt(F.try_divide(F.sum(F.col("n") * (F.col("v") - mu) ** 2), F.lit(float(total - 1))))
        parts.append(ranks.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("count"), F.max(mu).alias("mean"), spread.alias("std"), F.min("v").alias("min"),
            quantile(0.25).alias("p25"), quantile(0.5).alias("p50"), quantile(0.75).alias("p75"), F.max("v").alias("max"),
        ).select(F.lit(c).alias("column"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def id_range(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("min_id"), F.max(col).alias("max_id"))


def global_mean(df: DataFrame, col: str, name: str = "mean") -> DataFrame:
    return df.agg(F.avg(col).alias(name))


def count_true(df: DataFrame, cond: Column, name: str = "n_true") -> DataFrame:
    return df.agg(F.count_if(cond).alias(name))


def tags_per_book(book_tag_long: DataFrame) -> DataFrame:
    """Row sum of the 0/1 book x tag matrix, in long form."""
    return book_tag_long.groupBy("book_id").agg(F.count_distinct("tag_id").alias("n_tags"))


def argmax_rows(df: DataFrame, value: str) -> DataFrame:
    """All rows tied at the maximum of ``value`` (scalar-subquery max, no single-partition window)."""
    top = df.agg(F.max(value)).scalar()
    return df.where(F.col(value) == top)


def tag_share(books: DataFrame, book_tag_long: DataFrame, denominator: Column, top: int = 10,
              book_col: str = "book_id") -> DataFrame:
    """Share of books (of a given set) carrying each tag: top ``top`` tags by count, ties by name."""
    hits = book_tag_long.join(books.select(F.col(book_col).alias("book_id")).distinct(), "book_id", "left_semi")
    counts = hits.groupBy("tag_name").agg(F.count("tag_id").alias("n"))
    best = counts.orderBy(F.desc("n"), F.asc("tag_name")).limit(top)
    return best.select("tag_name", "n", F.try_divide(F.col("n").cast("double"), denominator).alias("share"))


def label_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def histogram_equal_width(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bin counts like ``numpy.histogram``: the last bin is closed; empty bins kept.

    Output (bin 1..bins, lo, hi, n)."""
    spark = df.sparkSession
    v = F.col(col).cast("double")
    stats = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    lo_raw, hi_raw = stats.select("lo").scalar(), stats.select("hi").scalar()
    same = lo_raw == hi_raw
    lo = F.when(same, lo_raw - 0.5).otherwise(lo_raw)
    hi = F.when(same, hi_raw + 0.5).otherwise(hi_raw)
    b = F.least(F.width_bucket(v, lo, hi, F.lit(bins)), F.lit(bins))
    # bin first in a projection: scalar subqueries may not sit inside grouping expressions
    counts = df.where(v.isNotNull()).select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / F.lit(bins)
    grid = spark.range(1, bins + 1).select(F.col("id").cast("long").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (lo + (F.col("bin") - 1) * width).alias("lo"),
        (lo + F.col("bin") * width).alias("hi"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
    )


def pivot_tag_matrix(book_tag_long: DataFrame, values: Sequence, names: Sequence[str] | None = None,
                     key: str = "book_id", pivot_col: str = "tag_id") -> DataFrame:
    """Long -> wide 0/1 matrix over explicit pivot values; repeated pairs collapse; missing = 0."""
    wide = (
        book_tag_long.withColumn("help", F.lit(1))
        .groupBy(key)
        .pivot(pivot_col, list(values))
        .agg(F.max("help"))
        .fillna(0)
    )
    if names:
        wide = wide.toDF(key, *names)
    return wide


def rating_matrix(ratings: DataFrame, value: str = "good", drop_zeros: bool = False) -> DataFrame:
    """users x books incidence in long form (user_id, book_id, value); unseen pairs are absent (NULL)."""
    out = ratings.select("user_id", "book_id", F.col(value).alias("value"))
    return out.where(F.col("value") != 0) if drop_zeros else out
