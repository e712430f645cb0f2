"""Projections, casts, filters, id handling and duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import materialize

# The tag-exclusion pattern of the reference workflow.
SHELF_TAG_PATTERN = "read|own|buy|default|favou?rit|book|library|wish"

_POS_BITS = 33  # monotonically_increasing_id keeps the partition index above bit 33


def dense_ids(df: DataFrame, order_cols: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Number rows 1..N in the order of ``order_cols`` without a single-partition window.

    The rows are range-sorted across partitions and written once with their place; each
    partition's row count (one row per partition, a bounded table) gives its offset. Counts and
    numbers read the same written copy, so they agree whatever the planner shares or prunes, and
    a lost executor re-reads it. ``order_cols`` should be unique for a reproducible order.
    """
    ordered = materialize(df.orderBy(*order_cols).withColumn("_mid", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("_pid", F.shiftright("_mid", _POS_BITS)).withColumn(
        "_pos", F.col("_mid").bitwiseAND((1 << _POS_BITS) - 1)
    )
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (
        ordered.join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_off") + F.col("_pos") + F.lit(start)).cast("long"))
        .drop("_mid", "_pid", "_pos", "_off")
    )


def relevel_ids(df: DataFrame, col: str, name: str | None = None, start: int = 0) -> DataFrame:
    """Map arbitrary ids to dense ``start..N-1+start`` in id order: (col, name)."""
    name = name or f"{col}_idx"
    return dense_ids(df.select(col).where(F.col(col).isNotNull()).distinct(), [col], name, start)


def cast_ids(df: DataFrame, cols: Sequence[str], lenient: bool = False, to: str = "long") -> DataFrame:
    """String ids -> integers. Strict cast raises on malformed values (ANSI); lenient gives NULL."""
    conv = (lambda c: F.col(c).try_cast(to)) if lenient else (lambda c: F.col(c).cast(to))
    return df.withColumns({c: conv(c) for c in cols})


def cast_all_int(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("int").alias(c) for c in df.columns])


def flag_good(ratings: DataFrame, top: int = 5, col: str = "rating", name: str = "good") -> DataFrame:
    """``good`` = 1 when the rating equals the top value, else 0."""
    return ratings.withColumn(name, (F.col(col) == F.lit(top)).cast("int"))


def dedup_keep_max(ratings: DataFrame, keys: Sequence[str] = ("user_id", "book_id"), value: str = "rating") -> DataFrame:
    """One row per key with the maximum value (partial aggregation before the shuffle)."""
    return ratings.groupBy(*keys).agg(F.max(value).alias(value))


def group_max_broadcast(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Attach the group maximum to every row (``transform(max)``).

    A window on the keys: the input (often itself a join) is read and shuffled once, where an
    aggregate joined back would read it twice. The window spills a large group to disk.
    """
    return df.withColumn(name, F.max(value).over(Window.partitionBy(*keys)))


def dedup_keep_max_rows(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Window form of the dedup for tables that carry extra columns: rows at the group max, distinct."""
    return (
        group_max_broadcast(df, keys, value, "_max")
        .where(F.col(value) == F.col("_max"))
        .drop("_max")
        .distinct()
    )


def exclude_regex(df: DataFrame, col: str, pattern: str = SHELF_TAG_PATTERN) -> DataFrame:
    """Drop rows whose ``col`` contains the (unanchored, case-sensitive) pattern; NULLs are dropped too."""
    return df.where(~F.col(col).rlike(pattern))


def select_positional(df: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    return df.select(*df.columns[start:stop])


def with_constant(df: DataFrame, name: str = "help", value=1) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def lookup_by_keys(df: DataFrame, col: str, keys: Sequence) -> DataFrame:
    return df.where(F.col(col).isin(list(keys)))


def filter_param(df: DataFrame, col: str, value: Column) -> DataFrame:
    """Predicate against a computed value given as a scalar-subquery Column."""
    return df.where(F.col(col) == value)


def dense_id_check(df: DataFrame, col: str) -> DataFrame:
    """Are the ids exactly 1..N? One aggregate row."""
    agg = df.agg(
        F.count_distinct(col).alias("n_distinct"),
        F.min(col).alias("min_id"),
        F.max(col).alias("max_id"),
    )
    return agg.withColumn("is_dense", (F.col("min_id") == 1) & (F.col("max_id") == F.col("n_distinct")))


def id_spine(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """All ids 1..max(col) as rows, including ids without any row."""
    spark = df.sparkSession
    hi = df.agg(F.max(col).alias("m"))
    name = name or col
    # range bounds are resolved from a one-row aggregate; sequence is generated distributed via range
    max_id = hi.first()["m"] or 0
    return spark.range(1, int(max_id) + 1).withColumnRenamed("id", name)


def scale_by_count(df: DataFrame, col: str, denominator: Column, name: str) -> DataFrame:
    """Divide a count column by a (scalar-subquery) row count, as double; 0 rows -> NULL."""
    return df.withColumn(name, F.try_divide(F.col(col).cast("double"), denominator))
