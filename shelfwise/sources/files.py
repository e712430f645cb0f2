"""CSV and JSON sources with explicit schemas (no inference), and writers for landed copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.clean import cast_ids

# Declared schemas of the domain files (FIXTURES.md section 1).
RATINGS_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("book_id", T.LongType(), False),
    T.StructField("rating", T.IntegerType(), False),
])
TAGS_SCHEMA = T.StructType([
    T.StructField("tag_id", T.LongType(), False),
    T.StructField("tag_name", T.StringType(), True),
])
TO_READ_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("book_id", T.LongType(), False),
])
# ids arrive as JSON strings: declare them as strings and cast after the load
BOOK_TAGS_JSON_SCHEMA = T.StructType([
    T.StructField("goodreads_book_id", T.StringType(), True),
    T.StructField("tag_id", T.StringType(), True),
    T.StructField("count", T.LongType(), True),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a declared schema. Columns are taken by their header name, in any order, and cast
    strictly; a header without a declared column raises ValueError, a malformed value or an empty
    field of a non-nullable column fails the job. Columns that are not declared are not read."""
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    missing = [f.name for f in schema if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: the header lacks {', '.join(missing)}")
    return raw.select(*[_required(F.col(f.name).cast(f.dataType), f) for f in schema])


def _required(value: Column, field: T.StructField) -> Column:
    if not field.nullable:
        value = F.coalesce(value, F.raise_error(F.lit(f"missing value of {field.name}")).cast(field.dataType))
    return value.alias(field.name)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_json_records(spark: SparkSession, path: str, schema: T.StructType = BOOK_TAGS_JSON_SCHEMA,
                      multi_line: bool = False, cast_cols: tuple[str, ...] = ("goodreads_book_id", "tag_id"),
                      rename: dict[str, str] | None = None) -> DataFrame:
    """JSON records read with string ids, which are then strictly cast to long; a record that lacks a
    declared field fails the job. ``rename`` maps field names to column names (default: count to cnt).

    A line holds one object or an array of objects, so a file of many lines is read in parallel;
    ``multi_line=True`` is for a file that spreads its array over lines and is read by one task."""
    df = spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
    need = [_required(F.col(f"`{f.name}`"), T.StructField(f.name, f.dataType, False)) for f in schema]
    df = df.select(*need).withColumnsRenamed({"count": "cnt"} if rename is None else rename)
    return cast_ids(df, list(cast_cols)) if cast_cols else df


def write_json_arrays(df: DataFrame, path: str, rows_per_array: int = 1000) -> str:
    """Land rows as JSON arrays, one array of about ``rows_per_array`` objects a line."""
    n = df.count()
    chunk = F.pmod(F.xxhash64(*df.columns), F.lit(max(1, -(-n // rows_per_array))))
    arrays = df.groupBy(chunk.alias("_chunk")).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    arrays.select("value").write.mode("overwrite").text(path)
    return path
