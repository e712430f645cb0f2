"""JDBC sources: a whole table read in parallel ranges, and a filtered read pushed to the database."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None, num_partitions: int = 8,
               properties: dict | None = None) -> DataFrame:
    """Whole table. With a numeric ``partition_column`` and bounds, Spark opens ``num_partitions``
    connections, each reading one stride of the key range (bounds only shape the strides; no row
    is dropped)."""
    props = dict(properties or {})
    if partition_column is not None and lower is not None and upper is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def read_filtered(spark: SparkSession, url: str, table: str, condition: Column, properties: dict | None = None) -> DataFrame:
    """Reflected table with a predicate; Catalyst pushes simple comparisons into the SQL sent to
    the database (``PushedFilters`` in the plan)."""
    return read_table(spark, url, table, properties=properties).where(condition)


def bounds(spark: SparkSession, url: str, table: str, column: str, properties: dict | None = None) -> tuple[int, int]:
    """min/max of the partition column, computed by the database (one-row pushed-down query)."""
    q = f"(select min({column}) as lo, max({column}) as hi from {table}) b"
    row = spark.read.jdbc(url, q, properties=dict(properties or {})).first()
    return int(row["LO"] if "LO" in row else row["lo"]), int(row["HI"] if "HI" in row else row["hi"])
