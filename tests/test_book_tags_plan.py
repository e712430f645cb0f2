"""Exploded tag rows stay spread over tasks: not broadcast, not left to the splits of one small file."""

import re

import pytest
from pyspark.sql import functions as F

from shelfwise.sources.fixtures import Tables, join_vocabulary


@pytest.fixture()
def part(spark, tmp_path):
    rows = spark.range(400).select(
        F.col("id").alias("p_partkey"), F.concat_ws(" ", F.concat(F.lit("w"), F.col("id") % 5), F.lit("x")).alias("p_name"),
        F.lit("Brand#21").alias("p_brand"), F.lit("PLAIN").alias("p_type"), (F.col("id") % 9).cast("int").alias("p_size"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_exploded_tags_are_neither_broadcast_nor_in_one_task(spark, part):
    t = Tables(spark, part)
    bt = t.book_tags()
    assert bt.count() == 2000
    plan = bt._jdf.queryExecution().sparkPlan().toString()
    joins = re.findall(r"BroadcastHashJoin \[tag_name[^\n]*", plan)
    assert joins and all("BuildRight" in j for j in joins)
    assert re.search(r"Generate explode(.|\n)*Exchange hashpartitioning\(p_partkey", bt._jdf.queryExecution().executedPlan().toString())


def test_join_vocabulary_beyond_its_limit(spark):
    rows = spark.range(60).select("id", F.concat(F.lit("w"), F.col("id") % 6).alias("w"))
    words = spark.range(5).select(F.concat(F.lit("w"), "id").alias("w"), (F.col("id") * 10).alias("n"))
    few, many = join_vocabulary(rows, words, "w"), join_vocabulary(rows, words, "w", limit=2)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) and many.count() == 50
    assert "SortMergeJoin" in many._jdf.queryExecution().sparkPlan().toString()
