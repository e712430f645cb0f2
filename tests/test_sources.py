import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfwise.sources import files, jdbc
from shelfwise.operators.clean import cast_ids

DERBY_PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_csv_round_trip_with_declared_schema(spark, tmp_path):
    df = spark.createDataFrame([(1, 10, 5), (2, 11, 3)], "user_id long, book_id long, rating int")
    path = files.write_csv(df, str(tmp_path / "ratings"))
    back = files.read_csv(spark, path, files.RATINGS_SCHEMA)
    assert back.dtypes == [("user_id", "bigint"), ("book_id", "bigint"), ("rating", "int")]
    assert sorted(map(tuple, back.collect())) == [(1, 10, 5), (2, 11, 3)]


def test_csv_columns_follow_the_header(spark, tmp_path):
    (tmp_path / "r.csv").write_text("book_id,extra,rating,user_id\n10,x,5,1\n11,y,3,2\n")
    back = files.read_csv(spark, str(tmp_path / "r.csv"), files.RATINGS_SCHEMA)
    assert back.columns == ["user_id", "book_id", "rating"]
    assert sorted(map(tuple, back.collect())) == [(1, 10, 5), (2, 11, 3)]


def test_csv_without_a_declared_column_or_value_fails(spark, tmp_path):
    (tmp_path / "r.csv").write_text("book_id,user_id\n10,1\n")
    with pytest.raises(ValueError, match="rating"):
        files.read_csv(spark, str(tmp_path / "r.csv"), files.RATINGS_SCHEMA)
    for row in ("10,,1", "10,five,1"):
        (tmp_path / "v.csv").write_text(f"book_id,rating,user_id\n{row}\n")
        with pytest.raises(PySparkException):
            files.read_csv(spark, str(tmp_path / "v.csv"), files.RATINGS_SCHEMA).collect()


RECORDS = [{"goodreads_book_id": "167697", "tag_id": "30574", "count": 11}, {"goodreads_book_id": "1", "tag_id": "2", "count": 3}]


@pytest.mark.parametrize("text, multi", [
    (json.dumps(RECORDS), False), (json.dumps(RECORDS, indent=1), True), ("\n".join(map(json.dumps, RECORDS)), False)])
def test_json_records_with_string_ids(spark, tmp_path, text, multi):
    p = tmp_path / "tags.json"
    p.write_text(text)
    df = files.read_json_records(spark, str(p), multi_line=multi)
    assert dict(df.dtypes) == {"goodreads_book_id": "bigint", "tag_id": "bigint", "cnt": "bigint"}
    assert sorted(map(tuple, df.collect())) == [(1, 2, 3), (167697, 30574, 11)]


def test_json_record_without_a_field_fails(spark, tmp_path):
    p = tmp_path / "tags.json"
    p.write_text(json.dumps([{"goodreads_book_id": "1", "tag_id": "2", "cnt": 3}]))
    with pytest.raises(PySparkException, match="count"):
        files.read_json_records(spark, str(p)).collect()


def test_json_arrays_round_trip_in_chunks(spark, tmp_path):
    rows = [(str(i), str(i % 7), i) for i in range(2500)]
    df = spark.createDataFrame(rows, "goodreads_book_id string, tag_id string, count long")
    path = files.write_json_arrays(df, str(tmp_path / "out"), rows_per_array=100)
    assert 20 <= spark.read.text(path).count() <= 25
    assert sorted(map(tuple, files.read_json_records(spark, path).collect())) == [(i, i % 7, i) for i in range(2500)]


def test_strict_cast_raises_and_lenient_gives_null(spark):
    df = spark.createDataFrame([("12",), ("x1",)], "v string")
    assert [r["v"] for r in cast_ids(df, ["v"], lenient=True).collect()] == [12, None]
    with pytest.raises(PySparkException):
        cast_ids(df, ["v"]).collect()


@pytest.fixture(scope="module")
def derby(spark):
    url = "jdbc:derby:memory:shelfwise_books;create=true"
    books = spark.range(1, 101).select(F.col("id").alias("ID"), (F.col("id") * 7 + 3).alias("BOOK_ID"),
                                       F.concat(F.lit("title "), F.col("id").cast("string")).alias("TITLE"))
    books.write.mode("overwrite").jdbc(url, "BOOKS", properties=DERBY_PROPS)
    return url


def test_jdbc_whole_table_in_parallel_ranges(spark, derby):
    lo, hi = jdbc.bounds(spark, derby, "BOOKS", "ID", DERBY_PROPS)
    df = jdbc.read_table(spark, derby, "BOOKS", "ID", lo, hi, 4, DERBY_PROPS)
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 100 and df.agg(F.sum("ID")).first()[0] == 5050


def test_jdbc_filter_is_pushed_down(spark, derby):
    df = jdbc.read_filtered(spark, derby, "BOOKS", F.col("ID") == 1, DERBY_PROPS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(ID), *EqualTo(ID,1)]" in plan or "EqualTo(ID,1)" in plan
    assert [tuple(r) for r in df.collect()] == [(1, 10, "title 1")]


def test_dealt_ratings_equal_the_planned_ones(spark, tmp_path, monkeypatch):
    from shelfwise.operators import aggregates as agg
    from shelfwise.plans.catalog import clean_ratings
    from shelfwise.sources import fixtures

    orders = [(i, i % 7) for i in range(40)] + [(3, 5), (None, 1), (41, None)]
    lines = [(i % 42, i % 9, float(i % 50 + 1)) for i in range(400)] + [(None, 1, 1.0), (2, None, 4.0)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")

    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)

    plain = fixtures.tables(spark, str(tmp_path))
    want, clean_want = rows(plain.ratings()), rows(clean_ratings(plain))
    counts = rows(plain.ratings().groupBy("user_id").count())
    assert rows(plain.ratings_per_user()) == counts
    assert rows(plain.ratings_of(F.lit(6).cast("long"))) == [r for r in want if r[0] == 6]
    monkeypatch.setattr(fixtures, "LARGE_ROWS", 10)
    monkeypatch.setattr(fixtures, "TASK_ROWS", 25)
    dealt = fixtures.tables(spark, str(tmp_path))
    assert rows(dealt.ratings()) == want and rows(clean_ratings(dealt)) == clean_want
    # tasks follow the rows, not the planner's number of partitions, and the second count of the keys moves no rows
    assert clean_ratings(dealt).rdd.getNumPartitions() == 17
    check = agg.duplicate_check(clean_ratings(dealt))
    assert check.first()[0] == 0
    assert check._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(user_id") == 1
