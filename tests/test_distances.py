import math

import numpy as np
from pyspark.sql import functions as F

from shelfwise.functions import vectors as vec


# two books over 12 tags, given by the positions of their ones
LEFT, RIGHT, WIDTH = {0, 2, 3, 7, 8}, {2, 3, 4, 8, 9, 10, 11}, 12


def _multi_hot(on):
    return [1.0 if i in on else 0.0 for i in range(WIDTH)]


def test_dense_distances_follow_set_arithmetic(spark):
    df = spark.createDataFrame([(_multi_hot(LEFT), _multi_hot(RIGHT))], "a array<double>, b array<double>")
    r = df.select(vec.sq_euclidean("a", "b").alias("e2"), vec.euclidean_limit("a", "b").alias("lim"),
                  vec.cosine_distance("a", "b").alias("cos"), vec.hamming("a", "b").alias("ham"),
                  vec.manhattan("a", "b").alias("man"), vec.sq_norm("a").alias("norm2")).first()
    differ = len(LEFT ^ RIGHT)
    assert r["e2"] == r["ham"] == r["man"] == differ and r["norm2"] == len(LEFT)
    assert math.isclose(r["lim"] ** 2, len(LEFT) + len(RIGHT))
    assert math.isclose(r["cos"], 1 - len(LEFT & RIGHT) / math.sqrt(len(LEFT) * len(RIGHT)))


def test_long_form_distances_follow_set_arithmetic(spark):
    df = spark.createDataFrame([(len(LEFT), len(RIGHT), len(LEFT & RIGHT))], "n_a int, n_b int, n_ab int")
    r = df.select(vec.multihot_sq_euclidean("n_a", "n_b", "n_ab").alias("e2"),
                  vec.multihot_cosine_distance("n_a", "n_b", "n_ab").alias("cos")).first()
    assert r["e2"] == len(LEFT ^ RIGHT)
    assert math.isclose(r["cos"], 1 - len(LEFT & RIGHT) / math.sqrt(len(LEFT) * len(RIGHT)))


def test_cosine_of_zero_vector_is_null(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert df.select(vec.cosine_distance("a", "b").alias("c")).first()["c"] is None


def test_gower_zero_range_contributes_nothing(spark):
    df = spark.createDataFrame([([1.0, 5.0], [3.0, 5.0], [4.0, 0.0])], "a array<double>, b array<double>, r array<double>")
    assert math.isclose(df.select(vec.gower("a", "b", "r").alias("g")).first()["g"], 0.25)


def test_mean_overlap_equals_dense_product(spark):
    from shelfwise.operators.distances import mean_overlap

    rng = np.random.default_rng(3)
    a = (rng.random((30, 12)) < 0.3).astype(int)
    a[0] = 0
    a[0, 1] = 1
    rows = [(i + 1, j + 1) for i in range(30) for j in range(12) if a[i, j]]
    df = spark.createDataFrame(rows, "book_id long, tag_id long")
    got = {r["book_id"]: r["mean_overlap"] for r in mean_overlap(df).collect()}
    keep = a.sum(axis=1) > 0
    sub = a[keep]
    expect = (sub @ sub.T).mean(axis=1)
    ids = np.nonzero(keep)[0] + 1
    for i, e in zip(ids, expect):
        assert math.isclose(got[i], e)
    first = {r["book_id"]: r["mean_overlap"] for r in mean_overlap(df, first_n=7).collect()}
    few = sub[:7]
    assert sorted(first) == list(ids[:7])
    assert np.allclose([first[i] for i in ids[:7]], (few @ few.T).mean(axis=1))


def test_describe_quartiles_are_exact(spark):
    from shelfwise.operators.aggregates import describe_column

    rng = np.random.default_rng(3)
    for values in (np.arange(1, 1001.0), rng.normal(size=501), rng.integers(0, 4, 300).astype(float), np.array([7.0])):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(5)
        r = describe_column(df, ["x"]).first()
        assert r["count"] == len(values) and math.isclose(r["mean"], values.mean(), abs_tol=1e-12)
        assert np.allclose([r["min"], r["p25"], r["p50"], r["p75"], r["max"]], np.quantile(values, [0, 0.25, 0.5, 0.75, 1]))
        assert r["std"] is None if len(values) == 1 else math.isclose(r["std"], values.std(ddof=1))
    empty = describe_column(df.limit(0), ["x"]).first()
    assert empty["count"] == 0 and empty["p50"] is None


def test_describe_plan_merges_no_percentile_in_one_task(spark):
    from shelfwise.operators.aggregates import value_ranks

    df = spark.range(0, 10000, numPartitions=6).selectExpr("id % 977 as x")
    plan = value_ranks(df, "x")._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan
    last = value_ranks(df, "x").orderBy("v").collect()
    assert [r["v"] for r in last] == list(range(977)) and last[-1]["last"] == 10000
    assert all(b["last"] - a["last"] == b["n"] for a, b in zip(last, last[1:]))
