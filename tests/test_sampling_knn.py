import numpy as np
from pyspark.sql import functions as F

from shelfwise.operators import neighbors as nbrs
from shelfwise.operators import sampling
from shelfwise.operators.joins import CELL_ROWS


def test_hash_split_and_folds_do_not_depend_on_partitioning(spark):
    df = spark.range(1, 3001).withColumnRenamed("id", "k")
    a = {r["k"]: (r["is_test"], r["fold"]) for r in
         sampling.kfold_assign(sampling.hash_split(df, "k"), "k").collect()}
    b = {r["k"]: (r["is_test"], r["fold"]) for r in
         sampling.kfold_assign(sampling.hash_split(df.repartition(17), "k"), "k").collect()}
    assert a == b
    share = sum(v[0] for v in a.values()) / len(a)
    assert 0.15 < share < 0.25
    assert set(v[1] for v in a.values()) == {0, 1, 2, 3, 4}


def test_split_and_folds_are_independent(spark):
    df = spark.range(1, 20001).withColumnRenamed("id", "k")
    both = sampling.kfold_assign(sampling.hash_split(df, "k"), "k")
    n = {(r["is_test"], r["fold"]): r["count"] for r in both.groupBy("is_test", "fold").count().collect()}
    assert all(abs(n[False, f] - 3200) < 250 and abs(n[True, f] - 800) < 150 for f in range(5))
    other = sampling.hash_split(sampling.hash_split(df, "k", name="a"), "k", name="b", seed=99)
    assert abs(other.where("a and b").count() - 800) < 150


def test_seeded_user_pick(spark):
    per_user = spark.createDataFrame([(i, 51 + i % 3) for i in range(1, 60)] + [(100, 3)], "user_id long, ratings long")
    picks = {sampling.pick_user(per_user, 50, seed=s).first()["user_id"] for s in range(12)}
    assert len(picks) > 5 and 100 not in picks
    assert sampling.pick_user(per_user, 50, seed=3).first() == sampling.pick_user(per_user.repartition(9), 50, seed=3).first()


def test_prefix_accuracy_equals_refit_per_k(spark):
    rng = np.random.default_rng(7)
    t = rng.normal(size=(40, 3))
    q = rng.normal(size=(15, 3))
    tl = (t[:, 0] > 0).astype(int)
    ql = (q[:, 0] > 0).astype(int)
    train = spark.createDataFrame([(i, t[i].tolist(), int(tl[i])) for i in range(40)], "tid long, vec array<double>, label int")
    test = spark.createDataFrame([(i, q[i].tolist(), int(ql[i])) for i in range(15)], "qid long, vec array<double>, label int")
    nb = nbrs.knn_neighbors(test, train, 6)
    curve = {r["k"]: r["accuracy"] for r in nbrs.prefix_accuracy(nb, train, test, 6).collect()}
    for k in range(1, 7):
        nk = nbrs.knn_neighbors(test, train, k)
        pred = nbrs.vote(nk, train.select("tid", "label"), weights="uniform").join(test.select("qid", "label"), "qid")
        acc = pred.agg(F.avg((F.col("pred") == F.col("label")).cast("double"))).first()[0]
        assert abs(curve[k] - acc) < 1e-12


def test_class_weights_and_resampling(spark):
    df = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "k long, y int")
    w = {r["y"]: r["weight"] for r in sampling.class_weights(df, "y").collect()}
    assert abs(w[1] - 400 / (2 * 100)) < 1e-12 and abs(w[0] - 400 / (2 * 300)) < 1e-12
    over = {r["y"]: r["count"] for r in sampling.oversample(df, "y").groupBy("y").count().collect()}
    assert over == {0: 300, 1: 300}
    from shelfwise.functions.hashing import hash_u32

    under = {r["y"]: r["count"] for r in sampling.undersample(df, "y", hash_u32("k")).groupBy("y").count().collect()}
    assert under[1] == 100 and 60 < under[0] < 140
    mixed = {r["y"]: r["count"] for r in sampling.hybrid_sample(df, "y", hash_u32("k")).groupBy("y").count().collect()}
    assert mixed[1] == 200 and 160 < mixed[0] < 240


def test_hot_group_is_spread_over_salt_cells(spark):
    from shelfwise.operators import joins

    n = 3 * CELL_ROWS + 5
    df = spark.createDataFrame([(1, i) for i in range(n)] + [(2, 0), (2, 1)], "user_id long, book_id long")
    prev = {r["user_id"]: r["salt_buckets"] for r in joins.pair_cost_preview(df, "user_id", 5).collect()}
    assert prev == {1: 4, 2: 1}
    pairs = joins.gram_join(df, "user_id", "book_id")
    assert pairs.agg(F.sum("n")).first()[0] == n * (n - 1) + 2


def test_hash_equals_plain_integers(spark):
    from shelfwise.functions.hashing import KNUTH, U32, hash_pair_u32, hash_u32

    def plain(k, seed):
        a = (k + seed * 40503) % U32 * KNUTH % U32
        return (a + (a >> 16) * (2 * seed + 1)) % U32 * KNUTH % U32

    keys = [0, 1, -1, 7, U32 - 1, U32, U32 + 5, 2**31, 2**40 + 3, -(2**35) - 9]
    df = spark.createDataFrame([(k, 13 * k) for k in keys], "k long, j long")
    for seed in (0, 1, 9):
        got = df.select("k", "j", hash_u32("k", seed).alias("h"), hash_pair_u32("k", "j", seed).alias("p")).collect()
        assert all(r["h"] == plain(r["k"], seed) and r["p"] == plain(plain(r["k"], seed) + r["j"], seed) for r in got)


def test_class_sizes_reach_the_rows_without_a_shuffle_by_class(spark):
    """Dealt by class, all rows of a class would meet in one task."""
    df = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    plan = sampling._with_sizes(df.repartition(4, "k"), "y")._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan or "leftHint=(strategy=broadcast)" in plan
    assert sampling._with_sizes(df, "y").where(F.col("n_class") == 286).count() == 286


def test_unread_books_are_averaged_before_the_join(spark):
    from shelfwise.operators import topk

    rows = [(u, b, int((u + b) % 3 == 0)) for u in range(12) for b in range(u % 4, 15)]
    flagged = spark.createDataFrame(rows, "user_id long, book_id long, good int")
    out = topk.top_unread_books(flagged, flagged.where("user_id = 3"), 4)
    assert [r["book_id"] for r in out.collect()] == [0, 1, 2]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("Aggregate [book_id")  # the join meets one row a book
