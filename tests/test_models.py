"""kNN, regression, PCA, SVD and k-means against NumPy brute force / closed forms on small fixtures."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from shelfwise.operators import cluster as clu
from shelfwise.operators import decompose as dec
from shelfwise.operators import neighbors as nbrs
from shelfwise.operators import products
from shelfwise.operators import regression as reg


def _frame(spark, ids, x, name):
    return spark.createDataFrame([(int(i), [float(v) for v in row]) for i, row in zip(ids, x)], f"{name} long, vec array<double>")


def _brute_knn(q, t, t_ids, k):
    out = {}
    for i, row in enumerate(q):
        d2 = ((t - row) ** 2).sum(axis=1)
        order = np.lexsort((t_ids, d2))[:k]
        out[i] = [(int(t_ids[j]), float(np.sqrt(d2[j]))) for j in order]
    return out


@pytest.mark.parametrize("rows", [1000, 7])
def test_knn_neighbors_match_brute_force_with_ties(spark, rows):
    rng = np.random.default_rng(0)
    t = (rng.random((60, 6)) < 0.4).astype(float)  # 0/1 data: many equal distances
    q = (rng.random((25, 6)) < 0.4).astype(float)
    t_ids = np.arange(100, 160)
    nb = nbrs.knn_neighbors(_frame(spark, range(25), q, "qid"), _frame(spark, t_ids, t, "tid"), 3, query_rows=rows, train_rows=rows)
    got = {}
    for r in nb.orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append((r["tid"], r["dist"]))
    expect = _brute_knn(q, t, t_ids, 3)
    for i in range(25):
        assert [a for a, _ in got[i]] == [a for a, _ in expect[i]]
        assert np.allclose([b for _, b in got[i]], [b for _, b in expect[i]])


def test_vote_rules(spark):
    nb = spark.createDataFrame([(1, 10, 1.0, 1), (1, 11, 2.0, 2), (2, 12, 0.0, 1), (2, 13, 0.0, 2), (2, 14, 0.5, 3),
                                (3, 15, 1.0, 1), (3, 16, 1.0, 2)], "qid long, tid long, dist double, rank int")
    labels = spark.createDataFrame([(10, 0), (11, 1), (12, 1), (13, 0), (14, 1), (15, 1), (16, 0)], "tid long, label int")
    dist = {r["qid"]: r["pred"] for r in nbrs.vote(nb, labels, weights="distance").collect()}
    # q1: 1/1 for class 0 beats 1/2 for class 1; q2: only zero-distance neighbours vote, tie -> 0; q3: tie -> 0
    assert dist == {1: 0, 2: 0, 3: 0}
    uni = {r["qid"]: r["pred"] for r in nbrs.vote(nb, labels, weights="uniform").collect()}
    assert uni == {1: 0, 2: 1, 3: 0}


def _design(spark, seed=1, n_books=40, p=5):
    rng = np.random.default_rng(seed)
    x = (rng.random((n_books, p)) < 0.5).astype(float)
    x[:, 0] = 1 - x[:, 1]  # keep a non-trivial correlation but full rank with intercept? add noise column
    x[:, 0] = (rng.random(n_books) < 0.5)
    rows = []
    for b in range(n_books):
        for _ in range(int(rng.integers(1, 6))):
            rows.append((b + 1, int(rng.integers(1, 6))))
    ratings = spark.createDataFrame(rows, "book_id long, rating int")
    vecs = _frame(spark, range(1, n_books + 1), x, "book_id")
    y = np.array([r for _, r in rows], float)
    X = np.array([x[b - 1] for b, _ in rows])
    return ratings, vecs, X, y


def test_ols_on_book_means_equals_raw_least_squares(spark):
    ratings, vecs, X, y = _design(spark)
    design = reg.book_design(ratings, vecs)
    model = reg.ols_fit(design)
    A = np.column_stack([np.ones(len(y)), X])
    beta = np.linalg.lstsq(A, y, rcond=None)[0]
    assert np.allclose([model.intercept] + list(model.coefficients), beta, atol=1e-8)
    g = {r["term"]: r["grad"] for r in reg.gradient_table(design, model, range(1, 6)).collect()}
    assert all(abs(v) < 1e-8 for v in g.values())
    r2 = reg.r_squared_raw(design, model).first()["r2"]
    resid = y - A @ beta
    assert math.isclose(r2, 1 - resid @ resid / ((y - y.mean()) @ (y - y.mean())), rel_tol=1e-9)


def _tag_set(vecs):
    """(book_id, tag_id) of the ones of the vectors, tags numbered from 1."""
    return vecs.select("book_id", F.posexplode("vec").alias("i", "x")).where("x <> 0").select(
        "book_id", (F.col("i") + 1).cast("long").alias("tag_id"))


def test_ols_inference_matches_closed_form(spark):
    ratings, vecs, X, y = _design(spark, seed=2)
    books = vecs.select("book_id")
    table = {r["term"]: r for r in reg.ols_inference(ratings, _tag_set(vecs), range(1, 6), books=books).collect()}
    A = np.column_stack([np.ones(len(y)), X])
    beta = np.linalg.lstsq(A, y, rcond=None)[0]
    resid = y - A @ beta
    sigma2 = resid @ resid / (len(y) - A.shape[1])
    se = np.sqrt(np.diag(sigma2 * np.linalg.inv(A.T @ A)))
    for term in range(6):
        assert math.isclose(table[term]["coef"], beta[term], abs_tol=1e-8)
        assert math.isclose(table[term]["std_err"], se[term], rel_tol=1e-6)
        assert 0 <= table[term]["p_value"] <= 1 and math.isclose(table[term]["t_value"], beta[term] / se[term], rel_tol=1e-6)


def test_singular_design_has_no_inference_and_p_values_are_student(spark):
    s = {"G": np.array([[4.0, 2.0, 2.0], [2.0, 2.0, 2.0], [2.0, 2.0, 2.0]]), "c": np.array([6.0, 4.0, 4.0]), "yy": 12.0, "n": 4.0}
    rows = reg.inference_from_stats(spark, s)
    assert all(r[1:] == (None, None, None) for r in rows)
    assert np.allclose(s["G"] @ [r[0] for r in rows], s["c"])
    # two-sided 5 % points of t with 10 and 30 degrees of freedom
    assert abs(reg.student_p_values(spark, [2.228139], 10)[0] - 0.05) < 1e-6
    assert abs(reg.student_p_values(spark, [-2.042272], 30)[0] - 0.05) < 1e-6


def test_lasso_path_equals_cold_starts():
    rng = np.random.default_rng(11)
    x = (rng.random((400, 12)) < 0.3).astype(float)
    x[:, 7] = 0.0  # a term that no row has
    y = x @ rng.normal(size=12) + rng.normal(size=400)
    a = np.column_stack([np.ones(400), x])
    s = {"G": a.T @ a, "c": a.T @ y, "yy": float(y @ y), "n": 400.0}
    alphas = [10 ** (-4 + i / 4) for i in range(16)]
    path = reg.lasso_path(s, alphas)
    for alpha in alphas:
        cold = reg.lasso_gram(s["G"], s["c"], 400.0, alpha)
        assert np.abs(path[alpha] - cold).max() < 1e-8
        assert reg.kkt_ok(path[alpha], s, alpha, 1e-8).all()
    assert [int((path[a][1:] != 0).sum()) for a in (alphas[0], alphas[-1])][0] > 5


def test_fold_statistics_equal_numpy(spark):
    rng = np.random.default_rng(3)
    tags = sorted({(int(b), int(t)) for b, t in zip(rng.integers(1, 30, 90), rng.choice([3, 5, 8, 99], 90))})
    rows = [(int(u), int(rng.integers(1, 35)), int(rng.integers(1, 6)), int(rng.integers(0, 3))) for u in range(300)]
    df = spark.createDataFrame(rows, "user_id long, book_id long, rating int, fold int")
    tag = spark.createDataFrame(tags + tags[:5], "book_id long, tag_id long")
    for books in (None, spark.createDataFrame([(b,) for b in range(1, 33)], "book_id long")):
        got = reg.fold_statistics(df, tag, [3, 5, 8], books=books)
        member = {b for b, t in tags if t in (3, 5, 8)} if books is None else set(range(1, 33))
        for f in range(3):
            x = np.array([[1.0] + [float((b, t) in set(tags)) for t in (3, 5, 8)] for _, b, _, g in rows if g == f and b in member])
            y = np.array([float(r) for _, b, r, g in rows if g == f and b in member])
            assert np.array_equal(got[f]["G"], x.T @ x) and np.array_equal(got[f]["c"], x.T @ y)
            assert (got[f]["yy"], got[f]["n"]) == (y @ y, len(y))


def test_lasso_raises_when_it_does_not_converge():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, 4)) + rng.normal(size=(30, 1)) * 5
    a = np.column_stack([np.ones(30), x])
    y = rng.normal(size=30)
    with pytest.raises(RuntimeError, match="not converged"):
        reg.lasso_gram(a.T @ a, a.T @ y, 30.0, 1e-4, max_iter=2)
    beta = reg.lasso_gram(a.T @ a, a.T @ y, 30.0, 0.05)
    stats = {"G": a.T @ a, "c": a.T @ y, "yy": y @ y, "n": 30.0}
    assert reg.kkt_ok(beta, stats, 0.05, 1e-8).all() and not reg.kkt_ok(beta + 0.1, stats, 0.05, 1e-8).all()
    assert reg.best_alpha([(0.1, 0.5, 0, 0), (0.2, 0.6, 0, 0), (0.3, 0.6, 0, 0)]) == 0.3


def test_lasso_spark_and_gram_solver_agree_and_satisfy_kkt(spark):
    ratings, vecs, X, y = _design(spark, seed=3)
    alpha = 0.02
    design = reg.book_design(ratings, vecs)
    model = reg.lasso_fit(design, alpha)
    kkt = reg.kkt_table(design, model, range(1, 6), alpha, 1e-6).collect()
    assert all(r["kkt_ok"] for r in kkt)
    A = np.column_stack([np.ones(len(y)), X])
    beta = reg.lasso_gram(A.T @ A, A.T @ y, float(len(y)), alpha)
    assert np.allclose([model.intercept] + list(model.coefficients), beta, atol=1e-5)


def test_fold_statistics_equal_direct_sums(spark):
    rows = [(1, 1, 5, 0), (1, 2, 3, 1), (2, 1, 4, 1), (2, 3, 2, 0)]
    rf = spark.createDataFrame(rows, "user_id long, book_id long, rating int, fold int")
    tags = spark.createDataFrame([(1, 7), (2, 7), (2, 8), (3, 8)], "book_id long, tag_id long")
    st = reg.fold_statistics(rf, tags, [7, 8])
    x = {1: [1, 1, 0], 2: [1, 1, 1], 3: [1, 0, 1]}
    for f in (0, 1):
        sel = [r for r in rows if r[3] == f]
        A = np.array([x[b] for _, b, _, _ in sel], float)
        yv = np.array([r for _, _, r, _ in sel], float)
        assert np.allclose(st[f]["G"], A.T @ A) and np.allclose(st[f]["c"], A.T @ yv)
        assert st[f]["yy"] == yv @ yv and st[f]["n"] == len(sel)


def test_pca_ratios_and_centred_scores(spark):
    rng = np.random.default_rng(4)
    x = (rng.random((50, 6)) < 0.4).astype(float)
    vecs = _frame(spark, range(1, 51), x, "book_id")
    fit = dec.PcaFit(vecs, 6)
    ev = np.sort(np.linalg.eigvalsh(np.cov(x, rowvar=False)))[::-1]
    assert np.allclose(fit.ratios, ev / ev.sum(), atol=1e-9)
    scores = np.array([r["vec"] for r in fit.scores(vecs, 3).orderBy("book_id").collect()])
    c = np.cov(scores, rowvar=False)
    assert np.allclose(c - np.diag(np.diag(c)), 0, atol=1e-9)
    assert np.allclose(np.diag(c), ev[:3], atol=1e-9)


def _entries(spark, a):
    i, j = np.nonzero(a)
    return spark.createDataFrame([(int(x) + 1, int(y) + 1, float(a[x, y])) for x, y in zip(i, j)], "row long, col long, value double")


def _factor(df, key, n, k):
    out = np.zeros((n, k))
    for r in df.collect():
        out[r[key] - 1] = r["vec"]
    return out


@pytest.mark.parametrize("case", ["gapless", "low_rank", "small"])
def test_svd_equals_numpy(spark, case):
    """Without a spectral gap, with fewer triplets than asked for, and with fewer columns than a block."""
    rng = np.random.default_rng(5)
    if case == "gapless":
        a, k = (rng.random((120, 90)) < 0.08).astype(float), 6
    elif case == "low_rank":
        a, k = rng.normal(size=(60, 3)) @ rng.normal(size=(3, 40)), 5
    else:
        a, k = rng.normal(size=(9, 6)), 6
    entries = _entries(spark, a)
    svd = dec.svd_krylov(entries, k, block=8, basis=32, tol=1e-7)
    exact = np.linalg.svd(a, compute_uv=False)
    rank = min(k, int((exact > 1e-9 * exact[0]).sum()))
    assert len(svd.s) == rank and np.allclose(svd.s, exact[:rank], rtol=1e-9)
    u, v = _factor(svd.u, "row", len(a), rank), _factor(svd.v, "col", a.shape[1], rank)
    assert np.allclose(a @ v, u * svd.s, atol=1e-8) and np.allclose(a.T @ u, v * svd.s, atol=1e-6)
    assert np.allclose(u.T @ u, np.eye(rank), atol=1e-9) and np.allclose(v.T @ v, np.eye(rank), atol=1e-9)
    assert (v[np.abs(v).argmax(axis=0), np.arange(rank)] > 0).all()
    for r in dec.svd_certificate(entries, svd).collect():
        assert max(r["res_left"], r["res_right"], r["ortho_u"], r["ortho_v"]) < 1e-6


def test_svd_says_when_it_does_not_converge(spark):
    a = (np.random.default_rng(1).random((80, 70)) < 0.1).astype(float)
    with pytest.raises(RuntimeError, match="not converged"):
        dec.svd_krylov(_entries(spark, a), 6, block=6, basis=20, max_products=2)


def test_latent_neighbour_equals_numpy(spark):
    from conftest import SF_SMALL

    from shelfwise.plans import catalog
    from shelfwise.sources.fixtures import tables

    t = tables(spark, SF_SMALL)
    fl = catalog.flagged(t).collect()
    n_u, n_b = max(r["user_id"] for r in fl), max(r["book_id"] for r in fl)
    a = np.zeros((n_u, n_b))
    for r in fl:
        a[r["user_id"] - 1, r["book_id"] - 1] = r["good"]
    u = np.linalg.svd(a, full_matrices=False)[0][:, : catalog.SVD_K]
    raw = {}
    for r in t.ratings().collect():
        raw[r["user_id"]] = raw.get(r["user_id"], 0) + 1
    me = min(x for x, n in raw.items() if n > 50)
    d = np.linalg.norm(u - u[me - 1], axis=1)
    want = [int(i) + 1 for i in np.argsort(d, kind="stable") if i != me - 1][:5]
    got = catalog.latent_nearest_user_of(t).collect()
    assert [r["user_id"] for r in got] == want
    assert np.allclose([r["dist"] for r in got], d[np.array(want) - 1], atol=1e-6)
    mine = {r["book_id"]: r["rating"] for r in fl if r["user_id"] == me}
    theirs = {r["book_id"]: r["rating"] for r in fl if r["user_id"] == want[0]}
    both = [(mine[b] - theirs[b]) ** 2 for b in mine.keys() & theirs.keys()]
    rmse = catalog.svd_user_rmse(spark, SF_SMALL).first()
    assert rmse["n_both"] == len(both) and (not both or math.isclose(rmse["rmse"], math.sqrt(sum(both) / len(both))))
    recs = {r["book_id"] for r in catalog.svd_recommend(spark, SF_SMALL).collect()}
    assert recs == {b for b, r in theirs.items() if r == 5 and b not in mine}


def test_als_takes_ids_beyond_32_bits(spark):
    rng = np.random.default_rng(2)
    rows = [(3_000_000_000 + i, 5_000_000_000 + j, int(rng.integers(1, 6))) for i in range(30) for j in range(20)]
    df = spark.createDataFrame(rows, "user_id long, book_id long, rating int")
    pred = dec.AlsFit(df, rank=4, max_iter=5).predict(df)
    assert pred.count() == 600 and set(pred.columns) == {"user_id", "book_id", "rating", "prediction"}
    err = math.sqrt(pred.selectExpr("avg(power(prediction - rating, 2)) as e").first()["e"])
    assert err < np.std([r[2] for r in rows])


def test_als_numbers_the_ratings_once(spark, monkeypatch):
    from conftest import SF_SMALL

    from shelfwise.plans import catalog

    calls, numbered = [], dec.AlsFit._numbered
    monkeypatch.setattr(dec.AlsFit, "_numbered", lambda self, df: calls.append(1) or numbered(self, df))
    got = catalog.factorize_ratings(spark, SF_SMALL).first()
    assert len(calls) == 1 and 0 < got["rmse_als"] < got["rmse_mean"]
    rows = [(i, j, i % 3 + j % 2 + 1) for i in range(12) for j in range(9) if (i + j) % 4] + [(None, 1, 5), (1, None, 5)]
    df = spark.createDataFrame(rows, "user_id long, book_id long, rating int")
    fit = dec.AlsFit(df, rank=2, max_iter=3)
    want = sorted((r["rating"], r["prediction"]) for r in fit.predict(df).collect())
    assert sorted(tuple(r) for r in fit.predict_fitted().collect()) == want and len(want) == len(rows) - 2


def test_als_last_half_step_solves_the_normal_equations(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), int(j), int(rng.integers(1, 6))) for i in range(25) for j in range(15) if rng.random() < 0.6]
    df = spark.createDataFrame(rows, "user_id long, book_id long, rating int")
    fit = dec.AlsFit(df, rank=3, max_iter=4, reg=0.2)
    x = {r["user_id"]: np.array(r["vec"]) for r in fit.user_factors().collect()}
    v = {r["book_id"]: np.array(r["vec"]) for r in fit.item_factors().collect()}
    got = {r["user_id"]: r["gradient"] for r in fit.user_gradients(df).collect()}
    assert got.keys() == x.keys() and max(got.values()) < 1e-5
    for user in x:
        mine = [(b, r) for u, b, r in rows if u == user]
        a = np.array([v[b] for b, _ in mine])
        want = np.linalg.solve(a.T @ a + 0.2 * len(mine) * np.eye(3), a.T @ [r for _, r in mine])
        assert np.allclose(x[user], want, atol=1e-4)
    worse = df.withColumn("rating", F.col("rating") + 1)  # other ratings do not fit the factors
    assert fit.user_gradients(worse).agg(F.max("gradient")).first()[0] > 1e-2


@pytest.mark.parametrize("cells", [(2048, 2048), (7, 5)])
def test_top_products_equal_brute_force(spark, cells):
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(40, 4)), 2)
    x[3] = 0  # every score ties
    v = np.round(rng.normal(size=(120, 4)) * (0.05 + (np.arange(120) % 10 == 0) * 3.0)[:, None], 2)
    v[50] = v[40]
    ids = np.arange(1000, 1120)
    seen = [(i, int(j)) for i in range(40) for j in rng.choice(ids, 6, replace=False)] + [(39, int(j)) for j in ids[:117]]
    seen = sorted(set(seen))
    out = products.top_products(_frame(spark, range(40), x, "user_id"), _frame(spark, ids, v, "book_id"), 5,
                                spark.createDataFrame(seen, "user_id long, book_id long"), *cells)
    got = {}
    for r in out.rows.orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append((r["book_id"], r["score"]))
    for i in range(40):
        score = np.round(v @ x[i], 9)
        free = [k for k in range(120) if (i, int(ids[k])) not in set(seen)]
        want = sorted(free, key=lambda k: (-score[k], ids[k]))[:5]
        assert [b for b, _ in got[i]] == [int(ids[k]) for k in want]
        assert np.allclose([s for _, s in got[i]], score[want])
    assert len(got[39]) <= 5 and out.formed < 0.7 * out.total  # few users go on to the small norms


def test_block_top_equals_brute_force_and_skips_leaves(monkeypatch):
    rng, shapes = np.random.default_rng(1), []
    for m, k in [(1, 1), (3, 40), (40, 300), (30, 700)]:
        u, v = np.round(rng.normal(size=(m, 3)), 1), np.round(rng.normal(size=(k, 3)), 1)
        u[0] = 0  # every score ties
        ids, seen = rng.permutation(k) + 1000, np.unique(rng.integers(0, m * k, size=m * k // 5))
        last = np.where(rng.random(m) < 0.5, -np.inf, np.round(rng.normal(size=m), 1))
        last_id = rng.integers(1000, 1000 + k, size=m)
        score, want = np.round(u @ v.T, 9), []
        for i in range(m):
            free = [(-score[i, j], ids[j]) for j in range(k) if i * k + j not in seen
                    and (score[i, j] > last[i] or (score[i, j] == last[i] and ids[j] < last_id[i]))]
            want += [(i, b) for _, b in sorted(free)[:5]]
        user, item, got = products.block_top(u, v, ids, 5, last, last_id, seen)
        assert sorted(zip(user, -got, ids[item])) == sorted((i, -score[i, list(ids).index(b)], b) for i, b in want)
    # near vectors share leaves: most products are not worked out
    v = np.repeat(rng.normal(size=(40, 6)), 128, axis=0) + rng.normal(size=(5120, 6)) * 0.01
    einsum = np.einsum
    monkeypatch.setattr(np, "einsum", lambda *a: shapes.append(a[1].shape[0]) or einsum(*a))
    products.block_top(rng.normal(size=(50, 6)), v, np.arange(5120), 5, np.full(50, -np.inf), np.zeros(50, int), np.zeros(0, int))
    assert sum(shapes) < 0.2 * 50 * 5120


def test_top_products_of_empty_tables(spark):
    users, items = _frame(spark, range(2), np.ones((2, 2)), "user_id"), _frame(spark, [7], np.ones((1, 2)), "book_id")
    assert products.top_products(users.limit(0), items, 3).rows.count() == 0
    assert products.top_products(users, items.limit(0), 3).rows.count() == 0
    assert [tuple(r) for r in products.top_products(users, items, 3).rows.orderBy("user_id").collect()] == [(0, 1, 7, 2.0), (1, 1, 7, 2.0)]


def _likes(spark, pairs):
    return spark.createDataFrame(pairs, "user_id long, book_id long")


def test_kmeans_assignment_and_total_ss(spark):
    pairs = [(1, 1), (1, 2), (2, 2), (3, 3), (4, 1), (4, 3)]
    good, users = _likes(spark, pairs), spark.range(1, 6).select(F.col("id").alias("user_id"))
    best = clu.assign(good, users, clu.first_users_as_centers(good, [2]))
    x = np.zeros((5, 3))
    for u, b in pairs:
        x[u - 1, b - 1] = 1
    lab = ((x[:, None, :] - x[None, :2, :]) ** 2).sum(axis=2).argmin(axis=1) + 1
    assert {r["user_id"]: r["cluster"] for r in best.collect()} == {i + 1: int(lab[i]) for i in range(5)}
    assert math.isclose(clu.total_ss_binary(good, 5).first()["inertia"], ((x - x.mean(axis=0)) ** 2).sum())


def test_kmeans_equals_numpy_lloyd_for_several_k_at_once(spark):
    rng = np.random.default_rng(4)
    x = (rng.random((40, 12)) < np.where(np.arange(40)[:, None] % 2, 0.6, 0.15)).astype(float)
    x[7] = 0  # a user without a good book
    good = _likes(spark, [(int(u) + 1, int(b) + 1) for u, b in zip(*np.nonzero(x))])
    users = spark.range(1, 41).select(F.col("id").alias("user_id"))
    assigned, centers = clu.kmeans(good, users, [1, 2, 4])
    got = {}
    for r in assigned.collect():
        got.setdefault(r["k"], {})[r["user_id"]] = r["cluster"]
    cost = {r["k"]: r["inertia"] for r in clu.inertia(assigned).collect()}
    firsts = [i for i in range(40) if x[i].any()]
    for k in (1, 2, 4):
        c, lab = x[firsts[:k]].copy(), None
        while True:
            d = np.round(((x[:, None, :] - c[None]) ** 2).sum(axis=2), 9)
            new = d.argmin(axis=1)
            if lab is not None and (new == lab).all():
                break
            lab = new
            c = np.stack([x[lab == j].mean(axis=0) if (lab == j).any() else np.full(12, np.inf) for j in range(k)])
        assert got[k] == {i + 1: int(lab[i]) + 1 for i in range(40)}
        assert math.isclose(cost[k], ((x - c[lab]) ** 2).sum(), abs_tol=1e-6)
    check = clu.certificate(good, users, assigned, centers).first()
    assert check["n_users"] == check["n_nearest"] == 120 and check["max_center_error"] < 1e-12


def test_svd_keeps_one_product_beside_its_basis(spark, monkeypatch):
    """The written table holds V and the newest product, not a second table as wide as V; its forerunners are gone."""
    rng = np.random.default_rng(3)
    a = (rng.random((90, 80)) < 0.2).astype(float)
    sizes, gram = [], dec._gram
    monkeypatch.setattr(dec, "_gram", lambda df, names, **kw: (sizes.append(g := gram(df, names, **kw)), g)[1])
    svd = dec.svd_krylov(_entries(spark, a), 4, block=5, basis=25, tol=1e-7)
    assert np.allclose(svd.s, np.linalg.svd(a, compute_uv=False)[:4], rtol=1e-9)
    assert svd.products > 5 and max(len(g) for g in sizes) <= 25 + 2 * 5


def test_svd_basis_gets_narrower_on_long_matrices(spark, monkeypatch):
    monkeypatch.setattr(dec, "BASIS_NUMBERS", 1000, raising=False)
    a = (np.random.default_rng(4).random((70, 60)) < 0.2).astype(float)
    sizes, gram = [], dec._gram
    monkeypatch.setattr(dec, "_gram", lambda df, names, **kw: (sizes.append(g := gram(df, names, **kw)), g)[1])
    svd = dec.svd_krylov(_entries(spark, a), 3, tol=1e-7)
    assert np.allclose(svd.s, np.linalg.svd(a, compute_uv=False)[:3], rtol=1e-9)
    assert max(len(g) for g in sizes) <= 18 + 2 * 3


def test_gradient_rows_move_once_by_user(spark):
    """The join with the user factors and the sums per user share one exchange of the rows."""
    rows = [(u, b, (u * 7 + b * 3) % 5 + 1) for u in range(12) for b in range(9) if (u + b) % 3]
    ratings = spark.createDataFrame(rows, "user_id long, book_id long, rating int")
    fit, was = dec.AlsFit(ratings, rank=3, max_iter=3), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = fit.user_gradients(ratings)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert plan.count("Exchange hashpartitioning(user_id") == 2  # the rows and the factors
    assert len(got) == 12 and max(r["gradient"] for r in got) < 1e-5


def test_topk_abs_per_group_keeps_pairs_that_never_co_occur(spark, tmp_path):
    """Two frequent tags without a common book have the largest |covariance|."""
    from shelfwise.operators import topk
    from shelfwise.plans import catalog

    x = np.zeros((12, 4))
    x[:6, 0] = x[6:, 1] = x[0, 2] = x[6, 3] = 1
    tags = spark.createDataFrame([(int(b), int(t)) for b, t in zip(*np.nonzero(x))], "book_id long, tag_id long")
    cov, exact = dec.covariance_long(tags, all_pairs=True), np.cov(x, rowvar=False)
    got = {(r["ti"], r["tj"]): r["cov"] for r in cov.collect()}
    assert got.keys() == {(i, j) for i in range(4) for j in range(4)}
    assert all(math.isclose(v, exact[k], abs_tol=1e-12) for k, v in got.items())
    top = topk.topk_abs_per_group(cov.where("ti <> tj"), "ti", "cov", "tj", 1).collect()
    assert {r["ti"]: r["tj"] for r in top}[0] == 1
    # the query, on rows of its own: red and blue are never the words of one book
    rows = [(k, ("red" if k < 6 else "blue") + f" w{k % 3}", "B", "T", 1) for k in range(12)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    got = catalog.topk_abs_per_group(spark, str(tmp_path)).collect()
    first = [(r["ti"], r["tj"]) for r in got if r["rank"] == 1 and math.isclose(r["cov"], -36 / 132, abs_tol=1e-6)]
    assert len(first) == 2 and first[0] == first[1][::-1] and len(got) == 8 * 5


def test_svd_sends_blocks_of_vectors_instead_of_a_row_per_entry(spark, monkeypatch):
    """Many blocks and cells, values of all kinds, repeated entries, null keys: the products and the triplets equal NumPy's."""
    monkeypatch.setattr(dec, "BLOCK_COLS", 7, raising=False)
    monkeypatch.setattr(dec, "CELL_ENTRIES", 150, raising=False)
    rng = np.random.default_rng(8)
    a = np.round(rng.normal(size=(50, 40)), 2) * (rng.random((50, 40)) < 0.3)
    entries = _entries(spark, a)
    twice = spark.createDataFrame([(3, 5, 0.5), (3, 5, 0.25), (None, 4, 9.0), (2, None, 9.0)], "row long, col long, value double")
    a[2, 4] += 0.75
    calls, multiply = [], dec._multiply
    monkeypatch.setattr(dec, "_multiply", lambda *x: calls.append(1) or multiply(*x))
    svd = dec.svd_krylov(entries.unionByName(twice), 4, block=4, basis=24, tol=1e-7)
    assert len(calls) == 1 and svd.products > 1  # for U at the end, not for the products
    assert np.allclose(svd.s, np.linalg.svd(a, compute_uv=False)[:4], rtol=1e-9)
    v = _factor(svd.v, "col", 40, 4)
    assert np.allclose(a.T @ (a @ v), v * svd.s**2, atol=1e-5) and np.allclose(v.T @ v, np.eye(4), atol=1e-9)
    # one product by hand
    cells = dec._Cells(entries)
    x = rng.normal(size=(40, 3))
    rows = cells.cols.join(spark.createDataFrame([(j + 1, x[j].tolist()) for j in range(40)], "col long, vec array<double>"), "col")
    got = _factor(cells.unstacked(cells.product(cells.stacked(rows))), "col", 40, 3)
    a[2, 4] -= 0.75
    assert cells.cells.count() > 1 and np.allclose(got, a.T @ (a @ x), atol=1e-9)


def test_kmeans_rounds_move_blocks_of_books_and_equal_the_single_steps(spark, monkeypatch):
    """Many blocks and cells, ratings without a book or a user, users without a rating or beyond the list, ks that end at different rounds."""
    monkeypatch.setattr(dec, "BLOCK_COLS", 5, raising=False)
    monkeypatch.setattr(clu, "CELL_ENTRIES", 40, raising=False)
    monkeypatch.setattr(dec, "FEW_ENTRIES", 40, raising=False)
    rng = np.random.default_rng(9)
    x = (rng.random((60, 23)) < np.where(np.arange(60)[:, None] % 3, 0.1, 0.5)).astype(float)
    x[11] = 0
    pairs = [(int(u) + 1, int(b) + 1) for u, b in zip(*np.nonzero(x))] + [(4, None), (9, None), (70, 2), (-3, 7)]
    users, ks = spark.range(1, 61).select(F.col("id").alias("user_id")), [1, 2, 3, 6]
    for good in (_likes(spark, pairs), _likes(spark, [*pairs, (None, 3)])):
        centers, last = clu.first_users_as_centers(good, ks), None
        while True:  # the rounds by the single steps
            now = clu.assign(good, users, centers).localCheckpoint()
            rows = sorted((r["k"], r["user_id"], r["cluster"], r["d2"]) for r in now.collect())
            if last is not None and [r[:3] for r in rows] == [r[:3] for r in last]:
                break
            made = clu.means(good, now)
            gone = now.select("k", "cluster").distinct().join(made, ["k", "cluster"], "left_anti")
            last, centers = rows, made.unionByName(gone.select("k", "cluster", F.lit(-1).cast("long").alias("book_id"), F.lit(0.0).alias("v"))).localCheckpoint()
        calls, assign = [], clu.assign
        with monkeypatch.context() as m:
            m.setattr(clu, "assign", lambda *a: calls.append(1) or assign(*a))
            assigned, found = clu.kmeans(good, users, ks)
        assert not calls
        assert np.allclose(sorted((r["k"], r["user_id"], r["cluster"], r["d2"]) for r in assigned.collect()), rows, atol=2e-9)
        key = lambda df: {(r["k"], r["cluster"], r["book_id"]): r["v"] for r in df.collect()}
        assert key(found) == pytest.approx(key(centers))


def test_als_blocks_grow_with_the_ratings_and_shuffles_are_removed(spark, monkeypatch):
    monkeypatch.setattr(dec, "ALS_RATINGS", 20, raising=False)
    made, als = [], dec.ALS
    monkeypatch.setattr(dec, "ALS", lambda **kw: made.append(als(**kw)) or made[-1])
    rows = [(u, b, (u * 7 + b * 3) % 5 + 1) for u in range(30) for b in range(12) if (u + b) % 3]
    df = spark.createDataFrame(rows, "user_id long, book_id long, rating int")
    fit = dec.AlsFit(df, rank=3, max_iter=5)
    assert made[0].getNumUserBlocks() == made[0].getNumItemBlocks() == len(rows) // 20 == 12
    assert made[0].getCheckpointInterval() == 2  # Spark removes the shuffles of the iterations before
    got = fit.user_gradients(df).collect()
    assert len(got) == 30 and max(r["gradient"] for r in got) < 1e-5
    monkeypatch.setattr(dec, "ALS_RATINGS", 1000)
    dec.AlsFit(df, rank=2, max_iter=1)
    assert made[1].getNumUserBlocks() == 10  # Spark's own number, and so the same start, on smaller tables
    # factors travel in the single precision they have
    plan = fit.user_gradients(df)._jdf.queryExecution().analyzed().toString()
    assert "cast(features" in plan and "as array<float>" in plan
