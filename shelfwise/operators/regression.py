"""Linear regression of ratings on book features: OLS, inference, LASSO and its cross-validation.

Features depend only on the book, so the raw rows are pre-aggregated per book (n, sum y,
sum y^2): a weighted fit on book means has the same coefficients as the raw fit (for OLS and
for LASSO with ``standardization=False``), while the data pass shrinks from ratings to books.
R^2, gradients and KKT checks are evaluated on the raw rows through the same sufficient statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import materialize

INTERCEPT = 0  # term id of the intercept in coefficient tables (tag ids start at 1)


def book_design(ratings: DataFrame, vectors: DataFrame, y: str = "rating") -> DataFrame:
    """Per book with features: (book_id, n, mean_y, sum_y, sum_y2, vec, features). Inner join:
    books without features leave the regression, as in the raw merge."""
    per_book = ratings.groupBy("book_id").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.avg(y).alias("mean_y"),
        F.sum(y).cast("double").alias("sum_y"),
        F.sum(F.col(y) * F.col(y)).cast("double").alias("sum_y2"),
    )
    return per_book.join(vectors, "book_id").withColumn("features", array_to_vector("vec"))


def ols_fit(design: DataFrame) -> LinearRegressionModel:
    lr = LinearRegression(featuresCol="features", labelCol="mean_y", weightCol="n", solver="normal",
                          regParam=0.0, fitIntercept=True)
    return lr.fit(design)


def lasso_fit(design: DataFrame, alpha: float) -> LinearRegressionModel:
    """min 1/(2n) SSE + alpha * L1 on the raw rows (weights n reproduce the raw objective)."""
    lr = LinearRegression(featuresCol="features", labelCol="mean_y", weightCol="n", solver="normal",
                          regParam=alpha, elasticNetParam=1.0, standardization=False, fitIntercept=True,
                          tol=1e-12, maxIter=1000)
    return lr.fit(design)


def coefficient_table(spark: SparkSession, model: LinearRegressionModel, terms: Sequence[int]) -> DataFrame:
    """(term, coef): one row per feature plus the intercept (term 0). Size = number of features."""
    rows = [(INTERCEPT, float(model.intercept))] + [(int(t), float(c)) for t, c in zip(terms, model.coefficients.toArray())]
    return spark.createDataFrame(rows, "term long, coef double")


def _residual_stats(design: DataFrame, model: LinearRegressionModel) -> DataFrame:
    """Per book: raw residual sum r_b = sum_y - n * pred_b, and SSR_b = sum (y - pred_b)^2."""
    pred = model.transform(design)
    return pred.select(
        "book_id", "n", "vec",
        (F.col("sum_y") - F.col("n") * F.col("prediction")).alias("r"),
        (F.col("sum_y2") - 2 * F.col("prediction") * F.col("sum_y") + F.col("n") * F.col("prediction") ** 2).alias("ssr"),
    )


def gradient_table(design: DataFrame, model: LinearRegressionModel, terms: Sequence[int]) -> DataFrame:
    """Raw-row gradient of 1/2 SSE per term: g_j = sum_rows x_j (y - pred) and the term's support
    (rows with x_j = 1). OLS optimality <=> g = 0 for every term. Output (term, support, grad)."""
    rs = _residual_stats(design, model)
    term_of = F.array(*[F.lit(int(t)) for t in terms])
    per_term = rs.select("n", "r", F.posexplode("vec").alias("_j", "_x")).where(F.col("_x") != 0)
    per_term = per_term.select(F.element_at(term_of, F.col("_j") + 1).cast("long").alias("term"), "n", "r", "_x")
    g = per_term.groupBy("term").agg(F.sum(F.col("_x") * F.col("n")).cast("long").alias("support"),
                                     F.sum(F.col("_x") * F.col("r")).alias("grad"))
    g0 = rs.agg(F.lit(INTERCEPT).cast("long").alias("term"), F.sum("n").cast("long").alias("support"), F.sum("r").alias("grad"))
    return g0.unionByName(g)


def r_squared_raw(design: DataFrame, model: LinearRegressionModel) -> DataFrame:
    """R^2 over the raw rows from per-book statistics: (n, r2)."""
    rs = _residual_stats(design, model).join(design.select("book_id", "sum_y", "sum_y2"), "book_id")
    s = rs.agg(F.sum("n").alias("n"), F.sum("ssr").alias("ssr"), F.sum("sum_y").alias("sy"), F.sum("sum_y2").alias("syy"))
    return s.select(F.col("n").cast("long").alias("n"),
                    (F.lit(1.0) - F.try_divide(F.col("ssr"), F.col("syy") - F.col("sy") ** 2 / F.col("n"))).alias("r2"))


def ols_inference(ratings: DataFrame, book_tag_set: DataFrame, terms: Sequence[int],
                  books: DataFrame | None = None) -> DataFrame:
    """Coefficients with standard errors, t and p values of the raw-row OLS (term 0: intercept), from one
    pass of sufficient statistics; no rating carries a feature vector. A singular design gives NULL
    inference columns. Output (term, coef, std_err, t_value, p_value)."""
    spark = ratings.sparkSession
    stats = fold_statistics(ratings.withColumn("fold", F.lit(0)), book_tag_set, terms, books=books)
    rows = [(i, *r) for i, r in zip([INTERCEPT, *map(int, terms)], inference_from_stats(spark, stats[0]))]
    return spark.createDataFrame(rows, "term long, coef double, std_err double, t_value double, p_value double")


def kkt_table(design: DataFrame, model: LinearRegressionModel, terms: Sequence[int], alpha: float, tol: float) -> DataFrame:
    """LASSO optimality per term with g_j = (1/n) sum x_j (y - pred):
    active (beta != 0): |g_j - alpha sign(beta_j)| <= tol; inactive: |g_j| <= alpha + tol;
    intercept: |g_0| <= tol. Output (term, active, grad, kkt_ok)."""
    spark = design.sparkSession
    g = gradient_table(design, model, terms)
    n = g.where(F.col("term") == INTERCEPT).select("support").scalar()
    beta = spark.createDataFrame(
        [(INTERCEPT, 0.0)] + [(int(t), float(b)) for t, b in zip(terms, model.coefficients.toArray())], "term long, beta double")
    j = g.join(beta, "term").withColumn("g", F.col("grad") / n)
    active = F.col("beta") != 0
    ok = (F.when(F.col("term") == INTERCEPT, F.abs("g") <= tol)
          .when(active, F.abs(F.col("g") - alpha * F.signum("beta")) <= tol)
          .otherwise(F.abs("g") <= alpha + tol))
    return j.select("term", active.alias("active"), F.col("g").alias("grad"), ok.alias("kkt_ok"))


# ------------------------------------------------------------------ cross-validation on sufficient statistics
def fold_statistics(ratings_fold: DataFrame, book_tag_set: DataFrame, terms: Sequence[int], y: str = "rating",
                    books: DataFrame | None = None) -> dict:
    """One distributed pass: per fold, the raw-row Gram X^T X (with intercept column), X^T y, y^T y, n.

    X^T X is built from tag pairs of each book (a book has few tags), weighted by the book's row
    count in the fold, so nothing per-row is ever expanded. The rows are read once: a book's terms stand in an array
    (at most p long), from which every cell follows. Returns NumPy arrays keyed by fold
    (size folds x p^2, independent of the row count). Rows take part whose book is among ``books``
    (book_id); by default the books with at least one of the terms."""
    per = ratings_fold.groupBy("fold", "book_id").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(y).cast("double").alias("sy"),
        F.sum(F.col(y) * F.col(y)).cast("double").alias("syy"))
    tags = book_tag_set.where(F.col("tag_id").isin([int(t) for t in terms])).groupBy("book_id").agg(F.collect_set("tag_id").alias("terms"))
    if books is not None:
        tags = books.select("book_id").distinct().join(tags, "book_id", "left")
    icpt, none = F.lit(INTERCEPT).cast("long"), F.lit(-1).cast("long")
    found = F.concat(F.array(icpt), F.coalesce("terms", F.array().cast("array<long>")))
    cell = lambda i, j, v: F.struct(i.alias("ti"), j.alias("tj"), v.alias("v"), F.lit(0.0).alias("v2"))
    # X^T X cells (ti, tj), X^T y cells (ti, -1) and the y^T y / n row (-1, -1)
    gram = F.flatten(F.transform("terms", lambda i: F.transform("terms", lambda j: cell(i, j, F.col("n")))))
    xty = F.transform("terms", lambda i: cell(i, none, F.col("sy")))
    yy = F.array(F.struct(none.alias("ti"), none.alias("tj"), F.col("syy").alias("v"), F.col("n").alias("v2")))
    rows = per.join(tags, "book_id").withColumn("terms", found).select("fold", F.explode(F.concat(gram, xty, yy)).alias("c"))
    cells = rows.groupBy("fold", "c.ti", "c.tj").agg(F.sum("c.v").alias("v"), F.sum("c.v2").alias("v2")).collect()  # folds x (p^2 + p + 1)
    idx = {INTERCEPT: 0, **{int(t): i + 1 for i, t in enumerate(terms)}}
    p = len(idx)
    stats: dict = {}

    def fold(f):
        return stats.setdefault(f, {"G": np.zeros((p, p)), "c": np.zeros(p), "yy": 0.0, "n": 0.0})

    for r in cells:
        f, ti, tj = int(r["fold"]), int(r["ti"]), int(r["tj"])
        if ti == -1:
            fold(f)["yy"], fold(f)["n"] = float(r["v"]), float(r["v2"])
        elif tj == -1:
            fold(f)["c"][idx[ti]] = float(r["v"])
        else:
            fold(f)["G"][idx[ti], idx[tj]] = float(r["v"])
    return stats


def lasso_gram(G: np.ndarray, c: np.ndarray, n: float, alpha: float, tol: float = 1e-12, max_iter: int = 100000,
               start: np.ndarray | None = None) -> np.ndarray:
    """Coordinate descent for 1/(2n) SSE + alpha L1 with an unpenalised intercept (column 0),
    on sufficient statistics only (p x p), from ``start`` (a solution for another alpha) or zero. Returns beta with
    the intercept first. Sweeps run over the active terms until these settle; then all terms are looked at
    once, and the solution stands when none of them moves."""
    p = len(c)
    mean_x = G[0, 1:] / n
    mean_y = c[0] / n
    Gc = G[1:, 1:] - n * np.outer(mean_x, mean_x)
    cc = c[1:] - n * mean_x * mean_y
    b = np.zeros(p - 1) if start is None else start[1:].copy()
    diag = np.diag(Gc).copy()
    used, limit = np.flatnonzero(diag > 0), n * alpha
    b[diag <= 0] = 0.0
    rest = cc - Gc @ b  # X^T (y - X b), kept up to date

    def sweep(terms: np.ndarray) -> float:
        moved = 0.0
        for j in terms.tolist():
            rho = rest[j] + diag[j] * b[j]
            new = (rho - limit if rho > limit else rho + limit if rho < -limit else 0.0) / diag[j]
            step = new - b[j]
            if step:
                rest[:] -= Gc[j] * step
                b[j] = new
                moved = max(moved, abs(step))
        return moved

    for _ in range(max_iter):
        if sweep(used) < tol:
            return np.concatenate([[mean_y - mean_x @ b], b])
        active = used[b[used] != 0]
        for _ in range(max_iter):
            if sweep(active) < tol:
                break
        rest = cc - Gc @ b  # without the rounding of many updates
    raise RuntimeError(f"lasso: not converged in {max_iter} sweeps at alpha {alpha}")


def total_statistics(stats: dict) -> dict:
    """The folds' statistics added up."""
    return {k: sum(s[k] for s in stats.values()) for k in ("G", "c", "yy", "n")}


def best_alpha(rows: Sequence[tuple[float, float, float, float]]) -> float:
    """The alpha with the highest mean score, the larger one on ties."""
    return max(rows, key=lambda r: (r[1], r[0]))[0]


def kkt_ok(beta: np.ndarray, s: dict, alpha: float, tol: float) -> np.ndarray:
    """Per term (intercept first) whether the LASSO conditions hold: see :func:`kkt_table`."""
    g = (s["c"] - s["G"] @ beta) / s["n"]
    ok = np.where(beta != 0, np.abs(g - alpha * np.sign(beta)) <= tol, np.abs(g) <= alpha + tol)
    ok[0] = abs(g[0]) <= tol
    return ok


def student_p_values(spark: SparkSession, t_values: Sequence[float], df: float) -> list[float]:
    """Two-sided p values of Student's t (the JVM's commons-math, which Spark ships)."""
    dist = spark.sparkContext._jvm.org.apache.commons.math3.distribution.TDistribution(float(df))
    return [2.0 * dist.cumulativeProbability(-abs(float(t))) for t in t_values]


def inference_from_stats(spark: SparkSession, s: dict) -> list[tuple]:
    """(coef, std_err, t_value, p_value) per term, intercept first, of OLS on the raw rows, from X^T X,
    X^T y, y^T y and n alone. A singular X^T X gives minimum-norm coefficients and no inference (None)."""
    gram, n = s["G"], s["n"]
    p = len(gram)
    if np.linalg.matrix_rank(gram, hermitian=True) < p or n <= p:
        return [(float(b), None, None, None) for b in np.linalg.lstsq(gram, s["c"], rcond=None)[0]]
    inverse = np.linalg.inv(gram)
    beta = np.linalg.solve(gram, s["c"])
    ssr = s["yy"] - 2 * beta @ s["c"] + beta @ gram @ beta
    se = np.sqrt(np.diag(inverse) * ssr / (n - p))
    t = beta / se
    return list(zip(beta.tolist(), se.tolist(), t.tolist(), student_p_values(spark, t, n - p)))


def r2_from_stats(beta: np.ndarray, s: dict) -> float:
    ssr = s["yy"] - 2 * beta @ s["c"] + beta @ s["G"] @ beta
    sst = s["yy"] - s["c"][0] ** 2 / s["n"]
    return float(1 - ssr / sst) if sst > 0 else float("nan")


def lasso_path(s: dict, alphas: Sequence[float]) -> dict[float, np.ndarray]:
    """{alpha: beta} by falling alpha, each solution starting from the one before it."""
    out: dict[float, np.ndarray] = {}
    beta = None
    for a in sorted(set(map(float, alphas)), reverse=True):
        out[a] = beta = lasso_gram(s["G"], s["c"], s["n"], a, start=beta)
    return out


def lasso_cv(stats: dict, alphas: Sequence[float]) -> list[tuple[float, float, float, float]]:
    """K-fold CV of the R^2 score: for each alpha (alpha, mean, population std, std / sqrt(K)). One path of
    solutions a fold (:func:`lasso_path`)."""
    folds, scores = sorted(stats), {}
    for f in folds:
        train = {k: sum(stats[g][k] for g in folds if g != f) for k in ("G", "c", "yy", "n")}
        scores[f] = {a: r2_from_stats(beta, stats[f]) for a, beta in lasso_path(train, alphas).items()}
    out = []
    for a in alphas:
        sc = np.array([scores[f][float(a)] for f in folds])
        out.append((float(a), float(sc.mean()), float(sc.std()), float(sc.std() / np.sqrt(len(folds)))))
    return out


__all__ = [
    "book_design", "ols_fit", "lasso_fit", "coefficient_table", "gradient_table", "r_squared_raw",
    "ols_inference", "kkt_table", "fold_statistics", "lasso_gram", "lasso_path", "lasso_cv", "total_statistics", "best_alpha", "kkt_ok",
    "inference_from_stats", "vector_to_array",
]
