"""Whitening against exact Python integers and NumPy."""

import math
import random

import numpy as np
import pytest
from conftest import SF_SMALL

from shelfwise.llm import whitening as w
from shelfwise.llm.common import table


def plain(rows, k=8):
    """{row number: (deviation, whitened)}, explained; covariances as exact fractions over n ** 3."""
    ok = [i for i, v in enumerate(rows) if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100000 for c in map(float, rows[i])] for i in ok]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    far = [[n * r[j] - s[j] for j in range(d)] for r in x]
    v = np.array([[sum(r[a] * r[b] for r in far) / n**3 for b in range(d)] for a in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    white = np.array(far, float) / n @ u / np.sqrt(e)
    return {i: (sum(c * c for c in far[j]), white[j]) for j, i in enumerate(ok)}, e / np.trace(v)


def check(spark, rows, k=8):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, n string, component int")
    got = w.whitening_digest(w.whiten(df, k)).collect()
    want, explained = plain(rows, k)
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert len(by) == len(got) and set(by) == {(i, j + 1) for i in want for j in range(len(explained))}
    for j in range(len(explained)):
        a, b = np.array([by[i, j + 1]["whitened"] for i in want]), np.array([want[i][1][j] for i in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
    for r in got:
        assert r["deviation"] == (want[r["vec_id"]][0] if want[r["vec_id"]][0] < 1 << 63 else None)
        assert r["n"] == len(want) and r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
        assert r["identity_error"] < 1e-8
    return got


def test_whitening_matches_plain_python_on_the_table(spark):
    rows = table(spark, SF_SMALL, "embeddings").orderBy("vec_id").limit(200).collect()
    check(spark, [r["embedding"] for r in rows])
    full = w.whiten(table(spark, SF_SMALL, "embeddings")).collect()
    assert len(full) == 8 * len({r["vec_id"] for r in full}) and full[0]["identity_error"] < 1e-4


def test_whitening_faulty_vectors_ties_and_repeats(spark):
    rng = random.Random(2)
    rows = [[rng.gauss(0, 1 + j) for j in range(5)] for _ in range(40)]
    rows += [None, [1.0, None, 0.0, 0.0, 0.0], [math.nan] * 5, [math.inf, 0.0, 0.0, 0.0, 0.0], rows[0], rows[0], [1.0, 2.0], []]
    got = check(spark, rows[:-2], 3)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)] + [(None, rows[1])], "vec_id long, embedding array<double>")
    more = w.whiten(df, 3).collect()  # other lengths are left out, a null id stays
    assert {r["vec_id"] for r in more} == {r["vec_id"] for r in got} | {None}
    same = [r for r in more if r["vec_id"] in (0, 44, 45)]
    assert len({(r["component"], r["whitened"], r["deviation"]) for r in same}) == 3


def test_whitening_rank_and_empty(spark):
    df = spark.createDataFrame([(i, [float(i), 2.0 * i, 3.0]) for i in range(10)], "vec_id long, embedding array<double>")
    assert {r["component"] for r in w.whiten(df).collect()} == {1}
    assert w.whiten(df.limit(1)).count() == 0 and w.whiten(df.limit(0)).count() == 0


def test_whitening_is_exact_beyond_64_bits(spark):
    rng = random.Random(9)
    rows = [[rng.choice([-1, 1]) * 2.0**rng.randint(20, 30) + rng.random() for _ in range(4)] for _ in range(60)]
    check(spark, rows, 4)
    far = w.whiten(spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")).collect()
    want, _ = plain(rows)
    assert all(int(r["deviation"]) == want[r["vec_id"]][0] for r in far) and max(v[0] for v in want.values()) > 1 << 63


def test_polarisation_equals_products(spark):
    rng = random.Random(4)
    rows = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(50)]
    clean = spark.createDataFrame([(v,) for v in rows], "v array<double>").repartition(7)
    x = [[math.floor(1024 * c) + 100000 for c in r] for r in rows]
    n, total = w.dimension_sums(clean, 6)
    assert (n, total) == (50, [sum(r[j] for r in x) for j in range(6)])
    square = w.pair_squares(clean, 6, n, total)
    far = [[n * r[j] - total[j] for j in range(6)] for r in x]
    for (i, j), q in square.items():
        assert q == sum((r[i] + r[j] if i != j else r[i]) ** 2 for r in far)
        if i != j:
            assert q - square[i, i] - square[j, j] == 2 * sum(r[i] * r[j] for r in far)
