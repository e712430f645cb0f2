import random
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from shelfwise.operators import collab, joins
from shelfwise.operators import clean
from shelfwise.operators.clean import dense_ids


def _brute_pairs(rows):
    by_group = {}
    for g, i in rows:
        by_group.setdefault(g, set()).add(i)
    c = Counter()
    for items in by_group.values():
        for a, b in permutations(sorted(items), 2):
            c[(a, b)] += 1
    return c


def test_gram_join_salted_equals_brute_force(spark):
    # one hot group holding most rows, plus small groups; cell_rows=3 forces salting
    rows = [(1, i) for i in range(1, 40)] + [(g, i) for g in range(2, 12) for i in range(g, g + 4)]
    df = spark.createDataFrame(rows, "user_id long, book_id long")
    got = {(r["item_a"], r["item_b"]): r["n"] for r in joins.gram_join(df, "user_id", "book_id", cell_rows=3).collect()}
    assert got == dict(_brute_pairs(rows))


def test_gram_join_diagonal(spark):
    rows = [(1, 1), (1, 2), (2, 1)]
    df = spark.createDataFrame(rows, "g long, i long")
    got = {(r["item_a"], r["item_b"]): r["n"] for r in joins.gram_join(df, "g", "i", include_diagonal=True, cell_rows=1).collect()}
    assert got == {(1, 1): 2, (2, 2): 1, (1, 2): 1, (2, 1): 1}


def test_item_closest_tie_goes_to_lowest_id(spark):
    sim = spark.createDataFrame([(1, 3, 2, 4, 0.5), (1, 2, 2, 4, 0.5), (1, 4, 1, 4, 0.25)],
                                "book_id long, other_id long, n_both long, n_good long, sim double")
    r = collab.item_closest(sim).first()
    assert (r["closest"], r["sim"]) == (2, 0.5)


def test_item_similarity_asymmetric_and_no_row_without_good(spark):
    flagged = spark.createDataFrame(
        [(1, 10, 5, 1), (1, 11, 5, 1), (2, 10, 5, 1), (3, 12, 1, 0), (2, 13, 5, 1)],
        "user_id long, book_id long, rating int, good int")
    sim = {(r["book_id"], r["other_id"]): r["sim"] for r in collab.item_similarity(flagged).collect()}
    assert sim[(10, 11)] == 0.5 and sim[(11, 10)] == 1.0
    assert all(12 not in k for k in sim)  # book 12 has no good rating


def test_dense_ids_across_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(13)
    out = dense_ids(df, ["k"], "rid").collect()
    assert sorted((r["k"], r["rid"]) for r in out) == [(k, k + 1) for k in range(5000)]


def test_pair_cost_preview_counts_pairs(spark):
    rows = [(1, i) for i in range(5)] + [(2, 1), (2, 2)]
    df = spark.createDataFrame(rows, "user_id long, book_id long")
    out = joins.pair_cost_preview(df, "user_id", 5).orderBy("user_id").collect()
    assert [(r["user_id"], r["n_pairs"]) for r in out] == [(1, 20), (2, 2)]
    assert out[0]["total_pairs"] == 22


def test_dense_ids_with_a_payload_at_scale(spark, tmp_path):
    """Checked from written output, with and without shared exchanges."""
    n = 3_000_000
    df = spark.range(0, n, numPartitions=16).select((F.col("id") * 7919 % 3_000_017).alias("k"), F.col("id").alias("payload"))
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            clean.dense_ids(df, ["k"], "dense").write.parquet(str(tmp_path / reuse))
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
        out = spark.read.parquet(str(tmp_path / reuse))
        r = out.agg(F.count(F.lit(1)), F.count_distinct("dense"), F.min("dense"), F.max("dense"), F.count_distinct("payload")).first()
        assert tuple(r) == (n, n, 1, n, n)
        # the numbers follow the order of the key
        low = out.where("dense <= 100000").agg(F.max("k")).first()[0]
        assert low < out.where("dense > 100000").agg(F.min("k")).first()[0]


def _plain_closest(rows):
    by_user, n_good = {}, Counter(i for _, i in rows)
    for u, i in rows:
        by_user.setdefault(u, set()).add(i)
    both = Counter((a, b) for items in by_user.values() for a, b in permutations(items, 2))
    best = {}
    for (a, b), n in both.items():
        best[a] = min(best.get(a, (0, 0)), (-n, b))
    return {a: (b, -n, n_good[a]) for a, (n, b) in best.items()}, sum(both.values())


def test_closest_items_equals_brute_force_and_forms_fewer_pairs(spark):
    """A few popular books that everyone likes beside many rare ones; ties in counts; one user with most books."""
    rng = random.Random(7)
    rows = {(u, i) for u in range(300) for i in range(6) if rng.random() < 0.6}
    rows |= {(u, 100 + rng.randrange(400)) for u in range(300) for _ in range(8)}
    rows |= {(999, i) for i in range(100, 300)}
    flagged = spark.createDataFrame([(u, i, 1) for u, i in sorted(rows)] + [(1, 7777, 0)], "user_id long, book_id long, good int")
    want, total = _plain_closest(rows)
    for round_pairs, cell_rows in ((10**9, 1024), (1, 1024), (1, 16), (3000, 50)):
        got = collab.closest_items(flagged, round_pairs=round_pairs, cell_rows=cell_rows)
        assert {r["book_id"]: (r["closest"], r["n_both"], r["n_good"]) for r in got.rows.collect()} == want
        assert got.total == total and got.pairs <= total
        if round_pairs == 10**9:
            assert got.rounds == 1 and got.pairs == total
    assert collab.closest_items(flagged, round_pairs=1).pairs < 0.8 * total
    some = spark.createDataFrame([(0,), (150,), (150,), (5555,)], "book_id long")
    got = collab.closest_items(flagged, only=some, round_pairs=1)
    assert {r["book_id"]: (r["closest"], r["n_both"], r["n_good"]) for r in got.rows.collect()} == {i: want[i] for i in (0, 150)}
    assert collab.closest_items(flagged.limit(0)).rows.count() == 0


def test_partner_rounds_join_small_tiers():
    tiers = [(0, 10, 1), (1, 20, 3), (2, 30, 6), (5, 500, 40)]
    assert collab.partner_rounds(tiers, 1) == [(5, 5, 6), (2, 2, 3), (1, 1, 1), (0, 0, 0)]
    assert collab.partner_rounds(tiers, 55) == [(5, 5, 6), (1, 2, 1), (0, 0, 0)]
    assert collab.partner_rounds(tiers, 10**6) == [(0, 5, 0)] and collab.partner_rounds([], 5) == []


def _tags(rng):
    sets = [tuple(sorted(rng.sample(range(10, 22), rng.randint(1, 4)))) for _ in range(25)]
    return [(g, i) for i in range(60) for g in sets[rng.randrange(25)]] + [(99, 1000)]


def test_gram_join_in_cells_equals_brute_force(spark):
    rows = _tags(random.Random(4))
    df = spark.createDataFrame(rows, "g long, i long")
    got = {(r["item_a"], r["item_b"]): r["n"] for r in joins.gram_join(df, "g", "i", in_cells=True, cell_items=7).collect()}
    assert got == dict(_brute_pairs(rows))


def test_gram_classes_hold_all_pairs_without_forming_those_of_twins(spark):
    rows = _tags(random.Random(4))
    pairs, members = joins.gram_classes(spark.createDataFrame(rows, "g long, i long"), "g", "i", cell_items=5)
    pairs, rep = pairs.collect(), {r["i"]: r["rep"] for r in members.collect()}
    n = {(r["rep"], r["other"]): r["n"] for r in pairs}
    assert len(n) == len(pairs) < len(_brute_pairs(rows)) / 3
    assert all(r["others"] == sum(x == r["other"] for x in rep.values()) for r in pairs)
    assert {(a, b): n[rep[a], rep[b]] for a in rep for b in rep if a != b and (rep[a], rep[b]) in n} == dict(_brute_pairs(rows))
