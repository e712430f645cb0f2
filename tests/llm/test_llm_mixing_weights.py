"""Mixing against the target weights as they are, without rounding to a cycle."""

import random

from pyspark.sql import functions as F

from shelfwise.llm import mixing


def deviation(order, blocks, weights):
    """Largest distance, in blocks, between what a source has had and its fluid target, over the slots until
    a source ends."""
    had, worst = [0] * len(blocks), 0.0
    total = sum(weights)
    for t, i in enumerate(order, 1):
        had[i] += 1
        if any(w * t / total > m for w, m in zip(weights, blocks)):
            break
        worst = max(worst, *(abs(h - w * t / total) for h, w in zip(had, weights)))
        if had[i] == blocks[i]:
            break
    return worst


def test_exact_slots_deal_every_block_once_and_near_the_target():
    rng = random.Random(7)
    for _ in range(12):
        n = rng.randint(1, 12)
        blocks, weights = [rng.randint(0, 90) for _ in range(n)], [rng.random() ** 3 + 1e-6 for _ in range(n)]
        order = list(mixing.exact_slots(blocks, weights))
        assert sorted(order) == [(i, j) for i, m in enumerate(blocks) for j in range(m)]
        live = [i for i in range(n) if blocks[i]]
        had, v, t = dict.fromkeys(live, 0), 0.0, 0
        w = {i: weights[i] for i in live}
        fluid = lambda x: sum(min(x * w[i], blocks[i]) for i in live)
        ends = sorted(blocks[i] / w[i] for i in live)
        for i, _ in order:  # the fluid target also past the end of a source
            had[i] += 1
            t += 1
            e = next(e for e in ends if fluid(e) >= t - 1e-9)
            rest = [k for k in live if blocks[k] / w[k] >= e]
            v = e - (fluid(e) - t) / sum(w[k] for k in rest)
            if max(blocks) > 1:
                assert all(abs(had[k] - min(v * w[k], blocks[k])) < 1 + 1e-9 for k in live)


def test_many_small_sources_keep_the_weight_of_a_large_one():
    blocks, weights = [3000] + [2] * 1000, [0.9] + [0.0001] * 1000
    order = [i for i, _ in mixing.exact_slots(blocks, weights)]
    assert deviation(order, blocks, weights) < 1 + 1e-9
    assert abs(order[:1000].count(0) - 900) <= 1


def test_unequal_sources_hold_the_unrounded_weights(spark):
    """A third of the rows in one source, the rest in 19 equal ones: weights rows ** 0.5."""
    rows = spark.range(96_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("s"), F.expr("(id div 3 * 2 + id % 3) % 19").cast("string"))).alias("source"))
    got = mixing.mix_sources(rows).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(96_000))
    names = sorted({r["source"] for r in got})
    counts = [sum(r["source"] == s for r in got) for s in names]
    order = [names.index(r["source"]) for r in got if r["source_rank"] % 16 == 0]
    assert deviation(order, [-(-n // 16) for n in counts], [n**0.5 for n in counts]) < 1 + 1e-9
