"""Collocations against plain Python; stretches of text, grouping of prefixes, edge cases."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL

from shelfwise.llm import collocations as c
from shelfwise.llm.common import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces_of(text):
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER))]


def plain(rows, min_count, top=2000, depth=5):
    by = {}
    for lang, text in rows:
        f = by.setdefault(lang if lang is not None else "und", collections.Counter())
        for w in pieces_of(text):
            for k in range(1, depth + 1):
                f.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in by.items():
        n = sum(v for k, v in f.items() if len(k) == 1)
        some = {k: v for k, v in f.items() if len(k) > 1 and v >= min_count}
        gone = {k[i:j] for k, v in some.items() for i in range(len(k)) for j in range(i + 2, len(k) + 1)
                if j - i < len(k) and 100 * v >= 100 * f[k[i:j]]}
        best = []
        for k, a in some.items():
            if k not in gone:
                s, _, left, right = min((1000 * a * n // (f[k[:i]] * f[k[i:]]), i, f[k[:i]], f[k[i:]]) for i in range(1, len(k)))
                best.append((-s, -a, " ".join(k).encode(), left, right))
        out += [(lang, i, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in c.collocations(df, **options).collect())


@pytest.mark.parametrize("min_count,budget,top", [(100, c.BUDGET, 2000), (3, 50, 2000), (6, 1, 40)])
def test_collocations_match_plain_python_on_the_table(spark, min_count, budget, top):
    docs = table(spark, SF_SMALL, "documents")
    want = plain([(r["lang"], r["text"]) for r in docs.collect()], min_count, top)
    assert want and mined(docs, min_count=min_count, budget=budget, top=top) == want


def test_collocations_edges(spark):
    rng = random.Random(3)
    words = ["A", "b", "É", "x\x01y", "x", "the", "of", "x-y", "\x02"]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", "", ".", "\t", "\n", ", "]) for _ in range(60)) for _ in range(80)]
    rows = [(i, t, rng.choice(["en", "de", None, "und", "a language"]), 1, "x") for i, t in enumerate(texts)]
    rows += [(100, None, "en", 1, "x"), (101, "", None, 1, "x"), (102, "one two", "fr", 1, "x"), (None, "the of the of", "en", 1, "x"),
             (None, "the of the of", "en", 1, "x"), (103, "Tie a. Tie a. a Tie. a Tie." * 10, "tie", 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n int, phrase string")
    plain_rows = [(r[2], r[1]) for r in rows]
    for budget in (1, 40):
        assert mined(df, min_count=4, budget=budget) == plain(plain_rows, 4)
    assert c.collocations(df.limit(0)).count() == 0
    assert mined(df, min_count=10**6) == []


def test_one_text_of_most_words_and_a_hot_phrase(spark):
    rng = random.Random(5)
    long = " ".join(rng.choice(["a", "b", "the same five words again", "c"]) for _ in range(30_000))
    rows = [("en", long)] + [("en", "the same five words again and more")] * 500 + [("en", "z " * 300)]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert mined(df, min_count=50, budget=10) == plain(rows, 50)


@pytest.mark.parametrize("stretch", [1, 7, 64])
def test_word_runs_keep_every_word_with_the_words_after_it(monkeypatch, stretch):
    monkeypatch.setattr(c, "STRETCH", stretch)
    rng = random.Random(stretch)
    texts = ["".join(rng.choice(["a", "Bc", " ", "\t", ".", "\n", "é", "dd"]) for _ in range(rng.randint(0, 60))) for _ in range(25)]
    texts[3], texts[4], texts[9] = "", None, "w" * 200
    for keep in (1, 5):
        got = collections.Counter()
        for w in c.word_runs(pa.array(texts, pa.string()), np.arange(len(texts)), keep):
            name = w.names.to_pylist()
            for i in range(w.counted):
                run = [name[w.code[i]]]
                while len(run) < keep and i + len(run) < len(w.code) and not w.begins[i + len(run)]:
                    run.append(name[w.code[i + len(run)]])
                got[int(w.lang[i]), " ".join(run)] += 1
        want = collections.Counter((d, " ".join(w[i : i + keep])) for d, t in enumerate(texts) for w in pieces_of(t) for i in range(len(w)))
        assert got == want


def test_long_prefixes_are_extended_and_groups_hold_the_budget(spark):
    rows = [("en", f"hot {a} {b} ", 1) for a in range(20) for b in range(30)] + [("en", f"cold{a} x ", 2) for a in range(400)] + [("en", "hot ", 5)]
    leaves = spark.createDataFrame(rows, "lang string, leaf string, c long")
    out, tops = c.partition_prefixes(leaves, 5, 50, 1)
    assert [tuple(r) for r in tops.collect()] == [("en", "hot", 605)]
    got = out.collect()
    assert len(got) == 1000 and {r["depth"] for r in got if r["leaf"].startswith("hot")} == {2}
    assert max(collections.Counter(r["group"] for r in got).values()) < 5 * 50
    nodes = {r["phrase"]: r["f"] for r in c.build_subtrees(out, 2).collect()}
    assert nodes == {**{f"hot {a}": 30 for a in range(20)}, **{f"cold{a}": 2 for a in range(400)}, **{f"cold{a} x": 2 for a in range(400)}}


def test_rare_pairs_that_share_a_place_with_frequent_ones_are_told_by_the_second_sketch(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    pairs = [(a, b) for a in words for b in words]
    rng.shuffle(pairs)
    texts = [" ".join(p) for p in pairs[:300] * 50 + pairs[300:] * 2]
    src = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    send = spark.sparkContext.broadcast
    first = send(c.sketch(src, 50, 12, 5, None)[0])
    second = send(c.sketch(src, 50, 12, 5, first)[0])
    leaves = c.truncated_suffixes(src, first, second, 12, 5).groupBy("leaf").sum("c").collect()
    held = {tuple(r["leaf"].split()): r["sum(c)"] for r in leaves if len(r["leaf"].split()) == 2}
    assert {p: held.get(p) for p in pairs[:300]} == dict.fromkeys(pairs[:300], 50)
    assert len(held) < 300 + 60  # 3,300 rare pairs, of which about one in twelve shares its place with a frequent phrase


def test_input_splits_are_read_together(spark, monkeypatch):
    rows = [(i, "en", f"all of the same words {i % 7}") for i in range(640)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(64)
    cores = spark.sparkContext.defaultParallelism
    assert c._gathered(df).rdd.getNumPartitions() == max(8, min(64, 2 * cores))
    assert c._gathered(df.coalesce(2)).rdd.getNumPartitions() == 2
    made = []
    leaves = c.truncated_suffixes
    monkeypatch.setattr(c, "truncated_suffixes", lambda *x: made.append(leaves(*x)) or made[-1])
    assert mined(df, min_count=50) == plain([r[1:] for r in rows], 50)
    n = made[0].count()
    assert n <= max(8, 2 * cores) * made[0].select("leaf").distinct().count() and made[0].rdd.getNumPartitions() <= max(8, 2 * cores)
