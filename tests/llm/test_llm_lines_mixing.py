"""Line dedup and source mixing against plain Python."""

import collections
import hashlib
import random

import pytest
from conftest import SF_SMALL

from shelfwise.llm import linededup, mixing
from shelfwise.llm.common import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_dedup(rows, min_chars=40, min_docs=5):
    holders = collections.defaultdict(set)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    for i, text in rows:
        for x in (text or "").split("\n"):
            if i is not None and len(key(x)) >= min_chars:
                holders[key(x)].add(i)
    out = collections.Counter()
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == i]
        out[i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    return out


def test_line_dedup_matches_plain_python_on_the_table(spark):
    docs = table(spark, SF_SMALL, "documents")
    got = linededup.line_digest(linededup.dedup_lines(docs)).collect()
    want = plain_dedup([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert collections.Counter(tuple(r) for r in got) == want
    assert sum(r["n_dropped"] for r in got) > 0


def test_line_dedup_edges(spark):
    long, other = "A line that is Long enough to be counted, é", "ÉCOLE " * 10
    rows = [(i, f"own {i}\n  {long}\t\n{other}", "x", 1) for i in range(5)]
    rows += [(5, f"{long.lower()}\n{long}\n\n", "x", 1), (None, f"{long}\nnull id", "x", 1), (7, None, None, None),
             (8, "", "", 0), (1, rows[1][1], "x", 1), (9, other.lower() + "\n" + other.replace("É", "é"), "x", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, line int")
    got = collections.Counter(tuple(r) for r in linededup.line_digest(linededup.dedup_lines(df)).collect())
    assert got == plain_dedup([r[:2] for r in rows])
    assert linededup.dedup_lines(df.limit(0)).count() == 0


def test_pfair_cycle_keeps_every_source_within_one_block():
    rng = random.Random(4)
    for _ in range(40):
        units = [rng.randint(1, 30) for _ in range(rng.randint(1, 9))]
        had, q = collections.Counter(), sum(units)
        for t, (i, j) in enumerate(mixing.pfair_cycle(units), 1):
            assert j == had[i]
            had[i] += 1
            assert all(abs(had[k] - u * t / q) < 1 for k, u in enumerate(units))
        assert [had[k] for k in range(len(units))] == units


def plain_mix(counts, units, block):
    """Cycle after cycle, block after block: the source of every position."""
    left, order = [-(-n // block) for n in counts], []
    sent = [0] * len(counts)
    while any(left):
        has = [min(a, u) for a, u in zip(left, units)]
        for i, _ in mixing.pfair_cycle(has):
            take = min(block, counts[i] - sent[i])
            order += [i] * take
            sent[i] += take
            left[i] -= 1
    return order


@pytest.mark.parametrize("weights", [None, {"src0": 1.0, "src1": 5.0, "src2": 0.5}])
def test_mixing_matches_a_plain_schedule(spark, weights):
    docs = table(spark, SF_SMALL, "documents")
    counts = collections.Counter(r["source"] for r in docs.collect())
    names = sorted(counts)
    share = [weights.get(s, 1.0) if weights else counts[s] ** 0.5 for s in names]
    units = mixing.cycle_units([counts[s] for s in names], share, 12)
    got = mixing.mix_sources(docs, weights, cycle=12, block=3).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(docs.count()))
    assert [r["source"] for r in got] == [names[i] for i in plain_mix([counts[s] for s in names], units, 3)]
    ranks = collections.defaultdict(list)
    for r in got:
        ranks[r["source"]].append(r["source_rank"])
    assert all(v == list(range(len(v))) for v in ranks.values())


def test_mixing_edges(spark):
    rows = [(1, "a", None), (1, "a", None), (2, None, None), (None, "b", "x"), (3, "", "y"), (4, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, source string, position string")
    got = mixing.mix_sources(df, block=2).collect()
    assert sorted(r["position"] for r in got) == list(range(6))
    assert collections.Counter((r["doc_id"], r["source"]) for r in got) == collections.Counter((a, b) for a, b, _ in rows)
    assert mixing.mix_sources(df.limit(0)).count() == 0
    mixed = mixing.mixed_order(df)
    assert mixed.columns == df.columns and collections.Counter(map(tuple, mixed.collect())) == collections.Counter(rows)
    with pytest.raises(ValueError):
        mixing.mix_sources(df, {"a": 0.0})
    with pytest.raises(ValueError):
        mixing.mix_sources(df, max_sources=2)
