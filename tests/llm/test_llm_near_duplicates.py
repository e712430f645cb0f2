"""Connected components, the n-gram Jaccard join and near-duplicate vectors against brute force."""

import collections
import random

import numpy as np
import pytest
from conftest import SF_SMALL

from shelfwise.llm import jaccard, shingles, vectors
from shelfwise.llm.common import block_pairs, table
from shelfwise.llm.graph import components


def roots(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_components_match_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(230)]
    links += [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(300)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    real = [x for x in links if None not in x and x[0] != x[1]]
    assert got == roots({v for x in real for v in x}, real)
    assert components(df.limit(0)).count() == 0


def test_block_pairs_bring_every_two_rows_together_once(spark):
    df = spark.range(700).selectExpr("id", "1 AS g", "CAST(700 AS bigint) AS size")
    met = collections.Counter()
    groups = collections.defaultdict(list)
    for r in block_pairs(df, "g", "id", "size", 100).collect():
        groups[r["_i"], r["_j"]].append((r["id"], r["_b"]))
    for (i, j), rows in groups.items():
        assert len(rows) < 400
        met.update((a, b) for a, x in rows for b, y in rows if a < b and (i == j or x != y))
    assert len(met) == 700 * 699 // 2 and set(met.values()) == {1}


def sets_of(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_join(rows, threshold=0.8):
    """(id, links, class) of every row by comparing all pairs of distinct sets."""
    sets = [sets_of(t) for _, t in rows]
    ids = [i for i, _ in rows]
    links, count = [], collections.Counter()
    holders = collections.defaultdict(list)
    for k, s in enumerate(sets):
        if s and ids[k] is not None:
            holders[s].append(k)
    distinct = list(holders)
    for n, s in enumerate(distinct):
        for t in distinct[: n + 1]:
            if len(s & t) >= threshold * len(s | t) - 1e-9:
                for x in holders[s]:
                    for y in holders[t]:
                        if x < y or (s is not t and x != y):
                            links.append((ids[x], ids[y]))
                            count[x] += 1
                            count[y] += 1
    near = roots({i for i in ids if i is not None}, links)
    return collections.Counter((i, count[k], near.get(i)) for k, i in enumerate(ids))


def test_shingles_match_plain_python():
    import pyarrow as pa

    from shelfwise.llm.common import string_buffer

    rng = random.Random(5)
    texts = [None, "", " \t", "a", "a b", "a  b\n", "b a"]
    texts += ["".join(rng.choice("ab é\n\x0b") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    col = pa.array(["skipped", *texts])[1:]
    got = shingles.shingle_sets(*string_buffer(col), 5)
    of = {}
    for t, s in zip(texts, got):
        want = sets_of(t)
        assert len(s) == len(want) and of.setdefault(want, s.tolist()) == s.tolist()
    assert len({tuple(v) for v in of.values()}) == len(of)
    assert sum(len(s) for s in of) > 0
    both = shingles.common_counts(got, width=7)
    plain = [sets_of(t) for t in texts]
    assert all(both[i, j] == len(plain[i] & plain[j]) for i in range(60) for j in range(60))


def test_near_duplicates_match_brute_force_on_the_table(spark):
    docs = table(spark, SF_SMALL, "documents")
    got = jaccard.near_duplicates(docs).collect()
    want = plain_join([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert collections.Counter(tuple(r)[:3] for r in got) == want
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)
    assert any(r["n_links"] for r in got)


@pytest.mark.parametrize("bucket", [8, 256])
def test_large_groups_and_shared_passages(spark, bucket, monkeypatch):
    """A large group of near copies, one of exact copies, and a passage that most other texts hold."""
    monkeypatch.setattr(jaccard, "CLUSTER", 16)
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base, passage = [word() for _ in range(150)], " ".join(word() for _ in range(60))
    texts = [" ".join(base)] * 40
    for _ in range(120):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(150)] = word()
        texts.append(" ".join(w))
    texts += [" ".join([word() for _ in range(60)] + [passage] + [word() for _ in range(40)]) for _ in range(120)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.near_duplicates(df, bucket=bucket).collect()
    assert collections.Counter(tuple(r)[:3] for r in got) == plain_join(rows)


def test_near_duplicate_edges(spark):
    long = "one two three four five six seven eight nine ten"
    rows = [(3, long), (3, long), (1, long), (None, long), (5, None), (6, ""), (7, " \n"), (8, "a b"), (9, "a  b"),
            (10, "b a"), (11, long + " x"), (12, "y " + long + " x")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, rep string")
    got = collections.Counter(tuple(r)[:3] for r in jaccard.near_duplicates(df).collect())
    assert got == plain_join(rows)
    assert jaccard.near_duplicates(df.limit(0)).count() == 0


def test_a_repeated_representative_counts_its_neighbours_links_once(spark):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, long), (1, long), (1, long), (4, long + " x"), (4, long + " x"), (7, long + " x y"), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert collections.Counter(tuple(r)[:3] for r in jaccard.near_duplicates(df).collect()) == plain_join(rows)


def test_very_long_texts(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdef") for _ in range(4)) for _ in range(150_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:140_000])), (3, " ".join(words[:100_000])), (4, "x" * 500_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert collections.Counter(tuple(r)[:3] for r in jaccard.near_duplicates(df).collect()) == plain_join(rows)


@pytest.mark.parametrize("n", [600, 1200])
def test_a_group_of_near_copies_writes_rows_in_proportion(spark, n):
    """Blocks of 32: pairs of blocks write one link each, each text one row of counts."""
    rng = random.Random(n)
    base = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(120)]
    rows = [(i, " ".join(base[: 60 + i % 2] + [f"own{i}"] + base[61:])) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    reps = jaccard.describe(docs, 5, 1, 2.5, "doc_id", "text").withColumnRenamed("doc_id", "rep").selectExpr("*", "1L AS m")
    bucket = reps.selectExpr("1L AS path", f"{n}L AS size", "rep")
    found = jaccard.sketch_candidates(bucket, reps, 0.8, 32).collect()
    pairs = (n // 32 + 1) * (n // 32 + 2) // 2
    assert roots(range(n), [(r["a"], r["b"]) for r in found]) == dict.fromkeys(range(n), 0)
    assert len(found) <= n + 2 * pairs
    clusters = reps.selectExpr("rep AS node", "1L AS component")
    checked = jaccard.verify(clusters, reps, docs, 0.8, 5, 32, "doc_id", "text").collect()
    assert sum(r["add"] > 0 for r in checked) == n and len(checked) <= 2 * n + 2 * pairs
    assert all(r["add"] == n - 1 for r in checked if r["root"] is None)


def test_meet_blocks_brings_every_two_rows_together(spark):
    from shelfwise.llm.common import Meeting, meet_blocks
    import pyarrow as pa

    class Count(Meeting):
        def __init__(self, rows):
            self.own, self.seen, self.later = rows.column("id").to_pylist(), 0, 0

        def meet(self, other, later):
            self.seen += other.num_rows
            self.later += later

        def result(self):
            return pa.RecordBatch.from_pydict({"id": pa.array(self.own), "seen": pa.array([self.seen + len(self.own)] * len(self.own)),
                                               "later": pa.array([self.later] * len(self.own))})

    sizes = {1: 1, 2: 40, 3: 700}
    df = spark.createDataFrame([(g, g * 1000 + i, n) for g, n in sizes.items() for i in range(n)], "g long, id long, size long")
    got = meet_blocks(df, "g", "id", "size", 50, Count, "id long, seen long, later long").collect()
    assert len(got) == 741 and all(r["seen"] == sizes[r["id"] // 1000] for r in got)
    assert len({r["later"] for r in got if r["id"] >= 3000}) == 14


def test_runs_follow_the_target_recall():
    assert jaccard.runs_for(0.8, 2.5, 0.9) < jaccard.runs_for(0.8, 2.5, 0.9999) == 6
    with pytest.raises(ValueError):
        jaccard.runs_for(0.5, 1.0, 0.9)


def plain_vectors(rows, threshold=0.93):
    ok, links, count = [], [], collections.Counter()
    for i, v, lab in rows:
        a = np.array([np.nan if x is None else x for x in v], float) if v else np.zeros(1)
        ok.append(i is not None and lab is not None and np.isfinite(a).all() and a.any())
    for x in range(len(rows)):
        for y in range(x):
            if ok[x] and ok[y] and rows[x][2] == rows[y][2] and len(rows[x][1]) == len(rows[y][1]):
                a, b = np.array(rows[x][1], float), np.array(rows[y][1], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links.append((rows[x][0], rows[y][0]))
                    count[x] += 1
                    count[y] += 1
    near = roots({i for i, _, _ in rows if i is not None}, links)
    return collections.Counter((i, count[k], near.get(i)) for k, (i, _, _) in enumerate(rows))


def test_near_vectors_match_brute_force_on_the_table(spark):
    emb = table(spark, SF_SMALL.replace("0.001", "0.01"), "embeddings")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in emb.collect()]
    got = vectors.near_vectors(emb).collect()
    assert collections.Counter(tuple(r)[:3] for r in got) == plain_vectors(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_near_vectors_find_borderline_pairs_in_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 32)
    rng = np.random.default_rng(2)
    center = rng.normal(size=48)
    rows = [(i, (center + rng.normal(size=48) * s).tolist(), 1) for i, s in enumerate(np.linspace(0.05, 0.45, 160))]
    rows += [(1000 + i, rows[3][1], 1) for i in range(50)] + [(2000 + i, rng.normal(size=48).tolist(), i % 2) for i in range(150)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(int(i), v, int(c)) for i, v, c in rows], "vec_id long, embedding array<double>, label int")
    assert collections.Counter(tuple(r)[:3] for r in vectors.near_vectors(df).collect()) == plain_vectors(rows)


def test_near_vector_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (1, v, 1), (2, [2.0, 4.0, 6.0], 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1),
            (8, [1.0, None, 3.0], 1), (9, [1.0, float("nan"), 3.0], 1), (10, [1.0, float("inf"), 3.0], 1), (None, v, 1),
            (11, [1e300, 2e300, 3e300], 1), (12, [1.0, 2.0, 3.0, 0.0], 1), (13, [-1.0, -2.0, -3.0], 1), (14, [5.0], 1), (15, [7.0], 1),
            (16, [-0.0, 1.0, 0.0], 1), (17, [0.0, 1.0, -0.0], 1)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<double>, label int, rep string")
    assert collections.Counter(tuple(r)[:3] for r in vectors.near_vectors(df).collect()) == plain_vectors(rows)
    assert vectors.near_vectors(df.limit(0)).count() == 0
