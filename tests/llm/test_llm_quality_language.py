"""Quality cascade, language id and toxicity."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL

from shelfwise.llm import langid, quality, toxicity
from shelfwise.llm.common import table

WORD = re.compile(r"[^ \t\n\x0b\x0c\r]+")


def plain_base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen = collections.Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed)


def test_quality_base_matches_plain_python(spark):
    docs = table(spark, SF_SMALL, "documents")
    want = {r["doc_id"]: plain_base(r["text"]) for r in docs.collect()}
    got = quality.quality(docs).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:7] == want[r["doc_id"]]
        assert r["kept"] == (r["rejected_by"] is None) and not (r["kept"] and r["base_failed"])


def test_quality_verdict_does_not_depend_on_the_order(spark):
    docs = table(spark, SF_SMALL, "documents")
    want = {r["doc_id"]: not quality.base_failed(r["n_words"], r["n_repeat_words"]) for r in quality.quality(docs).collect()}
    texts = {r["doc_id"]: quality.Text(r["text"]) for r in docs.collect()}
    for r in quality.quality(docs, quality.RULES[::-1]).collect():
        assert r["kept"] == (want[r["doc_id"]] and not any(x.rejects(texts[r["doc_id"]]) for x in quality.RULES))


def test_rules_are_ordered_by_rejections_per_cost():
    rules = [quality.Rule(n, lambda t: False) for n in "abcd"]
    figures = [("a", 1.0, 0.5), ("b", 0.1, 0.2), ("c", 0.01, 0.0), ("d", 0.001, 0.0)]
    assert [r.name for r in quality.order_rules(figures, rules)] == ["b", "a", "d", "c"]


def test_quality_edges(spark):
    again = "one two three four five six seven " * 40
    rows = [(1, None), (2, ""), (3, again), (3, again), (None, "a b\x0bc\n\n d"), (4, "wörd \x85x " * 6)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kept string")
    got = collections.Counter(tuple(r)[:7] for r in quality.quality(df).collect())
    assert got == collections.Counter((i, *plain_base(t)) for i, t in rows)
    assert quality.quality(df.limit(0)).count() == 0


def plain_profile(texts, top):
    n = collections.Counter()
    for t in texts:
        s = re.sub(r"[\W\d_]+", "\x01", "\x01" + t.lower() + "\x01")
        for k in (1, 2, 3):
            n.update(g for g in (s[i : i + k] for i in range(len(s) - k + 1)) if g != "\x01")
    code = lambda g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    return [code(g) for g, _ in sorted(n.items(), key=lambda x: (-x[1], code(x[0])))[:top]]


def test_out_of_place_distance_matches_plain_python():
    by = {"x": ["the thing is there, the end", "this and that"], "y": ["le chat est là", "la été à Paris"]}
    packed = {}
    for k, texts in by.items():
        parts = [langid.grams(t) for t in texts]
        codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        packed[k] = codes, np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)
    prof = langid.Profiles.of(packed, 40)
    plain = {k: plain_profile(v, 40) for k, v in by.items()}
    for text in ("the cat", "été", "là-bas 12 the", "zzz"):
        own = plain_profile([text], 40)
        far = {k: sum(abs(v.index(g) - i) if g in v else 40 for i, g in enumerate(own)) for k, v in plain.items()}
        best = min(sorted(far), key=far.get)
        assert prof.predict(text) == (best, pytest.approx(1 - far[best] / (40 * len(own))))


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = "Über die Brücke, the end. " * 50
    whole = langid.grams(text)
    monkeypatch.setattr(langid, "_PIECE", 7)
    parts = langid.grams(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_language_accuracy_on_held_out_rows(spark):
    docs = table(spark, SF_SMALL.replace("0.001", "0.01"), "documents")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = langid.predict_language(docs, langid.fit_profiles(docs)).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)


def test_language_edges(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !?", None), (4, "the end of the day", "en"), (None, "the day", "fr"), (5, "fin", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    got = langid.predict_language(df, langid.fit_profiles(df)).collect()
    assert len(got) == 6 and {r["doc_id"]: r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)} == {1: "und", 2: "und", 3: "und"}
    empty = df.limit(0)
    assert langid.predict_language(empty, langid.fit_profiles(empty)).count() == 0
    assert {r["lang_pred"] for r in langid.predict_language(df, langid.fit_profiles(empty)).collect()} == {"und"}


def test_cumulative_link_recovers_ordered_thresholds():
    rng = np.random.default_rng(0)
    x = rng.random((6000, 6)) < 0.5
    true_w, true_cuts = np.array([2.0, 1.0, 0.0, -1.0, 0.5, 0.0]), np.array([-0.5, 1.0, 2.5])
    z = x @ true_w + rng.logistic(size=6000)
    grades = (z[:, None] > true_cuts).sum(1)
    w, cuts = toxicity.fit_cumulative([np.flatnonzero(r) for r in x], grades, np.ones(6000), 6, 4, l2=0.0, steps=1500)
    assert (np.diff(cuts) > 0).all()
    assert np.abs(w - true_w).max() < 0.2 and np.abs(cuts - true_cuts).max() < 0.25


def test_toxicity_on_rows_outside_the_sample(spark):
    sf = SF_SMALL.replace("0.001", "0.1")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    train = labels.where("doc_id % 4 <> 1")
    model = toxicity.fit_toxicity(docs, train)
    assert (np.diff(model.cuts) > 0).all()
    truth = {r["doc_id"]: r["toxic"] for r in labels.where("doc_id % 4 = 1").collect()}
    got = {r["doc_id"]: r for r in toxicity.predict_toxicity(docs, model).collect()}
    assert len(got) == docs.count()
    assert all(0 <= r["severity"] <= len(model.cuts) for r in got.values())
    hit = sum(got[i]["toxic"] for i, t in truth.items() if t) / sum(truth.values())
    false = sum(got[i]["toxic"] for i, t in truth.items() if not t) / sum(1 - t for t in truth.values())
    assert hit >= 0.85 and false <= 0.005  # some 300 toxic texts in four languages to learn from


def test_toxicity_edges(spark):
    rows = [(i, "calm words here " + ("vile scum" if i % 3 == 0 else "kind friend"), "x") for i in range(60)]
    rows += [(100, None, "x"), (101, "", "x"), (None, "vile scum", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), None) for i in range(60)] + [(None, 1, 1), (100, 0, 1)],
                                   "doc_id long, toxic int, text int")
    got = {r["doc_id"]: r["toxic"] for r in toxicity.predict_toxicity(df, toxicity.fit_toxicity(df, labels)).collect()}
    assert got == {**{i: i % 3 == 0 for i in range(60)}, 100: False, 101: False, None: True}
    none = toxicity.fit_toxicity(df, labels.limit(0))
    assert none is None and not any(r["toxic"] for r in toxicity.predict_toxicity(df, none).collect())
    assert toxicity.predict_toxicity(df.limit(0), none).count() == 0


def test_toxicity_with_little_to_learn_from(spark):
    texts = [f"text number {i} speaks of {'dirt' if i % 2 else 'bread'} and {chr(97 + i) * 6}" for i in range(24)]
    odd = [(100, None), (101, ""), (102, "never seen words"), (102, "never seen words"), (None, "bread " * 3)]
    df = spark.createDataFrame([*enumerate(texts), *odd], "doc_id long, text string")
    for flags in ([i % 2 for i in range(24)], [1] * 24, [0] * 24, [int(i < 2) for i in range(24)], []):
        labels = spark.createDataFrame(list(enumerate(flags)), "doc_id long, toxic int")
        model = toxicity.fit_toxicity(df, labels)
        got = toxicity.predict_toxicity(df, model).collect()
        assert len(got) == 29 and not any(r["toxic"] for r in got if r["doc_id"] in (100, 101, 102))
        assert not any(r["toxic"] for r in got) or flags[:2] == [0, 1]
        assert df.where(toxicity.toxic_text(spark, model)("text")).count() == sum(r["toxic"] for r in got)


def test_predictions_follow_from_the_model_by_plain_python(spark):
    weights = {"vile": 2.5, "scum": 1.25, "scum*": 0.5, "kind": -3.0, "vile*2": 0.75, "filt*": 0.25, "filt*2": 1.5}
    cuts = [1.0, 2.0, 3.5]
    model = toxicity.OrdinalModel(weights, np.array(cuts), 0.6)
    texts = [None, "", "vile", "Vile SCUM kind", "filthy filtering", "vilely vileness", "kind kind scummy", "é vile " * 5000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(2, "vile", 1)], "doc_id long, text string, severity int")

    def plain(text):
        words = set(re.findall("[^\\W\\d_]+", (text or "").lower()))
        found = set(words)
        for n in (4, 5):
            stems = collections.Counter(w[:n] for w in words if len(w) > n)
            found |= {s + "*" for s in stems} | {f"{s}*{k}" for s, c in stems.items() for k in (2, 3) if c >= k}
        z = sum(weights.get(f, 0.0) for f in found)
        tails = [1 / (1 + math.exp(c - z)) for c in cuts]
        return sum(tails), tails[0], sum(t >= 0.5 for t in tails), tails[0] >= 0.6

    got = toxicity.predict_toxicity(df, model).collect()
    assert len(got) == 9
    for r in got:
        want = plain(texts[r["doc_id"]])
        assert (r["severity"], r["p_toxic"]) == pytest.approx(want[:2]) and (r["grade"], r["toxic"]) == want[2:]
