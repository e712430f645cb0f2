"""Toxicity grades by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import saved

_WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the word beginnings that are features beside whole words, for inflected and compound forms.
_STEMS = (4, 5)
#: From so many different words of a text with one beginning on, a feature of its own: a beginning that clean
#: texts have once and toxic texts several times.
_FAMILIES = (2, 3)
#: Bounds of the learned decision threshold.
THRESHOLDS = (0.03, 0.5)
#: Penalty (the first for small samples) and threshold are learned on held-out folds, from so many rows a class
#: on: the best recall at this share of false calls.
PENALTIES, FOLDS, FOLD_ROWS, FALSE_SHARE = (1e-5, 1e-4), 3, 60, 0.004


def _stems(word: str) -> list[str]:
    return [word[:n] + "*" for n in _STEMS if len(word) > n]


def _families(words: Iterable[str]) -> list[str]:
    """The beginnings that two, or three, of the (distinct) words share, marked by ``*2`` and ``*3``."""
    shared = Counter(stem for w in words for stem in _stems(w))
    return [f"{stem}{k}" for stem, n in shared.items() for k in _FAMILIES if n >= k]


def features(text: str | None) -> Counter:
    """Occurrences of the lower-cased words and, marked by ``*``, of the beginnings of longer words; 1 for
    beginnings that several different words share."""
    out = Counter(_WORD.findall((text or "").lower()))
    words = list(out.items())
    for w, n in words:
        for stem in _stems(w):
            out[stem] += n
    out.update(_families(w for w, _ in words))
    return out


@dataclass
class OrdinalModel:
    """P(grade >= k) = sigmoid(weights . x - cuts[k - 1]); x holds 0/1 features, cuts increase. A text is
    called toxic from P(grade >= 1) = ``threshold`` on."""

    weights: dict[str, float]
    cuts: np.ndarray
    threshold: float = 0.5

    def tail(self, text: str | None) -> np.ndarray:
        words = set(_WORD.findall((text or "").lower()))
        words.update([*(stem for w in words for stem in _stems(w)), *_families(words)])
        get = self.weights.get
        z = sum(sorted(v for w in words if (v := get(w)) is not None))
        return 1 / (1 + np.exp(np.clip(self.cuts - z, -500, 500)))


def fit_cumulative(rows: list[np.ndarray], grades: np.ndarray, sample_weight: np.ndarray, n_features: int,
                   n_grades: int, l2: float = 1e-5, steps: int = 600, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """(weights, cuts) of the proportional-odds model by full-batch Adam on the mean log loss.

    One weight vector serves all thresholds; cuts are the first one plus exponentials, which keeps
    them in order. ``rows`` lists the indices of each row's features."""
    size = np.array([len(r) for r in rows])
    idx = np.concatenate(rows).astype(np.int64) if len(rows) else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), size)
    sw = sample_weight / sample_weight.sum()
    p = np.concatenate((np.zeros(n_features), [0.0], np.zeros(n_grades - 2)))
    m, v = np.zeros_like(p), np.zeros_like(p)
    sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -500, 500)))
    for t in range(1, steps + 1):
        w, gaps = p[:n_features], np.exp(p[n_features + 1 :])
        cuts = p[n_features] + np.concatenate(([0.0], np.cumsum(gaps)))
        z = np.bincount(owner, w[idx], minlength=len(rows))
        full = np.concatenate(([-np.inf], cuts, [np.inf]))
        up, lo = sig(full[grades + 1] - z), sig(full[grades] - z)  # P(grade <= g), P(grade < g)
        prob = np.maximum(up - lo, 1e-12)
        d_up, d_lo = up * (1 - up) / prob, lo * (1 - lo) / prob
        g_z = sw * (d_up - d_lo)  # d loss / d z
        g_cut = np.zeros(n_grades + 1)
        np.add.at(g_cut, grades + 1, -sw * d_up)
        np.add.at(g_cut, grades, sw * d_lo)
        g_cut = g_cut[1:-1]
        later = np.cumsum(g_cut[::-1])[::-1]
        grad = np.concatenate((np.bincount(idx, g_z[owner], minlength=n_features) + l2 * w, [later[0]], later[1:] * gaps))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        p = p - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    cuts = p[n_features] + np.concatenate(([0.0], np.cumsum(np.exp(p[n_features + 1 :]))))
    return p[:n_features], cuts


def draw_labelled(docs: DataFrame, labels: DataFrame, per_class: int, id_col: str, text_col: str,
                  label_col: str, least: int) -> DataFrame:
    """(doc_id, text, toxic, rate): about ``per_class`` labelled rows of either class, drawn by a hash of
    the id; ``rate`` is the share of the class that was drawn. Of texts that share a signature of minimal
    word hashes, which copies and near copies do, one stays, so that a copied text's chance words do not
    pass for evidence; but where a class would keep fewer than ``least`` texts, its copies are all there is to learn
    from, and none is left out. Written once, as several passes read it."""
    lab = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
    lab = lab.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in lab.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rates = [min(1.0, per_class / max(1, sizes.get(c, 0))) for c in (0, 1)]
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 40)).cast("double") / float(1 << 40)
    rate = F.when(F.col("toxic") == 1, rates[1]).otherwise(rates[0])
    some = lab.withColumn("rate", rate).where(drawn < F.col("rate"))
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [_signatures(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(m, pa.string()) for m in zip(*marks))] if marks else
                                             [*batch.columns, pa.array([], pa.string()), pa.array([], pa.string())],
                                             ["doc_id", "text", "toxic", "rate", "s0", "s1"])

    rows = F.broadcast(some).join(text.where(F.col("text").isNotNull()), "doc_id").select("doc_id", "text", "toxic", "rate")
    rows = saved(rows.mapInArrow(sign, "doc_id long, text string, toxic int, rate double, s0 string, s1 string"))
    distinct = rows
    for s in ("s0", "s1"):
        first = distinct.groupBy("toxic", s).agg(F.min("doc_id").alias("doc_id")).select("doc_id")
        distinct = distinct.join(first, "doc_id", "left_semi")
    distinct = saved(distinct.drop("s0", "s1"))
    left = distinct.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    return distinct if min((r["n"] for r in left), default=0) >= least else rows.drop("s0", "s1")


def _signatures(text: str) -> tuple[str, str]:
    """Two tuples of three minimal hashes of the words; near copies share one of them with high probability."""
    words = [w.encode() for w in set(_WORD.findall(text.lower()))]
    return tuple(",".join(str(min((zlib.crc32(w, 10 * n + k) for w in words), default=0)) for k in range(3)) for n in (1, 2))


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 3000, max_features: int = 3000,
                 min_docs: int = 4, min_z: float = 4.5, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic") -> OrdinalModel | None:
    """Learn from a bounded sample of labelled rows (``per_class`` of either class, whole texts).

    The labels say toxic or not; grades 1 to 3 are read off the toxic texts themselves: by how many
    occurrences of marker features (those that set the classes apart most clearly) a text has,
    relative to the terciles of the toxic sample. Grade 0 is the clean class. Features: the
    ``max_features`` with the largest z-score between the classes, ``min_z`` at least, which keeps out words
    that stand in toxic texts by chance. The driver gets these and, for each
    sampled row, the indices of its features. The threshold is the 99.6 % quantile of the clean rows'
    probabilities by models that have not seen them (``FOLDS``), under the penalty with the best recall there;
    for small samples, a fifth above the 99.9 %
    quantile of the clean sample's own probabilities, within ``THRESHOLDS``. It always lies above the probability
    of a text without features, so that such a text, a null or empty one among them, is never toxic. None (nothing
    is toxic) when a class is missing or no feature sets the classes apart. A class with fewer than 2 * ``min_docs``
    distinct texts is learned with its copies: twenty copies of one toxic text teach its words."""
    sample = draw_labelled(docs, labels, per_class, id_col, text_col, label_col, 2 * min_docs)
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return None

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                by[toxic].update(features(text).keys())
            names = sorted(by[0].keys() | by[1].keys())
            yield pa.RecordBatch.from_pydict({"f": pa.array(names, pa.string()), "n0": pa.array([by[0][f] for f in names], pa.int64()),
                                              "n1": pa.array([by[1][f] for f in names], pa.int64())})

    counted = sample.select("text", "toxic").mapInArrow(explode, "f string, n0 long, n1 long")
    counted = counted.groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(F.col("n0") + F.col("n1") >= min_docs)
    share = (F.col("n0") + F.col("n1")) / float(n0 + n1)
    z = (F.col("n1") / float(n1) - F.col("n0") / float(n0)) / F.sqrt(share * (1 - share) * (1 / n0 + 1 / n1) + 1e-12)
    top = counted.withColumn("z", z).where(F.abs("z") >= min_z).orderBy(F.abs("z").desc(), "f").limit(max_features).collect()
    names = [r["f"] for r in top]
    if not names:
        return None
    index = {f: i for i, f in enumerate(names)}
    # markers: clearly toxic (z) and next to never clean; a word outranks its own beginning
    marker = {r["f"] for r in top if r["z"] >= 5 and r["n1"] * n0 >= 20 * r["n0"] * n1}
    marker -= {stem for f in marker if not f.endswith("*") for stem in _stems(f)}

    def index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array([sum(n for f, n in x.items() if f in marker) for x in found], pa.int64()),
                 pa.array([sorted(index[f] for f in x if f in index) for x in found], pa.list_(pa.int32()))],
                ["toxic", "rate", "hits", "idx"])

    rows = sample.select("text", "toxic", "rate", "doc_id").sortWithinPartitions("doc_id").mapInArrow(
        index_rows, "toxic int, rate double, hits long, idx array<int>").collect()
    rows.sort(key=lambda r: (r["toxic"], r["hits"], r["idx"]))
    toxic = np.array([r["toxic"] for r in rows])
    hits = np.array([r["hits"] for r in rows])
    cut = np.unique(np.quantile(hits[toxic == 1], [1 / 3, 2 / 3]))
    grades = np.where(toxic == 1, 1 + np.searchsorted(cut, hits, side="left"), 0)
    grades = np.unique(grades, return_inverse=True)[1]  # grades without a row are left out
    weight = 1 / np.array([r["rate"] for r in rows])
    found, n_grades = [np.array(r["idx"], np.int64) for r in rows], int(grades.max()) + 1
    fold, best = np.arange(len(rows)) % FOLDS, None

    def learn(on: np.ndarray, l2: float) -> tuple[np.ndarray, np.ndarray]:
        return fit_cumulative([found[i] for i in on], grades[on], weight[on], len(names), n_grades, l2=l2)

    def judge(w: np.ndarray, cuts: np.ndarray, on: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(cuts[0] - np.array([w[found[i]].sum() for i in on]), -500, 500)))

    if min((toxic == 0).sum(), (toxic == 1).sum()) >= FOLD_ROWS:
        for l2 in PENALTIES:
            unseen = np.zeros(len(rows))
            for k in range(FOLDS):
                unseen[fold == k] = judge(*learn(np.flatnonzero(fold != k), l2), np.flatnonzero(fold == k))
            at = max(float(np.quantile(unseen[toxic == 0], 1 - FALSE_SHARE)), THRESHOLDS[0])
            recall = float((unseen[toxic == 1] >= at).mean())
            if best is None or recall > best[0]:
                best = recall, l2, at
    w, cuts = learn(np.arange(len(rows)), best[1] if best else PENALTIES[0])
    threshold = best[2] if best else float(np.clip(
        1.2 * np.quantile(judge(w, cuts, np.flatnonzero(toxic == 0)), 0.999), *THRESHOLDS))
    model = OrdinalModel({f: float(x) for f, x in zip(names, w) if x}, cuts, threshold)
    model.threshold = max(threshold, float(np.nextafter(model.tail(None)[0], 1)))
    return model


def toxic_text(spark: SparkSession, model: OrdinalModel | None) -> Callable[[Column], Column]:
    """The model's verdict as a column function of the text: rows are judged where they stand."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def toxic(texts: pd.Series) -> pd.Series:
        model = shared.value
        return texts.map(lambda t: bool(model and model.tail(t)[0] >= model.threshold)).astype(bool)

    return toxic


def predict_toxicity(docs: DataFrame, model: OrdinalModel | None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, severity, p_toxic, grade, toxic) for every row, from the whole text.

    severity: expected grade, the sum of P(grade >= k). p_toxic: P(grade >= 1); toxic: p_toxic >= the model's
    threshold.
    grade: the number of thresholds passed with probability 0.5. A null or empty text has no features;
    without a model every row gets 0. Repeated rows give equal rows; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model = shared.value
            tails = [model.tail(t) if model else np.zeros(1) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([float(x.sum()) for x in tails], pa.float64()),
                 pa.array([float(x[0]) for x in tails], pa.float64()),
                 pa.array([int((x >= 0.5).sum()) for x in tails], pa.int32()),
                 pa.array([bool(model and x[0] >= model.threshold) for x in tails], pa.bool_())],
                ["doc_id", "severity", "p_toxic", "grade", "toxic"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, severity double, p_toxic double, grade int, toxic boolean")
