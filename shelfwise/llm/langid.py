"""Language identification by rank-order n-gram profiles (out-of-place distance)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters are packed 21 bits each; 1 stands for any run of other characters.
_BITS, _GAP = 21, 1
#: Characters of a text that are cut into n-grams at a time; counts of the pieces are added up.
_PIECE = 1 << 20
_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTERS


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(code, count) of all 1- to 3-grams of the lower-cased text; words keep a gap at both ends."""
    low = text.lower() + " "
    before, parts = np.array([_GAP], np.int64), []
    for i in range(0, len(low), _PIECE):
        new = np.frombuffer(low[i : i + _PIECE].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        new[~_letters()[new]] = _GAP
        new = new[(new != _GAP) | (np.concatenate((before[-1:], new[:-1])) != _GAP)]  # one gap for a run
        line = np.concatenate((before, new))
        two = line[:-1] << _BITS | line[1:]
        three = two[:-1] << _BITS | line[2:]
        old = len(before)  # n-grams that end in what is new
        parts.append(np.unique(np.concatenate((new[new != _GAP], two[old - 1 :], three[max(0, old - 2) :])), return_counts=True))
        before = line[-2:]
    if len(parts) == 1:
        return parts[0]
    codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)


def ranked(codes: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` most frequent codes, most frequent first, ties by code."""
    if len(codes) > top:
        least = np.partition(counts, -top)[-top]
        few = counts >= least
        codes, counts = codes[few], counts[few]
    return codes[np.lexsort((codes, -counts))][:top]


@dataclass
class Profiles:
    """Rank of every profile n-gram in every language; n-grams outside a profile count as ``top``."""

    langs: list[str]
    codes: np.ndarray
    ranks: np.ndarray  # codes x languages
    top: int

    @staticmethod
    def of(by_lang: dict[str, tuple[np.ndarray, np.ndarray]], top: int) -> Profiles:
        langs = sorted(by_lang)
        lists = [ranked(*by_lang[x], top) for x in langs]
        codes = np.unique(np.concatenate(lists)) if lists else np.empty(0, np.int64)
        ranks = np.full((len(codes), len(langs)), top, np.int32)
        for j, x in enumerate(lists):
            ranks[np.searchsorted(codes, x), j] = np.arange(len(x))
        return Profiles(langs, codes, ranks, top)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): the smallest sum of rank differences; ties go to the first language.
        The score is 1 at distance 0 and 0 when no n-gram is in the profile."""
        if text is None or not self.langs:
            return "und", 0.0
        codes, counts = grams(text)
        own = ranked(codes, counts, self.top)
        if not ((own < 1 << _BITS) & (own != _GAP)).any() and not ((codes < 1 << _BITS) & (codes != _GAP)).any():
            return "und", 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        known = self.codes[at] == own
        there = self.ranks[at[known]]
        gap = np.where(there < self.top, np.abs(there - np.arange(len(own))[known, None]), self.top)
        far = gap.sum(axis=0) + self.top * (len(own) - int(known.sum()))
        best = int(np.argmin(far))
        return self.langs[best], float(1 - far[best] / (self.top * len(own)))


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def fit_profiles(docs: DataFrame, rows_per_lang: int = 1500, top: int = 300, max_langs: int = 1000,
                 id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles from a bounded sample: about ``rows_per_lang`` rows of each language, drawn by a hash of
    the id among the rows with a text and a language whose :func:`fold` is not 1. Whole texts count.
    More than ``max_langs`` languages raise ValueError. The driver gets n-gram counts of the sample."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold("doc_id") != 1))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(max_langs + 1).collect()
    if len(sizes) > max_langs:
        raise ValueError(f"language id: more than {max_langs} languages")
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 40)).cast("double") / float(1 << 40)
    rate = F.lit(0.0)
    for r in sizes:
        rate = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, rows_per_lang / r["n"]))).otherwise(rate)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list] = {}
            for text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                by.setdefault(lang, []).append(grams(text))
            for lang, parts in by.items():
                codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(codes)), "code": codes, "n": n})

    parts = rows.where(drawn < rate).select("text", "lang").mapInArrow(count, "lang string, code long, n long")
    total = parts.groupBy("lang", "code").agg(F.sum("n").alias("n")).where(F.col("n") > 1)
    by_lang: dict[str, tuple[list, list]] = {}
    for r in total.collect():
        codes, counts = by_lang.setdefault(r["lang"], ([], []))
        codes.append(r["code"])
        counts.append(r["n"])
    return Profiles.of({k: (np.array(c, np.int64), np.array(n, np.int64)) for k, (c, n) in by_lang.items()}, top)


def predict_language(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row, from the whole text alone.

    lang_pred is ``und`` with score 0 for a null text, a text without a letter, or without profiles.
    held_out: fold 1 of the id (false for a null id). Repeated rows give equal rows."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shared.value.predict(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(fold(id_col) == 1, F.lit(False)).alias("held_out"),
                      F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
