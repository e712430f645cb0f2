"""Quality rules as a short-circuit cascade ordered by rejections per cost."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"


class Text:
    """One text with what several rules share, worked out at most once."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.raw = self.text.encode("utf-8", "surrogatepass")
        self.words = self.raw.split()  # bytes.split() cuts at ASCII white space only
        self.n_words = len(self.words)
        self.word_chars = len(self.text) - (len(self.raw) - len(self.raw.translate(None, _SPACE)))
        self.n_symbols = len(self.raw) - len(self.raw.translate(None, _SYMBOLS))
        self._lines: list[bytes] | None = None

    @property
    def lines(self) -> list[bytes]:
        """Lines that hold a word."""
        if self._lines is None:
            self._lines = [x for x in self.raw.split(b"\n") if x.strip()]
        return self._lines

    def dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    def repeat_words(self, n: int = 5) -> int:
        """Words inside a window of n words that occurs twice or more, its first occurrence included."""
        w = self.words
        grams = list(zip(*(w[i:] for i in range(n))))
        if len(set(grams)) == len(grams):
            return 0
        seen: dict[tuple, int] = {}
        for g in grams:
            seen[g] = seen.get(g, 0) + 1
        covered, reach = 0, 0
        for p, g in enumerate(grams):
            if seen[g] > 1:
                covered += p + n - max(p, reach)
                reach = p + n
        return covered


@dataclass(frozen=True)
class Rule:
    """``rejects`` tells whether a text fails; it must depend on the text alone."""

    name: str
    rejects: Callable[[Text], bool]


def _mean_length(t: Text) -> bool:
    return not 2 * t.n_words <= t.word_chars <= 12 * t.n_words


def _symbol_heavy(t: Text) -> bool:
    return 10 * t.n_symbols > t.n_words * 3


def _repeated_lines(t: Text) -> bool:
    return 10 * t.dup_lines() > 6 * len(t.lines)


def _digit_heavy(t: Text) -> bool:
    digits = len(t.raw) - len(t.raw.translate(None, b"0123456789"))
    return 2 * digits > t.word_chars


def _few_distinct(t: Text) -> bool:
    return t.n_words >= 20 and 10 * len(set(t.words)) < min(t.n_words, 400)


def _open_ended(t: Text) -> bool:
    return len(t.lines) >= 5 and 10 * sum(x.rstrip().endswith((b"...", "…".encode())) for x in t.lines) > 3 * len(t.lines)


RULES: tuple[Rule, ...] = (
    Rule("mean_word_length", _mean_length), Rule("symbols", _symbol_heavy), Rule("duplicate_lines", _repeated_lines),
    Rule("digits", _digit_heavy), Rule("distinct_words", _few_distinct), Rule("ellipsis_lines", _open_ended))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 10 or 100 * n_repeat_words > 20 * n_words


def measure(texts: Sequence[str | None], rules: Sequence[Rule]) -> list[tuple[str, float, float]]:
    """(rule, seconds a text, share rejected) of every rule on the texts that pass the base check."""
    made = [Text(x) for x in texts]
    made = [t for t in made if not base_failed(t.n_words, t.repeat_words())]
    out = []
    for rule in rules:
        began = time.perf_counter()
        hit = sum(rule.rejects(t) for t in made)
        out.append((rule.name, (time.perf_counter() - began) / max(1, len(made)), hit / max(1, len(made))))
    return out


def order_rules(figures: Sequence[tuple[str, float, float]], rules: Sequence[Rule]) -> list[Rule]:
    """Most rejections per second first; among rules that reject nothing, the cheaper first."""
    by = {name: (-(share / max(cost, 1e-9)), cost, name) for name, cost, share in figures}
    return sorted(rules, key=lambda r: by.get(r.name, (0.0, 0.0, r.name)))  # an empty table gives no figures


def measure_sample(docs: DataFrame, rules: Sequence[Rule], text_col: str, rows: int) -> list[tuple[str, float, float]]:
    """:func:`measure` on at most ``rows`` whole texts, on an executor; only the figures come back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [x for batch in batches for x in batch.column(0).to_pylist()]
        names, costs, shares = zip(*measure(texts, rules))
        yield pa.RecordBatch.from_pydict({"rule": list(names), "cost": list(costs), "share": list(shares)})

    some = docs.select(F.col(text_col).cast("string").alias("text")).limit(rows).coalesce(1)
    return [tuple(r) for r in some.mapInArrow(run, "rule string, cost double, share double").collect()]


def quality(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 200, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rejected_by).

    Words are runs of anything but ASCII white space. The base check fails a text with fewer than
    10 words or with over 20 % of its words in repeated windows of five. The others go through the
    rules until one rejects. Each rule's cost and rejections are first measured on a bounded sample
    (``sample_rows`` texts) and the rules ordered by rejections per cost. The order decides how much
    is computed and which of several failing rules is named in rejected_by, never which texts stay.

    One row for every row of ``docs``, whole texts. A null text has no words and fails the base
    check. Repeated rows give equal rows; other columns are not read; no rows give no rows."""
    ordered = order_rules(measure_sample(docs, rules, text_col, sample_rows), rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            for text in batch.column(1).to_pylist():
                t = Text(text)
                repeats = t.repeat_words()
                failed = base_failed(t.n_words, repeats)
                by = "base" if failed else next((r.name for r in ordered if r.rejects(t)), None)
                for c, v in zip(cols, (t.n_words, t.word_chars, t.n_symbols, t.dup_lines(), repeats, failed, by is None, by)):
                    c.append(v)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()]
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["doc_id", *names])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                               "n_repeat_words long, base_failed boolean, kept boolean, rejected_by string")
