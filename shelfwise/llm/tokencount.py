"""Token counts of a word-level BPE vocabulary, with whole words counted by look-up."""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words kept per Python worker with their counts, and the characters they may hold together; the store is emptied
#: after a text that leaves more.
KEEP_WORDS, KEEP_CHARS = 300_000, 8_000_000
#: Pre-tokens of up to so many bytes are merged by a plain scan.
SHORT = 40
_NONE, _LOW = 1 << 62, (1 << 20) - 1


def byte_letters() -> list[str]:
    """The letter that byte-level BPE files write for each byte: printable Latin-1 stands for itself,
    the others are numbered from U+0100 on."""
    out, extra = [], 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


class Vocabulary:
    """What counting needs from a tokenizer file: merges, special strings, split pattern."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec.get("post_processor"):
            raise ValueError("token counts: not a lower-casing word BPE file")
        self.suffix = model["end_of_word_suffix"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        # symbols: 0-255 bytes, 256-511 bytes that end a word, then one for every merged string;
        # merges: both symbols -> rank and symbol of the result in one number, which sorts by rank
        letters = byte_letters()
        number = {c: i for i, c in enumerate(letters)} | {c + self.suffix: 256 + i for i, c in enumerate(letters)}
        self.merges: dict[int, int] = {}
        for rank, (a, b) in enumerate(pairs):
            made = number.setdefault(a + b, len(number))
            self.merges.setdefault(number[a] << 20 | number[b], rank << 20 | made)
        self.vocab = model["vocab"]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.letters = letters

    def merge_count(self, word: str) -> int:
        """Tokens of one pre-token: lowest-ranked pair first, leftmost on ties."""
        sym = list(word.encode("utf-8", "surrogatepass"))
        if not sym:
            return 0
        sym[-1] += 256
        if len(sym) > SHORT:
            return self._merge_long(sym)
        get = self.merges.get
        pair = [get(a << 20 | b, _NONE) for a, b in zip(sym, sym[1:])]
        while pair:
            r = min(pair)
            if r == _NONE:
                break
            i = pair.index(r)
            sym[i] = r & _LOW
            del sym[i + 1], pair[i]
            if i < len(pair):
                pair[i] = get(sym[i] << 20 | sym[i + 1], _NONE)
            if i:
                pair[i - 1] = get(sym[i - 1] << 20 | sym[i], _NONE)
        return len(sym)

    def _merge_long(self, sym: list[int]) -> int:
        """The same merges with a queue that holds every pair once: n log n for a pre-token of any length."""
        n, gone, get = len(sym), -1, self.merges.get
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, i) for i in range(n - 1) if (r := get(sym[i] << 20 | sym[i + 1])) is not None]
        heapq.heapify(queue)
        count = n
        while queue:
            r, i = heapq.heappop(queue)
            j = right[i]
            if sym[i] == gone or j >= n or get(sym[i] << 20 | sym[j]) != r:
                continue  # one of the two has been merged meanwhile
            sym[i], sym[j] = r & _LOW, gone
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
                if (q := get(sym[i] << 20 | sym[right[i]])) is not None:
                    heapq.heappush(queue, (q, i))
            if left[i] >= 0 and (q := get(sym[left[i]] << 20 | sym[i])) is not None:
                heapq.heappush(queue, (q, left[i]))
            count -= 1
        return count

    def whole_words(self) -> list[str]:
        """The strings that are proven to encode alone as one token: every vocabulary entry that ends a
        word, is valid UTF-8 and comes out of the merges as a single symbol."""
        back = {c: b for b, c in enumerate(self.letters)}
        out = []
        for entry in self.vocab:
            if entry.endswith(self.suffix):
                try:
                    word = bytes(back[c] for c in entry.removesuffix(self.suffix)).decode()
                except (KeyError, UnicodeDecodeError):
                    continue
                if word and self.merge_count(word) == 1:
                    out.append(word)
        return out


def normalized(text: str) -> str:
    """NFC and lower case by character; white space needs no care, as it only separates."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()  # str.lower() alone would make a final sigma


class Counter:
    """Counts texts: whole words by look-up, other pre-tokens by merging, each distinct one once."""

    def __init__(self, vocab: Vocabulary, whole: list[str]):
        self.vocab, self.whole = vocab, whole
        self.words: dict[str, int] = dict.fromkeys(whole, 1)
        self.chars = 0
        self.find = regex.compile(vocab.pattern).findall
        self.special = regex.compile("|".join(map(regex.escape, sorted(vocab.specials, key=len, reverse=True))) or "(?!)")

    def count(self, text: str) -> int:
        parts = self.special.split(text)
        total, words = len(parts) - 1, self.words
        for part in parts:
            found = self.find(normalized(part))
            try:
                total += sum([words[w] for w in found])
            except KeyError:
                for w in found:
                    if w not in words:
                        words[w] = self.vocab.merge_count(w)
                        self.chars += len(w)
                total += sum([words[w] for w in found])
        if len(words) > len(self.whole) + KEEP_WORDS or self.chars > KEEP_CHARS:
            self.words, self.chars = dict.fromkeys(self.whole, 1), 0
        return total


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row; whole texts, no begin or end tokens.

    The file is read and the whole-word table proven once on the driver; both are broadcast, their
    size is that of the vocabulary. Special strings inside texts count as one token. A null text has
    0 bytes and 0 tokens; repeated rows give equal rows; other columns are not read."""
    with open(tokenizer_path, encoding="utf-8") as f:
        content = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((content, Vocabulary(content).whole_words()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            if counter is None:
                counter = Counter(Vocabulary(shared.value[0]), shared.value[1])
            texts = batch.column(1).to_pylist()
            n = [counter.count(t) if t else 0 for t in texts]
            size = [len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
