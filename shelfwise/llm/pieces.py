"""SentencePiece BPE encoding and decoding by suffix-array matching over batches of text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_NEVER = np.int64(1) << 60
#: Bytes of text whose distinct segments are encoded together, and characters per suffix array.
TEXT_BYTES, INDEX_CHARS = 6 << 20, 400_000
#: Segments longer than this are cut between characters that no piece holds side by side.
CUT = 48
#: Distinct segments kept with their ids by each Python worker, and the characters they may hold together.
KEEP, KEEP_CHARS = 400_000, 8_000_000


class PieceModel:
    """Tables of a SentencePiece BPE model (dummy prefix, byte fallback, no other normalisation).

    Tokens 0 .. v - 1 are the model's ids; behind them stand characters that occur in pieces but are
    none, and last one token for any other character. ``rank`` orders merges (the best score first),
    ``left`` and ``right`` are the two tokens that a piece is last merged from."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        v = sp.get_piece_size()
        self.size = v
        self._forget()
        normal = [i for i in range(v) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        text = {sp.id_to_piece(i): i for i in normal}
        if any(SPACE in p.lstrip(SPACE) for p in text) or [sp.is_byte(i) for i in range(v)].count(True) != 256:
            raise ValueError("pieces: the model needs byte fallback and pieces within words")
        if sp.encode("  a ") != sp.encode(f"{SPACE * 2}a ") or sp.decode(sp.encode("  a ")) != "  a ":
            raise ValueError("pieces: the model normalises its input")
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.bytes = [b""] * v
        for p, i in text.items():
            self.bytes[i] = p.replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])
        chars = sorted({c for p in text for c in p})
        self.char_of = np.ones(0x110000, np.uint16)  # 0 separates segments, 1 is a character of no piece
        for n, c in enumerate(chars):
            self.char_of[ord(c)] = n + 2
        token = dict(text)
        for c in chars:
            token.setdefault(c, len(token) - len(text) + v)
        total = max(token.values()) + 2
        self.stray = total - 1
        self.base = np.full(len(chars) + 2, self.stray, np.int32)
        for n, c in enumerate(chars):
            self.base[n + 2] = token[c]
        scores = sorted({sp.get_score(i) for p, i in text.items() if len(p) > 1}, reverse=True)
        place = {s: r for r, s in enumerate(scores)}
        self.rank = np.full(total, -1, np.int64)
        for p, i in text.items():
            if len(p) > 1:
                self.rank[i] = place[sp.get_score(i)]
        self.left, self.right = np.arange(total), np.arange(total)
        self.total = total
        keys, made, reach = [], [], []
        for p, i in text.items():
            for k in range(1, len(p)):
                if p[:k] in token and p[k:] in token:
                    keys.append(token[p[:k]] * total + token[p[k:]])
                    made.append(i)
            if len(p) > 1:
                last = self._last_merge(p, token)
                if last is not None:
                    self.left[i], self.right[i] = last
                    reach.append(p)
        order = np.argsort(keys)
        self.pair_keys = np.array(keys, np.int64)[order]
        self.pair_rank = self.rank[np.array(made)[order]]
        # the pieces to look for, as big-endian character numbers that compare like the text
        self.width = max(map(len, reach))
        grid = np.zeros((len(reach), self.width), ">u2")
        for n, p in enumerate(reach):
            grid[n, : len(p)] = self.char_of[[ord(c) for c in p]]
        self.piece_len = np.array([len(p) for p in reach])
        self.piece_id = np.array([text[p] for p in reach])
        pad = np.arange(self.width)[None, :] >= self.piece_len[:, None]
        self.low = np.ascontiguousarray(grid).view(f"S{2 * self.width}").ravel()
        self.high = np.ascontiguousarray(np.where(pad, 0xFFFF, grid).astype(">u2")).view(f"S{2 * self.width}").ravel()
        self.beside = np.unique(np.concatenate([
            self.char_of[[ord(c) for c in p[:-1]]].astype(np.int64) << 16 | self.char_of[[ord(c) for c in p[1:]]] for p in reach]))

    def _last_merge(self, piece: str, token: dict[str, int]) -> tuple[int, int] | None:
        """The last merge when the piece is encoded alone, or None if that gives several tokens."""
        sym: list[str] = list(piece)
        last = None
        while len(sym) > 1:
            best = min(((int(self.rank[token[a + b]]), k) for k, (a, b) in enumerate(zip(sym, sym[1:])) if a + b in token), default=None)
            if best is None:
                return None
            k = best[1]
            last = token[sym[k]], token[sym[k + 1]]
            sym[k : k + 2] = [sym[k] + sym[k + 1]]
        return last

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the texts of tokens a and b, joined, are encoded as just these two tokens.

        The last merges on both sides of the border are undone, latest first. At each stage the two
        tokens that face the border stood there until the merge undone last; they would have merged
        across it if their own merge comes before that one, or level with one to the right."""
        ok = np.ones(len(a), bool)
        idx, x, y = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        until = np.full(len(a), _NEVER)
        while len(idx):
            at = np.searchsorted(self.pair_keys, key := x * self.total + y)
            at = np.minimum(at, len(self.pair_keys) - 1)
            cross = (self.pair_keys[at] == key) & (2 * self.pair_rank[at] < until)
            ok[idx[cross]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~cross & ((rx >= 0) | (ry >= 0))
            idx, x, y, rx, ry = idx[go], x[go], y[go], rx[go], ry[go]
            undo_left = rx > ry
            until = np.where(undo_left, 2 * rx, 2 * ry + 1)
            x, y = np.where(undo_left, self.right[x], x), np.where(undo_left, y, self.left[y])
        return ok

    def matches(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(end, length, token) of every occurrence of every piece, sorted by end, longest first.

        The suffixes of the text, as far as the longest piece, are sorted; a piece's occurrences are
        one range of that order, found by binary search."""
        n = len(chars)
        padded = np.zeros(n + self.width, ">u2")
        padded[:n] = chars
        window = np.lib.stride_tricks.sliding_window_view(padded, self.width)[:n]
        keys = np.ascontiguousarray(window).view(f"S{2 * self.width}").ravel()
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        lo, hi = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.high, "right")
        count = hi - lo
        which = np.repeat(np.arange(len(count)), count)
        start = order[np.arange(len(which)) - np.repeat(np.cumsum(count) - count - lo, count)]
        at = np.arange(n)  # every character is a token of its own
        end = np.concatenate((start + self.piece_len[which], at + 1))
        length = np.concatenate((self.piece_len[which], np.ones(n, np.int64)))
        token = np.concatenate((self.piece_id[which], self.base[chars]))
        by = np.argsort(end * 64 - length, kind="stable")
        return end[by], length[by], token[by]

    def _index(self, codes: np.ndarray, spot: np.ndarray, starts: np.ndarray,
               sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) for the segments of one indexed text; ``spot`` is false between them."""
        chars = np.where(spot, self.char_of[codes], np.uint16(0))
        end, length, token = self.matches(chars)
        first = np.searchsorted(end, np.arange(len(chars) + 2))
        last, back = np.full(len(chars) + 1, -1, np.int64), np.zeros(len(chars) + 1, np.int64)
        order = np.argsort(-sizes, kind="stable")
        begin, size = starts[order], sizes[order]
        longer = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), "right") if len(size) else []
        for t, live in enumerate(longer, 1):  # relax: all segments' t-th positions at once
            pos = begin[:live] + t
            edge, todo = first[pos], np.arange(live)
            while len(todo):
                start = pos[todo] - length[edge]
                inner = start > begin[todo]
                fits = start == begin[todo]
                if inner.any():
                    fits[inner] = self.compatible(last[start[inner]], token[edge[inner]])
                done = todo[fits]
                last[pos[done]], back[pos[done]] = token[edge[fits]], start[fits]
                todo, edge = todo[~fits], edge[~fits] + 1
        path, cur = np.zeros(len(chars) + 1, bool), starts + sizes
        at = starts
        while len(cur):
            path[cur] = True
            cur = back[cur]
            cur, at = cur[cur > at], at[cur > at]
        ends = np.flatnonzero(path)
        ids = last[ends]
        per = np.searchsorted(ends, starts + sizes, "right") - np.searchsorted(ends, starts, "right")
        stray = np.flatnonzero(ids >= self.size)
        if not len(stray):
            return ids.astype(np.int32), per
        code = codes[ends[stray] - 1]
        width = np.ones(len(ids), np.int64)
        width[stray] = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        out, off = np.repeat(ids, width), np.cumsum(width) - width
        for c in np.unique(code):
            for k, b in enumerate(chr(c).encode("utf-8", "surrogatepass")):
                out[off[stray[code == c]] + k] = self.byte_ids[b]
        own = np.repeat(np.arange(len(starts)), per)
        return out.astype(np.int32), np.bincount(own, width, minlength=len(starts)).astype(np.int64)

    def encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all segments, number of ids of each)."""
        lens = np.array([len(s) for s in segments], np.int64)
        codes = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
        cut = np.zeros(len(codes) + 1, bool)
        bounds = np.concatenate(([0], np.cumsum(lens)))
        cut[bounds] = True
        if len(codes) and lens.max() > CUT:
            long = np.repeat(lens > CUT, lens)
            chars = self.char_of[codes].astype(np.int64)
            pair = chars[:-1] << 16 | chars[1:]
            at = np.minimum(np.searchsorted(self.beside, pair), len(self.beside) - 1)
            cut[1:-1] |= long[1:] & (self.beside[at] != pair)
        starts = np.flatnonzero(cut)
        parts, sizes = [], []
        while len(starts) > 1:
            to = max(1, int(np.searchsorted(starts, starts[0] + INDEX_CHARS, "right")) - 1)
            size = np.diff(starts[: to + 1])
            place = starts[:to] - starts[0] + np.arange(to)  # a separator behind each segment
            text = np.zeros(int(size.sum()) + to, np.uint32)
            spot = np.ones(len(text), bool)
            spot[place + size] = False
            text[spot] = codes[starts[0] : starts[to]]
            ids, per = self._index(text, spot, place, size)
            parts.append(ids)
            sizes.append(per)
            starts = starts[to:]
        ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
        per = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
        piece_start = np.flatnonzero(cut)[:-1]
        owner = np.searchsorted(bounds[:-1], piece_start, "right") - 1
        return ids, np.bincount(owner, per, minlength=len(segments)).astype(np.int64)

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.ids, self.per = np.empty(0, np.int32), np.empty(0, np.int64)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, as the library gives them without begin and end.

        Segments met before are looked up; the store is emptied after a call that leaves more than ``KEEP`` of them
        or more than ``KEEP_CHARS`` characters in it, so long segments do not stay."""
        known, before, rows = self.known, len(self.known), []
        for text in texts:
            found = _SEGMENT.findall(SPACE + text.replace(" ", SPACE)) if text else []
            rows.append(np.array([known.setdefault(s, len(known)) for s in found], np.int64))
        new = list(islice(known, before, None))
        self.chars += sum(map(len, new))
        ids, per = self.encode_segments(new)
        ids, per = np.concatenate((self.ids, ids)), np.concatenate((self.per, per))
        self.ids, self.per = ids, per
        off = np.cumsum(per) - per
        out = []
        for row in rows:
            n = per[row]
            ends = np.cumsum(n)
            out.append(ids[np.repeat(off[row] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)])
        if len(known) > KEEP or self.chars > KEEP_CHARS:
            self._forget()
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: bytes joined, without the space that encoding put in front."""
        raw = b"".join([self.bytes[i] for i in ids.tolist()])
        return raw.removeprefix(b" ").decode("utf-8", "replace")


def _model(spark, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(PieceModel(f.read()))


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about ``TEXT_BYTES`` of text, one row at least."""
    size = np.array([len(x) if x else 0 for x in batch.column(column).to_pylist()])
    group = np.cumsum(size) // TEXT_BYTES
    edges = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield batch.slice(a, b - a)


def _text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) for every row: the model's ids of the whole text, without begin and end.

    The distinct segments (from one space to the next) of a stretch of texts are joined into one
    text with a suffix array; every piece is binary-searched in it, and the occurrences, sorted by
    position, are relaxed from left to right. For BPE the one valid edge into a position is that whose
    piece is compatible with the last piece before it (:meth:`PieceModel.compatible`).

    A null or empty text has no ids; repeated rows give equal rows; other columns are not read. The
    broadcast tables have the size of the vocabulary."""
    shared = _model(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, 1) if whole.num_rows else ():
                ids = shared.value.encode(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give an empty text."""
    shared = _model(encoded.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [shared.value.decode(np.array(x or [], np.int32)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encode_checked(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                   keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): :func:`encode`, and whether the ids decode to the text (null
    counts as empty). Only a text that holds the character U+2581 does not come back. The row's columns
    ``keep`` follow as they are."""
    shared = _model(docs.sparkSession, model_path)
    names = ["doc_id", "n_tokens", "ids", "round_trip", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, 1) if whole.num_rows else ():
                texts = batch.column(1).to_pylist()
                ids = shared.value.encode(texts)
                same = [shared.value.decode(x) == (t or "") for x, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                     pa.array(same, pa.bool_()), *batch.columns[2:]], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *keep)
    kept = "".join(f", `{c}` {t}" for c, t in rows.dtypes[2:])
    return rows.mapInArrow(run, f"doc_id long, n_tokens long, ids array<int>, round_trip boolean{kept}")


def encode_digest(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip): each text encoded and decoded again.

    ids_sha256 is over the ids as 32-bit little-endian numbers. round_trip: the decoded text is the
    text (null counts as empty); only a text that holds the character U+2581 comes back changed."""
    shared = _model(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, 1) if whole.num_rows else ():
                texts = batch.column(1).to_pylist()
                ids = shared.value.encode(texts)
                back = [shared.value.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids], pa.string()),
                     pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back], pa.string()),
                     pa.array([b == (t or "") for b, t in zip(back, texts)], pa.bool_())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])

    return _text_rows(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean")
