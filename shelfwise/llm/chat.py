"""Chat formatting on token level: segments encoded apart, reserved ids between them, loss masks."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.tokencount import byte_letters

#: The template's control strings; their ids follow the vocabulary in this order.
CONTROLS = ("<s>", "</s>", "<<SYS>>", "[INST]", "[/INST]", "<|role|>", "<|body|>")
BEGIN, END, SYSTEM, USER, ASSISTANT, ROLE, BODY = range(len(CONTROLS))
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}

_CONTROL = re.compile("|".join(rf"({re.escape(c[0])})(\\*)({re.escape(c[1:])})" for c in CONTROLS))
_ESCAPED = re.compile("|".join(rf"({re.escape(c[0])})\\(\\*)({re.escape(c[1:])})" for c in CONTROLS))


def escape(text: str) -> str:
    """Break every control string with a backslash behind its first character, and add one to those
    that look broken already; so no control string is left and :func:`unescape` gives the text back."""
    return _CONTROL.sub(lambda m: _join(m, "\\"), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _join(m, ""), text)


def _join(m: re.Match, extra: str) -> str:
    first, slashes, rest = (x for x in m.groups() if x is not None)
    return first + extra + slashes + rest


class Codec:
    """Byte-level BPE vocabulary plus reserved ids. ``content`` is the tokenizer file's text."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(content)
        self.tok.encode_special_tokens = True  # special strings in a text are ordinary text
        spec = json.loads(content)
        back = {c: b for b, c in enumerate(byte_letters())}
        self.bytes: list[bytes] = [b""] * (max(spec["model"]["vocab"].values()) + 1)
        special = {t["content"] for t in spec["added_tokens"]}
        for piece, i in spec["model"]["vocab"].items():
            self.bytes[i] = piece.encode() if piece in special else bytes(back[c] for c in piece)
        self.first = max(len(self.bytes), 1 + max((t["id"] for t in spec["added_tokens"]), default=0))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch(texts, add_special_tokens=False)]

    def decode(self, ids) -> str:
        return b"".join([self.bytes[i] for i in ids]).decode("utf-8")

    def assemble(self, role: str, role_ids: list[int], ids: list[int], first: bool) -> tuple[np.ndarray, np.ndarray]:
        """One turn's ids and loss mask. The mask is the prefix sum of +1 where an assistant's text
        starts and -1 where it ends, so that markers are never under it."""
        head = [self.first + BEGIN] if first else []
        head += [self.first + ROLES[role]] if role in ROLES else [self.first + ROLE, *role_ids, self.first + BODY]
        out = np.array([*head, *ids, self.first + END], np.int32)
        step = np.zeros(len(out) + 1, np.int8)
        if role == "assistant":
            step[len(head)] += 1
            step[len(head) + len(ids)] -= 1
        return out, np.cumsum(step)[:-1].astype(bool)


def _source(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return df.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                     F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def format_turns(conversations: DataFrame, tokenizer_path: str, conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, seq, ids, loss): a conversation's token stream, one row per turn.

    Joined by (turn, seq), a conversation's ids are its training sample and ``loss`` is true at the
    tokens of assistant texts. Template: <s>, then for each turn a role marker, the escaped text and
    </s>; markers are reserved ids behind the vocabulary, never encoded from text. Roles other than
    system, user and assistant are written out between two markers.

    Turns stay rows, so a conversation of any length is spread over tasks. ``seq`` numbers rows that
    repeat a turn, in the order of role and text. A null role or text is empty; null conv_ids make
    one conversation; a null turn comes first; other columns are not read."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = conversations.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or Codec(shared.value)
            cols = {k: batch.column(i).to_pylist() for i, k in enumerate(batch.schema.names)}
            texts = codec.encode([escape(x) for x in cols["text"]])
            roles = codec.encode([escape(x) for x in cols["role"]])
            made = [codec.assemble(*x) for x in zip(cols["role"], roles, texts, cols["opens"])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), batch.column("seq"),
                 pa.array([m[0] for m in made], pa.list_(pa.int32())), pa.array([m[1] for m in made], pa.list_(pa.bool_()))],
                ["conv_id", "turn", "seq", "ids", "loss"])

    src = _source(conversations, conv, turn, role, text)
    # the first row of a conversation; repeated turns are numbered by a window, which spills and holds one row at a time
    first = src.groupBy("conv_id").agg(F.min(F.coalesce("turn", F.lit(-(1 << 63)))).alias("_first"))
    first = first.withColumnRenamed("conv_id", "_c")
    repeats = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = src.withColumn("seq", F.row_number().over(repeats).cast("long") - 1)
    rows = rows.join(first, F.col("conv_id").eqNullSafe(F.col("_c")))
    opens = (F.col("seq") == 0) & (F.coalesce("turn", F.lit(-(1 << 63))) == F.col("_first"))
    rows = rows.select("conv_id", "turn", "seq", "role", "text", opens.alias("opens"))
    return rows.mapInArrow(run, "conv_id long, turn long, seq long, ids array<int>, loss array<boolean>")


class _Reader:
    """Reads one conversation's stream back and keeps running digests only."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.turns, self.loss, self.n_turns, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def feed(self, ids: np.ndarray, loss: np.ndarray) -> None:
        """The ids and mask of one turn, up to its end marker."""
        base = self.codec.first
        marks = np.flatnonzero(ids >= base)
        kinds = (ids[marks] - base).tolist()
        parts = [self.codec.decode(p[p < base].tolist()) for p in np.split(ids, marks)]
        self.chars += sum(map(len, parts)) + sum(len(CONTROLS[k]) for k in kinds)
        if kinds and kinds[0] == BEGIN:
            kinds, parts = kinds[1:], parts[1:]
        names = {v: k for k, v in ROLES.items()}
        role, text = (unescape(parts[1]), unescape(parts[2])) if kinds[0] == ROLE else (names[kinds[0]], unescape(parts[1]))
        if kinds[-1] != END or len(kinds) != (3 if kinds[0] == ROLE else 2):
            raise ValueError("chat: the stream is not a turn")
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n_turns += 1
        learnt = unescape(self.codec.decode(ids[loss].tolist()))
        self.loss.update(learnt.encode())
        self.loss_chars += len(learnt)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), parsed from the ids.

    Rows stream in order through the task and only digests are kept, so a long conversation needs no
    more memory than its longest turn."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = formatted.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, now, reader, out = None, None, None, []
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def rows(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

        for batch in batches:
            codec = codec or Codec(shared.value)
            ids, loss = batch.column("ids"), batch.column("loss")
            for r, conv in enumerate(batch.column("conv_id").to_pylist()):
                if reader is None or conv != now:
                    if reader is not None:
                        out.append((now, *reader.row()))
                    now, reader = conv, _Reader(codec)
                reader.feed(ids[r].values.to_numpy(), ids_mask(loss[r]))
            if out:
                yield rows(out)
                out = []
        if reader is not None:
            yield rows([(now, *reader.row())])

    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "seq"]
    return formatted.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def ids_mask(value) -> np.ndarray:
    return value.values.to_numpy(zero_copy_only=False).astype(bool)
