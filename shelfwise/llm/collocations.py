"""Word collocations by vertical partitioning: phrase counts from depth-truncated suffix subtrees."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import mix64, saved, string_buffer
from shelfwise.llm.shingles import word_hashes
from shelfwise.session import delete_path, scratch_path

#: Bytes that end a piece, and those and blanks, which end a word.
BREAKS, BLANKS = ".,;:!?\n\x0b\x0c\r", " \t"
_BREAK = np.isin(np.arange(256), list(BREAKS.encode()))
_GAP = _BREAK | np.isin(np.arange(256), list(BLANKS.encode()))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of text worked on together; a longer word is taken whole.
STRETCH = 2 << 20
#: Counted leaves that a task holds before it passes them on.
HELD = 400_000
#: Counters of the sketch (a power of two) and parts it is added up in.
SLOT_BITS, SLICES = 23, 64
#: Tasks per core, and input splits per task, up to which splits are read together: a task sends its sketches and each
#: of its distinct leaves once, so fewer tasks send less.
TASKS_PER_CORE, SPLITS = 2, 8
#: Leaves (distinct truncated suffixes) a group of prefixes may hold, and the least and most groups: fewer leaves
#: are cut finer, so that all tasks have work; beyond MAX_GROUPS * BUDGET leaves the budget rises, so that the
#: table of extended prefixes stays bounded. Subtrees are built from sorted leaves one after another, so a larger
#: group takes longer, not more memory.
BUDGET, MIN_GROUPS, MAX_GROUPS = 1_000_000, 400, 20_000


@dataclass(frozen=True)
class Words:
    """A run of words: numbers into ``names``, the text's language, whether a piece begins at the word, and how
    many of the words are counted here (the others come again at the start of the next run)."""

    code: np.ndarray
    names: pa.Array
    lang: np.ndarray
    begins: np.ndarray
    counted: int


def _cut(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> int:
    """The last place up to ``hi`` where no word is cut in two, or the first one after it."""
    if hi >= len(data):
        return len(data)
    gaps = np.flatnonzero(_GAP[data[lo:hi]])
    last = lo + int(gaps[-1]) + 1 if len(gaps) else lo
    last = max(last, int(offsets[np.searchsorted(offsets, hi, "right") - 1]))
    if last > lo:
        return last
    after = hi
    while after < len(data):
        gaps = np.flatnonzero(_GAP[data[after : after + STRETCH]])
        end = after + int(gaps[0]) + 1 if len(gaps) else min(len(data), after + STRETCH)
        start = int(offsets[min(np.searchsorted(offsets, after, "left"), len(offsets) - 1)])
        if start <= end or len(gaps):
            return min(x for x in (start, end) if x > lo)
        after = end
    return len(data)


def word_runs(text: pa.Array, lang: np.ndarray, keep: int) -> Iterator[Words]:
    """The words of a column of texts, in stretches; the last ``keep`` words of a stretch that ends within a
    text begin the next one, so that every counted word stands with the ``keep`` words after it."""
    data, offsets = string_buffer(text)
    data = _LOWER[data]
    lo, pending = 0, True
    rest: tuple[pa.Array, np.ndarray, np.ndarray] | None = None
    while lo < len(data):
        hi = _cut(data, offsets, lo, lo + STRETCH)
        part = data[lo:hi]
        inside = ~_GAP[part]
        edge = np.zeros(len(part) + 1, bool)
        edge[offsets[(offsets >= lo) & (offsets <= hi)] - lo] = True
        starts = np.flatnonzero(inside & (edge[:-1] | np.concatenate(([True], ~inside[:-1]))))
        stops = np.flatnonzero(inside & (edge[1:] | np.concatenate((~inside[1:], [True])))) + 1
        breaks = np.cumsum(_BREAK[part] | edge[:-1])
        ends = np.concatenate(([0], np.cumsum(stops - starts))).astype(np.int32)
        new = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(part[inside])))
        owner = np.searchsorted(offsets, starts + lo, "right") - 1
        begins = np.diff(breaks[starts], prepend=0) > 0
        if len(starts):
            begins[0] |= pending
            pending = bool(breaks[-1] > breaks[starts[-1]])
        else:
            pending |= bool(len(breaks) and breaks[-1])
        names, langs = new, lang[owner]
        if rest is not None:
            names = pa.concat_arrays([rest[0], new])
            langs, begins = np.concatenate((rest[1], langs)), np.concatenate((rest[2], begins))
        whole = hi == len(data) or bool(offsets[np.searchsorted(offsets, hi, "left")] == hi)  # no text goes on behind
        counted = len(names) if whole else max(0, len(names) - keep)
        if len(names):
            coded = names.dictionary_encode()
            yield Words(coded.indices.to_numpy(), coded.dictionary, langs, begins, counted)
        rest = None if whole else (names.slice(counted), langs[counted:], begins[counted:])
        lo = hi


def _languages(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def _language_hashes(names: list[str]) -> np.ndarray:
    return mix64(np.array([zlib.crc32(x.encode()) + 1 for x in names], np.uint64))


def _grams(w: Words, langs: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1 to ``depth`` words: (hash, within a piece) of the phrase that begins at each word."""
    own = mix64(word_hashes(*string_buffer(w.names))[0])[w.code] ^ langs[w.lang]
    h, inside = own, np.ones(len(own), bool)
    for k in range(1, depth + 1):
        if k > 1:
            inside = np.append(inside[:-1] & ~w.begins[1:] if k == 2 else inside[:-1] & inside[1:], False)
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + np.append(own[k - 1 :], np.zeros(min(k - 1, len(own)), np.uint64)))
        yield mix64(h + np.uint64(k)), inside


def _place(h: np.ndarray, bits: int) -> np.ndarray:
    """A phrase's place in a sketch."""
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _other_place(h: np.ndarray, bits: int) -> np.ndarray:
    """A pair's place in the second sketch, from other bits: what shares its place in the first one rarely shares this."""
    return (h & np.uint64((1 << bits) - 1)).astype(np.int64)


def _common(found: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (found[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def _open_phrases(w: Words, langs: np.ndarray, depth: int, bits: int, pairs: np.ndarray,
                  longer: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, place in the second sketch, open) for 1 to ``depth`` words: the phrases all of whose words and pairs may
    be frequent, by the first sketch and, if given, the second."""
    one, two, still = None, None, None
    for k, (h, inside) in enumerate(_grams(w, langs, depth), 1):
        at = _other_place(h, bits) if k == 2 else _place(h, bits)
        if k == 1:
            one = still = _common(pairs, at)
        elif k == 2:
            two = still = one & np.append(one[1:], False) & inside & _common(pairs, _place(h, bits))
            if longer is not None:
                two = still = two & _common(longer, at)
        else:
            still = still & np.append(two[k - 2 :], np.zeros(min(k - 2, len(two)), bool))
        yield k, at, still


def sketch(src: DataFrame, min_count: int, bits: int, depth: int, pairs: Broadcast | None) -> tuple[np.ndarray, DataFrame]:
    """(bits, (lang, n) with the number of words): a phrase whose place in the sketch has fewer than ``min_count``
    occurrences over all texts is rare. Without ``pairs`` words and pairs are counted; with these, the phrases of 2
    words or more whose words and pairs may all be frequent, and the words of such pairs; a pair then stands at another place,
    so that a rare one that shares its first place with a frequent phrase is told as rare all the same. Counters stop at ``min_count``, which
    changes no sum that matters; a task sends them once, in slices, whatever the data's size."""
    size, part = 1 << bits, (1 << bits) // SLICES
    small = np.uint8 if min_count < 256 else np.uint32
    schema = "slice int, sums binary, lang string, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, words = None, {}
        for batch in batches:
            lang, names = _languages(batch.column(0))
            hashes = _language_hashes(names)
            for w in word_runs(batch.column(1), lang, depth):
                if sums is None:
                    sums = np.zeros(size, np.uint32)
                if pairs is None:
                    for h, inside in _grams(w, hashes, 2):
                        np.add.at(sums, _place(h, bits)[: w.counted][inside[: w.counted]], np.uint32(1))
                    for k, n in enumerate(np.bincount(w.lang[: w.counted], minlength=len(names)).tolist()):
                        words[names[k]] = words.get(names[k], 0) + n
                else:
                    word = None
                    for k, at, still in _open_phrases(w, hashes, depth, bits, pairs.value):
                        word = at if k == 1 else word
                        if k == 2:
                            np.add.at(sums, word[: w.counted][still[: w.counted]], np.uint32(1))
                            np.add.at(sums, word[1:][: w.counted][still[:-1][: w.counted]], np.uint32(1))
                        if k > 1:
                            np.add.at(sums, at[: w.counted][still[: w.counted]], np.uint32(1))
        if sums is not None:
            sums = np.minimum(sums, min_count).astype(small)
            parts = [sums[k * part : (k + 1) * part].tobytes() for k in range(SLICES)]
            at = [zlib.crc32(x.encode()) % SLICES for x in words]
            yield pa.RecordBatch.from_arrays(
                [pa.array([*range(SLICES), *at], pa.int32()), pa.array(parts + [None] * len(at), pa.binary()),
                 pa.array([None] * SLICES + list(words), pa.string()), pa.array([None] * SLICES + list(words.values()), pa.int64())],
                ["slice", "sums", "lang", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        words: dict[str, int] = {}
        for batch in batches:
            for k, raw, lang, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if lang is not None:
                    words[lang] = words.get(lang, 0) + n
                    continue
                new = np.frombuffer(raw.as_buffer(), small).astype(np.uint32)
                sums[k] = np.minimum(sums[k] + new, min_count) if k in sums else new
        for k, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.packbits(x >= min_count).tobytes()], pa.binary()),
                                              pa.nulls(1, pa.string()), pa.nulls(1, pa.int64())], ["slice", "sums", "lang", "n"])
        yield pa.RecordBatch.from_arrays([pa.nulls(len(words), pa.int32()), pa.nulls(len(words), pa.binary()), pa.array(list(words), pa.string()),
                                          pa.array(list(words.values()), pa.int64())], ["slice", "sums", "lang", "n"])

    added = saved(src.mapInArrow(count, schema).repartition(SLICES, "slice").mapInArrow(add, schema))
    found = np.zeros(size // 8, np.uint8)
    for r in added.where(F.col("slice").isNotNull()).select("slice", "sums").collect():
        found[r["slice"] * part // 8 : (r["slice"] + 1) * part // 8] = np.frombuffer(r["sums"], np.uint8)
    return found, added.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.sum("n").alias("n"))


def truncated_suffixes(src: DataFrame, pairs: Broadcast, longer: Broadcast, bits: int, depth: int) -> DataFrame:
    """(lang, leaf, c): at every word that stands in a pair that may be frequent the suffix of up to ``depth`` words within its piece, cut
    where the phrase so far becomes rare; counted within the task as far as ``HELD`` leaves go. The words of a leaf
    are each followed by one space."""
    def merged(parts: list[pa.RecordBatch]) -> pa.Table:
        return pa.Table.from_batches(parts).group_by(["lang", "leaf"]).aggregate([("c", "sum")]).rename_columns(["lang", "leaf", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        for part in stretches(batches):
            parts.append(part)
            if sum(x.num_rows for x in parts) > HELD:
                parts = merged(parts).to_batches()
                if sum(x.num_rows for x in parts) > HELD // 2:
                    yield from parts
                    parts = []
        if parts:
            yield from merged(parts).to_batches()

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, names = _languages(batch.column(0))
            hashes = _language_hashes(names)
            for w in word_runs(batch.column(1), lang, depth):
                length, goes_on = np.zeros(len(w.code), np.int64), np.ones(len(w.code), bool)
                for _, at, still in _open_phrases(w, hashes, depth, bits, pairs.value, longer.value):
                    goes_on = goes_on & still & _common(longer.value, at)
                    length += goes_on
                at = np.flatnonzero(length[: w.counted])
                if not len(at):
                    continue
                places = at[:, None] + np.arange(depth)
                code = np.where(np.arange(depth) < length[at, None], w.code[np.minimum(places, len(w.code) - 1)].astype(np.int64) + 1, 0)
                yield _distinct(w.lang[at], code, w.names, names)

    return src.mapInArrow(run, "lang string, leaf string, c long")


def _distinct(lang: np.ndarray, code: np.ndarray, words: pa.Array, langs: list[str]) -> pa.RecordBatch:
    """The distinct rows of codes with their number, as strings."""
    width = max(1, len(words).bit_length())
    each = 63 // width  # codes that fit one number
    keys = [lang] + [sum(code[:, k + i] << (width * i) for i in range(min(each, code.shape[1] - k))) for k in range(0, code.shape[1], each)]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for x in keys:
        new[1:] |= np.diff(x[order]) != 0
    first = np.flatnonzero(new)
    n, rows = np.diff(np.append(first, len(order))), order[first]
    picked = code[rows]
    ends = np.concatenate(([0], np.cumsum((picked > 0).sum(axis=1)))).astype(np.int32)
    flat = words.take(pa.array(picked[picked > 0] - 1))
    leaf = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), flat), " ")
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()).take(pa.array(lang[rows])), pc.binary_join_element_wise(leaf, "", " "), pa.array(n, pa.int64())],
        ["lang", "leaf", "c"])


def _words(text: str, number: Column | int) -> Column:
    """The first ``number`` words of a column, or the last ones for a negative number."""
    return F.call_function("substring_index", F.col(text), F.lit(" "), F.lit(number))


def partition_prefixes(leaves: DataFrame, depth: int, budget: int, min_groups: int = MIN_GROUPS,
                       max_groups: int = MAX_GROUPS) -> tuple[DataFrame, DataFrame]:
    """(rows, tops): vertical partitioning. A prefix that holds more leaves than the budget is replaced by its
    extensions by one word, and so on; the others are packed into groups. ``rows`` has each leaf with its group
    and the length ``depth`` of its prefix. ``tops`` has (lang, phrase, f) of the prefixes that were extended, which
    lie above all subtrees; there are at most ``max_groups`` of each length."""
    spark = leaves.sparkSession
    total = leaves.count()
    budget = max(1, min(budget, math.ceil(total / min_groups)), math.ceil(total / max_groups))
    groups = max(1, math.ceil(total / budget))
    rows, tops = leaves.withColumn("_open", F.lit(True)).withColumn("depth", F.lit(1)), []
    words = F.size(F.split("leaf", " ")) - 1
    for d in range(1, depth):
        level = rows.where(F.col("_open") & (words >= d)).groupBy("lang", _words("leaf", d).alias("phrase")).agg(
            F.count(F.lit(1)).alias("leaves"), F.sum("c").alias("f")).where(F.col("leaves") > budget)
        big = [(r["lang"], r["phrase"], r["f"]) for r in level.select("lang", "phrase", "f").collect()]
        if not big:
            break
        top = spark.createDataFrame(big, "lang string, phrase string, f long")
        tops.append(top)
        mark = F.broadcast(top.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase")))
        rows = rows.join(mark, (F.col("lang") == F.col("_lang")) & (_words("leaf", d) == F.col("_phrase")) & F.col("_open"), "left")
        rows = rows.withColumn("_open", F.col("_phrase").isNotNull()).withColumn(
            "depth", F.col("depth") + F.col("_open").cast("int")).drop("_lang", "_phrase")
    rows = rows.where(words >= F.col("depth")).select(
        F.pmod(F.xxhash64("lang", _words("leaf", F.col("depth"))), F.lit(groups)).alias("group"), "lang", "depth", "leaf", "c")
    empty = spark.createDataFrame([], "lang string, phrase string, f long")
    for top in tops:
        empty = empty.union(top)
    return rows, empty


def build_subtrees(rows: DataFrame, min_count: int) -> DataFrame:
    """(lang, phrase, f): the nodes with at least ``min_count`` occurrences of every group's suffix subtrees, at
    and below the prefix. Leaves come sorted; a node's count is the total of its leaves, and only the
    path to the current leaf is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path: list[str] = []
        sums: list[int] = []
        key, least = None, 1
        out: tuple[list, list, list] = ([], [], [])

        def close(down_to: int) -> None:
            while len(path) > down_to:
                f = sums.pop()
                if f >= min_count and len(path) >= least:
                    out[0].append(key[1])
                    out[1].append(" ".join(path))
                    out[2].append(f)
                path.pop()
                if path:
                    sums[-1] += f

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())],
                                              ["lang", "phrase", "f"])
            for x in out:
                x.clear()
            return made

        for batch in batches:
            for group, lang, depth, leaf, c in zip(*(batch.column(i).to_pylist() for i in range(5))):
                words = leaf.split(" ")[:-1]
                same = 0
                if key == (group, lang) and words[: least] == path[: least] and depth == least:
                    same = least
                    while same < len(path) and same < len(words) and path[same] == words[same]:
                        same += 1
                close(same)
                key, least = (group, lang), depth
                path.extend(words[same:])
                sums.extend([0] * (len(words) - same))
                sums[-1] += c
            if len(out[0]) > 20_000:
                yield flush()
        if key is not None:
            close(0)
            yield flush()

    sort = ["group", "lang", "depth", "leaf"]
    return rows.repartition("group").sortWithinPartitions(*sort).select(*sort, "c").mapInArrow(run, "lang string, phrase string, f long")


def _gathered(src: DataFrame) -> DataFrame:
    """The rows in tasks of up to ``SPLITS`` input splits each, ``TASKS_PER_CORE`` tasks a core at least as far as there
    are splits."""
    splits = src.rdd.getNumPartitions()
    return src.coalesce(max(1, min(splits, TASKS_PER_CORE * src.sparkSession.sparkContext.defaultParallelism), math.ceil(splits / SPLITS)))


def phrase_counts(docs: DataFrame, min_count: int, depth: int, lang_col: str, text_col: str, budget: int = BUDGET,
                  bits: int = SLOT_BITS) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, f) of all phrases of up to ``depth`` words that occur ``min_count`` times, without some of the
    single words that no phrase of two words among them holds, (lang, n))."""
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    src = _gathered(src)
    found, words = sketch(src, min_count, bits, depth, None)
    pairs = send(found)
    longer = send(sketch(src, min_count, bits, depth, pairs)[0])
    path = scratch_path(spark, "leaves")
    truncated_suffixes(src, pairs, longer, bits, depth).groupBy("lang", "leaf").agg(F.sum("c").alias("c")).write.parquet(path)
    rows, tops = partition_prefixes(spark.read.parquet(path), depth, budget)
    nodes = saved(build_subtrees(rows, min_count).union(tops.where(F.col("f") >= min_count)))
    delete_path(spark, path)
    return nodes, words


def collocations(docs: DataFrame, min_count: int = 100, top: int = 2000, max_words: int = 5, budget: int = BUDGET,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``max_words`` words.

    A-Z are lower-cased; texts fall into pieces at ``.,;:!?`` and line ends, pieces into words at blanks. n counts
    a language's words, a a phrase's occurrences within pieces, overlaps included; ``min_count`` is the least. A
    phrase cut after its first k words scores floor(1000 * a * n / (l * r)), l and r counting its two parts; its
    lowest score counts, the smallest k of equal ones. A phrase whose words stand in a longer one that
    occurs as often is dropped (then one by one word longer does too). Order: score and a falling, phrase rising by bytes.

    Method: two sketches of fixed size tell which words, pairs and longer phrases cannot reach ``min_count``; suffixes
    are cut there, which changes no count that matters, whatever the sketches' collisions. The distinct suffixes are
    dealt by prefixes within a memory budget (:func:`partition_prefixes`), each group's subtrees are built on
    their own (:func:`build_subtrees`), and all counts are totals of leaves. Scores are exact up to 38 digits.

    A null language is ``und``; a null or empty text has no words; texts of any length are read whole, in
    stretches. Repeated rows count each; other columns are not read; an empty table gives no rows."""
    nodes, words = phrase_counts(docs, min_count, max_words, lang_col, text_col, budget)
    size = F.size(F.split("phrase", " "))
    cuts = nodes.withColumnRenamed("f", "a").withColumn("m", size).where(F.col("m") > 1)
    cuts = cuts.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.withColumn("first", _words("phrase", F.col("k"))).withColumn(
        "rest", _words("phrase", F.col("k") - F.col("m")))
    first, rest = (nodes.select("lang", F.col("phrase").alias(c), F.col("f").alias(n)) for c, n in (("first", "l"), ("rest", "r")))
    cuts = saved(cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]))
    covered = cuts.where((F.col("k") == F.col("m") - 1) & (F.col("l") == F.col("a"))).select("lang", F.col("first").alias("phrase")).union(
        cuts.where((F.col("k") == 1) & (F.col("r") == F.col("a"))).select("lang", F.col("rest").alias("phrase"))).distinct()
    score = F.expr("(cast(1000 * a as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    scored = cuts.join(words, "lang").withColumn("score", score)
    best = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("b"), F.first("a").alias("a"), F.first("n").alias("n"))
    best = best.join(covered, ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
