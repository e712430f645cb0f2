"""Line dedup: lines repeated over many documents go, except in one of them (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import WHITE

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; pure ASCII text takes the fast path of ``lower``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower()))


def _key(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE))


def _hashes(key: Column) -> Column:
    """128 bits in two independent halves, so that distinct lines stay distinct at any corpus size."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                min_docs: int = 5, carry: bool = False) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text) per row of ``docs``; with ``carry`` also ``row``, a struct of all
    columns of the row.

    A text is split at ``\\n``; a null or empty text is one empty line. A line's key is the line
    without ASCII white space at its ends and with A-Z lower-cased. A key of at least ``min_chars``
    code points that stands in at least ``min_docs`` distinct documents loses all its lines, except
    in the largest document id that holds it. The other lines stay in their order.

    Rows that repeat a document id count as one document. Rows without an id are no document: they
    count for nothing and keep all lines. Other columns, whatever their names, are not read.

    Plan: one row per (document, distinct long key) of two hashes is counted with a partial
    aggregate, so a line of every document costs one row per task. Only keys over the threshold are
    joined back to the documents that lose them; the texts are shuffled once, to meet their list."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    whole = src if not carry else docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    row = ["row"] if carry else []
    lines = F.split(_lower_ascii(F.col("text")), "\n")
    long_lines = src.where(F.col("doc_id").isNotNull() & (F.length("text") >= min_chars)).select(
        "doc_id", F.explode(lines).alias("line"))
    keyed = long_lines.select("doc_id", _key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    hashed = keyed.select("doc_id", _hashes(F.col("key")).alias("h")).select("doc_id", "h.h1", "h.h2").distinct()
    common = hashed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("_n"), F.max("doc_id").alias("_last"))
    common = common.where(F.col("_n") >= min_docs).drop("_n")
    gone = hashed.join(common, ["h1", "h2"]).where(F.col("doc_id") != F.col("_last"))
    lost = gone.groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("_lost"))
    text = F.coalesce("text", F.lit(""))
    both = whole.join(lost, "doc_id", "left").select(
        "doc_id", *row, "_lost", text.alias("text"), F.split(text, "\n").alias("_lines"))
    stays = F.filter("_lines", lambda x: (F.length(x) < min_chars)
                     | ~F.array_contains("_lost", _hashes(_key(_lower_ascii(x)))))
    kept = both.select("doc_id", *row, "text", "_lost", F.size("_lines").cast("long").alias("n_lines"),
                       F.when(F.col("_lost").isNotNull(), stays).alias("_kept"))
    return kept.select(
        "doc_id", "n_lines",
        F.when(F.col("_lost").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("_kept")).cast("long")
        .alias("n_dropped"),
        F.when(F.col("_lost").isNull(), F.col("text")).otherwise(F.array_join("_kept", "\n")).alias("kept_text"), *row)


def line_digest(result: DataFrame) -> DataFrame:
    """The query's columns: the kept text as a hash."""
    return result.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
