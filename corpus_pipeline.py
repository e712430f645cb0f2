"""Corpus pipeline: toxicity, line dedup, near-duplicate removal, source mixing, tokenization."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import jaccard, linededup, mixing, pieces, queries, toxicity
from shelfwise.llm.common import table
from shelfwise.session import delete_path, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The columns of documents; a stage keeps any others under names that clash with nothing.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keeps_columns(stage: Stage) -> Stage:
    """Let a stage see other columns under plain numbers, and give them back their names."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = [c if c in COLUMNS else f"column_{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*plain), sf_dir).select(*plain).toDF(*docs.columns)

    return run


@keeps_columns
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the ordinal model calls toxic go, whatever their ids."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return docs.where(~toxicity.toxic_text(spark, model)("text"))


@keeps_columns
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that many documents share; n_chars follows the new text. Rows that share an id are
    one document with several texts, each of which loses its own lines."""
    out = linededup.dedup_lines(docs, carry=True)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)}
    return out.select(*(F.when(F.col("n_dropped") > 0, new[c]).otherwise(F.col("row")[c]).alias(c) if c in new
                        else F.col("row")[c].alias(c) for c in docs.columns))


@keeps_columns
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, that with the smallest id. Rows without an id stay.

    Where rows share an id, the sorted rows are written and numbered, and the numbers stand in for the ids: each
    row is judged by its own text."""
    shared = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if shared.isEmpty():
        gone = jaccard.near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("gone"))
        return docs.join(gone, F.col("doc_id") == F.col("gone"), "left_anti")
    path = scratch_path(spark, "numbered")
    docs.orderBy(F.asc_nulls_last("doc_id"), F.xxhash64("text"), "text").write.parquet(path)
    rows = mixing.with_position(spark.read.parquet(path))
    number = F.when(F.col("doc_id").isNotNull(), F.col("position")).alias("number")
    gone = jaccard.near_duplicates(rows.select(number, "text"), id_col="number").where(~F.col("kept"))
    return rows.join(gone.select(F.col("doc_id").alias("gone")), F.col("position") == F.col("gone"), "left_anti").drop("position")


@keeps_columns
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, globally sorted into the mixed order of their sources."""
    return mixing.mixed_order(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip, source, position): the SentencePiece ids of every text; round_trip
    tells that they decode to it, position is the row's place in the mixed order."""
    return pieces.encode_checked(mixing.with_position(docs, ["doc_id", "text", "source"]), queries.PIECES, keep=["source", "position"])


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("near_duplicates", drop_near_duplicates),
          ("mixing", mix), ("sentencepiece", tokenize)]

#: Model predictions and token ids cannot be stated in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the whole documents table; each one's rows are written to the shared folder and
    read again. A stage's folder is removed when the next stage has been written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return docs
