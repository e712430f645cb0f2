"""The mixed order outlives the stage folder."""

import os

from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import mixing


def test_the_last_stage_returns_the_mixed_order_of_a_reread_table(spark, tmp_path):
    """Part files of very different sizes, which Spark reads in another order than that of their numbers."""
    size = F.when(F.col("id") < 600, 2).otherwise(200)
    df = spark.range(900).select(
        F.col("id").alias("doc_id"), F.expr("repeat(sha2(string(id), 256), 1)").alias("text"), F.lit("en").alias("lang"),
        F.concat(F.lit("s"), (F.col("id") % 7).cast("string")).alias("source"), size.cast("long").alias("n_chars"))
    df = df.withColumn("text", F.expr("concat_ws(' ', transform(sequence(1, n_chars), i -> substr(sha2(string(doc_id * 1000 + i), 256), 1, 6)))"))
    df = df.unionByName(df.where("doc_id = 5")).unionByName(df.where("doc_id = 6").withColumn("doc_id", F.lit(None).cast("long")))
    mixed = df.repartitionByRange(6, "n_chars", "doc_id").sortWithinPartitions("n_chars", "doc_id")
    want = [(r["doc_id"], r["source"]) for r in mixed.collect()]
    path = str(tmp_path / "mixed")
    mixed.write.parquet(path)
    assert sum(f.endswith(".parquet") for f in os.listdir(path)) > 1
    back = spark.read.parquet(path)
    assert [(r["doc_id"], r["source"]) for r in back.collect()] != want  # the order that the read gives
    out = corpus_pipeline.tokenize(spark, back, "").collect()
    assert sorted(r["position"] for r in out) == list(range(len(want)))
    assert [(r["doc_id"], r["source"]) for r in sorted(out, key=lambda r: r["position"])] == want
    unwritten = mixing.with_position(mixed).orderBy("position").collect()
    assert [(r["doc_id"], r["source"]) for r in unwritten] == want


def test_run_returns_the_order_of_the_mixing_stage(spark, monkeypatch):
    kept, mix = [], corpus_pipeline.mix

    def noted(spark, docs, sf_dir):
        out = mix(spark, docs, sf_dir)
        kept.extend((r["doc_id"], r["source"]) for r in out.collect())
        return out

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, noted if n == "mixing" else f) for n, f in corpus_pipeline.STAGES])
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").orderBy("position").collect()
    assert [r["position"] for r in out] == list(range(len(out)))
    assert [(r["doc_id"], r["source"]) for r in out] == kept
