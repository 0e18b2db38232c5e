import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline  # noqa: E402
from stratiform.llm.store import stored  # noqa: E402


def test_every_stage_works_on_what_the_one_before_kept(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality", "near_dedup", "mixing", "packing"] and corpus_pipeline.ORACLE_SQL is None
    kept = {}
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stored(stage(spark, now, sf))
        assert now.columns == docs.columns
        kept[name] = now
        assert now.distinct().join(docs, docs.columns, "left_anti").count() == 0
    clean = labels.where("quality = 1 and toxic = 0")
    for name in ("language_id", "quality"):
        assert clean.join(kept[name], "doc_id", "left_anti").count() <= 0.02 * clean.count()
    assert kept["near_dedup"].groupBy("text").count().where("count > 1").count() == 0
    counts = now.groupBy("doc_id").count()
    assert counts.where("count > 2").count() == 0 and counts.where("count = 2").count() > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, now, sf)
    assert packed.where("piece = 0").count() == now.count() and packed.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 2048


def test_an_empty_table_goes_through(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    spark.read.parquet(f"{sf}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_sources_and_ids_of_any_kind(spark, tmp_path):
    words = "the house and the garden were quiet when they came back from town"
    rows = [(k, f"{words} number {k}", "en", None if k % 3 == 0 else f"s{k % 2}", 1) for k in range(40)] + [(None, words, None, None, None), (41, None, None, "s0", 0), (42, "", "en", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
