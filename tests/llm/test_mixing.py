import re

import pytest
from pyspark.sql import functions as F

from stratiform.llm.mixing import MixRules, _permuted, _positions, mix_sources, mixed_documents, source_targets


def filled(sizes, weights=(3, 1, 2), budget=1.5, most=2):
    """Targets by resharing the excess until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()) * budget, {}
    while True:
        rest = total - sum(full.values())
        left = [s for s in names if s not in full]
        share = {s: rest * w[s] / sum(w[x] for x in left) for s in left}
        over = [s for s in left if share[s] > most * sizes[s]]
        if not over:
            return full | share
        full |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 70}, {"x": 8}, {"a": 0, "b": 5}, {"s%02d" % k: (k * 37) % 91 for k in range(30)}])
def test_targets_match_repeated_resharing(frame, sizes):
    rows = frame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in source_targets(rows, MixRules()).collect()}
    assert got == pytest.approx(filled(sizes))


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = mix_sources(docs).cache()
    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()}
    assert {r.doc_id: r.size for r in out.collect()} == sizes
    assert out.where("taken > 2 * size or taken < 0").count() == 0
    for r in out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum("size").alias("size"), F.first("source_size").alias("s")).collect():
        assert r.size == r.s and abs(r.taken - r.target) <= 2 * 64
    again = mix_sources(docs.repartition(7))
    assert out.exceptAll(again).count() == 0 and again.exceptAll(out).count() == 0


def test_hot_source_in_many_buckets_and_shards(spark):
    rules = MixRules(block=8, shard=16, rows=50)
    docs = spark.range(900).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
        F.expr("repeat('word ', cast(id % 40 as int))").alias("text"), F.lit(1).alias("size"),
    )
    out = mix_sources(docs, rules)
    assert out.count() == 900 and out.where("taken > 2 * size").count() == 0
    for r in out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 16


def test_edges(frame):
    rows = [(1, None, None), (2, "", "a"), (3, "one", None), (4, "two three " * 400, "a"), (4, "two three " * 400, "a"), (None, "x y", "b")]
    out = mix_sources(frame(rows, "doc_id long, text string, source string"), MixRules(block=4))
    assert sorted((r.doc_id or 0, r.size) for r in out.collect()) == [(0, 2), (1, 0), (2, 0), (3, 1), (4, 800), (4, 800)]
    assert out.where("taken > 2 * size").count() == 0
    empty = frame([], "doc_id long, text string, source string")
    assert mix_sources(empty).count() == 0 and mixed_documents(empty).count() == 0


def test_mixed_documents_keep_columns_and_whole_copies(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    counts = out.groupBy("doc_id").count().withColumnRenamed("count", "n")
    assert counts.where("n > 2").count() == 0 and out.distinct().join(docs, docs.columns, "left_anti").count() == 0


@pytest.mark.parametrize("rows", [50_000, 60])
def test_whole_copies_meet_the_targets_of_sources(spark, rows):
    """Documents span several blocks, so their takes lie near the ratio of their source, one below 0.5 among them."""
    source = F.when(F.col("id") % 3 == 0, "b").when(F.col("id") % 3 == 1, F.concat(F.lit("a"), F.col("id") % 2)).otherwise(F.concat(F.lit("c"), F.col("id") % 4))
    docs = spark.range(1200).select(F.col("id").alias("doc_id"), source.alias("source"), F.expr("repeat('word ', 200 + cast(id * 7919 % 400 as int))").alias("text"))
    rules = MixRules(weights=(3, 1, 2), budget=0.9, block=8, rows=rows)
    targets = {r.source: (r.size, r.target) for r in mix_sources(docs, rules).groupBy("source").agg(F.sum("size").alias("size"), F.first("target").alias("target")).collect()}
    assert any(t < 0.5 * n for n, t in targets.values()) and any(0.5 * n < t < n for n, t in targets.values())
    out = mixed_documents(docs, rules)
    got = {r.source: r.n for r in out.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), " "))).alias("n")).collect()}
    for source, (size, target) in targets.items():
        assert abs(got.get(source, 0) - target) <= 600 * -(-1200 // rows) + 2 * 8
    assert out.groupBy("doc_id").count().where("count > 2").count() == 0


def test_no_python_on_the_way(spark, sf):
    plan = mix_sources(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


@pytest.mark.parametrize("blocks", [1, 2, 3, 7, 64, 991, 5000])
def test_slots_are_permuted_within_each_source(spark, blocks):
    rows = spark.range(blocks).select("id", F.explode(F.array(F.lit(0), F.lit(1))).alias("sid"))
    got = rows.select("id", "sid", _permuted(F.col("id"), F.lit(blocks).cast("long"), F.col("sid"), 5).alias("at")).collect()
    for sid in (0, 1):
        assert sorted(r["at"] for r in got if r.sid == sid) == list(range(blocks))
    if blocks > 900:
        steps = {(b - a) % blocks for a, b in zip(*(([r["at"] for r in sorted(got) if r.sid == 0])[k:] for k in (0, 1)))}
        assert len(steps) > blocks / 3  # no fixed stride
        assert [r["at"] for r in sorted(got) if r.sid == 0] != [r["at"] for r in sorted(got) if r.sid == 1]


def test_rows_without_ids_are_parted(spark):
    rows = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.concat(F.lit("w "), F.col("id")).alias("text"))
    sizes = rows.select("doc_id", F.lit(2).cast("long").alias("size"), F.xxhash64("text").alias("hash"), F.lit(0).alias("sid"))
    placed = _positions(sizes, MixRules(rows=1000), 20_000)
    assert placed.select("start").distinct().count() == 20_000 and placed.agg(F.max("start")).first()[0] == 39_998
    assert mix_sources(rows, MixRules(rows=1000)).agg(F.sum("taken")).first()[0] == pytest.approx(60_000, abs=128)


def test_columns_of_any_name_survive_the_mix(spark, frame):
    docs = frame([(k, "a", "x y z", k, 1, 2) for k in range(50)], "doc_id long, source string, text string, _copies long, _id int, c0 int")
    out = mixed_documents(docs)
    assert out.columns == docs.columns and out.where("_copies <> doc_id or _id <> 1 or c0 <> 2").count() == 0 and out.count() > 0
