import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from stratiform.llm import bands, queries

PACKER = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)


def ratio(data):
    return len(PACKER.compress(data)) / len(data)


def verdict(text, rules):
    """Whether the bands let a text pass, from plain calls."""
    data = (text or "").encode()
    low_high = lambda n: next((b[1], b[2]) for b in rules.bands if n < b[0])
    low, high = low_high(len(data))
    if not data or not low <= ratio(data) <= high:
        return not data and low <= 1 <= high
    chunks = [data[k : k + rules.chunk] for k in range(0, len(data), rules.chunk)]
    if len(data) < 2 * rules.chunk:
        return True
    if len(chunks[-1]) <= rules.chunk // 2:
        chunks[-2:] = [chunks[-2] + chunks[-1]]
    out = sum(len(c) for c in chunks if not low_high(len(c))[0] - rules.chunk_slack <= ratio(c) <= low_high(len(c))[1] + rules.chunk_slack)
    return out / len(data) <= rules.bad_share


def test_limits_from_labels_part_good_from_bad(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rules = bands.fit_bands(docs, labels)
    out = bands.compression_bands(docs, rules, keep=["doc_id"]).join(labels, "doc_id").join(docs.select("doc_id", F.octet_length("text").alias("size")), "doc_id")
    out = out.where("NOT base_failed").cache()
    share = lambda test: out.where(test).agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert share("quality = 1") >= 0.98 and share("quality = 0 AND size >= 2048") <= 0.1
    some = docs.where("doc_id % 40 = 0").select("doc_id", "text")
    got = {r.doc_id: r.kept or r.base_failed for r in bands.compression_bands(some, rules, keep=["doc_id"]).collect()}
    failed = {r.doc_id for r in bands.compression_bands(some, rules, keep=["doc_id"]).where("base_failed").collect()}
    assert got == {r.doc_id: r.doc_id in failed or verdict(r.text, rules) for r in some.collect()}


def test_every_byte_of_a_long_text_is_judged():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9))) for _ in range(900)]
    natural = " ".join(rng.choice(words, 8000)).encode()
    rules = bands.BandRules(bad_share=0.0, bands=((1 << 62, 0.2, 0.9),), chunk_slack=0.0)
    for tail in (100, 2000, 2100, 4000):
        text = natural[: 3 * 4096] + b"z" * tail
        assert (bands._ratios(pa.array([text.decode()]), rules)[1][0] > 0) == (tail >= 2000 and not verdict(text.decode(), rules))


def test_limits_beyond_what_is_learned():
    size = np.repeat(2 ** np.arange(8, 14), 200)
    learned = bands.bands_from(size + np.arange(len(size)) % 50, 0.7 - 0.02 * np.log2(size) + 0.001 * (np.arange(len(size)) % 7))
    ends, low, high = (np.array(x) for x in zip(*learned))
    assert (low < high).all() and (np.diff(low[ends > 2**14]) <= 0).all() and low[-1] < 0.3 and (np.diff(high[ends < 2**8]) <= 0).all()
    assert bands.bands_from(size[:20], np.ones(20)) == ()


def test_limits_come_from_all_good_texts(spark):
    # Sizes and ratios of 30,000 good texts; half of them, dealt out by no id, compress far better.
    n = 30_000
    size, ratio = 300 + np.arange(n) * 7919 % 9000, 0.5 + 0.0001 * (np.arange(n) * 104729 % 1000) - 0.2 * (np.arange(n) % 2)
    rows = spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit(60).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_repeat_words"),
        (300 + F.col("id") * 7919 % 9000).alias("size"), (0.5 + 0.0001 * (F.col("id") * 104729 % 1000) - 0.2 * (F.col("id") % 2)).alias("ratio"),
    )
    got = bands.fit_measured(rows, spark.range(n).selectExpr("id AS doc_id", "1 AS quality")).bands
    want = bands.bands_from(size, ratio)
    assert [b[0] for b in got] == [b[0] for b in want] and np.abs(np.array(got)[:, 1:] - np.array(want)[:, 1:]).max() < 2e-5


def test_judging_measured_texts_is_judging_texts(frame):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(400)]
    rows = [(k, " ".join(rng.choice(words, int(rng.integers(1, 4000))))) for k in range(60)] + [(60, None), (61, "")]
    docs = frame(rows, "doc_id long, text string")
    want, got = (sorted(df.collect()) for df in (bands.compression_bands(docs, keep=["doc_id"]), bands.judge(bands.measure_texts(docs, keep=["doc_id"]))))
    assert got == want and len(got) == 62


def test_nothing_to_learn_from(frame):
    docs, labels = frame([(1, "a b"), (None, None)], "doc_id long, text string"), frame([(1, 1), (None, 1), (2, None)], "doc_id long, quality int")
    assert bands.fit_bands(docs, labels) == bands.BandRules()
    assert bands.fit_bands(docs.limit(0), labels.limit(0)) == bands.BandRules()


def test_large_ids_of_conversations_are_told_apart(spark, tmp_path):
    ids = [2**60 + k for k in range(4)]
    rows = [(i, 0, "user", "hi") for i in ids] + [(i, 1, "assistant", f"answer {i % 2}") for i in ids]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    made = queries.op4_preference_formatting(spark, str(tmp_path)).collect()
    assert sorted(r.pair_id for r in made) == [2**59, 2**59 + 1]
