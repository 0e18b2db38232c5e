import re

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from stratiform.llm import bands, language, resample


def test_held_out_languages_are_told(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    right = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.9 and out.where("rejected").count() < 0.03 * docs.count()
    assert out.where("score < 0 or score > 1").count() == 0


def test_language_edges(frame):
    rows = [(k, f"the cat and the dog of the house number {k} were there with them", "en") for k in range(30)]
    rows += [(k, f"der hund und die katze von dem haus nummer {k} waren mit ihnen dort", "de") for k in range(30, 60)]
    rows += [(60, None, "en"), (61, "", "de"), (62, "123 !!", None), (None, "the dog and the cat of the house were there", None), (64, "der hund " * 5000, None), (65, "Das HAUS und die Katze", None)]
    out = {r.doc_id: r for r in language.predict_languages(frame(rows, "doc_id long, text string, lang string")).collect()}
    assert [out[k].lang_pred for k in (60, 61, 62)] == ["und"] * 3 and [out[k].score for k in (60, 61, 62)] == [0.0] * 3
    assert out[64].lang_pred == out[65].lang_pred == "de" and out[None].lang_pred == "en" and not out[64].rejected
    empty = frame([], "doc_id long, text string, lang string")
    assert language.predict_languages(empty).count() == 0
    unknown = language.predict_languages(frame([(1, "word", None)], "doc_id long, text string, lang string")).first()
    assert (unknown.lang_pred, unknown.rejected) == ("und", True)


def test_learning_never_reads_held_out_rows(frame):
    rows = [(k, "aaa bbb ccc " * 9, "x") for k in range(40)] + [(k, "ddd eee fff " * 9, "y") for k in range(40, 80)]
    docs = frame(rows, "doc_id long, text string, lang string")
    spoiled = docs.withColumn("text", F.when(language.held_out(), F.lit("zzz")).otherwise(F.col("text")))
    assert language.learn_languages(docs.where(~language.held_out())) == language.learn_languages(spoiled.where(~language.held_out()))


def test_names_that_clash_are_refused(frame):
    docs = frame([(1, "a", 2.0)], "doc_id long, text string, score double")
    with pytest.raises(ValueError, match="score"):
        language.classify_languages(docs, {"en": b"a"})
    assert "p_score" in language.classify_languages(docs, {"en": b"a"}, prefix="p_").columns


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


TEXTS = [None, "", " \n ", "a b c a b c", "x\nx\n x\nx \n\nx", "é£ # * $%&|<>", "w " * 200, "a a a", "a a a a", "one\r\none\r\n", "A b c a b c", "\n\n\n"]


def test_counts_match_plain_python(spark, sf):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect() if len(r.text or "") < 4000]
    got = zip(*(x.tolist() for x in bands.text_counts(pa.array(texts, pa.string()))))
    for text, counts in zip(texts, got):
        assert counts == plain_counts(text), repr(text)[:200]


def test_bands_reject_repetitive_and_incompressible_text(frame):
    draw = np.random.default_rng(5)
    word = lambda: "".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), int(draw.integers(2, 9))))
    common = [word() for _ in range(300)]
    natural = " ".join(draw.choice(common, 600))
    noise = " ".join("".join(chr(c) for c in draw.integers(33, 127, 40)) for _ in range(80))
    half = natural + " " + " ".join(f"{a} {b}" for a in common[:3] for b in common[:2]) * 300
    rows = [(1, natural), (2, "buy now " * 300), (3, noise), (4, half), (5, "short text"), (6, None)]
    out = {r.doc_id: r for r in bands.compression_bands(frame(rows, "doc_id long, text string"), keep=["doc_id"]).collect()}
    assert out[1].kept and not any(out[k].kept for k in (2, 3, 4, 5, 6))
    assert out[2].base_failed and out[5].base_failed and not out[3].base_failed
    whole = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False).compress(natural.encode())
    assert out[1].ratio == len(whole) / len(natural.encode())
    assert bands.compression_bands(frame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError, match="kept"):
        bands.compression_bands(frame([(1, "a", True)], "doc_id long, text string, kept boolean"))


def test_resampling_keeps_the_good_and_drops_the_bad(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = resample.resample_decisions(docs, labels).join(labels, "doc_id").cache()
    share = lambda q: out.where(f"quality = {q}").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert share(1) > 0.98 and share(0) < 0.4
    kept = resample.resample(docs, labels)
    decided = resample.resample_decisions(docs, labels)
    assert kept.columns == docs.columns and kept.count() == decided.where("kept").count()


def test_log_weights_match_brute_force(spark, frame):
    rules = resample.ResampleRules(buckets=64, noise=0.0)
    rows = [(1, "Good text, good text"), (2, "bad bad !!"), (3, None), (4, ""), (5, "good")]
    docs = frame(rows, "doc_id long, text string")
    labels = frame([(1, 1, 0), (2, 0, 0), (5, 1, 1)], "doc_id long, quality int, toxic int")
    model = resample.fit_resampler(docs, labels, rules)
    grams = {}
    for i, text in rows:
        row, bucket = resample._features(pa.array([text], pa.string()), 64)
        grams[i] = bucket.tolist()
    raw, target = np.ones(64), np.ones(64)
    for i, bs in grams.items():
        for b in bs:
            raw[b] += 1
            target[b] += i == 1
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    got = {r.doc_id: (r.log_weight, r.n_features) for r in resample.log_weights(docs, model, rules, keep=["doc_id"]).collect()}
    assert {i: n for i, (_, n) in got.items()} == {i: len(b) for i, b in grams.items()} and len(grams[1]) == 9
    for i, bs in grams.items():
        assert got[i][0] == pytest.approx(ratio[bs].sum())


@pytest.mark.parametrize("values", [[3.0] * 10, [float(k) for k in range(50)], [1e300, -1e300, 0.0, 5e-324], list(np.random.default_rng(2).normal(size=700).round(2))])
def test_kth_largest_is_exact(frame, values):
    df = frame([(float(v),) for v in values], "v double")
    for k in {1, 2, len(values) // 2 or 1, len(values)}:
        assert resample.kth_largest(df, "v", min(k, len(values)), bins=4) == sorted(values, reverse=True)[min(k, len(values)) - 1]


def test_resampling_edges(frame):
    docs = frame([(1, "a b", "x"), (1, "a b", "x"), (None, None, "y")], "doc_id long, text string, log_weight string")
    none = frame([], "doc_id long, quality int, toxic int")
    assert resample.resample_decisions(docs.drop("log_weight"), none).where("kept").count() == 3
    assert resample.resample(docs, none).columns == docs.columns
    assert resample.resample_decisions(docs.limit(0), none).count() == 0


def test_labels_of_rows_that_are_gone_take_no_others(frame):
    """Bad rows that an earlier stage rejected do not count for the kept share."""
    labels = frame([(k, 1 if k < 10 else 0, 0) for k in range(20)], "doc_id long, quality int, toxic int")
    docs = frame([(k, f"some words {k}") for k in range(10)], "doc_id long, text string")
    assert resample.fit_resampler(docs, labels).keep_share == 1.0
    assert resample.fit_resampler(docs.union(frame([(15, "bad words")], "doc_id long, text string")), labels).keep_share < 1.0


def test_languages_learn_from_rows_without_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.lit(None).cast("long").alias("doc_id"), "text", "lang")
    model = language.learn_languages(docs)
    assert len(model) == 4 and all(len(x) > 30_000 for x in model.values())
