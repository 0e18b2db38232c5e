import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratiform.llm.backoff import BackoffRules, _pack, _unpack, score_texts


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]  # None: the end


def brute(rows, rules):
    """The same model from plain dictionaries."""
    held = {i: i is not None and zlib.crc32(str(i).encode()) % rules.parts == rules.part for i, _ in rows}
    train = [tokens(t) for i, t in rows if not held[i]]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    states = {*c, None}
    pairs = Counter((h, w) for t in train for h, w in zip(["<s>", *t[:-1]], t) if (h == "<s>" or h in states) and w in states)
    off = lambda counts: min(max((one := sum(k == 1 for k in counts)) / (one + 2 * sum(k == 2 for k in counts)), 0.1), 0.9) if any(k in (1, 2) for k in counts) else 0.5
    d1, d2 = off(c.values()), off(pairs.values())
    history = {h: (len(train) if h == "<s>" else c[h]) or 1 for h in {*states, "<s>"}}
    taken = Counter()
    for (h, _), k in pairs.items():
        taken[h] += k - d2
    left = {h: 1 - taken[h] / history[h] for h in history}
    p1 = lambda w: 1.0 if not n else (c[w] - d1) / n if c[w] else d1 * v / n

    def p(w, h):
        if h != "<s>" and h not in states:
            return p1(w)
        return left[h] * p1(w) + max(pairs.get((h, w), 0) - d2, 0) / history[h]

    out = {}
    for i, text in rows:
        t = tokens(text)
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)
        out[i] = (held[i], len(t), sum(c[w] > 0 for w in t), n, base, sum(math.log10(p(w, h)) for h, w in zip(["<s>", *t[:-1]], t)))
    for h in [*list(states)[:20], "<s>", "no state"]:
        assert not n or sum(p(w, h) for w in c) + p("never seen", h) == pytest.approx(1)
    return out


def got(df):
    return {r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in df.collect()}


def same(a, b):
    assert set(a) == set(b)
    for i in a:
        assert a[i][:4] == b[i][:4] and a[i][4:] == pytest.approx(b[i][4:])


@pytest.mark.parametrize("rules", [BackoffRules(block=30_000, range_bytes=20_000), BackoffRules()])
def test_given_documents(spark, sf, tmp_path, rules):
    spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(60).coalesce(1).write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    same(got(score_texts(docs, rules)), brute([(r.doc_id, r.text) for r in docs.collect()], rules))


def test_edges(spark, frame, tmp_path):
    rows = [(1, None), (2, ""), (3, "a A a b"), (4, "b " * 3000), (None, "a c"), (6, "new words"), (8, "a b")]
    path = str(tmp_path / "t")
    frame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).coalesce(1).write.parquet(path)
    rules = BackoffRules(block=5, range_bytes=1)
    same(got(score_texts(spark.read.parquet(path), rules)), brute(rows, rules))
    assert score_texts(frame([], "doc_id long, text string")).count() == 0


def test_held_out_texts_are_likelier_than_by_the_base(spark):
    out = score_texts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out")
    base, score = out.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > 0.9 * base and np.isfinite(score)


def test_nothing_to_train_on(frame):
    held = [k for k in range(200) if zlib.crc32(str(k).encode()) % 7 == 2]
    out = score_texts(frame([(k, "a b") for k in held], "doc_id long, text string")).collect()
    assert all((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0) for r in out)


def test_rare_words_have_arcs(spark, frame, tmp_path):
    """Every word has a share of the tokens below 1/4000; a pair that was trained is still likelier than one that was not."""
    held = lambda k: zlib.crc32(str(k).encode()) % 7 == 2
    one, two = [k for k in range(6000) if not held(k)][:2]
    first, second = [k for k in range(6000, 6100) if held(k)][:2]
    rows = [(k, f"u{k} v{k}") for k in range(6000)] + [(first, f"u{one} v{one}"), (second, f"u{one} v{two}")]
    path = str(tmp_path / "t")
    frame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)
    out = got(score_texts(spark.read.parquet(path)))
    assert out[first][0] and out[second][0] and out[first][4] == pytest.approx(out[second][4]) and out[first][5] > out[second][5] + 0.1


def test_texts_longer_than_a_block(spark, frame, tmp_path):
    rows = [(k, " ".join(f"w{(j * j + k) % 997}" for j in range(n))) for k, n in enumerate([200_000, 3, 0, 150_000, 7])]
    path = str(tmp_path / "t")
    frame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)
    rules = BackoffRules(block=1 << 16, range_bytes=1 << 18)
    same(got(score_texts(spark.read.parquet(path), rules)), brute(rows, rules))


def test_rows_that_move_raise(spark, frame):
    rows = frame([(k, f"a{k} b{k % 7}") for k in range(200)], "doc_id long, text string").repartition(3)
    moving = rows.coalesce(1).mapInPandas(lambda parts: (p.sample(frac=1) for p in parts), rows.schema)  # another order whenever it is read
    with pytest.raises(Exception, match="not what it was"):
        score_texts(moving, BackoffRules(block=200)).collect()


@pytest.mark.parametrize("size", [4, 6, 8])
def test_packed_numbers(size):
    x = np.random.default_rng(size).integers(0, 1 << (8 * size - 1), 1000, dtype=np.uint64)
    assert (_unpack(_pack(x, size), size) == x).all() and len(_unpack(_pack(x[:0], size), size)) == 0
