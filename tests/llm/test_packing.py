import functools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratiform.llm.packing import PackRules, WordIds, pack_documents, plan_sequences, token_ids

ODD = [
    "it's 'tis dogs'. don't,'x", "áb…»x É.é <|endoftext|> <|EndOfText|> <|x|>", "\x00a\x1cb c\u0085d e f", "中文字 text, 123abc_def", "", "  ", None,
    "Σίσυφος ΟΔΟΣ. İstanbul, ǅ x²", "×÷ a×b.", "ß ẞ ŉ.", "á. Áb, é", "don't. DON'T!", "<|STARTOFTEXT|>. x", "a|b||c %$", "x" * 3000,
]


@functools.cache
def model():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@functools.cache
def words_once():
    return WordIds(None, 1000)


def test_ids_equal_those_of_whole_texts(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()] + ODD
    words = WordIds(None, 500)
    for _ in range(2):  # the second time from memory
        flat, bounds = token_ids(pa.array(texts), words)
        for k, text in enumerate(texts):
            assert flat[bounds[k] : bounds[k + 1]].tolist() == model().encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aB1'.,-_é»ñ…́ \n|<>$İΣ")), max_size=25), max_size=5))
def test_ids_of_any_text(texts):
    flat, bounds = token_ids(pa.array(texts, pa.string()), words_once())
    for k, text in enumerate(texts):
        assert flat[bounds[k] : bounds[k + 1]].tolist() == model().encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40)))
def test_plans_use_every_length_as_often_as_counted(counts):
    plan = plan_sequences(counts, 32)
    used = {}
    for lengths, times in plan:
        assert sum(lengths) <= 32 and times > 0
        for x in lengths:
            used[x] = used.get(x, 0) + times
    assert used == counts
    total = sum(k * n for k, n in counts.items())
    assert sum(t for _, t in plan) <= 2 * -(-total // 32) + 1


def test_complements_fill_sequences_exactly():
    assert plan_sequences({2000: 5, 48: 5}, 2048) == [((2000, 48), 5)]
    assert plan_sequences({2000: 3, 40: 3, 8: 3}, 2048) == [((2000, 40, 8), 3)]
    assert plan_sequences({1000: 2, 500: 2, 300: 2, 248: 2}, 2048) == [((1000, 500, 300, 248), 2)]
    assert plan_sequences({2048: 7}, 2048) == [((2048,), 7)] and plan_sequences({}, 2048) == []


def test_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = pack_documents(docs, with_ids=True).toPandas()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for doc, part in rows.sort_values("piece").groupby("doc_id"):
        ids = [i for x in part["ids"] for i in x]
        assert ids == [*model().encode(texts[doc], add_special_tokens=False).ids, 0]
        assert part.start.tolist() == [2048 * k for k in range(len(part))] and (part.length[:-1] == 2048).all()
        assert [zlib.crc32(np.array(x, "<u4").tobytes()) for x in part["ids"]] == part.ids_crc32.tolist()
    for _, part in rows.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *part.length.cumsum()[:-1]] and part.length.sum() <= 2048
    assert rows.sequence_id.nunique() <= 1.05 * -(-rows.length.sum() // 2048) + 1


def test_edges(frame, spark):
    rows = [(1, None, 5), (2, "", 6), (3, "a", 7), (3, "a", 7), (None, "b " * 5000, 8)]
    out = pack_documents(frame(rows, "doc_id long, text string, piece int"), PackRules(rows=2)).toPandas()
    assert sorted(out.length) == [1, 1, 2, 2, 905, 2048, 2048]
    for _, part in out.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *part.length.cumsum()[:-1]]
    assert pack_documents(frame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("n", [400])
def test_equal_lengths_get_places_of_their_own(spark, n):
    docs = spark.range(n).selectExpr("id doc_id", "'a b c' text")
    out = pack_documents(docs, PackRules(rows=30)).toPandas()
    assert len(out.drop_duplicates(["sequence_id", "offset"])) == n and out.sequence_id.nunique() == 1
