import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratiform.llm.tokenbits import BitRules, PackedFile, PackedWriter, bits_for, pack, pieces, read_token_files, token_index, unpack, write_token_files
from stratiform.session import shared_folder

MODEL = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
SMALL = BitRules(block=64, file_ids=3000, part_ids=500)


def expected(rows):
    """(doc_id, start, n_tokens, crc) by plain encoding, rows of one id in any order of their texts."""
    at, out = 0, []
    for doc_id, text in rows:
        ids = MODEL.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def got(df):
    return [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.orderBy("start").collect()]


@settings(deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=70))
def test_packing_is_exact_and_smallest(width, ids):
    ids = np.array(ids, np.uint64) & np.uint64((1 << width) - 1)
    data = pack(ids, width)
    assert len(data) == (len(ids) * width + 7) // 8
    assert unpack(data, len(ids), width).tolist() == ids.tolist()
    assert sum(int(x) << (k * width) for k, x in enumerate(ids)) == int.from_bytes(data, "little")


def test_too_large_ids_are_refused():
    with pytest.raises(ValueError):
        pack(np.array([8]), 3)
    assert [bits_for(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


def test_random_access(tmp_path):
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 1 << 13, n) for n in (0, 1, 700, 64, 5000, 3)]
    out = PackedWriter(f"{tmp_path}/a/b.idbits", 13, 64)
    for k, ids in enumerate(docs):
        for at in range(0, len(ids), 999):
            out.add(ids[at : at + 999])
        out.end(None if k == 0 else -k)
    out.close()
    held, everything = PackedFile(f"file:{tmp_path}/a/b.idbits"), np.concatenate(docs)
    assert held.n_ids == len(everything) and held.doc_ids.tolist() == [0, -1, -2, -3, -4, -5] and held.null.tolist() == [True] + [False] * 5
    for k, ids in enumerate(docs):
        assert held.document(k).tolist() == ids.tolist()
    for a, b in rng.integers(0, len(everything) + 1, (50, 2)):
        assert held.ids(int(a), int(b)).tolist() == everything[a : max(a, b)].tolist()
    (tmp_path / "cut").write_bytes((tmp_path / "a/b.idbits").read_bytes()[:-1])
    with pytest.raises(ValueError):
        PackedFile(f"{tmp_path}/cut")


@settings(deadline=None, max_examples=60)
@given(st.text(alphabet="ab Z.'s\n\té1", max_size=200))
def test_cuts_do_not_change_ids(text):
    parts = list(pieces(text, 7))
    assert "".join(parts) == text
    assert sum((MODEL.encode(p, add_special_tokens=False).ids for p in parts), []) == MODEL.encode(text, add_special_tokens=False).ids


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect())
    out = token_index(docs.withColumn("file", F.lit(1)).withColumn("start", F.lit(2)), SMALL).cache()
    assert got(out) == expected(rows)
    assert out.select("file").distinct().count() > 20


def test_edges(spark, frame):
    rows = [(3, "x"), (None, None), (3, "y"), (2, ""), (5, "word " * 40_000), (3, "x"), (-7, None), (4, "long" * 9000)]
    out = got(token_index(frame(rows, "doc_id long, text string"), SMALL))
    assert [x[0] for x in out] == [None, -7, 2, 3, 3, 3, 4, 5]
    assert [x[1] for x in out] == np.cumsum([0] + [x[2] for x in out])[:-1].tolist()
    assert sorted(x[2:] for x in out) == sorted(x[2:] for x in expected(rows))
    assert token_index(frame([], "doc_id long, text string"), SMALL).collect() == []


def test_one_id_with_all_rows_is_split(spark):
    docs = spark.range(400).select(F.lit(9).alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text")).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would join so small parts again
    try:
        files = write_token_files(docs, shared_folder(spark), SMALL).cache()
        files.count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert files.select("part").distinct().count() > 1 and files.agg(F.sum("n_docs")).first()[0] == 400
    again = read_token_files(files, SMALL)
    assert again.count() == 400 and again.select("start").distinct().count() == 400
