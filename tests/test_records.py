"""Files cut into records in parallel: as one task would read them, at any borders of the ranges."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.sources.landing import land_csv, land_json
from stratiform.sources.records import CsvPieces, JsonPieces, file_records

SHAPE = T.StructType().add("movie_id", "string").add("x", "string").add("ratings_summary", T.StructType().add("avg_rating", "string"))


@pytest.fixture(params=[900])
def small_ranges(spark, request):
    names = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield request.param
    for n, v in before.items():
        spark.conf.set(n, v)


def cell(rng):
    k = rng.random()
    if k < 0.5:
        return rng.choice([str(rng.randrange(1000)), "", 'stray " quote', "a'b", '5" x'])
    return '"' + "".join(rng.choice(["a", "b", ",", "\n", '""', "x y", "5,b\n", "é"]) for _ in range(rng.randrange(12))) + '"'


@pytest.mark.parametrize("end, name", [("\n", "no\nte"), ("\r\n", "note")])  # the one-task reader takes the first line end it sees for that of the file
def test_csv_as_one_task_reads_it(spark, tmp_path, small_ranges, end, name):
    rng = random.Random(small_ranges)
    for file, n in (("a", 300), ("b", 5)):
        rows = [f"{i},{cell(rng)}" for i in range(n)] + ["", '900,"' + "long\n" * 2000 + '"', "901,end"]
        (tmp_path / f"{file}.csv").write_bytes((f'id,"{name}"' + end + end.join(rows)).encode())
    path, columns = str(tmp_path), ["id", name, "budget"]
    got = land_csv(spark, path, columns, breaks=True, order_as="at").orderBy("at").drop("at")
    want = land_csv(spark, path, columns, multi_line=True, order_as="at").orderBy("at").drop("at")
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert got.count() == 309


def test_states_beyond_a_broadcast(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text("id,n\n" + "".join(f'{i},"{i}\n{"z" * (i % 90)},"""\n' for i in range(300)))
    some, others = (file_records(spark, str(tmp_path), CsvPieces(), n).select("record").collect() for n in (10**6, 0))
    assert sorted(some) == sorted(others) and len(some) == 301


def test_many_tasks_read_one_cell_and_one_file(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text('id,n\n1,"' + "x\n" * 6000 + '"\n2,b\n')
    (tmp_path / "b.json").write_text(json.dumps([{"movie_id": k} for k in range(1000)]))
    rows = land_csv(spark, f"{tmp_path}/a.csv", ["id", "n"], breaks=True)
    assert sorted((r.id, len(r.n)) for r in rows.collect()) == [("1", 11999), ("2", 1)]
    made = file_records(spark, f"{tmp_path}/b.json", JsonPieces())
    assert made.select("block").distinct().count() > 2 and made.count() == 1000


def test_a_break_is_an_error_by_default(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_text('id,note\n1,"a\n5,b"\n2,c\n')
    with pytest.raises(ValueError, match="line break"):
        land_csv(spark, str(f), ["id", "note"])
    for how in ({"breaks": True}, {"multi_line": True}):
        assert sorted(tuple(r) for r in land_csv(spark, str(f), ["id", "note"], **how).collect()) == [("1", "a\n5,b"), ("2", "c")]
    f.write_text('id,note\n1,"a ""quoted"", b"\n2,5" c\n')
    assert land_csv(spark, str(f), ["id", "note"]).count() == 2


@pytest.mark.parametrize("text", ['id,n\n1,"a\n', "id,n\n1\n", "id,n\n1,a\r2,b\n", 'id,n\n1,"a""\n2,b\n', "id,id\n1,2\n", "id,\n1,2\n"])
def test_broken_files_are_errors(spark, tmp_path, text):
    (tmp_path / "a.csv").write_bytes(text.encode())
    with pytest.raises(Exception):
        land_csv(spark, str(tmp_path), ["id", "n"], breaks=True).collect()


def test_files_with_other_headers_are_errors(spark, tmp_path):
    for name, head in (("a", "id,n"), ("b", "n,id")):
        (tmp_path / f"{name}.csv").write_text(f"{head}\n1,2\n")
    with pytest.raises(Exception, match="other columns"):
        land_csv(spark, str(tmp_path), ["id", "n"], breaks=True).collect()


def test_files_without_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n\n")
    assert land_csv(spark, str(tmp_path), ["id", "n"], breaks=True).collect() == []


def value(rng, deep=0):
    k = rng.random()
    if k < 0.5 or deep > 3:
        return "".join(rng.choice(["a", "}", "{", '"', "\\", "[", "]", ",", "\n", "é"]) for _ in range(rng.randrange(8)))
    if k < 0.7:
        return rng.choice([None, 5, -1.5, True])
    if k < 0.85:
        return {rng.choice("ab"): value(rng, deep + 1) for _ in range(rng.randrange(3))}
    return [value(rng, deep + 1) for _ in range(rng.randrange(3))]


def tight(text):
    """A nested value in a text column, without white space between its parts."""
    try:
        return json.dumps(json.loads(text))
    except (TypeError, ValueError):
        return text


def documents(seed):
    rng = random.Random(seed)
    docs = [{"movie_id": str(i), "x": value(rng), "ratings_summary": rng.choice([None, {"avg_rating": "7.50", "y": value(rng)}])} for i in range(200)]
    return [*docs, {"movie_id": "200", "x": "}" * 4000}]


@pytest.mark.parametrize("indent", [None, 2])
def test_json_arrays_as_one_task_reads_them(spark, tmp_path, small_ranges, indent):
    docs = documents(small_ranges)
    (tmp_path / "a.json").write_text(json.dumps(docs, indent=indent, ensure_ascii=indent is None) + "\n" * (indent or 0))
    (tmp_path / "b.json").write_text(" [ ] \n")
    (tmp_path / "c.json").write_text(json.dumps(docs[0], indent=indent))
    flat = {"movie_id": "movie_id", "x": "x", "avg": "ratings_summary.avg_rating"}
    got = land_json(spark, str(tmp_path), SHAPE, flat, arrays=True, order_as="at").orderBy("at").drop("at")
    want = land_json(spark, str(tmp_path), SHAPE, flat, multi_line=True, order_as="at").orderBy("at").drop("at")
    assert [(r.movie_id, tight(r.x), r.avg) for r in got.collect()] == [(r.movie_id, tight(r.x), r.avg) for r in want.collect()]
    assert got.count() == 202
    texts = file_records(spark, f"{tmp_path}/a.json", JsonPieces()).orderBy("block", "piece").select(F.regexp_replace("record", r"\A[^{]*", "")).collect()
    assert [json.loads(r[0]) for r in texts] == docs


def test_objects_one_after_the_other(spark, tmp_path, small_ranges):
    docs = documents(1)
    (tmp_path / "a.json").write_text("\n".join(json.dumps(d, indent=1) for d in docs))
    assert land_json(spark, str(tmp_path), SHAPE, {"movie_id": "movie_id"}, arrays=True).distinct().count() == 201


@pytest.mark.parametrize("text", ['[{"a":1}', '[{"a":1', '{"a":{"b":1}', '[{"a":1}]}', '[{"a":"x}]', '[1, {"a":1}]', '[{"a":1} {"a":2}]', '{"a":1},{"a":2}', '[{"a":1}] x'])
def test_broken_arrays_are_errors(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception):
        land_json(spark, str(tmp_path), SHAPE, {"movie_id": "movie_id"}, arrays=True).collect()
