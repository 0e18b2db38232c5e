"""Files as they come."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratiform.sources.landing import land_csv, land_json
from stratiform.plans.tasklog import log_landed, read_log
from stratiform.session import cluster_settings
from stratiform.sources import tables
from stratiform.sources.tables import read_folder, register_views, write_folder, write_table
from stratiform.operators.dedup import collapse_duplicates

AT = dt.datetime(2024, 1, 1)


def test_numbers_of_an_array_file_are_read_once_and_as_they_stand(spark, tmp_path):
    f = tmp_path / "a.json"
    numbers = ["0.10", "1e3", "12345678901234567890", "-0", "7"]
    f.write_text("[" + ",\n".join(f'{{"movie_id": {k}, "ratings_summary": {{"avg_rating": {numbers[k % 5]}}}}}' for k in range(5000)) + "]\n", encoding="utf-8")
    read = lambda: sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = read()
    rows = land_json(spark, str(f), multi_line=True).select("movie_id", "avg_rating").collect()
    assert sorted(map(tuple, rows), key=lambda r: int(r[0])) == [(str(k), numbers[k % 5]) for k in range(5000)]
    assert read() - before < 10 * f.stat().st_size
    f.write_bytes(b"\xef\xbb\xbf {\"movie_id\": \"1\"}")
    (tmp_path / "empty.json").write_text(" \n")
    assert [r.movie_id for r in land_json(spark, str(tmp_path), multi_line=True).collect()] == ["1"]


def test_csv_by_header_name(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_text('title,id\n"x, ""y""\nz", 1 \nN/A,2\n')
    df = land_csv(spark, str(f), ["id", "title", "budget"], AT, multi_line=True)
    assert [tuple(r) for r in df.collect()] == [("1", 'x, "y"\nz', None, AT), ("2", None, None, AT)]


def test_csv_with_a_strange_column(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_text("id,odd\n1,2\n")
    with pytest.raises(ValueError, match="odd"):
        land_csv(spark, str(f), ["id"])
    assert land_csv(spark, str(f), ["id"], exact=False).columns == ["id"]


@pytest.mark.parametrize("multi_line", [True, False])
def test_file_order_tells_the_last_row(spark, tmp_path, multi_line):
    for name, values in (("a.csv", "pqr"), ("b.csv", "xyz")):
        (tmp_path / name).write_text("id,v\n" + "".join(f"1,{v}\n" for v in values))
    df = land_csv(spark, str(tmp_path), ["id", "v"], multi_line=multi_line, order_as="at")
    assert collapse_duplicates(df, "id", ["at"], ["v"]).first().v == "z"


@pytest.mark.parametrize("text", ['[{"movie_id": 1, "ratings_summary": {"avg_rating": 7.50, "total_ratings": 3}}, {"movie_id": "2"}]',
                                  '{"movie_id": 1, "ratings_summary": {"avg_rating": 7.50, "total_ratings": 3, "x": 1}}'])
def test_json_array_or_object(spark, tmp_path, text):
    f = tmp_path / "r.json"
    f.write_text(text)
    got = sorted(tuple(r) for r in land_json(spark, str(f), loaded_at="t", multi_line=True).collect())
    assert got[0] == ("1", "7.50", "3", None, "t")
    assert got[1:] in ([], [("2", None, None, None, "t")])


def test_append_and_overwrite(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "t")
    assert write_folder(df, path).count() == 3
    assert write_folder(df, path, append=True).count() == 6
    assert write_folder(df, path).count() == 3


def test_a_write_that_fails_halfway_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    write_folder(spark.range(100), path)
    broken = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 90, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    for append in (False, True):
        with pytest.raises(Exception, match="stop"):
            write_folder(broken, path, append=append)
        assert read_folder(spark, path).count() == 100


def test_readers_keep_the_version_they_began_with(spark, tmp_path):
    path = str(tmp_path / "t")
    old = write_folder(spark.range(5), path)
    assert write_folder(old.unionAll(old), path).count() == 10 and old.count() == 5
    write_folder(spark.range(1), path)
    assert read_folder(spark, path).count() == 1 and len(list((tmp_path / "t").glob("data-*"))) == 2


def test_an_append_with_a_key_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    for key, n in (("a", 3), ("b", 4), ("a", 1)):
        write_folder(spark.range(n), path, append=True, key=key)
    assert read_folder(spark, path).count() == 5


def test_a_second_writer_adds_to_the_first(spark, tmp_path, monkeypatch):
    path, taken = str(tmp_path / "t"), []
    create = tables._Files.create_whole

    def late(self, name, text):
        if not taken:
            taken.append(name)
            write_folder(spark.range(2), path, append=True)  # another writer comes first
        return create(self, name, text)

    monkeypatch.setattr(tables._Files, "create_whole", late)
    assert write_folder(spark.range(3), path, append=True).count() == 5


def test_partitions_and_buckets_are_published(spark, tmp_path):
    rows = spark.range(20).select("id", (F.col("id") % 3).alias("p"))
    path = str(tmp_path / "p")
    write_folder(rows, path, partition_by=["p"])
    assert write_folder(rows, path, append=True, partition_by=["p"]).where("p = 1").count() == 14
    made = write_folder(rows, str(tmp_path / "b"), bucket_by=(4, ["id"]))
    assert sorted(made.collect()) == sorted(rows.collect())
    assert sorted(read_folder(spark, str(tmp_path / "b")).collect()) == sorted(rows.collect())
    with pytest.raises(ValueError):
        write_folder(rows, path, append=True, bucket_by=(4, ["id"]))


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS landing_test LOCATION '{tmp_path}'")
        left, right = (write_table(spark.range(100), f"landing_test.{n}", bucket_by=(4, ["id"])) for n in ("l", "r"))
        joined = left.join(right, "id")
        assert joined.count() == 100
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql("DROP DATABASE IF EXISTS landing_test CASCADE")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")


def test_views_read_as_tables(spark):
    register_views({"three": spark.range(3)})
    assert spark.sql("SELECT count(*) FROM three").first()[0] == 3


def test_shuffles_grow_with_the_data():
    assert cluster_settings(100 << 40, 4000)["spark.sql.shuffle.partitions"] == "524288"
    assert cluster_settings(1 << 30, 4000)["spark.sql.shuffle.partitions"] == "8000"


def test_a_failed_step_is_logged_and_raised(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,odd\n1,2\n")
    log = str(tmp_path / "log")
    with pytest.raises(ValueError, match="odd"):
        log_landed(spark, lambda: land_csv(spark, str(tmp_path / "a.csv"), ["id"]), "r", "a", str(tmp_path / "raw"), log, AT, "a.csv")
    log_landed(spark, lambda: land_csv(spark, str(tmp_path / "a.csv"), ["id"], exact=False), "r", "a", str(tmp_path / "raw"), log, AT, "a.csv")
    got = {r.status: r for r in read_log(spark, log).collect()}
    assert set(got) == {"failed", "completed"} and got["completed"].rows_out == 1
    assert "odd" in got["failed"].error_message and got["failed"].rows_out is None and got["failed"].finished_at > got["failed"].started_at
