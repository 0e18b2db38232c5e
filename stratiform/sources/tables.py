"""Writing layers: replace or append all at once, as folders of Parquet versions, catalog tables or views.

A published folder holds data in subfolders of their own and, in ``_versions``, numbered lists of the subfolders that make up the table.
A writer first writes its data, then lists it under the next number; the list appears by one rename that fails if the number is
taken. So readers see the table before or after a write and never in between, a write that dies leaves only an unlisted subfolder,
and of two writers at a time the second adds to what the first has published.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

VERSIONS = "_versions"


class _Files:
    """The few calls on a folder's file system that publishing needs, whatever store it is in."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.jvm, self.gateway, self.conf = spark._jvm, spark.sparkContext._gateway, spark._jsc.hadoopConfiguration()
        self.folder = folder.rstrip("/")
        self.fs = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self, name: str) -> list[str]:
        path = self._path(name)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_whole(self, name: str, text: str) -> bool:
        """Create a file with this text, all at once; False if it exists."""
        draft = self._path(f"{VERSIONS}/.{uuid.uuid4().hex}")
        out = self.fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.conf)
        plain = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(context.makeQualified(draft), context.makeQualified(self._path(name)), plain)
            return True
        except Exception as error:
            self.fs.delete(draft, False)
            if self.fs.exists(self._path(name)):
                return False
            raise error

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def _listed(files: _Files) -> tuple[int, dict | None]:
    """Number and content of the newest list; 0 and None where nothing is published."""
    names = [n for n in files.names(VERSIONS) if n.endswith(".json")]
    return (int(names[-1].removesuffix(".json")), json.loads(files.read(f"{VERSIONS}/{names[-1]}"))) if names else (0, None)


def publish(spark: SparkSession, path: str, part: str, key: str | None, append: bool, about: dict, keep: int = 2) -> None:
    """List a written subfolder: in place of all, or besides them and in place of one with the same key. Data that the last ``keep``
    lists do not name is removed."""
    files = _Files(spark, path)
    while True:
        number, old = _listed(files)
        parts = [p for p in old["parts"] if key is None or p["key"] != key] if append and old else []
        new = {"parts": [*parts, {"folder": part, "key": key}], **about}
        if files.create_whole(f"{VERSIONS}/{number + 1:012d}.json", json.dumps(new)):
            break
    listed = {n: json.loads(files.read(f"{VERSIONS}/{n}")) for n in files.names(VERSIONS) if n.endswith(".json")}
    last = sorted(listed)[-keep:]
    held = {p["folder"] for n in last for p in listed[n]["parts"]}
    for name in sorted(listed)[:-keep]:
        for p in listed[name]["parts"]:
            if p["folder"] not in held:
                files.delete(p["folder"])
        files.delete(f"{VERSIONS}/{name}")


def write_folder(
    df: DataFrame,
    path: str,
    append: bool = False,
    partition_by: Sequence[str] = (),
    key: str | None = None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> DataFrame:
    """Publish rows as Parquet below ``path`` and return the table as it is now, whose rows no longer depend on the plan that made them.

    Replaces the table, or adds to it (``append``). Appended rows with a ``key`` take the place of those appended with that key before,
    so a step that is repeated leaves its rows once. Tables in as many buckets of the same columns join on them without a shuffle;
    the buckets are part of what is published, so appending to them, or partitions beside them, is an error.
    """
    spark, part = df.sparkSession, f"data-{uuid.uuid4().hex}"
    place = f"{path.rstrip('/')}/{part}"
    if bucket_by:
        if append or partition_by:
            raise ValueError("a table in buckets is written as a whole, without partitions")
        count, columns = bucket_by
        name = f"buckets_{uuid.uuid4().hex}"
        dealt = df.repartition(count, *columns).write.bucketBy(count, *columns).sortBy(*columns)
        dealt.option("path", place).format("parquet").saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")  # an external table: its files stay, and readers find them by what is published
    else:
        df.write.partitionBy(*partition_by).parquet(place)
    about = {"partitions": list(partition_by), "schema": json.loads(df.schema.json())} | ({"buckets": [bucket_by[0], list(bucket_by[1])]} if bucket_by else {})
    publish(spark, path, part, key, append, about)
    return read_folder(spark, path)


def write_table(
    df: DataFrame,
    name: str,
    append: bool = False,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> DataFrame:
    """Write a catalog table. Tables in as many buckets of one key join and group on it without a shuffle."""
    writer = df.write.mode("append" if append else "overwrite").partitionBy(*partition_by)
    if bucket_by:
        count, columns = bucket_by
        writer = writer.bucketBy(count, *columns).sortBy(*columns)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Make models readable by name in SQL, without computing them."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """A published table as last listed, or a plain folder of Parquet files. The rows stay those of this moment."""
    number, listed = _listed(_Files(spark, path))
    if listed is None:
        return spark.read.parquet(path)
    base = path.rstrip("/")
    if "buckets" in listed:
        return _bucketed(spark, f"{base}/{listed['parts'][0]['folder']}", listed)
    parts = [f"{base}/{p['folder']}" for p in listed["parts"]]
    if listed["partitions"] and len(parts) > 1:  # each subfolder has partitions of its own
        return reduce(DataFrame.unionByName, [spark.read.parquet(p) for p in parts])
    return spark.read.parquet(*parts)


def _bucketed(spark: SparkSession, place: str, listed: dict) -> DataFrame:
    """The files as a table of this session's catalog that knows their buckets."""
    from pyspark.sql import types as T

    count, columns = listed["buckets"]
    name = "buckets_" + uuid.uuid5(uuid.NAMESPACE_URL, place).hex
    if not spark.catalog.tableExists(name):
        shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(listed["schema"]).fields)
        by = ", ".join(f"`{c}`" for c in columns)
        where = place.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({shape}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {count} BUCKETS LOCATION '{where}'")
    return spark.table(name)
