"""Land delimited and JSON files as text columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stratiform.functions.text import FILE_MISSING, nullify_file_cell
from stratiform.sources.records import CsvPieces, JsonPieces, file_records, open_lines

RATINGS_SCHEMA = T.StructType([
    T.StructField("movie_id", T.StringType()),
    T.StructField("ratings_summary", T.StructType([
        T.StructField("avg_rating", T.StringType()),
        T.StructField("total_ratings", T.StringType()),
        T.StructField("std_dev", T.StringType()),
    ])),
])
# Landed column → place in the nested document; the deviation is renamed on the way.
# Fixed value: control characters that no JSON text holds.
NO_LINE = "\x1e\x00\x1e"

RATINGS_COLUMNS = {
    "movie_id": "movie_id",
    "avg_rating": "ratings_summary.avg_rating",
    "total_ratings": "ratings_summary.total_ratings",
    "stg_dev": "ratings_summary.std_dev",
}


def file_order() -> Column:
    """Position of a row in its files: path, block, then place in the block. Only valid right above the file scan."""
    return F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "FAILFAST"}


def land_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    loaded_at: dt.datetime | None = None,
    multi_line: bool = False,
    missing: Sequence[str] = FILE_MISSING,
    order_as: str | None = None,
    exact: bool = True,
    breaks: bool = False,
) -> DataFrame:
    """Read CSV by header name, all cells as text, missing markers and blanks as NULL.

    A column the table does not have is an error (``exact``) or is left unread, one the file does not have is NULL.
    Files split into ranges. A cell whose quotes hold a line break is an error, raised at the call, which looks through the quotes of
    all lines for it. ``breaks`` allows such cells and still reads each file in ranges, see ``file_records``; ``multi_line`` allows
    them too, but reads each file in one task.
    """
    if breaks:
        raw, order = _csv_records(spark, path)
    else:
        if not multi_line:
            _refuse_breaks(spark, path)
        raw, order = spark.read.options(header=True, multiLine=multi_line, enforceSchema=False, **CSV_OPTIONS).csv(path), None
    extra = [c for c in raw.columns if c not in columns and c != order]
    if exact and extra:
        raise ValueError(f"columns not in the table: {extra}")
    cells = [
        (nullify_file_cell(F.col(f"`{c}`"), missing) if c in raw.columns else F.lit(None).cast("string")).alias(c)
        for c in columns
    ]
    if loaded_at is not None:
        cells.append(F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("loaded_at"))
    if order_as:
        cells.append((F.col(f"`{order}`") if order else file_order()).alias(order_as))
    return raw.select(*cells)


def _refuse_breaks(spark: SparkSession, path: str | Sequence[str]) -> None:
    quoted = spark.read.text(path).where(F.col("value").contains('"'))
    found = quoted.mapInArrow(open_lines, "value string").agg(F.min("value")).first()[0]
    if found is not None:
        raise ValueError(f"a cell holds a line break, which needs breaks=True or multi_line=True; its line begins with {found!r}")


def _place() -> Column:
    """As ``file_order``, for rows of ``file_records``."""
    return F.struct("path", "block", F.col("piece").alias("row"))


def _csv_records(spark: SparkSession, path: str | Sequence[str]) -> tuple[DataFrame, str]:
    """All cells by header name, and the name of a last column with the place of the row. Every file must have the same header."""
    head = spark.read.options(multiLine=True, **CSV_OPTIONS).csv(path).first()
    names = [] if head is None else list(head)
    if None in names or len({*names}) < len(names):
        raise ValueError(f"column names are missing or occur twice: {names}")
    record = F.regexp_replace("record", r"\A\ufeff|\r\z", "")
    rows = file_records(spark, path, CsvPieces()).select(record.alias("record"), "first", _place().alias("place")).where("record <> ''")
    schema = ", ".join(f"c{k} string" for k in range(len(names))) or "c0 string"
    rows = rows.withColumn("cells", F.from_csv("record", schema, {**CSV_OPTIONS, "multiLine": "true"}))
    given = F.array(*[F.col(f"cells.c{k}") for k in range(len(names))])
    same = F.when(given == F.array(*map(F.lit, names)), False).otherwise(F.raise_error(F.concat(F.lit("a file has other columns: "), "record")))
    order = "".join(["place", *names])  # longer than any column's name
    rows = rows.where(F.when(F.col("first"), same).otherwise(True))
    return rows.select(*[F.col(f"cells.c{k}").alias(n) for k, n in enumerate(names)], F.col("place").alias(order)), order


def land_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = RATINGS_SCHEMA,
    flatten: Mapping[str, str] = RATINGS_COLUMNS,
    loaded_at: str | None = None,
    multi_line: bool = False,
    order_as: str | None = None,
    arrays: bool = False,
) -> DataFrame:
    """Read JSON and flatten nested fields to columns; a missing nested object gives NULLs.

    Files hold one object or array a line and split into ranges. With ``arrays`` a file is one array of objects, or objects one after
    the other, with line breaks anywhere or nowhere, and still splits, see ``file_records``; a nested value in a text column comes
    without white space between its parts. With ``multi_line`` a file of up to 2 GB is one object or array, read in one task; where it is longer
    than a range of Spark's reader, a task for each range reads on to its end, so ``arrays`` is for such files.
    """
    if arrays:
        raw = _json_records(spark, path, schema)
    else:
        # Spark's multi-line reader goes back to the file for every number in a text column, 4 KB each time. So a file is one line.
        raw = spark.read.schema(schema).option("mode", "FAILFAST").json(path, lineSep=NO_LINE if multi_line else None)
    cells = [F.col(place).alias(name) for name, place in flatten.items()]
    if loaded_at is not None:
        cells.append(F.lit(loaded_at).alias("loaded_at"))
    if order_as:
        cells.append((F.col("_place") if arrays else file_order()).alias(order_as))
    return raw.select(*cells)


def _json_records(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    rows = file_records(spark, path, JsonPieces())
    before = F.when(F.col("base") == 0, r"\A\ufeff?\s*\{").when(F.col("first"), r"\A\ufeff?\s*\[\s*\{").otherwise(r"\A\s*,\s*\{")
    bad = F.raise_error(F.concat(F.lit("not an object in its place: "), F.substring("record", 1, 200)))
    text = F.when(F.regexp("record", before), F.regexp_replace("record", r"\A[^{]*", "")).otherwise(bad)
    parsed = F.from_json(text, schema, {"mode": "FAILFAST"})
    return rows.select(parsed.alias("doc"), _place().alias("_place")).select("doc.*", "_place")
