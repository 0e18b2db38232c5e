"""Declared data tests, as counts of violating rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _row(table: str, column: str, test: str, violations: Column) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(test).alias("test"),
        F.coalesce(violations, F.lit(0)).cast("long").alias("violations"),
    ]


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULLs of all named columns in one pass."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in columns]
    return counts.select(F.inline(F.array(*entries))).select(
        F.lit(table).alias("table_name"), "column_name", F.lit("not_null").alias("test"), "violations"
    )


def check_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    return repeated.agg(*_row(table, column, "unique", F.count(F.lit(1))))


def check_accepted(df: DataFrame, table: str, column: str, values: Sequence[str]) -> DataFrame:
    """Distinct values that are not in the list; NULL passes."""
    other = df.filter(~F.col(column).isin(*values)).select(column).distinct()
    return other.agg(*_row(table, column, "accepted_values", F.count(F.lit(1))))


def check_relationship(df: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose key is missing in the parent; NULL passes.

    Keys are counted before the anti join, so a key many rows share is one row of the join.
    """
    keys = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    orphans = keys.join(parent.select(F.col(parent_column).alias("_key")), "_key", "left_anti")
    return orphans.agg(*_row(table, column, "relationships", F.sum("_n")))


@dataclass(frozen=True)
class Declared:
    """Tests declared on one table."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    relationships: Mapping[str, tuple[str, str]] = field(default_factory=dict)


def run_checks(tables: Mapping[str, DataFrame], declared: Mapping[str, Declared]) -> DataFrame:
    """All declared tests of the given tables as one frame of violation counts."""
    out = []
    for name, tests in declared.items():
        df = tables[name]
        if tests.not_null:
            out.append(check_not_null(df, name, tests.not_null))
        out += [check_unique(df, name, c) for c in tests.unique]
        out += [check_accepted(df, name, c, values) for c, values in tests.accepted.items()]
        for c, (parent, key) in tests.relationships.items():
            out.append(check_relationship(df, name, c, tables[parent], key))
    return reduce(DataFrame.unionByName, out)
