"""Audit reports: key quality, layer counts, coverage, filter impact, corrections, freshness and top-k.

Each input table is read once, with one aggregate for all its metrics. The reports are unions of one-row aggregates.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stratiform.functions.measures import BOTH_MILLION, BUDGET_MILLION, BUDGET_THOUSAND, ORIGINAL
from stratiform.functions.numbers import exact_mean, exact_ratio
from stratiform.functions.text import nullify_spaces
from stratiform.operators.lists import tokens


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _long(rows: DataFrame, section: str, prefix: Column | None, metrics: Mapping[str, Column]) -> DataFrame:
    """Wide one-row metrics to (section, metric, value)."""
    entries = [
        F.struct(
            (F.concat(prefix, F.lit(f":{name}")) if prefix is not None else F.lit(name)).alias("metric"),
            value.cast("long").alias("value"),
        )
        for name, value in metrics.items()
    ]
    return rows.select(F.lit(section).alias("section"), F.inline(F.array(*entries)))


def key_quality(relations: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, rows without a key and rows beyond the first per key, for each relation."""

    def one(name: str, df: DataFrame, key: str) -> DataFrame:
        known = df.groupBy(nullify_spaces(F.col(key)).alias("known")).agg(F.count(F.lit(1)).alias("n"))
        rows = F.coalesce(F.sum("n"), F.lit(0))
        return known.agg(
            F.lit(name).alias("relation"),
            rows.alias("total_rows"),
            F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("missing_key_rows"),
            (rows - F.count("known")).alias("duplicate_key_rows"),
        )

    return _union([one(name, df, key) for name, (df, key) in relations.items()])


def layer_counts(tables: Mapping[str, tuple[DataFrame, DataFrame, DataFrame]]) -> DataFrame:
    """Rows of each table in its raw, staged and typed layer, and the drop from one to the next."""
    layers = ("raw_rows", "staged_rows", "typed_rows")
    counts = _union(
        [
            df.agg(F.lit(name).alias("table_name"), F.lit(layer).alias("layer"), F.count(F.lit(1)).alias("n"))
            for name, frames in tables.items()
            for layer, df in zip(layers, frames)
        ]
    )
    wide = counts.groupBy("table_name").agg(*[F.max(F.when(F.col("layer") == x, F.col("n"))).alias(x) for x in layers])
    return wide.withColumns(
        {
            "raw_minus_staged": F.col("raw_rows") - F.col("staged_rows"),
            "staged_minus_typed": F.col("staged_rows") - F.col("typed_rows"),
        }
    )


def coverage(universe: DataFrame, universe_key: str, kept: DataFrame, kept_key: str) -> DataFrame:
    """Distinct ids of the universe, those kept, and the difference."""
    sides = _union(
        [
            df.agg(F.lit(name).alias("side"), F.count_distinct(nullify_spaces(F.col(key))).alias("n"))
            for name, df, key in (("universe", universe, universe_key), ("kept", kept, kept_key))
        ]
    )
    pick = {name: F.max(F.when(F.col("side") == name, F.col("n"))) for name in ("universe", "kept")}
    return sides.agg(
        pick["universe"].alias("universe_ids"),
        pick["kept"].alias("kept_ids"),
        (pick["universe"] - pick["kept"]).alias("missing_ids"),
    )


def filter_impact(df: DataFrame, list_column: str, date_column: str, sep: str = ",") -> DataFrame:
    """What exploding a list would give: items before filters, blank ones, ones without a year, and those kept."""
    pieces = F.split(F.coalesce(F.col(list_column), F.lit("")), f"\\Q{sep}\\E")
    items = F.size(pieces)
    blank = F.size(F.filter(pieces, lambda x: F.trim(x) == ""))
    dated = F.col(date_column).isNotNull()
    sizes = df.select(items.alias("items"), blank.alias("blank"), dated.alias("dated"))

    def total(c: Column, name: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).alias(name)

    return sizes.agg(
        total(F.col("items"), "exploded_rows_before_filter"),
        total(F.col("blank"), "dropped_blank_company_rows"),
        total(F.when(~F.col("dated"), F.col("items")), "dropped_null_release_year_rows"),
        total(F.when(F.col("dated"), F.col("items") - F.col("blank")), "rows_kept_by_bridge_filter"),
    )


def audit_report(
    quality: DataFrame, layers: DataFrame, covered: DataFrame, impact: DataFrame, ordered: bool = True
) -> DataFrame:
    """All audit parts as (section, metric, value)."""

    def same(*names: str) -> dict[str, Column]:
        return {n: F.col(n) for n in names}

    relation, table = F.col("relation"), F.col("table_name")
    parts = [
        _long(quality, "raw_key_quality", relation, same("total_rows", "missing_key_rows", "duplicate_key_rows")),
        _long(layers, "layer_counts", table, {
            "raw_rows": F.col("raw_rows"),
            "python_staging_rows": F.col("staged_rows"),
            "dbt_staging_rows": F.col("typed_rows"),
        }),
        _long(layers, "layer_deltas", table, {
            "raw_minus_python_staging": F.col("raw_minus_staged"),
            "python_staging_minus_dbt_staging": F.col("staged_minus_typed"),
        }),
        _long(covered, "ratings_coverage", None, {
            "movie_universe_ids": F.col("universe_ids"),
            "ratings_ids_kept": F.col("kept_ids"),
            "movie_ids_without_ratings_after_stage": F.col("missing_ids"),
        }),
        _long(impact, "bridge_filter_impact", None, same(*impact.columns)),
    ]
    report = _union(parts)
    return report.orderBy("section", "metric") if ordered else report


def correction_audit(bridge: DataFrame, ordered: bool = True) -> DataFrame:
    """Rows whose amounts were repaired, with the amounts as they came."""
    flag = F.col("budget_correction_flag")
    budget, revenue = F.col("budget_amount"), F.col("revenue_amount")
    million, thousand = F.lit(1_000_000), F.lit(1000)
    rows = bridge.filter(flag != ORIGINAL).select(
        "movie_id",
        "title",
        "release_year",
        "production_company",
        F.when(flag == BOTH_MILLION, revenue / million).otherwise(revenue).cast("decimal(18,2)").alias("revenue_original"),
        revenue.alias("revenue_corrected"),
        F.when(flag.isin(BOTH_MILLION, BUDGET_MILLION), budget / million)
        .when(flag == BUDGET_THOUSAND, budget / thousand)
        .cast("decimal(18,2)")
        .alias("budget_original"),
        budget.alias("budget_corrected"),
        F.when(budget > 0, exact_ratio(revenue, budget, 2, "decimal(22,2)")).alias("roi_corrected"),
        flag.alias("budget_correction_flag"),
        "record_loaded_at",
    )
    return rows.orderBy("budget_correction_flag", "production_company", "release_year", "title") if ordered else rows


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("rows")) for n, df in tables.items()])


def freshness(tables: Mapping[str, tuple[DataFrame, str]], now: dt.datetime) -> DataFrame:
    """Latest load time of each table and its age in seconds at a given time."""
    at = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")

    def one(name: str, df: DataFrame, column: str) -> DataFrame:
        latest = df.agg(F.max(column).cast("timestamp_ntz").alias("last_loaded"))
        age = F.timestamp_diff("SECOND", F.col("last_loaded"), at)
        return latest.select(F.lit(name).alias("table_name"), "last_loaded", age.alias("age_seconds"))

    return _union([one(name, df, column) for name, (df, column) in tables.items()])


def top_k(df: DataFrame, by: Sequence[Column], k: int = 10) -> DataFrame:
    """The k first rows in an order: each task keeps k, so no full sort takes place."""
    return df.orderBy(*by).limit(k)


def list_group_performance(
    df: DataFrame, list_column: str, sep: str = ",", group: str = "genre_name", ordered: bool = True
) -> DataFrame:
    """Entities, mean rating and revenue in millions per item of a list column, from one row per entity.

    An item listed twice by an entity counts once. Repeats are dropped within the row, so entities are counted by plain
    partial counts and no distinct count has to shuffle every (item, entity) pair.
    """
    items = F.array_distinct(tokens(F.col(list_column), sep))
    rows = df.select("avg_rating", "revenue_amount", F.explode_outer(items).alias(group)).filter(F.col(group).isNotNull())
    out = rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("total_movies"),
        exact_mean(F.col("avg_rating"), 4).alias("avg_rating"),
        exact_ratio(F.sum("revenue_amount"), F.lit(1_000_000), 4).alias("total_revenue_millions"),
    )
    return out.orderBy(F.col("total_revenue_millions").desc_nulls_first(), group) if ordered else out


def cast_losses(df: DataFrame, table: str, cells: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Per column the cells with text, and those of them whose typed form is NULL, from one aggregate over the table.

    ``cells`` maps a name to its text and its typed form. A key that is lost drops its row from the typed table.
    """
    counts = []
    for name, (text, typed) in cells.items():
        some = nullify_spaces(text).isNotNull()
        counts.append(
            F.struct(F.lit(name).alias("column_name"), F.count_if(some).alias("filled_cells"), F.count_if(some & typed.isNull()).alias("lost_cells"))
        )
    one = df.agg(F.array(*counts).alias("counts"))
    return one.select(F.lit(table).alias("table_name"), F.inline("counts"))
