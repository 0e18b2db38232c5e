"""Staged text tables to typed tables with one row per entity."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stratiform.functions.dates import parse_routed_date
from stratiform.functions.measures import harmonise_rating
from stratiform.functions.numbers import clean_decimal, clean_int, digits_to_long, numeric_text
from stratiform.functions.text import BAR, nullify_spaces, rewrite_delimiters
from stratiform.operators.audit import cast_losses
from stratiform.operators.dedup import latest_per_key
from stratiform.operators.scaling import minmax_and_zscore


def _latest(staged: DataFrame, key: str, loaded: Column) -> DataFrame:
    """The latest row per numeric key; equal load times are settled by the other columns, so reruns agree."""
    keyed = staged.withColumn("movie_id", digits_to_long(F.col(key)))
    rest = [c for c in keyed.columns if c not in ("movie_id", "loaded_at")]
    return latest_per_key(keyed, "movie_id", [loaded, *rest])


def typed_core(staged: DataFrame) -> DataFrame:
    return _latest(staged, "id", F.col("loaded_at")).select(
        "movie_id",
        nullify_spaces(F.col("title")).alias("title"),
        parse_routed_date(F.col("release_date")).alias("release_date"),
        clean_decimal(F.col("budget")).alias("budget_amount"),
        clean_decimal(F.col("revenue")).alias("revenue_amount"),
        F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"),
    )


def typed_extended(staged: DataFrame, list_pattern: str = BAR) -> DataFrame:
    return _latest(staged, "id", F.col("loaded_at")).select(
        "movie_id",
        nullify_spaces(F.col("genres")).alias("genres"),
        nullify_spaces(F.col("production_countries")).alias("production_countries"),
        rewrite_delimiters(F.col("production_companies"), list_pattern).alias("production_companies"),
        nullify_spaces(F.col("spoken_languages")).alias("spoken_languages"),
        F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"),
    )


def ratings_on_one_scale(staged: DataFrame) -> DataFrame:
    """Typed ratings with the rating on 0..10, before it is rounded."""
    rating = numeric_text(F.col("avg_rating")).try_cast("decimal(24,12)")
    return _latest(staged, "movie_id", nullify_spaces(F.col("loaded_at"))).select(
        "movie_id",
        harmonise_rating(rating).alias("rating_10"),
        clean_int(F.col("total_ratings")).alias("total_ratings"),
        clean_decimal(F.col("stg_dev"), 10, 4).alias("std_dev"),
        nullify_spaces(F.col("loaded_at")).try_cast("timestamp_ntz").alias("loaded_at"),
    )


def typed_ratings(staged: DataFrame) -> DataFrame:
    return scored_ratings(ratings_on_one_scale(staged))


def scored_ratings(one_scale: DataFrame, known: Column | None = None) -> DataFrame:
    """Ratings with their column-wide scores. The column's statistics are a pass of their own, so give a written table, or those
    that were taken as it was written (``known``)."""
    scored = minmax_and_zscore(one_scale, "rating_10", "avg_rating_minmax", "avg_rating_zscore", known=known)
    return scored.select(
        "movie_id",
        F.round("rating_10", 4).cast("decimal(10,4)").alias("avg_rating"),
        "total_ratings",
        "std_dev",
        F.col("avg_rating_minmax").cast("decimal(12,6)").alias("avg_rating_minmax"),
        F.col("avg_rating_zscore").cast("decimal(12,6)").alias("avg_rating_zscore"),
        "loaded_at",
    )


def typing_losses(staged: Mapping[str, DataFrame]) -> DataFrame:
    """What typing the given staged tables loses, by table and column."""
    c = F.col
    cells = {
        "movies_main": {
            "id": (c("id"), digits_to_long(c("id"))), "release_date": (c("release_date"), parse_routed_date(c("release_date"))),
            "budget": (c("budget"), clean_decimal(c("budget"))), "revenue": (c("revenue"), clean_decimal(c("revenue"))),
        },
        "movie_extended": {"id": (c("id"), digits_to_long(c("id")))},
        "ratings": {
            "movie_id": (c("movie_id"), digits_to_long(c("movie_id"))),
            "avg_rating": (c("avg_rating"), numeric_text(c("avg_rating")).try_cast("decimal(24,12)")),
            "total_ratings": (c("total_ratings"), clean_int(c("total_ratings"))),
            "stg_dev": (c("stg_dev"), clean_decimal(c("stg_dev"), 10, 4)),
            "loaded_at": (c("loaded_at"), nullify_spaces(c("loaded_at")).try_cast("timestamp_ntz")),
        },
    }
    return reduce(DataFrame.unionByName, [cast_losses(df, name, cells[name]) for name, df in staged.items()])
