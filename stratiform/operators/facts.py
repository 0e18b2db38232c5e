"""Fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratiform.functions.measures import both_improved, interest_band
from stratiform.functions.numbers import percent_change
from stratiform.operators.dimensions import name_key


def rating_fact(ratings: DataFrame, entities: DataFrame) -> DataFrame:
    """One row per rated entity with its attributes, return on budget and interest band."""
    attributes = entities.select(
        "movie_id", "title", "release_date_key", "release_date", "genres", "production_countries", "budget_amount",
        "revenue_amount",
    )
    return ratings.join(attributes, "movie_id", "left").select(
        "movie_id",
        "title",
        "release_date_key",
        "release_date",
        F.year("release_date").alias("release_year"),
        F.month("release_date").alias("release_month"),
        "genres",
        "production_countries",
        "budget_amount",
        "revenue_amount",
        percent_change(F.col("revenue_amount"), F.col("budget_amount")).alias("roi_pct"),
        "avg_rating",
        "total_ratings",
        "std_dev",
        "avg_rating_minmax",
        "avg_rating_zscore",
        interest_band(F.col("total_ratings")).alias("interest_band"),
        F.col("loaded_at").alias("rating_loaded_at"),
    )


def group_year_fact(metrics: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Group-year measures under the key of the name dimension; names it does not have are dropped.

    A dimension built from the same bridge has every name, and its key is a function of the name: leave ``names`` out then,
    and no join takes place. With it, the name side goes by its compared form, and is broadcast only if it measures small.
    """
    norm = name_key(F.col("production_company"))
    if names is None:
        rows = metrics.filter(F.trim("production_company") != "").withColumn("production_company_key", F.md5(norm))
    else:
        keys = names.select(norm.alias("_key"), "production_company_key")
        rows = metrics.withColumn("_key", norm).join(keys, "_key")
    measures = [
        "release_year", "movies_released", "total_revenue", "avg_revenue", "weighted_avg_rating", "avg_vote_count",
        "prior_year_revenue", "prior_year_rating", "revenue_yoy_pct", "rating_yoy_delta",
    ]
    return rows.select(
        "production_company_key",
        "production_company",
        (F.col("release_year") * 10000 + 101).cast("int").alias("release_year_start_date_key"),
        F.make_date(F.col("release_year"), F.lit(1), F.lit(1)).alias("release_year_start_date"),
        *measures,
        both_improved(F.col("revenue_yoy_pct"), F.col("rating_yoy_delta")).alias("growth_and_rating_improved"),
        "record_loaded_at",
    )
