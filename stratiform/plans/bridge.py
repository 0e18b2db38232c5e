"""Entity rows to one row per entity and name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stratiform.functions.measures import budget_factor, repair_flag, revenue_factor
from stratiform.functions.names import NameTable
from stratiform.functions.text import ARTICLES, NAME_RULES
from stratiform.operators.lists import explode_names, merge_articles


def base_join(core: DataFrame, extended: DataFrame, ratings: DataFrame) -> DataFrame:
    """Dated core rows with their lists and ratings, and the latest load time of the three.

    All sides have one row per key and are pruned before the joins, which share one partitioning.
    """
    lists = extended.select(
        "movie_id", "production_companies", "genres", "production_countries", F.col("loaded_at").alias("_extended_at")
    )
    rated = ratings.select("movie_id", "avg_rating", "total_ratings", F.col("loaded_at").alias("_rated_at"))
    return (
        core.filter(F.col("release_date").isNotNull())
        .join(lists, "movie_id", "left")
        .join(rated, "movie_id", "left")
        .select(
            "movie_id",
            "title",
            "release_date",
            F.year("release_date").alias("release_year"),
            "budget_amount",
            "revenue_amount",
            "avg_rating",
            "total_ratings",
            "genres",
            "production_countries",
            "production_companies",
            F.greatest("loaded_at", "_extended_at", "_rated_at").alias("record_loaded_at"),
        )
    )


def repair_amounts(df: DataFrame, budget: str = "budget_amount", revenue: str = "revenue_amount") -> DataFrame:
    """Scale up amounts that lost their magnitude, and flag how."""
    flagged = df.withColumn("budget_correction_flag", repair_flag(F.col(budget), F.col(revenue)))
    flag = F.col("budget_correction_flag")
    return flagged.withColumns(
        {
            budget: (F.col(budget) * budget_factor(flag)).cast("decimal(18,2)"),
            revenue: (F.col(revenue) * revenue_factor(flag)).cast("decimal(18,2)"),
        }
    )


def company_bridge(
    base: DataFrame,
    sep: str = ",",
    articles: Sequence[str] = ARTICLES,
    rules: Sequence[tuple[str, str]] | NameTable = NAME_RULES,
    first_flag: str | None = None,
) -> DataFrame:
    """One row per entity and listed name. Amounts are repaired once per entity, before its list is unfolded."""
    merged = merge_articles(repair_amounts(base), "production_companies", sep, articles).drop("production_companies")
    rows = explode_names(merged, "items", "production_company", rules, first_flag)
    out = [
        "movie_id", "title", "release_date", "release_year", "budget_amount", "revenue_amount", "avg_rating",
        "total_ratings", "genres", "production_countries", "production_company", "budget_correction_flag",
        "record_loaded_at",
    ]
    kept = rows.filter((F.col("production_company") != "") & F.col("release_year").isNotNull())
    return kept.select(*out, *([first_flag] if first_flag else []))
