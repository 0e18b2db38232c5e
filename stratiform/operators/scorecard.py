"""Trend bands, group summaries, decision scores and labels."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from stratiform.functions.measures import trend_band
from stratiform.functions.numbers import exact_mean, exact_ratio
from stratiform.operators.metrics import with_prior
from stratiform.operators.scaling import with_scalar

# Score of each trend band; any other band scores 0.
BAND_SCORES = {
    "outperforming": "1.00",
    "stable_positive": "0.80",
    "rating_up_revenue_down": "0.50",
    "revenue_up_rating_down": "0.50",
    "declining": "0.20",
}
# Label of each trend band.
BAND_LABELS = {
    "outperforming": "Outperforming",
    "stable_positive": "Stable Positive",
    "rating_up_revenue_down": "Rating Up, Revenue Down",
    "revenue_up_rating_down": "Revenue Up, Rating Down",
    "declining": "Declining",
}
# Dot colour of each trend band.
BAND_COLOURS = {
    "outperforming": "#67002E",
    "stable_positive": "#A8C1D3",
    "rating_up_revenue_down": "#C480A7",
    "revenue_up_rating_down": "#6E98B5",
    "declining": "#364B59",
}
# What a group without a band, and an inactive group, show.
NO_BAND, NO_LABEL, NO_COLOUR = "unclassified", "Unclassified", "#9E9E9E"
INACTIVE_BAND, INACTIVE_LABEL, INACTIVE_COLOUR = "inactive", "Inactive", "#7A7A7A"
DOT = "⬤"


@dataclass(frozen=True)
class ScoreRules:
    """Windows, weights and cut-offs; the defaults are the reference values."""

    trend_years: tuple[int, int] = (1990, 2024)
    years: tuple[int, int] = (2000, 2024)
    min_years: int = 5
    inactive_year: int = 2013
    recent_gap: int = 2
    full_years: int = 15
    weights: Mapping[str, str] = field(
        default_factory=lambda: {"latest": "0.45", "dominant": "0.25", "years": "0.10", "recency": "0.20"}
    )
    recency: tuple[tuple[int, str], ...] = ((0, "1.00"), (2, "0.80"), (5, "0.50"))
    consistency_above: str = "0.15"
    incentivise_from: str = "0.40"
    review_from: str = "0.20"


def _number(text: str) -> Column:
    return F.lit(Decimal(text))


def _lookup(c: Column, table: Mapping[str, str], other: str) -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[c], F.lit(other))


def trend_bands(fact: DataFrame, rules: ScoreRules = ScoreRules()) -> DataFrame:
    """Each group-year with the year observed before it and its band."""
    rows = fact.filter(F.col("release_year").between(*rules.trend_years))
    seen = with_prior(
        rows, "production_company_key", ["release_year", "production_company"], {"prior_observed_year": "release_year"}
    )
    band = trend_band(F.col("prior_observed_year"), F.col("revenue_yoy_pct"), F.col("rating_yoy_delta"))
    return seen.withColumn("performance_band", band).select(
        "production_company_key", "production_company", "release_year_start_date_key", "release_year",
        "prior_observed_year", "total_revenue", "avg_revenue", "weighted_avg_rating", "avg_vote_count",
        "revenue_yoy_pct", "rating_yoy_delta", "growth_and_rating_improved", "performance_band", "record_loaded_at",
    )


def group_summary(fact: DataFrame, rules: ScoreRules = ScoreRules()) -> DataFrame:
    """Years observed and improved, means and latest year of each group with enough years in the window."""
    improved = F.sum(F.col("growth_and_rating_improved").cast("long"))
    return (
        fact.filter(F.col("release_year").between(*rules.years))
        .groupBy("production_company_key", "production_company")
        .agg(
            F.count(F.lit(1)).alias("years_observed"),
            improved.alias("years_improved"),
            exact_ratio(improved, F.count(F.lit(1)), 4).alias("consistency_ratio"),
            exact_mean(F.col("revenue_yoy_pct"), 2).alias("avg_revenue_yoy_pct"),
            exact_mean(F.col("rating_yoy_delta"), 4).alias("avg_rating_yoy_delta"),
            exact_mean(F.col("weighted_avg_rating"), 4).alias("avg_weighted_rating"),
            exact_mean(F.col("total_revenue"), 2).alias("avg_total_revenue"),
            F.max("release_year").alias("latest_year"),
            F.max("release_year_start_date_key").alias("latest_year_start_date_key"),
        )
        .filter(F.col("years_observed") >= rules.min_years)
    )


def band_counts(trends: DataFrame, rules: ScoreRules = ScoreRules()) -> DataFrame:
    """How often and how lately each group was in each band; years without a baseline do not count."""
    return (
        trends.filter(F.col("release_year").between(*rules.years) & (F.col("performance_band") != "no_baseline"))
        .groupBy("production_company_key", "performance_band")
        .agg(F.count(F.lit(1)).alias("year_count"), F.max("release_year").alias("max_year"))
    )


def _pick(name: str, *order: Column) -> Column:
    return F.min_by("performance_band", F.struct(*order, F.col("performance_band"))).alias(name)


def _dominant() -> Column:
    return _pick("dominant_band", -F.col("year_count"), -F.col("max_year"))


def _latest() -> Column:
    return _pick("latest_band", -F.col("max_year"))


def dominant_category(counts: DataFrame) -> DataFrame:
    """The most frequent band of each group, then the latest, then by name."""
    return counts.groupBy("production_company_key").agg(_dominant())


def latest_category(counts: DataFrame) -> DataFrame:
    """The band of each group's latest year, then by name."""
    return counts.groupBy("production_company_key").agg(_latest())


def both_categories(counts: DataFrame) -> DataFrame:
    """Dominant and latest band together, from the same counts."""
    return counts.groupBy("production_company_key").agg(_dominant(), _latest())


def window_bound(df: DataFrame, fact: DataFrame, rules: ScoreRules = ScoreRules()) -> DataFrame:
    """Attach the latest year of the whole window to every row."""
    window = fact.filter(F.col("release_year").between(*rules.years)).select("release_year")
    return with_scalar(df, window, F.max("release_year"), "analysis_max_year")


def decision_score(df: DataFrame, rules: ScoreRules = ScoreRules()) -> DataFrame:
    """Weighted score from latest and dominant band, years observed and recency; 0 for inactive groups."""
    gap = F.col("analysis_max_year") - F.col("latest_year")
    recency = _number("0.00")
    for years, value in reversed(rules.recency):
        recency = F.when(gap <= years, _number(value)).otherwise(recency)
    latest, dominant = (
        _lookup(F.col(c), BAND_SCORES, "0.00").cast("decimal(4,2)") for c in ("latest_band", "dominant_band")
    )
    years = F.least(F.col("years_observed").cast("decimal(10,0)") / F.lit(rules.full_years), F.lit(1))
    parts = {"latest": latest, "dominant": dominant, "years": years, "recency": recency}
    score = sum((parts[p] * _number(w) for p, w in rules.weights.items()), start=_number("0"))
    inactive = F.col("latest_year") <= rules.inactive_year
    return df.withColumns(
        {
            "years_since_latest_release": gap,
            "is_inactive_studio": inactive,
            "is_recently_active": gap <= rules.recent_gap,
            "weighted_decision_score": F.when(inactive, _number("0.0000"))
            .otherwise(F.round(score, 4))
            .cast("decimal(10,4)"),
        }
    )


def action_label(df: DataFrame, rules: ScoreRules = ScoreRules()) -> DataFrame:
    """What to do about a group, by consistency and score."""
    steady = F.col("consistency_ratio") > _number(rules.consistency_above)
    score = F.col("weighted_decision_score")
    action = (
        F.when(F.col("is_inactive_studio"), "Inactive")
        .when(steady & (score >= _number(rules.incentivise_from)), "Incentivise")
        .when(steady & (score >= _number(rules.review_from)), "Review")
        .otherwise("Renegotiate")
    )
    return df.withColumn("studio_action_recommendation", action)


def present(df: DataFrame) -> DataFrame:
    """Labels, colour and dot of each group's bands; an inactive group shows only that."""
    inactive = F.col("is_inactive_studio")
    dominant, latest = F.col("dominant_band"), F.col("latest_band")

    def shown(c: Column, other: str) -> Column:
        return F.when(inactive, other).otherwise(c)

    return df.withColumns(
        {
            "dominant_performance_band": shown(dominant, INACTIVE_BAND),
            "latest_performance_band": shown(_lookup(latest, BAND_LABELS, NO_LABEL), INACTIVE_LABEL),
            "dominant_performance_band_label": shown(_lookup(dominant, BAND_LABELS, NO_LABEL), INACTIVE_LABEL),
            "performance_dot": F.lit(DOT),
            "performance_dot_color_hex": shown(_lookup(dominant, BAND_COLOURS, NO_COLOUR), INACTIVE_COLOUR),
        }
    )


def scored_groups(fact: DataFrame, trends: DataFrame, rules: ScoreRules = ScoreRules()) -> DataFrame:
    """Group summaries with their bands and the bound of the window."""
    bands = both_categories(band_counts(trends, rules))
    rows = group_summary(fact, rules).join(bands, "production_company_key", "left")
    named = rows.withColumns({c: F.coalesce(F.col(c), F.lit(NO_BAND)) for c in ("dominant_band", "latest_band")})
    return window_bound(named, fact, rules)


def scorecard(fact: DataFrame, trends: DataFrame, rules: ScoreRules = ScoreRules(), ordered: bool = True) -> DataFrame:
    """One row per group: summary, bands, score and action, steadiest first."""
    rows = present(action_label(decision_score(scored_groups(fact, trends, rules), rules), rules))
    out = rows.select(
        "production_company_key", "production_company", "years_observed", "years_improved", "consistency_ratio",
        "avg_revenue_yoy_pct", "avg_rating_yoy_delta", "avg_weighted_rating", "avg_total_revenue", "latest_year",
        "latest_year_start_date_key", "years_since_latest_release", "is_inactive_studio", "is_recently_active",
        "dominant_performance_band", "latest_performance_band", "dominant_performance_band_label", "performance_dot",
        "performance_dot_color_hex", "weighted_decision_score", "studio_action_recommendation",
    )
    if not ordered:
        return out
    by = ("consistency_ratio", "avg_revenue_yoy_pct", "avg_weighted_rating")
    return out.orderBy(*[F.col(c).desc_nulls_first() for c in by])
