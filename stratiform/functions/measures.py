"""Business measures: rating scales, amount repair, weighted means, bands and flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stratiform.functions.numbers import exact_mean, exact_ratio

# Audit flags of the amount repair.
BOTH_MILLION = "both_scaled_×1m"
BUDGET_MILLION = "budget_scaled_×1m"
BUDGET_THOUSAND = "budget_scaled_×1k"
ORIGINAL = "original"
REPAIR_FLAGS = (ORIGINAL, BOTH_MILLION, BUDGET_MILLION, BUDGET_THOUSAND)

# Least votes for each interest band, highest first.
INTEREST_BANDS = ((10000, "blockbuster_signal"), (1000, "high_interest"), (100, "medium_interest"))
LOW_INTEREST = "low_interest"


def harmonise_rating(c: Column) -> Column:
    """Ratings on 0..5, 0..10 or 0..100 scales to 0..10, to 13 decimals; below 0 and above 100 give NULL."""
    return (
        F.when((c < 0) | (c > 100), None)
        .when(c <= 5, c * 2)
        .when(c > 10, c / 10)
        .otherwise(c)
        .cast("decimal(28,13)")
    )


def repair_flag(budget: Column, revenue: Column) -> Column:
    """Which magnitude repair applies to a pair of amounts; the first match wins."""
    tiny_budget = (budget > 0) & (budget < 1000)
    return (
        F.when(tiny_budget & (revenue > 0) & (revenue < 1000), BOTH_MILLION)
        .when(tiny_budget & (revenue > 1_000_000), BUDGET_MILLION)
        .when((budget >= 1000) & (budget < 1_000_000) & (revenue >= 100_000_000), BUDGET_THOUSAND)
        .otherwise(ORIGINAL)
    )


def budget_factor(flag: Column) -> Column:
    million = flag.isin(BOTH_MILLION, BUDGET_MILLION)
    return F.when(million, 1_000_000).when(flag == BUDGET_THOUSAND, 1000).otherwise(1)


def revenue_factor(flag: Column) -> Column:
    return F.when(flag == BOTH_MILLION, 1_000_000).otherwise(1)


def weighted_mean(value: Column, weight: Column, digits: int = 4) -> Column:
    """Aggregate: mean weighted by votes; the plain mean when no votes exist. A NULL value with votes counts as 0.

    Values keep 8 decimals, weights 4.
    """
    votes = F.coalesce(weight, F.lit(0)).cast("decimal(16,4)")
    total = F.sum(votes)
    weighed = F.sum(F.coalesce(value.cast("decimal(18,8)"), F.lit(0)) * votes)
    return F.when(total > 0, exact_ratio(weighed, total, digits, "decimal(20,4)")).otherwise(exact_mean(value, digits))


def interest_band(votes: Column) -> Column:
    out = F.lit(LOW_INTEREST)
    for least, name in reversed(INTEREST_BANDS):
        out = F.when(votes >= least, name).otherwise(out)
    return out


def both_improved(growth: Column, rating_delta: Column) -> Column:
    return F.coalesce((growth > 0) & (rating_delta >= 0), F.lit(False))


def trend_band(prior_year: Column, growth: Column, rating_delta: Column, strong: float = 20) -> Column:
    """Band of one year against the year before it; what cannot be compared counts as declining."""
    better_rating = rating_delta >= 0
    return (
        F.when(prior_year.isNull(), "no_baseline")
        .when(better_rating & (growth >= strong), "outperforming")
        .when(better_rating & (growth >= 0), "stable_positive")
        .when(better_rating & (growth < 0), "rating_up_revenue_down")
        .when((rating_delta < 0) & (growth >= 0), "revenue_up_rating_down")
        .otherwise("declining")
    )
