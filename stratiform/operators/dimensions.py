"""Calendar, attribute and name dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from stratiform.functions.dates import date_key


def date_spine(dates: DataFrame, column: str, today: dt.date, years_ahead: int = 5) -> DataFrame:
    """One row per day from the start of the first year in the data to the end of the years ahead.

    Without dated rows the spine runs from 1900-01-01 and ends a day short of ``years_ahead`` years from today. The source
    is reduced to one row first; the days that row unfolds to are bounded by the calendar.
    """
    now = F.lit(today).cast("date")
    span = dates.agg(F.min(column).cast("date").alias("lo"), F.max(column).cast("date").alias("hi"))
    first = F.coalesce(F.trunc("lo", "year"), F.lit("1900-01-01").cast("date"))
    base = F.greatest(F.coalesce(F.trunc("hi", "year"), now), F.trunc(now, "year"))
    last = F.date_sub(F.add_months(base, 12 * years_ahead), 1)
    return span.select(F.explode(F.sequence(first, last)).alias("date_day"))


def date_dimension(spine: DataFrame) -> DataFrame:
    """Calendar attributes of each day: keys, parts, names, period bounds and boundary flags."""
    day = F.col("date_day")
    starts = {p: F.trunc(day, p) for p in ("month", "quarter", "year")}
    months = {"month": 1, "quarter": 3, "year": 12}
    ends = {p: F.date_sub(F.add_months(starts[p], n), 1) for p, n in months.items()}
    weekday = F.weekday(day) + 1
    out = [
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year_number"),
        F.quarter(day).alias("quarter_number"),
        F.month(day).alias("month_number"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        weekday.alias("iso_day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
    ]
    for p in months:
        out += [starts[p].alias(f"{p}_start_date"), ends[p].alias(f"{p}_end_date")]
    out.append((weekday >= 6).alias("is_weekend"))
    for p in months:
        out += [(day == starts[p]).alias(f"is_{p}_start"), (day == ends[p]).alias(f"is_{p}_end")]
    return spine.select(*out)


def attribute_dimension(core: DataFrame, extended: DataFrame) -> DataFrame:
    """Core rows with their extended attributes, a calendar key and the later load time."""
    more = extended.withColumnRenamed("loaded_at", "_extended_at")
    return core.join(more, "movie_id", "left").select(
        "movie_id",
        "title",
        date_key(F.col("release_date")).alias("release_date_key"),
        "release_date",
        "budget_amount",
        "revenue_amount",
        "genres",
        "production_countries",
        "production_companies",
        "spoken_languages",
        F.greatest("loaded_at", "_extended_at").alias("record_loaded_at"),
    )


def name_key(c) -> F.Column:
    """The form names are compared by."""
    return F.lower(F.trim(c))


def name_dimension(
    df: DataFrame, name: str = "production_company", year: str = "release_year", loaded: str = "record_loaded_at"
) -> DataFrame:
    """One row per name regardless of case, with a hashed key, a spelling, and its first and latest year.

    Spellings are reduced first with fixed-width aggregates only, which hash-aggregate; the least spelling, whose text
    buffer makes Spark sort, is then taken over the few spellings and not over all rows.
    """
    spelled = F.trim(F.col(name))
    spellings = (
        df.select(spelled.alias("_name"), F.col(year).alias("_year"), F.col(loaded).alias("_loaded"))
        .filter(F.col("_name") != "")
        .groupBy("_name")
        .agg(F.min("_year").alias("lo"), F.max("_year").alias("hi"), F.max("_loaded").alias("at"))
    )
    return (
        spellings.groupBy(name_key(F.col("_name")).alias("_key"))
        .agg(
            F.min("_name").alias("production_company"),
            F.min("lo").alias("first_release_year"),
            F.max("hi").alias("latest_release_year"),
            F.max("at").alias("loaded_at"),
        )
        .select(F.md5("_key").alias("production_company_key"), "production_company", "first_release_year",
                "latest_release_year", "loaded_at")
    )
