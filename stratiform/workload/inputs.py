"""The given tables in the shape the operators read.

All inputs are projections of whole tables; values are made messy from the row's own columns. Nothing is sampled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratiform.functions.dates import in_years
from stratiform.functions.numbers import exact_ratio
from stratiform.operators.metrics import group_year_metrics, year_over_year
from stratiform.operators.scorecard import ScoreRules
from stratiform.plans.layers import Inputs, Settings

LOADED_AT = dt.datetime(2002, 1, 1)
TODAY = dt.date(2001, 12, 31)
RULES = ScoreRules(trend_years=(1995, 2001), years=(1995, 2001), inactive_year=1999)
SETTINGS = Settings(loaded_at=LOADED_AT, today=TODAY, rules=RULES)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _text(c: Column) -> Column:
    return c.cast("string")


def _tenths(c: Column) -> Column:
    """A whole number of tenths as decimal text."""
    return F.concat(_text(F.floor(c / 10)), F.lit("."), _text(c % 10))


def _arrival() -> Column:
    names = ("shipdate", "linenumber", "partkey", "suppkey", "quantity", "extendedprice", "returnflag", "linestatus")
    # The day is unknown for first lines of an order, which then come before all others of their id.
    seen = F.when(F.col("l_linenumber") != 1, F.col("l_shipdate")).alias("seen")
    return F.struct(seen, *[F.col(f"l_{n}") for n in names]).alias("arrival")


def _line_id() -> Column:
    order = _text(F.col("l_orderkey"))
    unknown = (F.col("l_partkey") % 97 == 0) & (F.col("l_linenumber") != 1)
    return F.when(unknown, None).when(F.col("l_partkey") % 89 == 0, F.concat(F.lit("x"), order)).otherwise(order).alias("id")


def raw_core(spark: SparkSession, sf: str) -> DataFrame:
    """Core rows with repeated keys: one per lineitem, in three date forms, with blanks and amounts of all sizes."""
    lines = table(spark, sf, "lineitem")
    number, supp, part, ship = (F.col(f"l_{n}") for n in ("linenumber", "suppkey", "partkey", "shipdate"))
    price, quantity = _money(F.col("l_extendedprice")), _money(F.col("l_quantity"))
    title = (
        F.when(number == 1, None).when(number == 2, " ").when(number == 3, "None")
        .otherwise(F.concat_ws("-", F.col("l_returnflag"), _text(part)))
    )
    date = (
        F.when(number % 4 == 1, F.date_format(ship, "yyyy-MM-dd"))
        .when(number % 4 == 2, F.date_format(ship, "MM/dd/yyyy"))
        .when(number % 4 == 3, F.date_format(ship, "dd-MM-yyyy"))
        .when(supp % 2 == 0, "n/a")
        .otherwise("")
    )
    budget = (
        F.when(supp % 5 == 0, "").when(supp % 5 == 1, F.concat(F.lit("$"), _text(price)))
        .when(supp % 5 == 2, _text(quantity)).otherwise(_text(price))
    )
    revenue = (
        F.when(part % 6 == 0, None).when(part % 6 == 1, _text(quantity)).when(part % 6 == 2, _text(_money(price * 10000)))
        .when(part % 6 == 3, "unknown").otherwise(_text(_money(price * 3)))
    )
    return lines.select(
        _line_id(), title.alias("title"), date.alias("release_date"), budget.alias("budget"), revenue.alias("revenue"),
        F.col("l_shipdate").alias("loaded_at"), _arrival(),
    )


def raw_extended(spark: SparkSession, sf: str) -> DataFrame:
    """List rows with repeated keys: one per lineitem, with cut-off articles, bars, blanks and name variants."""
    lines = table(spark, sf, "lineitem")
    number, supp, part = (F.col(f"l_{n}") for n in ("linenumber", "suppkey", "partkey"))
    supplier = F.concat(F.lit("Supplier "), _text(supp))
    house = F.concat(F.lit("Part House "), _text(part % 300))
    companies = (
        F.when(number == 1, F.concat(F.lit("The,"), supplier, F.lit(","), house))
        .when(number == 2, F.concat(F.lit("Lions Gate,LIONSGATE UK,"), supplier))
        .when(number == 3, "")
        .when(number == 4, F.concat(supplier, F.lit(" | "), house))
        .when(number == 5, F.concat(F.upper(supplier), F.lit(", ,An")))
        .when(number == 6, F.concat(F.lit("A,An,"), house))
    )
    genres = F.when(number % 3 == 0, " ").otherwise(F.concat_ws(",", F.col("l_returnflag"), F.col("l_linestatus")))
    countries = F.when(supp % 4 == 0, None).otherwise(F.concat(F.lit("NATION_"), _text(supp % 25)))
    languages = F.when(part % 4 == 0, "en|fr").when(part % 4 == 1, "nan").when(part % 4 == 2, "en")
    return lines.select(
        _line_id(), genres.alias("genres"), countries.alias("production_countries"),
        companies.alias("production_companies"), languages.alias("spoken_languages"),
        F.col("l_shipdate").alias("loaded_at"), _arrival(),
    )


def iso_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def raw_ratings(spark: SparkSession, sf: str) -> DataFrame:
    """Rating rows on mixed scales: one per event, three events to an id."""
    kind, event, value = F.col("event_type"), F.col("event_id"), F.col("value")
    rating = (
        F.when(kind == "click", _tenths(event % 50)).when(kind == "view", _text(_money(value)))
        .when(kind == "signup", "-1").when(kind == "error", "")
    )
    return table(spark, sf, "events").select(
        F.when(event % 101 != 0, _text(event - event % 3)).alias("movie_id"),
        rating.alias("avg_rating"),
        F.when(kind == "purchase", "").otherwise(_text(F.col("user_id") * 20)).alias("total_ratings"),
        _text(_money(value)).alias("stg_dev"),
        F.when(kind != "signup", iso_text(F.col("ts"))).alias("loaded_at"),
        F.struct("ts", "event_id").alias("arrival"),
    )


def enrichment(spark: SparkSession, sf: str) -> DataFrame:
    """The second source: one row per order."""
    key, cust, status, day = (F.col(f"o_{n}") for n in ("orderkey", "custkey", "orderstatus", "orderdate"))
    price = _text(_money(F.col("o_totalprice")))
    title = F.when(key % 9 != 0, F.concat_ws(" ", F.col("o_orderpriority"), _text(key)))
    date = (
        F.when(key % 13 == 0, None).when(key % 3 == 0, F.date_format(day, "yyyy-MM-dd")).when(key % 3 == 1, F.date_format(day, "MM/dd/yyyy"))
        .otherwise(F.date_format(day, "dd-MM-yyyy"))
    )
    return table(spark, sf, "orders").select(
        _text(key).alias("id"),
        title.alias("title"),
        date.alias("release_date"),
        price.alias("budget"),
        F.when(key % 8 != 0, price).alias("revenue"),
        F.when(status == "F", "Drama,Crime").when(status == "O", "Comedy").alias("genres"),
        F.concat(F.lit("Customer House "), _text(cust % 200)).alias("production_companies"),
        F.concat(F.lit("Land "), _text(cust % 25)).alias("production_countries"),
        F.lit("en").alias("spoken_languages"),
        _tenths(key % 101).alias("vote_average"),
        F.when(key % 37 == 0, "many").otherwise(_text(cust % 60)).alias("vote_count"),
        F.when(status == "F", "Released").when(status == "O", "RELEASED").otherwise("Rumored").alias("status"),
        F.when(key % 17 != 0, day).alias("seen_at"),
    )


def layered_inputs(spark: SparkSession, sf: str) -> Inputs:
    return Inputs(
        core=raw_core(spark, sf),
        extended=raw_extended(spark, sf),
        ratings=raw_ratings(spark, sf),
        enrichment=enrichment(spark, sf),
        core_order=["arrival"],
        extended_order=["arrival"],
        ratings_order=["arrival"],
        enrichment_order=["seen_at"],
    )


def dirty_orders(spark: SparkSession, sf: str) -> DataFrame:
    """One text row per order for the column cleaners."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    price = _text(_money(F.col("o_totalprice")))
    padded = F.concat(F.lit("\t "), F.col("o_orderpriority"), F.lit(" \n"))
    return table(spark, sf, "orders").select(
        key,
        F.when(key % 11 == 0, "12a").when(key % 11 == 1, "").when(key % 11 == 2, "-1")
        .otherwise(F.concat(F.lit(" "), _text(key), F.lit(" "))).alias("id"),
        F.when(key % 7 == 0, " \t").when(key % 7 == 1, None).when(key % 7 == 2, " NULL ").when(key % 7 == 3, "NaN")
        .otherwise(padded).alias("title"),
        F.when(key % 5 == 0, F.date_format(day, "yyyy-M-d")).when(key % 5 == 1, F.date_format(day, "MM/dd/yyyy"))
        .when(key % 5 == 2, F.date_format(day, "dd-MM-yyyy")).when(key % 5 == 3, F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.date_format(day, "yyyy")).alias("release_date"),
        F.when(key % 6 == 0, F.concat(F.lit("$"), F.format_number(F.col("o_totalprice"), 2)))
        .when(key % 6 == 1, "n/a").when(key % 6 == 2, "").when(key % 6 == 3, "1.2.3")
        .otherwise(F.concat(price, F.lit(" USD"))).alias("budget"),
        F.concat_ws(" | ", F.col("o_orderstatus"), F.col("o_orderpriority")).alias("companies"),
    )


def mixed_ratings(spark: SparkSession, sf: str) -> DataFrame:
    """One rating per order on a scale to 5, 10 or 100 with eight decimals, some out of range, missing or just above a scale."""
    key = F.col("o_orderkey")
    spread = key * 7919 * 104729
    rating = (
        F.when(key % 6 == 0, None).when(key % 6 == 1, spread % 500_000_000).when(key % 6 == 2, spread % 1_000_000_000)
        .when(key % 6 == 3, spread % 10_000_000_000).when(key % 6 == 4, F.lit(-1)).otherwise(F.lit(500_000_000) + key % 3)
    )
    return table(spark, sf, "orders").select(
        key, exact_ratio(rating, F.lit(100_000_000), 8).cast("decimal(18,8)").alias("rating")
    )


def amounts(spark: SparkSession, sf: str) -> DataFrame:
    """A budget and a revenue per order: both tiny, budget tiny, budget small against a huge revenue, or plain."""
    key, price = F.col("o_orderkey"), _money(F.col("o_totalprice"))
    tiny = _money(F.col("o_custkey") % 1000)
    shape = key % 10
    return table(spark, sf, "orders").select(
        key,
        F.when(shape <= 2, tiny).when(shape == 9, None).otherwise(price).alias("budget_amount"),
        F.when(shape == 0, tiny + 1).when(shape == 1, price * 100).when(shape == 3, price * 1000)
        .when(shape == 8, None).otherwise(price).cast("decimal(18,2)").alias("revenue_amount"),
    )


def name_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Word lists from whole texts, split on spaces; articles open most sentences."""
    return table(spark, sf, "documents").select("doc_id", "text")


def customer_bridge(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order and customer, with two spellings, zero and missing amounts, ratings and votes."""
    key, cust = F.col("o_orderkey"), _text(F.col("o_custkey"))
    price = _money(F.col("o_totalprice"))
    return table(spark, sf, "orders").select(
        key.alias("movie_id"),
        F.when(key % 10 == 0, F.concat(F.lit("CUSTOMER "), cust)).otherwise(F.concat(F.lit("Customer "), cust))
        .alias("production_company"),
        F.year("o_orderdate").alias("release_year"),
        F.when(key % 20 == 0, 0).when(key % 23 == 0, None).otherwise(price).cast("decimal(18,2)").alias("revenue_amount"),
        F.when(key % 29 != 0, (key % 100).cast("decimal(10,4)") / 10).cast("decimal(10,4)").alias("avg_rating"),
        F.when(key % 31 != 0, key % 50).cast("int").alias("total_ratings"),
        F.col("o_orderdate").alias("record_loaded_at"),
    )


def customer_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Customer-year measures; an order names its customer once, so rows are distinct orders."""
    rows = customer_bridge(spark, sf).withColumn("is_first", F.lit(True))
    return group_year_metrics(rows, first_flag="is_first")


def supplier_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier-year measures with change, from order lines.

    Lines are summed to order and supplier before the join, so an order with very many lines is reduced on the map side;
    supplier names are joined after all aggregation, to a result as long as suppliers times years.
    """
    net = _money(F.col("l_extendedprice")) * (1 - F.col("l_discount").cast("decimal(4,2)"))
    quantity = F.col("l_quantity").cast("decimal(12,0)")
    lines = (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_suppkey")
        .agg(
            F.round(F.sum(net), 2).cast("decimal(18,2)").alias("revenue_amount"),
            F.sum(quantity).cast("int").alias("total_ratings"),
            exact_ratio(F.sum(quantity), F.count(F.lit(5)) * 5, 4).alias("avg_rating"),
        )
    )
    dated = table(spark, sf, "orders").filter(in_years(F.col("o_orderdate"), *SETTINGS.metric_years))
    orders = dated.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.year("o_orderdate").alias("release_year"),
        F.col("o_orderdate").alias("record_loaded_at"),
    )
    rows = lines.join(orders, "l_orderkey").withColumn("is_first", F.lit(True))
    yearly = group_year_metrics(rows, group="l_suppkey", entity="l_orderkey", first_flag="is_first")
    names = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("production_company")
    )
    return year_over_year(yearly, group="l_suppkey").join(names, "l_suppkey").drop("l_suppkey")
