"""One query per operator, each over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stratiform.functions.dates import normalise_mixed_date, parse_routed_date
from stratiform.functions.measures import REPAIR_FLAGS, harmonise_rating
from stratiform.functions.names import NameTable, standardise_by_table
from stratiform.functions.numbers import clean_decimal, digits_to_long
from stratiform.functions.text import is_blank, is_placeholder, nullify, rewrite_delimiters, standardise_name
from stratiform.operators import audit, buildlog, checks, scorecard as sc
from stratiform.operators.dedup import collapse_duplicates, dedup_profile, keep_first, latest_per_key
from stratiform.operators.dimensions import attribute_dimension, date_dimension, date_spine, name_dimension
from stratiform.operators.enrich import fill_missing
from stratiform.operators.facts import group_year_fact, rating_fact
from stratiform.operators.lists import explode_list, merge_articles
from stratiform.operators.metrics import change_measures, group_year_metrics, with_prior, with_prior_spread, year_over_year
from stratiform.operators.scaling import minmax, zscore
from stratiform.functions.measures import weighted_mean
from stratiform.plans import layers
from stratiform.plans.bridge import base_join, company_bridge, repair_amounts as repair
from stratiform.plans.staging import CORE_SIGNALS, ENRICHMENT_COLUMNS, Staged, prepare_enrichment
from stratiform.plans.tasklog import Task, Writer, log_landed, log_staged, read_log
from stratiform.plans.typed import typing_losses
from stratiform.session import shared_folder
from stratiform.sources.landing import land_csv, land_json
from stratiform.sources.tables import read_folder, write_folder
from stratiform.workload import inputs as src

Query = Callable[[SparkSession, str], DataFrame]

LINE_ORDER = (
    "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)


# Whole numbers that may be NULL, which some engines hand over as floats and some do not.
GAPPY = {"total_ratings", "prior_year", "prior_observed_year", "release_date_key", "release_month", "rows_in", "rows_out", "rows_rejected"}


def tidy(df: DataFrame, gappy: set[str] = GAPPY) -> DataFrame:
    """Plain column types, which read the same from any engine: decimals as doubles, dates and times as text.

    Whole numbers with gaps become doubles as well.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType) or (f.name in gappy and isinstance(f.dataType, T.IntegralType)):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


# --- landing and cleaning ---------------------------------------------------------------------------------------------


def land_csv_files(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    note = (
        F.when(key % 5 == 0, F.concat(F.lit('He said "'), F.col("o_orderpriority"), F.lit('", then\nleft')))
        .when(key % 5 == 1, "N/A").when(key % 5 == 2, "  ").when(key % 5 == 3, " NULL ").otherwise(F.col("o_orderpriority"))
    )
    path = shared_folder(spark)
    orders = src.table(spark, sf, "orders")
    cells = orders.select(
        F.col("o_orderkey").alias("id"), note.alias("title"), F.col("o_totalprice").cast("decimal(18,2)").alias("budget")
    )
    cells.write.options(header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False,
                        ignoreTrailingWhiteSpace=False).csv(path)
    return tidy(land_csv(spark, path, ["id", "title", "budget", "revenue"], src.LOADED_AT, multi_line=True))


def land_csv_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Files without line breaks in cells, which split into blocks."""
    path = shared_folder(spark)
    parts = src.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.concat(F.lit('a "'), F.col("p_type"), F.lit('", or b')).alias("title"),
        F.when(F.col("p_size") % 3 == 0, "nan").otherwise(F.col("p_size").cast("string")).alias("budget"),
    )
    parts.write.options(header=True, quoteAll=True, escape='"').csv(path)
    return land_csv(spark, path, ["id", "title", "budget", "revenue"])


def land_csv_parallel(spark: SparkSession, sf: str) -> DataFrame:
    """Cells with line breaks, also such that both halves have as many cells as the table."""
    key = F.col("o_orderkey")
    note = F.when(key % 3 == 0, F.concat(F.lit('he said "no"'), F.lit("\n5,6,"), F.col("o_orderpriority"))).otherwise(F.concat(F.lit("x,"), F.col("o_custkey")))
    path = shared_folder(spark)
    cells = src.table(spark, sf, "orders").select(key.alias("id"), F.col("o_orderstatus").alias("budget"), note.alias("title"))
    cells.write.options(header=True, quoteAll=True, escape='"').csv(path)
    return land_csv(spark, path, ["id", "title", "budget"], breaks=True)


def land_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    """The enrichment source as a file of more columns than are read, in another order."""
    path = shared_folder(spark)
    rows = src.enrichment(spark, sf)
    wide = rows.select(F.lit("x").alias("homepage"), *reversed([c for c in rows.columns if c != "seen_at"]), F.col("id").alias("imdb_id"))
    wide.write.options(header=True, quoteAll=True, escape='"').csv(path)
    return land_csv(spark, path, ENRICHMENT_COLUMNS, exact=False)


def land_json_files(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("value").cast("decimal(18,2)")
    summary = F.when(
        F.col("event_type") != "error",
        F.struct(value.alias("avg_rating"), F.col("user_id").alias("total_ratings"),
                 F.when(F.col("event_type") != "view", value).alias("std_dev")),
    )
    doc = F.struct(F.col("event_id").alias("movie_id"), summary.alias("ratings_summary"))
    path = shared_folder(spark)
    src.table(spark, sf, "events").select(F.to_json(F.array(doc)).alias("value")).write.text(path)
    return land_json(spark, path, loaded_at="2002-01-01T00:00:00+00:00")


def array_files(spark: SparkSession, sf: str) -> str:
    """Files of one array each, spread over lines; as many for a market segment as keep each array at about 10,000 documents."""
    path = shared_folder(spark)
    doc = F.struct(
        F.col("c_custkey").alias("movie_id"),
        F.when(F.col("c_custkey") % 4 != 0, F.struct(F.col("c_nationkey").alias("avg_rating"), F.lit("7").alias("total_ratings"))).alias("ratings_summary"),
    )
    customer = src.table(spark, sf, "customer")
    bucket = F.pmod(F.xxhash64("c_custkey"), F.lit(customer.count() // 50_000 + 1)).alias("bucket")
    files = customer.groupBy("c_mktsegment", bucket).agg(F.to_json(F.collect_list(doc)).alias("value"))
    files.select(F.regexp_replace("value", r"\},\{", "},\n{").alias("value"), F.concat_ws("-", "c_mktsegment", "bucket").alias("part")).write.partitionBy("part").text(path)
    return f"{path}/part=*"


def land_json_arrays(spark: SparkSession, sf: str) -> DataFrame:
    return land_json(spark, array_files(spark, sf), multi_line=True, loaded_at="t")


def land_json_parallel(spark: SparkSession, sf: str) -> DataFrame:
    """The same files in ranges."""
    return land_json(spark, array_files(spark, sf), arrays=True, loaded_at="t")


def nullify_text(spark: SparkSession, sf: str) -> DataFrame:
    return src.dirty_orders(spark, sf).select("o_orderkey", *[nullify(F.col(c)).alias(c) for c in ("id", "title", "budget")])


def blank_flags(spark: SparkSession, sf: str) -> DataFrame:
    title = F.col("title")
    return src.dirty_orders(spark, sf).select(
        "o_orderkey", is_blank(title).alias("is_blank"), is_placeholder(title).alias("is_placeholder")
    )


def normalise_dates(spark: SparkSession, sf: str) -> DataFrame:
    return src.dirty_orders(spark, sf).select(
        "o_orderkey", normalise_mixed_date(F.col("release_date")).alias("release_date")
    )


def numeric_keys(spark: SparkSession, sf: str) -> DataFrame:
    keys = src.dirty_orders(spark, sf).select("o_orderkey", digits_to_long(F.col("id")).alias("movie_id"))
    return tidy(keys, {"movie_id"})


def clean_amounts(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(src.dirty_orders(spark, sf).select("o_orderkey", clean_decimal(F.col("budget")).alias("budget_amount")))


def route_dates(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(src.dirty_orders(spark, sf).select(
        "o_orderkey", parse_routed_date(F.col("release_date")).alias("release_date")
    ))


def rewrite_list_delimiters(spark: SparkSession, sf: str) -> DataFrame:
    return src.dirty_orders(spark, sf).select("o_orderkey", rewrite_delimiters(F.col("companies")).alias("companies"))


def harmonise_ratings(spark: SparkSession, sf: str) -> DataFrame:
    scaled = harmonise_rating(F.col("rating"))
    return tidy(src.mixed_ratings(spark, sf).select("o_orderkey", F.round(scaled, 4).alias("rating_10")))


def _rating_10(spark: SparkSession, sf: str) -> DataFrame:
    return src.mixed_ratings(spark, sf).select("o_orderkey", harmonise_rating(F.col("rating")).alias("rating_10"))


def minmax_ratings(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(minmax(_rating_10(spark, sf), "rating_10", "rating_minmax"))


def zscore_ratings(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(zscore(_rating_10(spark, sf), "rating_10", "rating_zscore"))


# --- duplicates and gaps ----------------------------------------------------------------------------------------------


def duplicate_profile(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_profile(src.raw_core(spark, sf), "id", ["arrival"], CORE_SIGNALS)


def collapse_duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["id", *CORE_SIGNALS]
    kept = collapse_duplicates(src.raw_core(spark, sf), "id", ["arrival"], CORE_SIGNALS, True, columns)
    return kept.select(*columns, "n_rejected", "n_recovered")


def _undated(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines, some without a date."""
    dated = F.when(F.col("l_partkey") % 5 != 0, F.col("l_shipdate"))
    return src.table(spark, sf, "lineitem").withColumn("l_shipdate", dated)


def keep_first_rows(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(keep_first(_undated(spark, sf).select("l_orderkey", *LINE_ORDER), "l_orderkey", LINE_ORDER))


def latest_rows(spark: SparkSession, sf: str) -> DataFrame:
    lines = _undated(spark, sf).select("l_partkey", "l_orderkey", *[c for c in LINE_ORDER if c != "l_partkey"])
    return tidy(latest_per_key(lines, "l_partkey", [c for c in LINE_ORDER if c != "l_partkey"] + ["l_orderkey"]))


def fill_gaps(spark: SparkSession, sf: str) -> DataFrame:
    rows = src.raw_core(spark, sf).select("id", "title", "budget", "revenue", "loaded_at")
    mapping = {"title": "title", "budget": "budget", "revenue": "revenue"}
    filled = fill_missing(rows, src.enrichment(spark, sf), "id", mapping, count_as="cells_filled")
    return tidy(filled)


def _step(spark: SparkSession, sf: str, name: str) -> Staged:
    return layers.staged_table(name, src.layered_inputs(spark, sf), src.SETTINGS)


def _staged(spark: SparkSession, sf: str) -> dict[str, Staged]:
    return layers.staged_tables(src.layered_inputs(spark, sf), src.SETTINGS)


def _typed(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A typed table planned from the raw ones."""
    steps = layers.staged_tables(src.layered_inputs(spark, sf), src.SETTINGS, [name])
    return layers.typed_tables({n: s.rows for n, s in steps.items()})[f"stg_{name}"]


def _write_typed(spark: SparkSession, sf: str) -> str:
    folder = shared_folder(spark)
    layers.write_typed(src.layered_inputs(spark, sf), src.SETTINGS, Writer(folder))
    return folder


# Where a session has written the typed tables of a data folder.
_WRITTEN: dict[tuple[str, str], str] = {}


def _stored(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The typed tables as a build writes them, in buckets. The first query of a session that needs them writes them; they are written
    again if they are gone."""
    at = (spark.sparkContext.applicationId, sf)
    read = lambda: {n: read_folder(spark, f"{_WRITTEN[at]}/staging/{n}") for n in layers.MODELS[:3]}
    if at in _WRITTEN:
        try:
            return read()
        except AnalysisException:
            pass
    _WRITTEN[at] = _write_typed(spark, sf)
    return read()


def _models(spark: SparkSession, sf: str) -> layers.Models:
    """Models over the stored typed tables."""
    return layers.Models(src.layered_inputs(spark, sf), src.SETTINGS, _stored(spark, sf))


def typed_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the typed tables, all three written anew from the raw ones."""
    folder = _write_typed(spark, sf)
    counts = [read_folder(spark, f"{folder}/staging/{n}").agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows")) for n in layers.MODELS[:3]]
    return reduce(DataFrame.unionByName, counts)


def staged_core(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_step(spark, sf, "movies_main").rows)


def staged_extended(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_step(spark, sf, "movie_extended").rows)


def staged_ratings(spark: SparkSession, sf: str) -> DataFrame:
    return _step(spark, sf, "ratings").rows


def staged_core_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _step(spark, sf, "movies_main").stats


def staged_extended_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _step(spark, sf, "movie_extended").stats


def staged_ratings_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _step(spark, sf, "ratings").stats


def typed_table(name: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return tidy(_typed(spark, sf, name))

    return query


def first_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_enrichment(src.enrichment(spark, sf), ["seen_at"])


def model(name: str) -> Query:
    """One model of the whole chain, over the typed tables as written."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        return tidy(_models(spark, sf)[name])

    return query


def company_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    """The scorecard of the whole chain, over the fact table as written."""
    models = _models(spark, sf)
    fact = "fct_company_year_performance"
    models.put(fact, write_folder(models[fact], f"{shared_folder(spark)}/{fact}"))
    return tidy(models["vw_high_value_studio_performance"])


# --- bridge and metrics -----------------------------------------------------------------------------------------------


def joined_base(spark: SparkSession, sf: str) -> DataFrame:
    typed = _stored(spark, sf)
    return tidy(base_join(typed["stg_movies_main"], typed["stg_movie_extended"], typed["stg_ratings"]))


def explode_lists(spark: SparkSession, sf: str) -> DataFrame:
    rows = src.raw_extended(spark, sf).select("id", "loaded_at", "production_companies")
    return tidy(explode_list(rows, "production_companies", item="production_company").drop("production_companies"))


def merge_list_articles(spark: SparkSession, sf: str) -> DataFrame:
    merged = merge_articles(src.name_lists(spark, sf), "text", sep=" ")
    return merged.select("doc_id", F.posexplode_outer("items").alias("pos", "item")).filter("item IS NOT NULL")


def repair_amounts(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(repair(src.amounts(spark, sf)))


def standardise_names(spark: SparkSession, sf: str) -> DataFrame:
    rules = ((r"(?i)^(small|red)\s*", "Plain House"), (r"(?i)widget$", "Widget House"))
    return src.table(spark, sf, "part").select("p_partkey", standardise_name(F.col("p_name"), rules).alias("p_name"))


def standardise_by_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Part names by a table of rules, one for each number of a part, and some for the parts' own names."""
    own = [("small wid", "Small Widgets"), ("SMALL", "Plain House"), ("r e d", "Red House"), ("red plate", "never: an earlier rule fits")]
    table = NameTable([*((f"part {k} of", f"Part {k}") for k in range(10_000)), *own])
    numbered = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("PART"), (F.col("p_partkey") % 20_000).cast("string"), F.lit("  of set"))).otherwise(F.col("p_name"))
    return src.table(spark, sf, "part").select("p_partkey", standardise_by_table(numbered, table).alias("p_name"))


def group_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(group_year_metrics(src.customer_bridge(spark, sf)))


def weighted_means(spark: SparkSession, sf: str) -> DataFrame:
    fine = (F.col("avg_rating") + F.col("movie_id") % 997 * F.lit("0.0000001").cast("decimal(8,7)")).cast("decimal(12,7)")
    rows = src.customer_bridge(spark, sf).withColumn("fine", fine).groupBy("production_company")
    return tidy(rows.agg(weighted_mean(F.col("fine"), F.col("total_ratings"), 6).alias("weighted_avg_rating")))


def prior_periods(spark: SparkSession, sf: str) -> DataFrame:
    keep = ["production_company", "release_year", "total_revenue", "weighted_avg_rating"]
    metrics = src.customer_metrics(spark, sf).select(*keep)
    prior = {"prior_year": "release_year", "prior_year_revenue": "total_revenue", "prior_year_rating": "weighted_avg_rating"}
    return tidy(with_prior(metrics, "production_company", ["release_year"], prior))


def prior_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The order line shipped before each one with the same return flag: three groups that are the whole table."""
    lines = src.table(spark, sf, "lineitem").select("l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    prior = {"prior_orderkey": "l_orderkey", "prior_quantity": "l_quantity"}
    spread = with_prior_spread(lines, "l_returnflag", order, prior)
    return tidy(spread.select("l_returnflag", "l_orderkey", "l_linenumber", "prior_orderkey", "prior_quantity"), GAPPY | {"prior_orderkey"})


def change_rates(spark: SparkSession, sf: str) -> DataFrame:
    metrics = src.customer_metrics(spark, sf)
    prior = {"prior_year_revenue": "total_revenue", "prior_year_rating": "weighted_avg_rating"}
    changed = change_measures(with_prior(metrics, "production_company", ["release_year"], prior))
    return tidy(changed.select("production_company", "release_year", "revenue_yoy_pct", "rating_yoy_delta"))


# --- marts ------------------------------------------------------------------------------------------------------------


def date_table(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(date_dimension(date_spine(src.table(spark, sf, "orders"), "o_orderdate", src.TODAY)))


def entity_dimension(spark: SparkSession, sf: str) -> DataFrame:
    typed = _stored(spark, sf)
    return tidy(attribute_dimension(typed["stg_movies_main"], typed["stg_movie_extended"]))


def names_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(name_dimension(src.customer_bridge(spark, sf)))


def ratings_fact(spark: SparkSession, sf: str) -> DataFrame:
    typed = _stored(spark, sf)
    movies = attribute_dimension(typed["stg_movies_main"], typed["stg_movie_extended"])
    return tidy(rating_fact(typed["stg_ratings"], movies), GAPPY | {"release_year"})


def _customer_fact(spark: SparkSession, sf: str) -> DataFrame:
    return group_year_fact(year_over_year(src.customer_metrics(spark, sf)))


def _stored_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The fact as written, for the reports that read it several times."""
    return write_folder(_customer_fact(spark, sf), f"{shared_folder(spark)}/fact")


def customer_year_fact(spark: SparkSession, sf: str) -> DataFrame:
    names = name_dimension(src.customer_bridge(spark, sf))
    return tidy(group_year_fact(year_over_year(src.customer_metrics(spark, sf)), names))


def supplier_trends(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: supplier-year measures, their change and their trend band, from order lines."""
    return tidy(sc.trend_bands(group_year_fact(src.supplier_metrics(spark, sf)), src.RULES))


def trend_banding(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(sc.trend_bands(_customer_fact(spark, sf), src.RULES))


# --- scoring ----------------------------------------------------------------------------------------------------------


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    return sc.band_counts(sc.trend_bands(_customer_fact(spark, sf), src.RULES), src.RULES)


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    fact = _stored_fact(spark, sf)
    return sc.scored_groups(fact, sc.trend_bands(fact, src.RULES), src.RULES)


def group_summaries(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(sc.group_summary(_customer_fact(spark, sf), src.RULES))


def dominant_bands(spark: SparkSession, sf: str) -> DataFrame:
    return sc.dominant_category(_counts(spark, sf))


def latest_bands(spark: SparkSession, sf: str) -> DataFrame:
    return sc.latest_category(_counts(spark, sf))


def window_bounds(spark: SparkSession, sf: str) -> DataFrame:
    fact = _stored_fact(spark, sf)
    summary = sc.group_summary(fact, src.RULES).select("production_company_key", "production_company", "latest_year")
    return sc.window_bound(summary, fact, src.RULES)


def decision_scores(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(sc.decision_score(_scored(spark, sf), src.RULES).select(
        "production_company_key", "production_company", "years_since_latest_release", "is_inactive_studio",
        "is_recently_active", "weighted_decision_score",
    ))


def action_labels(spark: SparkSession, sf: str) -> DataFrame:
    labelled = sc.action_label(sc.decision_score(_scored(spark, sf), src.RULES), src.RULES)
    return labelled.select("production_company_key", "production_company", "studio_action_recommendation")


def band_labels(spark: SparkSession, sf: str) -> DataFrame:
    return sc.present(sc.decision_score(_scored(spark, sf), src.RULES)).select(
        "production_company_key", "production_company", "dominant_performance_band", "latest_performance_band",
        "dominant_performance_band_label", "performance_dot", "performance_dot_color_hex",
    )


def customer_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    fact = _stored_fact(spark, sf)
    return tidy(sc.scorecard(fact, sc.trend_bands(fact, src.RULES), src.RULES))


# --- audits and tests -------------------------------------------------------------------------------------------------


def _quality(spark: SparkSession, sf: str) -> DataFrame:
    return audit.key_quality({
        "raw.movies_main": (src.raw_core(spark, sf), "id"),
        "raw.movie_extended": (src.raw_extended(spark, sf), "id"),
        "raw.ratings": (src.raw_ratings(spark, sf), "movie_id"),
    })


def _written(spark: SparkSession, sf: str) -> tuple[layers.Inputs, dict[str, DataFrame], layers.Models]:
    """Staged and typed tables as written, for reports that read several of them."""
    raw = src.layered_inputs(spark, sf)
    return raw, *layers.write_typed(raw, src.SETTINGS, Writer(shared_folder(spark)))


def _layer_rows(raw: layers.Inputs, staged: dict[str, DataFrame], models: layers.Models) -> DataFrame:
    source = {"movies_main": raw.core, "movie_extended": raw.extended, "ratings": raw.ratings}
    return audit.layer_counts({n: (df, staged[n], models[f"stg_{n}"]) for n, df in source.items()})


def layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _layer_rows(*_written(spark, sf))


def rating_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return audit.coverage(src.raw_core(spark, sf), "id", _step(spark, sf, "ratings").rows, "movie_id")


def _impact(models) -> DataFrame:
    lists = models["stg_movie_extended"].select("movie_id", "production_companies")
    dated = models["stg_movies_main"].select("movie_id", "release_date").join(lists, "movie_id", "left")
    return audit.filter_impact(dated, "production_companies", "release_date")


def filter_impact(spark: SparkSession, sf: str) -> DataFrame:
    return _impact(_stored(spark, sf))


def audit_report(spark: SparkSession, sf: str) -> DataFrame:
    raw, staged, models = _written(spark, sf)
    return audit.audit_report(
        _quality(spark, sf),
        _layer_rows(raw, staged, models),
        audit.coverage(raw.core, "id", staged["ratings"], "movie_id"),
        _impact(models),
    )


def correction_audit(spark: SparkSession, sf: str) -> DataFrame:
    bridge = layers.bridge_table(_stored(spark, sf))
    return tidy(audit.correction_audit(bridge))


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return audit.table_counts({n: src.table(spark, sf, n) for n in ("customer", "events", "lineitem", "orders", "part")})


def table_freshness(spark: SparkSession, sf: str) -> DataFrame:
    now = dt.datetime(2024, 2, 1)
    return tidy(audit.freshness({
        "events": (src.table(spark, sf, "events"), "ts"),
        "lineitem": (src.table(spark, sf, "lineitem"), "l_shipdate"),
        "orders": (src.table(spark, sf, "orders"), "o_orderdate"),
    }, now))


def top_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = src.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("release_year"))
    return audit.top_k(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


def genre_performance(spark: SparkSession, sf: str) -> DataFrame:
    typed = _stored(spark, sf)
    rated = typed["stg_ratings"].select("movie_id", "avg_rating")
    rows = (
        typed["stg_movies_main"].select("movie_id", "revenue_amount")
        .join(typed["stg_movie_extended"].select("movie_id", "genres"), "movie_id", "left")
        .join(rated, "movie_id", "left")
    )
    return tidy(audit.list_group_performance(rows, "genres"))


def task_metrics(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark)
    log, at = f"{folder}/log", src.LOADED_AT
    landed = (f"{folder}/raw", log, at)
    log_landed(spark, lambda: src.raw_ratings(spark, sf).drop("arrival"), "r1", "ratings", *landed, "ratings.json")
    src.table(spark, sf, "region").select("r_name", "r_regionkey").write.option("header", True).csv(f"{folder}/region")
    # A file with a column that its table does not have: the step fails, is recorded, and what needs it is skipped.
    try:
        log_landed(spark, lambda: land_csv(spark, f"{folder}/region", ["r_name"]), "r1", "region", *landed, "region.csv")
    except ValueError as error:
        Task(log, "r1", "staging", "build_region", "staging.region", at, source_relation="raw.region").skip(spark, f"upstream: {error}")
    for name, step in _staged(spark, sf).items():
        log_staged(step, "r1", name, f"{folder}/staged", log, at)
    rows = read_log(spark, log)
    in_order = (F.col("finished_at") >= F.col("started_at")) & (F.col("duration_seconds") >= 0)
    return tidy(rows.withColumn("clocks_in_order", in_order).drop("finished_at", "duration_seconds"))


def cast_losses(spark: SparkSession, sf: str) -> DataFrame:
    """What typing loses of the dirty orders and of the staged tables."""
    c = F.col
    cells = {
        "id": (c("id"), digits_to_long(c("id"))), "release_date": (c("release_date"), parse_routed_date(c("release_date"))),
        "budget": (c("budget"), clean_decimal(c("budget"))),
    }
    dirty = audit.cast_losses(src.dirty_orders(spark, sf), "dirty_orders", cells)
    return dirty.unionByName(typing_losses({n: s.rows for n, s in _staged(spark, sf).items()}))


def build_log_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """Each event is one build run of three nodes: two models and a test, with parents among nodes and sources."""
    events = src.table(spark, sf, "events")
    run = F.concat(F.lit("run-"), F.col("event_id").cast("string"))
    ok = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "view", "skipped").otherwise("success")
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    timing = F.array(
        F.struct(F.concat(at, F.lit("Z")).alias("started_at"), F.concat(at, F.lit("Z")).alias("completed_at")),
        F.struct(F.concat(at, F.lit("Z")).alias("started_at"), at.alias("completed_at")),
    )

    def result(node: str, status, rows, relation):
        return F.struct(
            F.lit(node).alias("unique_id"), status.alias("status"), timing.alias("timing"),
            (F.floor(F.col("value")) / 2).alias("execution_time"),
            F.struct(rows.alias("rows_affected")).alias("adapter_response"),
            relation.alias("relation_name"), F.concat(F.lit("event "), F.col("event_type")).alias("message"),
        )

    none = F.lit(None).cast("string")
    # Counts as numbers (marked =, unquoted below), a number in quotes, a fraction, a negative, and none.
    shapes = F.array(*[F.lit(x) for x in ("=12", "12", "=12.0", "=-1", None)])
    results = F.array(
        result("model.a", F.lit("success"), F.concat(F.lit("="), F.col("user_id")), F.lit('"db"."marts"."a"')),
        result("model.b", ok, F.element_at(shapes, (F.col("event_id") % 5 + 1).cast("int")), none),
        result("test.c", F.lit("fail"), none, none),
    )

    def node(kind: str, schema: str, name: str, alias: str | None, relation: str | None, parents: list[str]):
        return F.struct(
            F.lit(kind).alias("resource_type"), F.lit(schema).alias("schema"), F.lit("db").alias("database"),
            F.lit(name).alias("name"), F.lit(alias).cast("string").alias("alias"),
            F.lit(relation).cast("string").alias("relation_name"), F.lit(f"models/{name}.sql").alias("original_file_path"),
            F.struct(F.array(*[F.lit(p) for p in parents]).cast("array<string>").alias("nodes")).alias("depends_on"),
        )

    nodes = F.create_map(
        F.lit("model.a"), node("model", "marts", "a", None, None, ["source.z", "model.up", "source.z"]),
        F.lit("model.b"), node("model", "marts", "b", "b_alias", None, ["model.a", "model.gone"]),
        F.lit("model.up"), node("model", "staging", "up", None, '"db"."staging"."up"', []),
        F.lit("test.c"), node("test", "marts", "c", None, None, ["model.a"]),
    )
    sources = F.create_map(F.lit("source.z"), node("source", "raw", "z", None, None, []))
    folder = shared_folder(spark)
    document = F.regexp_replace(F.to_json(F.struct(run.alias("run_id"), results.alias("results"))), '"=([^"]*)"', "$1")
    # The documents say the same over and over, so most of their size goes by packing. A packed file is read by one task: a fixed
    # number of them, as few bytes of events make large documents.
    dealt = events.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "event_id")
    write = lambda doc, name: dealt.select(doc.alias("value")).write.text(f"{folder}/{name}", compression="lz4")
    write(document, "results")
    write(F.to_json(F.struct(run.alias("run_id"), nodes.alias("nodes"), sources.alias("sources"))), "manifests")
    read = lambda schema, name: spark.read.schema(schema).json(f"{folder}/{name}")
    tasks = buildlog.flatten_build_logs(
        read(buildlog.RESULTS_SCHEMA, "results"), read(buildlog.MANIFEST_SCHEMA, "manifests"), "marts"
    )
    return tidy(tasks)


def check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return checks.check_not_null(src.customer_bridge(spark, sf), "customer_bridge",
                                 ["movie_id", "revenue_amount", "avg_rating", "total_ratings"])


def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    lines = src.table(spark, sf, "lineitem")
    orders = src.table(spark, sf, "orders")
    return checks.check_unique(lines, "lineitem", "l_orderkey").unionByName(
        checks.check_unique(orders, "orders", "o_orderkey"))


def check_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    flags = checks.check_accepted(repair(src.amounts(spark, sf)), "amounts", "budget_correction_flag", REPAIR_FLAGS)
    kinds = checks.check_accepted(src.table(spark, sf, "events"), "events", "event_type", ["click", "view", "signup"])
    return flags.unionByName(kinds)


def check_relationships(spark: SparkSession, sf: str) -> DataFrame:
    orders, lines = src.table(spark, sf, "orders"), src.table(spark, sf, "lineitem")
    up = checks.check_relationship(lines, "lineitem", "l_orderkey", orders, "o_orderkey")
    down = checks.check_relationship(orders, "orders", "o_orderkey", lines, "l_orderkey")
    return up.unionByName(down)


def declared_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Build and write every layer, running every declared test on the way."""
    return layers.build_layers(src.layered_inputs(spark, sf), src.SETTINGS, shared_folder(spark)).checks


QUERIES: dict[str, Query] = {
    "land_csv": land_csv_files,
    "land_csv_blocks": land_csv_blocks,
    "land_csv_parallel": land_csv_parallel,
    "land_enrichment": land_enrichment,
    "land_json": land_json_files,
    "land_json_arrays": land_json_arrays,
    "land_json_parallel": land_json_parallel,
    "nullify_text": nullify_text,
    "blank_flags": blank_flags,
    "normalise_mixed_dates": normalise_dates,
    "duplicate_profile": duplicate_profile,
    "collapse_duplicates": collapse_duplicate_rows,
    "keep_first": keep_first_rows,
    "fill_missing": fill_gaps,
    "prepare_enrichment": first_enrichment,
    "stage_core": staged_core,
    "stage_core_stats": staged_core_stats,
    "stage_extended": staged_extended,
    "stage_extended_stats": staged_extended_stats,
    "stage_ratings": staged_ratings,
    "stage_ratings_stats": staged_ratings_stats,
    "numeric_keys": numeric_keys,
    "latest_per_key": latest_rows,
    "clean_amounts": clean_amounts,
    "route_dates": route_dates,
    "rewrite_delimiters": rewrite_list_delimiters,
    "harmonise_ratings": harmonise_ratings,
    "minmax_ratings": minmax_ratings,
    "zscore_ratings": zscore_ratings,
    "typed_layers": typed_layers,
    "typed_core": typed_table("movies_main"),
    "typed_extended": typed_table("movie_extended"),
    "typed_ratings": typed_table("ratings"),
    "base_join": joined_base,
    "explode_list": explode_lists,
    "merge_articles": merge_list_articles,
    "repair_amounts": repair_amounts,
    "standardise_names": standardise_names,
    "standardise_by_rules": standardise_by_rules,
    "company_bridge": model("int_movie_company_bridge"),
    "group_year_metrics": group_metrics,
    "weighted_mean": weighted_means,
    "prior_period": prior_periods,
    "prior_lines": prior_lines,
    "change_measures": change_rates,
    "company_year_metrics": model("int_company_year_metrics"),
    "date_dimension": date_table,
    "attribute_dimension": entity_dimension,
    "name_dimension": names_dimension,
    "company_dimension": model("dim_production_companies"),
    "rating_fact": ratings_fact,
    "group_year_fact": customer_year_fact,
    "company_year_fact": model("fct_company_year_performance"),
    "supplier_trends": supplier_trends,
    "trend_bands": trend_banding,
    "company_year_trends": model("vw_company_year_trends"),
    "group_summary": group_summaries,
    "dominant_category": dominant_bands,
    "latest_category": latest_bands,
    "window_bound": window_bounds,
    "decision_score": decision_scores,
    "action_label": action_labels,
    "presentation_labels": band_labels,
    "customer_scorecard": customer_scorecard,
    "company_scorecard": company_scorecard,
    "key_quality": _quality,
    "layer_counts": layer_counts,
    "rating_coverage": rating_coverage,
    "filter_impact": filter_impact,
    "audit_report": audit_report,
    "correction_audit": correction_audit,
    "table_counts": table_counts,
    "freshness": table_freshness,
    "top_k": top_orders,
    "genre_performance": genre_performance,
    "task_metrics": task_metrics,
    "cast_losses": cast_losses,
    "build_log_tasks": build_log_tasks,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_accepted_values": check_accepted_values,
    "check_relationships": check_relationships,
    "declared_checks": declared_checks,
}
