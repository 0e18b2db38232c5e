"""Queries agree with their SQL, and their plans have the shape meant for them."""

import pytest
from compare import connect, differences

from stratiform.operators.scorecard import ScoreRules
from stratiform.plans import layers
from stratiform.plans.tasklog import Writer, read_log
from stratiform.sources.tables import read_folder
from stratiform.workload import inputs as src
from stratiform.workload.oracles import ORACLES
from stratiform.workload.queries import QUERIES


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_agrees_with_sql(spark, sf, con, name):
    assert differences(QUERIES[name](spark, sf), con, ORACLES[name]) == []


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["supplier_trends", "customer_scorecard", "minmax_ratings", "stage_core", "company_bridge", "rating_fact"])
def test_no_cross_join_and_no_python(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow"):
        assert bad not in plan


def test_cleaners_do_not_shuffle(spark, sf):
    for name in ("nullify_text", "clean_amounts", "route_dates", "repair_amounts", "merge_articles", "explode_list"):
        assert "Exchange" not in plan_of(QUERIES[name](spark, sf)), name


def test_collapse_shuffles_once_after_combining(spark, sf):
    plan = plan_of(QUERIES["collapse_duplicates"](spark, sf))
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan


def test_rows_are_shuffled_as_they_came(spark, sf):
    for name in ("collapse_duplicates", "duplicate_profile"):
        plan = plan_of(QUERIES[name](spark, sf))
        # A plan reads from its end upwards: rows are dealt out first, and what the aggregate needs of them is made after that.
        assert plan.index("partial_max_by") < plan.index("Exchange hashpartitioning(id") and "xxhash64" not in plan[plan.index("Exchange hashpartitioning(id"):], name


def test_flagged_metrics_need_no_distinct_count(spark, sf):
    plan = plan_of(src.customer_metrics(spark, sf))
    assert plan.count("Exchange") == 1 and "distinct" not in plan.lower()


def test_scans_read_only_what_is_used(spark, sf):
    plan = plan_of(QUERIES["weighted_mean"](spark, sf))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_typed_tables_join_without_a_shuffle(spark, sf):
    QUERIES["base_join"](spark, sf)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined, fact = (plan_of(QUERIES[n](spark, sf)) for n in ("base_join", "rating_fact"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")
    assert joined.count("Join") == 2 and "Exchange" not in joined
    assert "Exchange" not in fact and fact.count("FileScan") == 3


def test_the_enrichment_source_joins_without_moving(spark, sf, tmp_path):
    raw = src.layered_inputs(spark, sf)
    layers.write_typed(raw, src.SETTINGS, Writer(str(tmp_path)))
    extra = read_folder(spark, f"{tmp_path}/staged/enrichment")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(layers.staged_table("movies_main", raw, src.SETTINGS, extra).rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan


def test_year_range_reaches_the_scan(spark, sf):
    details = QUERIES["supplier_trends"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1990-01-01" in details


# The declared columns of the models, with types where they are declared.
DECLARED_TYPES = {
    "stg_movies_main": "movie_id bigint, title string, release_date date, budget_amount decimal(18,2), revenue_amount decimal(18,2), loaded_at timestamp_ntz",
    "stg_movie_extended": "movie_id bigint, genres string, production_countries string, production_companies string, spoken_languages string,"
                          " loaded_at timestamp_ntz",
    "stg_ratings": "movie_id bigint, avg_rating decimal(10,4), total_ratings int, std_dev decimal(10,4), avg_rating_minmax decimal(12,6),"
                   " avg_rating_zscore decimal(12,6), loaded_at timestamp_ntz",
}
METRICS = "movies_released total_revenue avg_revenue weighted_avg_rating avg_vote_count prior_year_revenue prior_year_rating revenue_yoy_pct rating_yoy_delta"
DECLARED_COLUMNS = {
    "int_movie_company_bridge": "movie_id title release_date release_year budget_amount revenue_amount avg_rating total_ratings genres production_countries"
                                " production_company budget_correction_flag record_loaded_at",
    "int_company_year_metrics": f"production_company release_year {METRICS} record_loaded_at",
    "dim_movies": "movie_id title release_date_key release_date budget_amount revenue_amount genres production_countries production_companies"
                  " spoken_languages record_loaded_at",
    "dim_production_companies": "production_company_key production_company first_release_year latest_release_year loaded_at",
    "fct_movie_ratings": "movie_id title release_date_key release_date release_year release_month genres production_countries budget_amount revenue_amount"
                         " roi_pct avg_rating total_ratings std_dev avg_rating_minmax avg_rating_zscore interest_band rating_loaded_at",
}


def check_schemas(models):
    for name, declared in DECLARED_TYPES.items():
        assert [f"{n} {t}" for n, t in models[name].dtypes] == declared.replace("(18,2)", "(18;2)").replace("(10,4)", "(10;4)").replace("(12,6)", "(12;6)") \
            .replace(", ", "|").replace(";", ",").split("|"), name
    for name, declared in DECLARED_COLUMNS.items():
        assert set(models[name].columns) == set(declared.split()), name


def test_build_writes_every_layer(spark, sf, tmp_path):
    for _ in range(2):  # a repeated build replaces its tables and the rows of its log
        built = layers.build_layers(src.layered_inputs(spark, sf), src.SETTINGS, str(tmp_path), str(tmp_path / "log"), "r1")
    logged = read_log(spark, str(tmp_path / "log")).collect()
    assert {r.status for r in logged} == {"completed"} and len({(r.stage_name, r.task_name) for r in logged}) == len(logged) == 19
    assert {(r.stage_name, r.task_name): r.rows_out for r in logged}["marts", "build_dim_movies"] == built.models["dim_movies"].count()
    assert built.checks.count() == 33 and built.checks.filter("violations > 0").count() == 0
    bridge = built.models["int_movie_company_bridge"]
    assert layers.FIRST not in bridge.columns and bridge.count() > 0
    assert set(built.models) == set(layers.MODELS)
    check_schemas(built.models)
    written = {str(p.relative_to(tmp_path)) for p in tmp_path.glob("*/*") if p.is_dir()}
    assert {"staged/ratings", "staging/stg_ratings", "intermediate/int_movie_company_bridge", "marts/dim_date"} <= written


def test_broken_layer_stops_the_build(spark, sf, tmp_path):
    inputs = src.layered_inputs(spark, sf)
    typed = layers.typed_tables({n: s.rows for n, s in layers.staged_tables(inputs, src.SETTINGS, ["ratings"]).items()})
    models = {"stg_movies_main": typed["stg_ratings"].unionAll(typed["stg_ratings"]), "stg_movie_extended": typed["stg_ratings"],
              "stg_ratings": typed["stg_ratings"]}
    with pytest.raises(layers.ChecksFailed, match="stg_movies_main.movie_id unique"):
        layers._test_layer("staging", models, Writer(str(tmp_path)))


def test_rules_default_to_the_reference_values():
    rules = ScoreRules()
    assert (rules.years, rules.min_years, rules.inactive_year) == ((2000, 2024), 5, 2013)
    assert (rules.incentivise_from, rules.review_from, rules.consistency_above) == ("0.40", "0.20", "0.15")
