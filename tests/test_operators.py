"""Table operators on small frames, and on groups that hold most of the rows."""

import datetime as dt
import json
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from stratiform.functions.numbers import clean_decimal, digits_to_long
from stratiform.operators import audit, buildlog, checks, scorecard as sc
from stratiform.operators.dedup import collapse_duplicates, dedup_profile, hot_keys, keep_first, latest_per_key
from stratiform.operators.dimensions import date_dimension, date_spine, name_dimension
from stratiform.operators.enrich import fill_missing
from stratiform.operators.facts import group_year_fact, rating_fact
from stratiform.operators.lists import explode_list, explode_names, merge_articles
from stratiform.operators.metrics import group_year_metrics, with_prior, with_prior_spread
from stratiform.operators.scaling import known_statistics, minmax, minmax_and_zscore, statistics, zscore
from stratiform.sources.tables import write_folder
from stratiform.plans.staging import stage_ratings


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_collapse_recovers_the_last_filled_cell(frame):
    df = frame([("1", 1, "x", None), ("1", 2, "", "b"), ("1", 3, None, ""), ("2", 1, "y", "c"), ("2", 2, "None", "c")],
               "k string, n int, a string, b string")
    kept = collapse_duplicates(df, "k", ["n"], ["a", "b"], counters=True)
    assert rows(kept, "k", "n", "a", "b") == [("1", 3, "x", "b"), ("2", 2, "y", "c")]
    assert rows(kept, "k", "n_rejected", "n_recovered") == [("1", 2, 2), ("2", 1, 1)]


def test_collapse_keeps_a_placeholder_with_nothing_better(frame):
    df = frame([("1", 1, None), ("1", 2, "None")], "k string, n int, a string")
    assert rows(collapse_duplicates(df, "k", ["n"], ["a"]), "a") == [("None",)]


def test_profile_tells_exact_from_conflicting(frame):
    df = frame([("1", 1, "a"), ("1", 2, " a "), ("2", 1, "a"), ("2", 2, "b"), ("3", 1, "c")], "k string, n int, a string")
    p = dedup_profile(df, "k", ["n"], ["a"]).first()
    assert (p.duplicate_groups, p.duplicate_rows, p.exact_duplicate_groups, p.conflicting_duplicate_groups) == (2, 4, 1, 1)
    assert (p.keys_with_potential_value_loss, p.risk, p.dedup_status) == (0, "MEDIUM", "CHECK CONFLICTS")


def test_profile_counts_every_lost_cell(frame):
    df = frame([("1", 1, "a"), ("1", 2, "b"), ("1", 3, " ")], "k string, n int, a string")
    p = dedup_profile(df, "k", ["n"], ["a"]).first()
    assert (p.keys_with_potential_value_loss, p.potential_value_loss_cells, p.risk) == (1, 2, "HIGH")


def test_profile_of_unique_keys(frame):
    p = dedup_profile(frame([("1", 1, "a")], "k string, n int, a string"), "k", ["n"], ["a"]).first()
    assert (p.duplicate_groups, p.duplicate_rows, p.risk, p.dedup_status) == (0, 0, None, "NO DUPLICATES")


def test_collapse_of_a_hot_key_matches_brute_force(frame):
    rng = random.Random(7)
    data = []
    for n in range(3000):
        key = "hot" if n % 3 == 0 else str(rng.randrange(400))
        data.append((key, n, rng.choice(["", None, "nan", "v%d" % n]), rng.choice([" ", "w%d" % n])))
    got = {r.k: (r.n, r.a, r.b) for r in
           collapse_duplicates(frame(data, "k string, n int, a string, b string"), "k", ["n"], ["a", "b"]).collect()}
    want = {}
    blank = lambda v: (v or "").strip().lower() in ("", "none", "null", "nan")
    for key, n, a, b in data:
        old = want.get(key, (None, None, None))
        want[key] = (n, old[1] if blank(a) and not blank(old[1]) else a, old[2] if blank(b) and not blank(old[2]) else b)
    assert got == want


def test_hot_keys_are_combined_before_the_shuffle(frame):
    data = [(k, n, v) for n in range(40) for k, v in ((None, "x%d" % n if n % 3 else ""), ("hot", "y%d" % n if n % 4 else None), (str(n % 11), "z%d" % n))]
    df = frame(data, "k string, n int, a string")
    hot = hot_keys(df, "k", 20)
    assert sorted(hot, key=str) == [None, "hot"] and hot_keys(df, "k") == []
    for some in (hot, ["hot"], [None]):
        for make in (
            lambda h: collapse_duplicates(df, "k", ["n"], ["a"], True, hot=h), lambda h: dedup_profile(df, "k", ["n"], ["a"], h),
            lambda h: keep_first(df, "k", ["n"], h), lambda h: latest_per_key(df, "k", ["n"], h),
        ):
            assert sorted(map(str, make(some).collect())) == sorted(map(str, make([]).collect()))
    plan = collapse_duplicates(df, "k", ["n"], ["a"], hot=hot)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and plan.rindex("Exchange") < plan.rindex("partial_max_by")


def test_first_and_latest(frame):
    df = frame([(1, 1, "a"), (1, 2, "b"), (2, None, "c"), (2, 0, "d"), (None, 9, "e")], "k int, n int, v string")
    assert rows(keep_first(df.filter("k = 1"), "k", ["n"]), "v") == [("a",)]
    assert rows(latest_per_key(df, "k", ["n"]), "k", "v") == [(1, "b"), (2, "d")]


@pytest.mark.parametrize("order", [["o"], ["o", "v"]])
def test_a_null_order_keeps_the_row_and_loses_to_any_value(frame, order):
    df = frame([(1, None, "a"), (2, None, "c"), (2, 5, "d"), (2, 7, "e")], "k int, o int, v string")
    assert rows(latest_per_key(df, "k", order), "k", "o", "v") == [(1, None, "a"), (2, 7, "e")]
    assert rows(keep_first(df, "k", order), "k", "o", "v") == [(1, None, "a"), (2, 5, "d")]
    assert rows(collapse_duplicates(df, "k", order, ["v"]), "k", "o", "v") == [(1, None, "a"), (2, 7, "e")]
    recovered = collapse_duplicates(frame([(1, None, "a"), (1, 3, "")], "k int, o int, v string"), "k", order, ["v"])
    assert rows(recovered, "k", "o", "v") == [(1, 3, "a")]
    p = dedup_profile(df, "k", order, ["v"]).first()
    assert (p.duplicate_groups, p.duplicate_rows, p.rows_rejected_dedup) == (1, 3, 2)


def test_column_names_of_any_kind(frame):
    df = frame([(1, 1, "x"), (1, 2, "")], "`a b` int, `order` int, `group` string")
    assert rows(collapse_duplicates(df, "a b", ["order"], ["group"], True), "order", "group", "n_recovered") == [(2, "x", 1)]
    assert rows(keep_first(df, "a b", ["order"]), "order") == [(1,)] and rows(latest_per_key(df, "a b", ["order"]), "order") == [(2,)]


def test_minmax_of_long_decimals_stays_in_range(frame):
    values = ["0", "0.00004", "7.65437", "9.99999"]
    df = frame([(D(v),) for v in values], "v decimal(18,8)")
    got = [r.m for r in minmax(df, "v", "m").orderBy("v").collect()]
    assert got == [D("0.000000"), D("0.000004"), D("0.765438"), D("1.000000")]
    rng = random.Random(3)
    df = frame([(D(rng.randrange(10**9)) / 10**8,) for _ in range(500)], "v decimal(18,8)")
    low, high = minmax(df, "v", "m").agg(F.min("m"), F.max("m")).first()
    assert (low, high) == (D("0.000000"), D("1.000000"))
    assert dict(zscore(df, "v", "z").dtypes)["z"] == "decimal(12,6)"


def test_cast_losses_count_text_that_typing_drops(frame):
    df = frame([("1", "2.5"), ("x", "n/a"), (" ", None), ("2", "1.2.3")], "id string, v string")
    cells = {"id": (F.col("id"), digits_to_long(F.col("id"))), "v": (F.col("v"), clean_decimal(F.col("v")))}
    assert rows(audit.cast_losses(df, "t", cells), "table_name", "column_name", "filled_cells", "lost_cells") == [("t", "id", 3, 1), ("t", "v", 3, 2)]


def test_staged_ratings_meet_without_a_key(frame):
    core = frame([(None,), ("1",)], "id string")
    raw = frame([(None, "7", "9", None, "t", 1), ("1", "8", "9", None, "t", 2)], "movie_id string, avg_rating string, total_ratings string, stg_dev string, loaded_at string, at int")
    none = frame([], "id string, vote_average string, vote_count string, status string")
    for whole in (False, True):
        step = stage_ratings(raw, core, none, ["at"], "t", one_row_per_id=whole)
        stats = step.stats.first()
        assert rows(step.rows, "movie_id", "avg_rating") == [("1", "8"), (None, "7")] and (stats.rows_out, stats.rows_rejected) == (2, 0)


def test_fill_only_blank_from_known(frame):
    df = frame([("1", "0"), ("2", " "), ("3", None), ("4", "None")], "id string, v string")
    src = frame([("1", "5"), ("2", "5"), ("3", None), ("4", "5")], "id string, w string")
    got = rows(fill_missing(df, src, "id", {"v": "w"}, "n"), "id", "v", "n")
    assert got == [("1", "0", 0), ("2", "5", 1), ("3", None, 0), ("4", "None", 0)]


def test_explode_keeps_positions_of_the_list_as_written(frame):
    df = frame([(1, "A Co, ,B Co"), (2, None), (3, "")], "id int, v string")
    assert rows(explode_list(df, "v"), "id", "pos", "item") == [(1, 1, "A Co"), (1, 3, "B Co")]


@pytest.mark.parametrize(
    "text, items",
    [("The,Warner Bros.", ["The Warner Bros."]), ("A,An,X", ["A An"]), ("X,The", ["X", "The"]), ("The, ,X,Y", ["The X", "Y"]),
     (" , ", []), ("the,X", ["the", "X"])],
)
def test_articles(frame, text, items):
    assert merge_articles(frame([(1, text)], "id int, v string"), "v").first()["items"] == items


def test_articles_of_a_missing_list(frame):
    merged = merge_articles(frame([(1, None)], "id int, v string"), "v")
    assert explode_names(merged.drop("v"), "items", "name").count() == 0


def test_first_listing_marks_one_row_per_name(frame):
    df = frame([(1, ["LIONSGATE", "X", "Lions Gate", "X"])], "id int, items array<string>")
    got = rows(explode_names(df, "items", "name", first_flag="f"), "name", "f")
    assert got == [("Lions Gate Films", False), ("Lions Gate Films", True), ("X", False), ("X", True)]


def test_scaling_without_range_is_null(frame):
    df = frame([(D("5"),), (D("5"),), (None,)], "v decimal(18,8)")
    out = zscore(minmax(df, "v", "m"), "v", "z").collect()
    assert all(r.m is None and r.z is None for r in out)


def test_scaling(frame):
    df = frame([(D("0"),), (D("4"),), (D("8"),)], "v decimal(18,8)")
    out = sorted((r.v, r.m, r.z) for r in zscore(minmax(df, "v", "m"), "v", "z").collect())
    assert [(float(m), z) for _, m, z in out] == [(0.0, -1.0), (0.5, 0.0), (1.0, 1.0)]


def bridge(frame, data):
    return frame(data, "movie_id long, production_company string, release_year int, revenue_amount decimal(18,2), "
                       "avg_rating decimal(10,4), total_ratings int, record_loaded_at timestamp_ntz, f boolean")


def test_metrics_count_entities_once_and_amounts_as_listed(frame):
    at = dt.datetime(2020, 1, 1)
    df = bridge(frame, [
        (1, "X", 2000, D("100"), D("8"), 10, at, True), (1, "X", 2000, D("100"), D("8"), 10, at, False),
        (2, "X", 2000, D("0"), None, None, at, True), (3, "X", 2000, D("-5"), D("2"), 0, at, True),
        (4, "X", 1989, D("1"), D("2"), 1, at, True),
    ])
    plain, flagged = (group_year_metrics(df, first_flag=f).collect() for f in (None, "f"))
    assert plain == flagged and len(plain) == 1
    r = plain[0]
    assert (r.movies_released, r.total_revenue, r.avg_revenue) == (3, D("200.00"), D("65.00"))
    assert (r.weighted_avg_rating, r.avg_vote_count) == (D("8.0000"), D("5.00"))
    once = group_year_metrics(df, first_flag="f", distinct_entities=True).first()
    assert (once.movies_released, once.total_revenue) == (3, D("100.00"))


def test_prior_skips_gaps(frame):
    df = frame([("X", 2000, 1), ("X", 2003, 2), ("Y", 2001, 5)], "g string, y int, v int")
    got = rows(with_prior(df, "g", ["y"], {"before": "v", "year": "y"}), "g", "y", "before", "year")
    assert got == [("X", 2000, None, None), ("X", 2003, 1, 2000), ("Y", 2001, None, None)]


def test_calendar_bounds(frame):
    dates = frame([(dt.date(1999, 3, 2),), (dt.date(2001, 5, 5),), (None,)], "d date")
    spine = date_spine(dates, "d", dt.date(2026, 12, 1))
    lo, hi, n = spine.agg(F.min("date_day"), F.max("date_day"), F.count("*")).first()
    assert (lo, hi, n) == (dt.date(1999, 1, 1), dt.date(2030, 12, 31), (hi - lo).days + 1)
    empty = date_spine(dates.filter("false"), "d", dt.date(2026, 12, 1))
    assert empty.agg(F.min("date_day"), F.max("date_day")).first()[:] == (dt.date(1900, 1, 1), dt.date(2031, 11, 30))


def test_calendar_attributes(frame):
    spine = frame([(dt.date(2021, 1, 1),), (dt.date(2020, 2, 29),)], "date_day date")
    out = {r.date_key: r for r in date_dimension(spine).collect()}
    first, leap = out[20210101], out[20200229]
    assert (first.week_of_year, first.iso_day_of_week, first.is_year_start, first.is_weekend) == (53, 5, True, False)
    assert (leap.day_name, leap.is_month_end, leap.is_quarter_end, leap.quarter_end_date) == (
        "Saturday", True, False, dt.date(2020, 3, 31))
    assert len(first) == 24


def test_names_regardless_of_case(frame):
    at = dt.datetime(2020, 1, 1)
    df = frame([("Foo", 2001, at), ("FOO ", 1999, at), (" ", 2000, at)],
               "production_company string, release_year int, record_loaded_at timestamp_ntz")
    assert rows(name_dimension(df), "production_company_key", "production_company", "first_release_year",
                "latest_release_year") == [("acbd18db4cc2f85cedef654fccc4a4d8", "FOO", 1999, 2001)]


def test_return_on_budget(frame):
    rated = frame([(1, None), (2, 1000), (9, 5)], "movie_id long, total_ratings int").withColumns({
        c: F.lit(None).cast("double") for c in ("avg_rating", "std_dev", "avg_rating_minmax", "avg_rating_zscore")
    }).withColumn("loaded_at", F.lit(None).cast("timestamp_ntz"))
    movies = frame([(1, D("100"), D("250"), dt.date(2001, 2, 3)), (2, D("0"), D("5"), None)],
                   "movie_id long, budget_amount decimal(18,2), revenue_amount decimal(18,2), release_date date")
    movies = movies.withColumns({c: F.lit("x") for c in ("title", "genres", "production_countries")}).withColumn(
        "release_date_key", F.lit(1))
    got = rows(rating_fact(rated, movies), "movie_id", "roi_pct", "interest_band", "release_month")
    assert got == [(1, D("150.00"), "low_interest", 2), (2, None, "high_interest", None), (9, None, "low_interest", None)]


def test_dominant_and_latest(frame):
    data = [("k", b, y, 0) for b, y in (("b", 1999), ("b", 2001), ("a", 2000), ("a", 2001), ("c", 2010))]
    trends = frame(data, "production_company_key string, performance_band string, release_year int, x int")
    counts = sc.band_counts(trends)
    assert rows(sc.both_categories(counts), "dominant_band", "latest_band") == [("a", "c")]


def scored(frame, latest_year, years, latest, dominant, ratio, top):
    return frame([(latest_year, years, latest, dominant, D(ratio), top)],
                 "latest_year int, years_observed long, latest_band string, dominant_band string, "
                 "consistency_ratio decimal(28,4), analysis_max_year int")


@pytest.mark.parametrize(
    "args, score, action",
    [((2024, 15, "declining", "declining", "0.2", 2024), "0.44", "Incentivise"),
     ((2024, 15, "declining", "declining", "0.15", 2024), "0.44", "Renegotiate"),
     ((2018, 15, "declining", "declining", "0.2", 2024), "0.24", "Review"),
     ((2013, 15, "outperforming", "outperforming", "0.9", 2024), "0", "Inactive"),
     ((2020, 3, "unclassified", "other", "0.2", 2024), "0.12", "Renegotiate")],
)
def test_score_and_action(frame, args, score, action):
    r = sc.present(sc.action_label(sc.decision_score(scored(frame, *args)))).first()
    assert (r.weighted_decision_score, r.studio_action_recommendation) == (D(score), action)
    assert (r.performance_dot_color_hex == "#7A7A7A") == (action == "Inactive")


def test_fact_with_and_without_a_dimension(frame, spark, sf):
    from stratiform.operators.metrics import year_over_year
    from stratiform.workload import inputs as src

    metrics = year_over_year(src.customer_metrics(spark, sf))
    joined = group_year_fact(metrics, name_dimension(src.customer_bridge(spark, sf)))
    assert joined.exceptAll(group_year_fact(metrics)).count() == 0
    assert joined.count() == metrics.count()


def test_checks(frame):
    df = frame([(1, "a"), (1, "b"), (None, "b"), (3, None)], "k int, v string")
    parent = frame([(1,)], "p int")
    assert rows(checks.check_not_null(df, "t", ["k", "v"]), "column_name", "violations") == [("k", 1), ("v", 1)]
    assert checks.check_unique(df, "t", "k").first().violations == 1
    assert checks.check_accepted(df, "t", "v", ["a"]).first().violations == 1
    assert checks.check_relationship(df, "t", "k", parent, "p").first().violations == 1


def test_filter_impact_agrees_with_exploding(frame):
    df = frame([("a, ,b", dt.date(2000, 1, 1)), (None, None), ("c", None)], "v string, d date")
    assert audit.filter_impact(df, "v", "d").first()[:] == (5, 2, 2, 2)


def test_top_k_and_freshness(frame):
    df = frame([(i, dt.datetime(2024, 1, 1 + i)) for i in range(5)], "n int, at timestamp_ntz")
    assert [r.n for r in audit.top_k(df, [F.col("n").desc()], 2).collect()] == [4, 3]
    fresh = audit.freshness({"t": (df, "at")}, dt.datetime(2024, 1, 6)).first()
    assert (fresh.last_loaded, fresh.age_seconds) == (dt.datetime(2024, 1, 5), 86400)


def test_build_log_edges(spark, tmp_path):
    results = tmp_path / "results.json"
    results.write_text("""{"run_id": "r", "results": [
        {"unique_id": "m.a", "status": "success", "timing": [{"started_at": "2024-01-01T00:00:00Z", "completed_at": null},
          {"started_at": null, "completed_at": "2024-01-01T00:00:02.5Z"}], "execution_time": 2.5,
          "adapter_response": {"rows_affected": 12.0}, "relation_name": null, "message": "fine"},
        {"unique_id": "m.b", "status": "error", "timing": [], "execution_time": null, "adapter_response": {},
          "relation_name": "\\"d\\".\\"s\\".\\"b\\"", "message": "broke"},
        {"unique_id": "m.other", "status": "success"}, {"unique_id": "gone", "status": "success"}]}""")
    manifest = tmp_path / "manifest.json"
    manifest.write_text("""{"run_id": "r", "nodes": {
        "m.a": {"resource_type": "model", "schema": "s", "database": "d", "name": "a", "depends_on": {"nodes": ["src.z", "src.z", "m.b"]}},
        "m.b": {"resource_type": "model", "schema": "s", "name": "b", "depends_on": {"nodes": []}},
        "m.other": {"resource_type": "model", "schema": "t", "name": "o"}},
        "sources": {"src.z": {"schema": "raw", "identifier": "z", "name": "zz"}}}""")
    tasks = buildlog.flatten_build_logs(
        spark.read.schema(buildlog.RESULTS_SCHEMA).json(str(results), multiLine=True),
        spark.read.schema(buildlog.MANIFEST_SCHEMA).json(str(manifest), multiLine=True), "s")
    a, b = (tasks.filter(F.col("task_name") == n).first() for n in "ab")
    assert tasks.count() == 2
    assert (a.status, a.rows_out, a.duration_seconds, a.source_relation, a.target_relation) == (
        "completed", None, 2, "raw.z, s.b", "d.s.a")
    assert (a.started_at, a.finished_at) == (dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 8, 0, 2, 500000))
    assert (b.status, b.error_message, b.source_relation, b.target_relation, b.duration_seconds, b.started_at) == (
        "failed", "broke", None, "d.s.b", None, None)
    assert buildlog.run_status(tasks).first()[1:] == (2, 1, "partial")


def test_build_log_documents_are_read_and_shuffled_once(spark, tmp_path):
    """A run's results may lie in two documents and its manifest be there twice; parents are found among many nodes."""
    node = lambda i, parents: {"resource_type": "model", "schema": "s", "name": f"n{i}", "depends_on": {"nodes": parents}}
    nodes = {f"m.{i}": node(i, [f"m.{(i * 7 + 1) % 40}", "src.z", None, "gone"]) for i in range(40)}
    manifest = {"run_id": "r", "nodes": {**nodes, "src.z": None}, "sources": {"src.z": {"name": "z"}, "m.8": {"name": "hidden"}}}
    done = lambda ids: {"run_id": "r", "results": [{"unique_id": i, "status": "error" if i == "m.39" else "success"} for i in ids]}
    documents = {
        "results": [done([f"m.{i}" for i in range(20)] + ["m.x", None]), done([f"m.{i}" for i in range(20, 40)]),
                    {"run_id": None, "results": [{"unique_id": "m.1"}]}],
        "manifests": [manifest, manifest, {**manifest, "run_id": None}],
    }
    for name, docs in documents.items():
        (tmp_path / f"{name}.json").write_text("\n".join(map(json.dumps, docs)))
    read = lambda schema, name: spark.read.schema(schema).json(str(tmp_path / f"{name}.json"))
    tasks = buildlog.flatten_build_logs(read(buildlog.RESULTS_SCHEMA, "results"), read(buildlog.MANIFEST_SCHEMA, "manifests"), "s")
    plan = tasks._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("FileScan json"), plan.count("Exchange")) == (2, 1)
    assert rows(tasks, "task_name", "source_relation", "run_status") == sorted(
        (f"n{i}", f"s.n{(i * 7 + 1) % 40}, z", "partial") for i in range(40))


def test_look_back_in_a_hot_group_spreads_over_tasks(spark, frame):
    rows = [("hot" if i % 3 else None if i % 2 else "g%d" % (i % 8), None if i % 50 == 0 else i * 37 % 1009, i, "v%d" % i) for i in range(3000)]
    df, prior = frame(rows, "g string, at long, id long, v string"), {"was": "v", "was_at": "at"}
    want = sorted(map(repr, with_prior(df, "g", ["at", "id"], prior).collect()))
    for n in (1, 7, 40):
        got = with_prior_spread(df, "g", ["at", "id"], prior, n)
        assert sorted(map(repr, got.collect())) == want
    tasks = got.where("g = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert tasks > 20
    assert with_prior_spread(df.limit(0), "g", ["at", "id"], prior).count() == 0


def test_statistics_taken_while_writing(spark, frame, tmp_path):
    for rows in ([(D("3.5"),), (None,), (D("7.25"),), (D("4"),)], [(D("1"),)], [(None,)], []):
        df = frame(rows, "x decimal(10,4)").repartition(3)
        watched, seen = statistics(df, "x")
        written = write_folder(watched, str(tmp_path / f"t{len(rows)}"))
        scored = minmax_and_zscore(written, "x", "m", "z", known=known_statistics(written, "x", seen))
        assert sorted(map(repr, scored.collect())) == sorted(map(repr, minmax_and_zscore(df, "x", "m", "z").collect()))
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "ubquery" not in plan
