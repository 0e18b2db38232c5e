"""Column functions on the edge cases they are made for."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from stratiform.functions.names import NameTable, standardise_by_table
from stratiform.functions import dates, measures, numbers, text
from stratiform.operators.metrics import change_measures


def values(frame, inputs, kind, fn):
    df = frame([(i, v) for i, v in enumerate(inputs)], f"n int, v {kind}")
    return [r[0] for r in df.orderBy("n").select(fn(F.col("v"))).collect()]


def pairs(frame, inputs, kinds, fn):
    df = frame([(i, *v) for i, v in enumerate(inputs)], f"n int, a {kinds[0]}, b {kinds[1]}")
    return [r[0] for r in df.orderBy("n").select(fn(F.col("a"), F.col("b"))).collect()]


def test_nullify_strips_every_kind_of_space(frame):
    got = values(frame, [" a\t", "　x\xa0", " \n", "", None, "a b"], "string", text.nullify)
    assert got == ["a", "x", None, None, None, "a b"]


def test_file_cells_know_missing_markers_only_as_written(frame):
    got = values(frame, ["N/A", " N/A ", "none", "None", "NULL", " x "], "string", text.nullify_file_cell)
    assert got == [None, "N/A", "none", None, None, "x"]


def test_blank_and_placeholder(frame):
    cells = [None, "", " \t", "None", " NULL ", "nan", "nano", "0", "no ne"]
    assert values(frame, cells, "string", text.is_blank) == [True, True, True] + [False] * 6
    assert values(frame, cells, "string", text.is_placeholder) == [True] * 6 + [False] * 3


def test_numeric_key(frame):
    cells = [" 007 ", "7a", "", "-1", "7\n", None, "99999999999999999999"]
    assert values(frame, cells, "string", numbers.digits_to_long) == [7, None, None, None, None, None, None]


def test_amount_text(frame):
    cells = ["$1,200.50", "", "n/a", "1.2.3", "-", "-5", "2.005", None]
    got = values(frame, cells, "string", numbers.clean_decimal)
    assert got == [D("1200.50"), None, None, None, None, D("-5.00"), D("2.01"), None]


def test_count_text_must_be_whole(frame):
    assert values(frame, ["123.0", "12.5", "1,000", "x"], "string", numbers.clean_int) == [123, None, 1000, None]


def test_routed_dates(frame):
    cells = ["2020-1-5", "01/15/2020", "15-01-2020", "2020", "2020-02-30", "13/13/2020", " 2020-01-05 ", None]
    day = dt.date
    got = values(frame, cells, "string", dates.parse_routed_date)
    assert got == [day(2020, 1, 5), day(2020, 1, 15), day(2020, 1, 15), None, None, None, day(2020, 1, 5), None]


def test_mixed_dates_fall_back_to_day_first(frame):
    cells = ["25/12/2020", "12/25/2020", "2020-3-4", "4-3-2020", "soon", ""]
    got = values(frame, cells, "string", dates.normalise_mixed_date)
    assert got == ["2020-12-25", "2020-12-25", "2020-03-04", "2020-03-04", None, None]


def test_wall_clock_shifts_only_zoned_text(frame):
    cells = ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00", "2024-01-01T00:00:00.5+02:00", None]
    got = values(frame, cells, "string", dates.wall_clock)
    assert got == [dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 6, 0, 0, 500000), None]


def test_wall_clock_is_the_same_in_any_session_zone(frame, spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = values(frame, ["2024-01-01T00:00:00Z"], "string", lambda c: dates.wall_clock(c).cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2024-01-01 08:00:00"]


def test_delimiter_rewrite_by_intent_and_as_written(frame):
    assert values(frame, ["a | b|c", " ", None], "string", text.rewrite_delimiters) == ["a,b,c", None, None]
    literal = values(frame, ["a | b"], "string", lambda c: text.rewrite_delimiters(c, r"\\s*\\|\\s*"))
    assert literal == ["a | b"]


def test_rating_scales(frame):
    cells = [D(x) if x is not None else None for x in ("-1", "0", "4", "5", "5.1", "10", "75", "101", None)]
    got = values(frame, cells, "decimal(18,8)", measures.harmonise_rating)
    assert got == [None, 0, 8, 10, D("5.1"), 10, D("7.5"), None, None]


def test_repair_flags(frame):
    cells = [(5, 20), (5, 2000000), (5, 5000), (500000, 100000000), (1000000, 100000000), (0, 20), (None, 20)]
    got = pairs(frame, cells, ("bigint", "bigint"), measures.repair_flag)
    o = measures.ORIGINAL
    assert got == [measures.BOTH_MILLION, measures.BUDGET_MILLION, o, measures.BUDGET_THOUSAND, o, o, o]


def test_name_rules(frame):
    got = values(frame, ["LIONSGATE", "Lions  Gate UK", "Big Lions Gate", None], "string", text.standardise_name)
    assert got == ["Lions Gate Films", "Lions Gate Films", "Big Lions Gate", None]


def test_table_of_name_rules_is_the_same_as_patterns(frame):
    rules = [("lions gate", "Lions Gate Films"), ("a b", "AB"), ("ab c", "ABC"), ("x", "X"), ("x y", "never"), ("ä", "Umlaut")]
    names = ["LIONSGATE", "Lions  Gate UK", "lions\t gate", "Big Lions Gate", None, "", "ab", "A  B", "abc", "ab  c", "a bc", "b", "xy", "x", " x", "ä", "Ä", "lions gat"]
    patterns = [("(?i)^" + r"\s*".join(b.split()), n) for b, n in rules]
    table = NameTable(rules)
    want = values(frame, names, "string", lambda c: text.standardise_name(c, patterns))
    assert values(frame, names, "string", lambda c: standardise_by_table(c, table)) == want
    lists = frame([([n for n in names[:5]],), (None,), ([],), (names[5:],)], "l array<string>")
    assert [r[0] for r in lists.select(standardise_by_table(F.col("l"), table, lists=True)).collect()] == [want[:5], None, [], want[5:]]


def test_ten_thousand_rules_keep_the_plan_small(spark):
    rows = spark.range(10).select(F.concat(F.lit("name "), F.col("id") * 1000).alias("n"))
    plans = []
    for n in (10, 10_000):
        df = rows.select(standardise_by_table(F.col("n"), NameTable((f"name {k} ", f"N{k}") for k in reversed(range(n)))).alias("n"))
        plans.append(len(df._jdf.queryExecution().optimizedPlan().toString()))
    assert df.first()[0] == "N0" and df.collect()[9][0] == "N9000" and abs(plans[0] - plans[1]) < 20


@pytest.mark.parametrize(
    "rows, mean",
    [([("8", 100), (None, 100)], D("4.0000")), ([("6", 0), ("8", None)], D("7.0000")), ([(None, 0)], None)],
)
def test_weighted_mean(frame, rows, mean):
    df = frame([(None if v is None else D(v), w) for v, w in rows], "v decimal(10,4), w int")
    assert df.agg(measures.weighted_mean(F.col("v"), F.col("w"))).first()[0] == mean


def test_ratio_rounds_halves_away_from_zero(frame):
    got = pairs(frame, [(1, 8), (-1, 8), (1, 3), (1, 0), (None, 2)], ("bigint", "bigint"),
                lambda a, b: numbers.exact_ratio(a, b, 2))
    assert got == [D("0.13"), D("-0.13"), D("0.33"), None, None]


def test_change_needs_a_base(frame):
    rows = [(D("150"), D("100"), D("7"), D("6")), (D("0"), D("150"), D("7"), None), (D("10"), D("0"), None, D("1")),
            (D("10"), None, D("1"), D("1"))]
    money, rate = "decimal(28,2)", "decimal(28,4)"
    df = frame(rows, f"total_revenue {money}, prior_year_revenue {money}, weighted_avg_rating {rate}, prior_year_rating {rate}")
    got = [(r.revenue_yoy_pct, r.rating_yoy_delta) for r in change_measures(df).collect()]
    assert got == [(D("50.00"), D("1.0000")), (D("-100.00"), None), (None, None), (None, D("0.0000"))]


def test_trend_bands(frame):
    df = frame(
        [(i, None if g is None else D(str(g)), D(str(r))) for i, (g, r) in enumerate(
            [(20, 0), (0, 0), (-1, 0), (0, -0.1), (-1, -1), (None, 1)])],
        "n int, g decimal(18,2), r decimal(18,4)",
    )
    bands = [r[0] for r in df.orderBy("n").select(measures.trend_band(F.lit(1999), F.col("g"), F.col("r"))).collect()]
    assert bands == ["outperforming", "stable_positive", "rating_up_revenue_down", "revenue_up_rating_down", "declining",
                     "declining"]
    assert df.select(measures.trend_band(F.lit(None), F.col("g"), F.col("r"))).distinct().collect()[0][0] == "no_baseline"


def test_interest_bands(frame):
    got = values(frame, [10000, 9999, 999, 99, None], "int", measures.interest_band)
    assert got == ["blockbuster_signal", "high_interest", "medium_interest", "low_interest", "low_interest"]


def test_wall_clock_in_the_repeated_hour(spark, frame):
    """The session zone's clock shows 02:30 twice in the night summer time ends; the instants stay apart."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        texts = ["2024-10-27T00:30:00Z", "2024-10-27T01:30:00Z", "2024-07-01T10:00:00.123456+02:00", "2024-07-01T10:00:00", None]
        df = frame([(t,) for t in texts], "t string").select(dates.wall_clock(F.col("t")).cast("string").alias("w"))
        assert [r.w for r in df.collect()] == ["2024-10-27 08:30:00", "2024-10-27 09:30:00", "2024-07-01 16:00:00.123456", "2024-07-01 10:00:00", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_weighted_mean_keeps_its_decimals(frame):
    df = frame([(D("7.12345"), 1), (D("7.12344"), 1)], "v decimal(10,5), w int")
    assert df.agg(measures.weighted_mean(F.col("v"), F.col("w"), 6)).first()[0] == D("7.123445")
    half = frame([(D("1"), D("0.5")), (D("4"), D("0.25"))], "v decimal(10,5), w decimal(6,2)")
    assert half.agg(measures.weighted_mean(F.col("v"), F.col("w"), 6)).first()[0] == D("2.000000")


def test_rating_scale_is_chosen_before_rounding(frame):
    df = frame([(D("5.000000001"),), (D("5"),), (D("10.000000001"),)], "r decimal(24,12)")
    got = [r[0] for r in df.select(measures.harmonise_rating(F.col("r"))).collect()]
    assert got == [D("5.000000001"), D("10"), D("1.0000000001")]
