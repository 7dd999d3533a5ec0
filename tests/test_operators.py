"""Edges of the operators on small rows."""

from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.operators import aggregate, balance, filters, quality, season, windows
from wattfolio.settings import Offset, SeasonSpan

D = date.fromisoformat


def tuples(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# --- sums


def test_daily_sum_of_missing_values_is_zero(spark):
    rows = [
        ("a", datetime(2022, 1, 1, 6), 1.0), ("a", datetime(2022, 1, 1, 23, 59), float("nan")),
        ("a", datetime(2022, 1, 2), None), ("b", datetime(2022, 1, 1), 5.0), ("b", None, 9.0),
    ]
    df = spark.createDataFrame(rows, "s string, t timestamp_ntz, v double")
    got = sorted(tuples(aggregate.daily_sum(df, "v", "t", ["s"]), "s", "date", "v"))
    assert got == [("a", D("2022-01-01"), 1.0), ("a", D("2022-01-02"), 0.0), ("b", D("2022-01-01"), 5.0)]


def test_weekly_sum_equals_a_sunday_resample(spark):
    days = [date(2020, 12, 20) + timedelta(i) for i in (0, 1, 5, 13, 14, 40, 41, 90)]
    values = [float(i + 1) for i in range(len(days))]
    df = spark.createDataFrame(list(zip(days, values)), "d date, v double")
    got = sorted(tuples(aggregate.weekly_sum(df, "v", "d"), "week_end", "v"))
    want = pd.Series(values, index=pd.to_datetime(days)).resample("W").sum()
    assert got == [(d.date(), v) for d, v in want.items()]
    assert any(v == 0 for _, v in got)


def test_weeks_are_filled_within_each_series_only(spark):
    rows = [("a", D("2022-01-02"), 1.0), ("a", D("2022-01-23"), 2.0), ("b", D("2022-01-16"), 3.0)]
    df = spark.createDataFrame(rows, "s string, d date, v double")
    got = sorted(tuples(aggregate.weekly_sum(df, "v", "d", ["s"]), "s", "week_end", "v"))
    assert got == [
        ("a", D("2022-01-02"), 1.0), ("a", D("2022-01-09"), 0.0),
        ("a", D("2022-01-16"), 0.0), ("a", D("2022-01-23"), 2.0), ("b", D("2022-01-16"), 3.0),
    ]


def test_repeats_go_and_conflicts_stay(spark):
    t = datetime(2023, 1, 1)
    rows = [(t, "10"), (t, "10"), (t, "10.0"), (t, "12"), (t + timedelta(hours=1), "10")]
    df = spark.createDataFrame(rows, "t timestamp_ntz, q string")
    assert sorted(tuples(aggregate.drop_repeats(df, "t", "q"), "q")) == [("10",), ("10",), ("10.0",), ("12",)]
    assert tuples(quality.conflicting_readings(df, "t", "q"), "t", "values") == [(t, 3)]


def test_mean_of_sums(spark):
    rows = [(2015, 1, 1.0), (2015, 1, 2.0), (2016, 1, 5.0), (2016, 2, None)]
    df = spark.createDataFrame(rows, "y int, m int, v double")
    got = aggregate.mean_of_sums(df, "v", {"y": F.col("y"), "m": F.col("m")}, ["m"])
    assert sorted(tuples(got, "m", "mean")) == [(1, 4.0), (2, 0.0)]


def test_share_of_a_zero_total_is_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 0.0)], "s string, v double")
    assert sorted(tuples(aggregate.share_of_total(df, "v", ["s"]), "s", "v", "share")) == [
        ("a", 1.0, 0.25), ("a", 3.0, 0.75), ("b", 0.0, None)
    ]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "v int, s string")
    b = spark.createDataFrame([(2,), (2,)], "v int")
    assert tuples(aggregate.union_all([a, b]), "v", "s") == [(1, "x"), (2, None), (2, None)]


# --- windows


def test_rolling_median_counts_rows_and_crosses_years(spark):
    days = [date(2021, 12, 20) + timedelta(2 * i) for i in range(20)]
    values = [float((i * 37) % 23) for i in range(20)]
    values[9] = None
    df = spark.createDataFrame(list(zip(days, values)), "d date, v double")
    got = df.select("d", windows.rolling_median(F.col("v"), "d").alias("m")).orderBy("d").collect()
    want = pd.Series(values, dtype=float).rolling(7).median()
    for r, w in zip(got, want):
        assert (r.m is None and pd.isna(w)) or r.m == w
    assert sum(r.m is None for r in got) == 13


def test_even_window_takes_the_middle(spark):
    df = spark.createDataFrame([(D("2022-01-01"), 1.0), (D("2022-01-02"), 4.0)], "d date, v double")
    got = df.select(windows.rolling_median(F.col("v"), "d", rows=2)).collect()
    assert [r[0] for r in got] == [None, 2.5]


def test_dense_days_make_the_window_count_days(spark):
    df = spark.createDataFrame([("a", D("2022-01-01"), 1.0), ("a", D("2022-01-04"), 2.0)], "s string, d date, v double")
    got = sorted(tuples(windows.on_every_day(df, "d", ["s"]), "d", "v"), key=str)
    assert got == [
        (D("2022-01-01"), 1.0), (D("2022-01-02"), None), (D("2022-01-03"), None), (D("2022-01-04"), 2.0)
    ]


def test_latest_skips_missing_values_whatever_the_order(spark):
    rows = [("a", D("2022-01-03"), None), ("a", D("2022-01-01"), 1.0), ("a", D("2022-01-02"), 2.0), ("b", D("2022-01-01"), None)]
    df = spark.createDataFrame(rows, "s string, d date, v double")
    assert tuples(windows.latest(df, "v", "d", ["s"]), "s", "d", "v") == [("a", D("2022-01-02"), 2.0)]


def test_last_day_goes_per_series(spark):
    rows = [("a", D("2022-01-01")), ("a", D("2022-01-02")), ("b", D("2022-01-05"))]
    df = spark.createDataFrame(rows, "s string, d date")
    assert tuples(windows.without_last_day(df, "d", ["s"]), "s", "d") == [("a", D("2022-01-01"))]


# --- season


@pytest.fixture(scope="module")
def season_rows(spark):
    rows = []
    for y in range(2019, 2024):
        for i, key in enumerate(["01-01", "01-02", "02-29", "03-01"]):
            if key == "02-29" and y != 2020:
                continue
            if y == 2023 and key == "03-01":
                continue
            rows.append((D(f"{y}-{key}"), key, y, float(y - 2000 + i)))
    return spark.createDataFrame(rows, "date date, k string, y int, v double")


def test_one_aggregate_equals_the_outer_join(season_rows):
    span = SeasonSpan(curr_year=2023)
    history, current = season.calendar_span("date", span)
    once = season.seasonal_table(season_rows, "k", "v", F.col("y"), span.years, history, current)
    joined = season.join_season(
        season.years_as_columns(season_rows, "k", "v", F.col("y"), span.years),
        season.envelope(season_rows, "k", "v", history),
        "k",
    )
    columns = ["k", "2023", "2022", fixed.MEAN, fixed.MAXIMUM, fixed.MINIMUM]
    assert season.newest_first(once, ["k"]).columns == columns
    assert sorted(tuples(once, *columns), key=str) == sorted(tuples(joined, *columns), key=str)
    assert {r[0]: r for r in tuples(once, *columns)}["02-29"] == ("02-29", None, None, 22.0, 22.0, 22.0)


def test_strict_pivot_refuses_a_repeated_cell(spark):
    rows = [("01-01", 2022, 1.0), ("01-01", 2022, None)]
    df = spark.createDataFrame(rows, "k string, y int, v double")
    with pytest.raises(Exception, match="more than one value for a season key in 2022"):
        season.years_as_columns(df, "k", "v", F.col("y"), [2022]).collect()
    assert tuples(season.years_as_columns(df, "k", "v", F.col("y"), [2023]), "k") == []


def test_year_over_year_keeps_the_reference_keys(season_rows):
    got = season.year_over_year(season_rows, "k", "v", F.col("y"), 2021, [2022, 2023])
    assert season.newest_first(got, ["k"], []).columns == ["k", "2023", "2022", "2021"]
    assert sorted(tuples(got, "k", "2023", "2022", "2021")) == [
        ("01-01", 23.0, 22.0, 21.0), ("01-02", 24.0, 23.0, 22.0), ("03-01", None, 25.0, 24.0)
    ]


def test_mask_one_cell(spark):
    df = spark.createDataFrame([(38, 1.0), (39, 2.0), (None, 3.0)], "w int, x double")
    got = tuples(season.mask_cells(df, F.col("w") == 39, "x"), "w", "x")
    assert got == [(38, 1.0), (39, None), (None, 3.0)]


def test_span_is_checked():
    assert SeasonSpan(curr_year=2024).years == [2022, 2023, 2024]
    with pytest.raises(ValueError):
        SeasonSpan(curr_year=2021)
    with pytest.raises(ValueError):
        SeasonSpan(curr_year=2024, history_end="31.12.2021")


# --- balance


@pytest.fixture(scope="module")
def flow_rows(spark):
    rows = [
        ("import", datetime(2022, 1, 1, 6), 10.0), ("import", datetime(2022, 1, 1, 7), 5.0),
        ("export", datetime(2022, 1, 1, 6), 4.0), ("import", datetime(2022, 1, 2, 6), 7.0),
        ("export", datetime(2022, 1, 3, 6), 1.0), ("import", datetime(2022, 1, 4, 6), None),
        ("export", datetime(2022, 1, 4, 6), None),
    ]
    return spark.createDataFrame(rows, "direction string, t timestamp_ntz, v double")


def test_balance_keeps_import_days_and_missing_exports(flow_rows):
    got = sorted(tuples(balance.flow_balance(flow_rows, "direction", "v", "t"), "date", "import", "export", "diff"))
    assert got == [
        (D("2022-01-01"), 15.0, 4.0, 11.0), (D("2022-01-02"), 7.0, None, None), (D("2022-01-04"), 0.0, 0.0, 0.0)
    ]
    sides = [aggregate.daily_sum(flow_rows.filter(F.col("direction") == d), "v", "t") for d in ("import", "export")]
    joined = balance.join_balance(*sides, "v", "date")
    assert sorted(tuples(joined, "date", "import", "export", "diff")) == got


def test_weights_by_window_equal_weights_by_join(spark):
    days = [date(2020, 12, 30) + timedelta(i) for i in range(1200)]
    rows = [(d, float(i % 11) if i % 17 else None) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "d date, v double")
    offset = Offset()
    a = balance.add_offset(balance.with_weights(df, "v", "d", 2021), "v", "d", offset)
    joined = balance.join_weights(df, balance.seasonal_weights(df, "v", "d", 2021), "d")
    b = balance.add_offset(joined, "v", "d", offset)
    assert sorted(tuples(a, "d", "v", "weight"), key=str) == sorted(tuples(b, "d", "v", "weight"), key=str)
    plain = {d: v for d, v in rows}
    got = {d: (v, w) for d, v, w in tuples(a, "d", "v", "weight")}
    total = sum(v for d, v in rows if v is not None and d.year == 2021)
    assert got[D("2024-02-29")] == (plain[D("2024-02-29")], None)
    assert got[D("2020-12-31")][0] == plain[D("2020-12-31")]
    same_day = plain[D("2021-03-05")]
    assert got[D("2022-03-05")][0] == pytest.approx(plain[D("2022-03-05")] + 9190 * same_day / total)
    spread = sum(got[d][0] - plain[d] for d in days if d.year == 2021 and plain[d] is not None)
    assert spread == pytest.approx(9190)


def test_one_operator_at_one_import_point(spark):
    rows = [
        ("import", "Wallbach", "Fluxys TENP"), ("import", "Wallbach", "Other"), ("import", "Wallbach", None),
        ("import", "Oltingue", "Other"), ("export", "Wallbach", "Other"),
    ]
    df = spark.createDataFrame(rows, "d string, p string, o string")
    kept = df.filter(balance.single_operator(F.col("d"), F.col("p"), F.col("o")))
    assert [tuple(r) for r in kept.collect()] == [rows[0], rows[3], rows[4]]


# --- quality

FLOWS = [
    ("import", "Oltingue", "kWh/d", "exit"), ("import", "Wallbach", "kWh/d", "exit"),
    ("import", "Wallbach", None, "exit"), ("import", "Basel", "kWh/d", "exit"),
    ("export", "Oltingue", "kWh/d", "entry"), ("export", "Thayngen", "kWh/d", "exit"),
]


@pytest.fixture(scope="module")
def checked_flows(spark):
    return spark.createDataFrame(FLOWS, "direction string, point string, unit string, directionKey string")


def points(df):
    return sorted({(r.direction, r.point) for r in df.collect()})


def test_check_report_counts_missing_units(checked_flows):
    report = quality.check_report(checked_flows, ["direction", "point"], quality.flow_checks())
    got = {(r.direction, r.point): (r.rows, r.bad_unit, r.bad_directionKey, r.passes) for r in report.collect()}
    assert got[("import", "Wallbach")] == (2, 1, 0, False)
    assert got[("export", "Thayngen")] == (1, 0, 1, False)
    assert got[("import", "Basel")] == (1, 0, 0, True)


def test_fail_mode_stops_the_job_even_if_the_column_is_not_used(checked_flows):
    checks = quality.flow_checks()
    with pytest.raises(Exception, match="unexpected value in one of: unit, directionKey"):
        quality.enforce_expected(checked_flows, checks).select("point").collect()
    good = checked_flows.filter("point = 'Basel'")
    assert quality.enforce_expected(good, checks).select("point").count() == 1


def test_quarantine_drops_whole_points(checked_flows):
    kept = quality.without_bad_keys(checked_flows, ["direction", "point"], quality.flow_checks())
    assert points(kept) == [("export", "Oltingue"), ("import", "Basel"), ("import", "Oltingue")]


def test_quarantine_of_a_missing_key(spark):
    rows = [(None, "MWh/d"), (None, "kWh/d"), ("a", "kWh/d")]
    df = spark.createDataFrame(rows, "point string, unit string")
    kept = quality.without_bad_keys(df, ["point"], {"unit": F.lit("kWh/d")})
    assert [tuple(r) for r in kept.collect()] == [("a", "kWh/d")]


def test_stop_drops_the_point_and_all_later_ones(checked_flows):
    order = {"import": fixed.IMPORT_POINTS, "export": fixed.EXPORT_POINTS}
    kept = quality.enforce_expected(checked_flows, quality.flow_checks(), "stop", order=order)
    assert points(kept) == [("export", "Oltingue"), ("import", "Oltingue")]
    one = {"import": ["Basel", "Oltingue"], "export": ["Oltingue"]}
    kept = quality.enforce_expected(checked_flows, quality.flow_checks(), "stop", order=one)
    assert points(kept) == [("export", "Oltingue"), ("import", "Basel"), ("import", "Oltingue")]
    with pytest.raises(Exception, match="no reading order for export"):
        quality.enforce_expected(
            checked_flows, quality.flow_checks(), "stop", order={"import": ["Basel"]}
        ).collect()
    good = checked_flows.filter("point in ('Basel', 'Oltingue')")
    kept = quality.enforce_expected(good, quality.flow_checks(), "stop", order={"import": [], "export": []})
    assert points(kept) == points(good)
    with pytest.raises(ValueError):
        quality.enforce_expected(checked_flows, quality.flow_checks(), "stop")
    with pytest.raises(ValueError):
        quality.enforce_expected(checked_flows, quality.flow_checks(), "other")


def level_frame(spark, values):
    start = date(2022, 9, 1)
    rows = [("de", start + timedelta(i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "country string, date date, full double")


GATES = [
    # a false low reading passes the gate that includes it, not the other one
    ([84.0, 85.1, 86.1, 0.21], True, False),
    ([84.0, 85.1, 84.9, 85.2], True, True),
    # one missing last value blocks both
    ([84.0, 85.1, 84.9, None], False, False),
    # only rising: the smallest change, widened, exceeds the last one
    ([80.0, 81.0, 82.0, 83.0], False, False),
    ([80.0], False, False),
]


@pytest.mark.parametrize("values, reference, exclude_last", GATES)
def test_plausibility_gate(spark, values, reference, exclude_last):
    df = level_frame(spark, values)
    for mode, want in (("reference", reference), ("exclude_last", exclude_last)):
        table = quality.plausibility(df, "full", "date", ["country"], mode)
        assert [r.plausible for r in table.collect()] == [want]
        column = quality.with_plausibility(df, "full", "date", ["country"], mode)
        assert {r.plausible for r in column.collect()} == {want}
    with pytest.raises(ValueError):
        quality.plausibility(df, "full", "date", ["country"], "none")


@pytest.mark.parametrize(
    "as_of, fresh", [("2023-12-13", True), ("2023-12-20", False), ("2023-12-13 00:00:01", False)]
)
def test_freshness_counts_from_the_monday(spark, as_of, fresh):
    # week 48 of 2023 starts on 27 November, 16 days before 13 December
    df = spark.createDataFrame([("47", 1.0), ("48", 2.0), ("49", None)], "week_num string, `2023` double")
    row = quality.freshness(df, "week_num", "2023", as_of).first()
    assert (row.last_week, row.monday, row.fresh) == (48, D("2023-11-27"), fresh)


def test_freshness_without_any_value(spark):
    df = spark.createDataFrame([("47", None)], "week_num string, `2023` double")
    assert quality.freshness(df, "week_num", "2023", "2023-12-13").first().fresh is False


def test_missing_and_repeated_pages(spark):
    rows = [("de", 1, 3), ("de", 2, 3), ("de", 2, 3), ("fr", 1, 2), ("fr", 2, 2), ("it", 1, 2), ("it", 3, 2)]
    df = spark.createDataFrame(rows, "c string, page int, last int")
    got = sorted(tuples(quality.page_completeness(df, "page", "last", ["c"]), "c", "pages", "complete"))
    assert got == [("de", 2, False), ("fr", 2, True), ("it", 1, False)]


def test_overlap_report(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "p string, t int")
    assert tuples(quality.overlapping_rows(df, ["p", "t"]), "p", "t", "rows") == [("a", 1, 2)]


# --- filters


def test_bounds_include_both_days(spark):
    times = [datetime(2020, 12, 31, 23, 59), datetime(2021, 1, 1), datetime(2021, 12, 31, 23, 45), datetime(2022, 1, 1)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    assert tuples(filters.within(df, "t", "2021-01-01", "2021-12-31"), "t") == [(times[1],), (times[2],)]
    assert filters.filled(spark.createDataFrame([(1,), (None,)], "x int"), "x").count() == 1
    both = filters.every(F.col("t") > F.lit(times[0]).cast("timestamp_ntz"), F.year("t") == 2021)
    assert df.filter(both).count() == 2
