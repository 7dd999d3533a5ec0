"""Column functions against Python's own calendar and rounding."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.functions import dates, numbers, texts


@pytest.fixture(scope="module")
def days(spark):
    start = date(1994, 12, 1)
    return spark.createDataFrame([(start + timedelta(i),) for i in range(15_000)], "d date").repartition(4)


def test_calendar_keys_for_forty_years(days):
    d = F.col("d")
    rows = days.select(
        "d",
        dates.month_day(d).alias("md"),
        dates.week_end(d).alias("sunday"),
        dates.iso_year_week(d).alias("yw"),
        dates.iso_week_key(d).alias("wk"),
        dates.part(dates.iso_year_week(d), 0).alias("iso_year"),
        dates.leap_day(d).alias("leap"),
        dates.german_date(d).alias("german"),
        dates.on_display_year(dates.month_day(d), 2023).alias("shown"),
    ).collect()
    assert len(rows) == 15_000
    for r in rows:
        assert r.md == r.d.strftime("%m-%d")
        assert r.sunday == r.d + timedelta(6 - r.d.weekday())
        assert r.yw == r.d.strftime("%G-%V")
        assert r.wk == r.d.strftime("%V")
        assert r.iso_year == r.d.strftime("%G")
        assert r.leap == (r.md == "02-29")
        assert r.german == f"{r.d.day}. {fixed.GERMAN_MONTHS[r.d.month - 1]} {r.d.year}"
        assert r.shown == "2023-" + r.md


def test_mondays_of_weeks(spark):
    weeks = [(y, w) for y in range(2015, 2040) for w in range(1, 53)]
    rows = (
        spark.createDataFrame(weeks, "y int, w int")
        .select(
            "y", "w",
            dates.monday_of_week(F.col("y"), F.col("w")).alias("rule"),
            dates.monday_of_iso_week(F.col("y"), F.col("w")).alias("iso"),
        )
        .collect()
    )
    for r in rows:
        assert r.rule == datetime.strptime(f"{r.y}-W{r.w}-1", "%Y-W%W-%w").date()
        assert r.iso == date.fromisocalendar(r.y, r.w, 1)
    assert any(r.rule != r.iso for r in rows)


@pytest.mark.parametrize(
    "text, want",
    [
        ("2022-01-01 06:00:00", datetime(2022, 1, 1, 6)),
        ("2022-01-01T06:00:00+01:00", datetime(2022, 1, 1, 6)),
        ("2022-01-01 23:30:00+0200", datetime(2022, 1, 1, 23, 30)),
        ("2022-06-01T23:00Z", datetime(2022, 6, 1, 23)),
        ("2022-01-01", datetime(2022, 1, 1)),
        (None, None),
    ],
)
def test_wall_clock_keeps_the_shown_time(spark, text, want):
    formats = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd")
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(dates.wall_clock(F.col("t"), *formats).alias("t")).first().t == want


def test_wall_clock_refuses_or_blanks_other_texts(spark):
    df = spark.createDataFrame([("soon",)], "t string")
    with pytest.raises(Exception, match="not a timestamp: soon"):
        df.select(dates.wall_clock(F.col("t"), "yyyy-MM-dd")).collect()
    assert df.select(dates.wall_clock(F.col("t"), "yyyy-MM-dd", strict=False)).first()[0] is None


def test_in_zone_moves_the_clock(spark):
    df = spark.createDataFrame([("2022-06-30T22:00Z",)], "t string")
    fmt = "yyyy-MM-dd'T'HH:mmX"
    assert df.select(dates.in_zone(F.col("t"), fmt, "UTC")).first()[0] == datetime(2022, 6, 30, 22)
    assert df.select(dates.in_zone(F.col("t"), fmt, "Europe/Paris")).first()[0] == datetime(2022, 7, 1, 0)


def test_positions_count_from_one(spark):
    df = spark.createDataFrame([(datetime(2022, 12, 31, 22), p) for p in (1, 2, 4)], "s timestamp_ntz, p int")
    hourly = [r[0] for r in df.select(dates.at_position(F.col("s"), F.col("p"))).collect()]
    assert hourly == [datetime(2022, 12, 31, 22), datetime(2022, 12, 31, 23), datetime(2023, 1, 1, 1)]
    quarters = [r[0] for r in df.select(dates.at_position(F.col("s"), F.col("p"), 15)).collect()]
    assert quarters[2] == datetime(2022, 12, 31, 22, 45)


def test_numbers(spark):
    nan = float("nan")
    df = spark.createDataFrame([("1.5", nan), ("NaN", 2.0), (None, None)], "t string, x double")
    got = df.select(numbers.number(F.col("t")).alias("t"), numbers.number(F.col("x")).alias("x")).collect()
    assert [tuple(r) for r in got] == [(1.5, None), (None, 2.0), (None, None)]
    assert df.agg(numbers.total(F.col("x"))).first()[0] == 2.0
    assert df.filter("t is null").agg(numbers.total(F.col("x"))).first()[0] == 0.0
    bad = spark.createDataFrame([("x1",)], "t string")
    assert bad.select(numbers.number(F.col("t"), lenient=True)).first()[0] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.select(numbers.number(F.col("t"))).collect()


def test_rounding_is_half_to_even(spark):
    values = [2.25, 2.35, 86.15, 0.25, 0.35, -2.25, 100.0, 45.96]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(numbers.one_digit(F.col("x"))).collect()]
    assert got == [float(np.round(v, 1)) for v in values]
    commas = [r[0] for r in df.select(texts.decimal_comma(F.col("x"))).collect()]
    assert commas == [str(np.round(v, 1)).replace(".", ",") for v in values]


def test_plain_text_is_short_and_without_exponent(spark):
    values = [90.52, 12345678.9, 1.0e7, -98765432.125, 5.0e15, 0.1, 0.00025, 0.0, 8318.452428571429, 123456789.12345679]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(numbers.plain_text(F.col("x"))).collect()]
    assert got == [repr(v) for v in values]
    assert [float(g) for g in got] == values
    assert df.select(numbers.plain_text(F.lit(None).cast("double"))).first()[0] is None


def test_percent_change_of_nothing_is_null(spark):
    df = spark.createDataFrame([(110.0, 100.0), (1.0, 0.0)], "a double, b double")
    got = [r[0] for r in df.select(numbers.percent_change(F.col("a"), F.col("b"))).collect()]
    assert got == [pytest.approx(10.0), None]


def test_sheet_has_64_different_measures():
    names = fixed.grid_measures()
    assert len(names) == len(set(names)) == 64
    assert names[0] == "endverbrauchte_energie"
    assert names[-1] == "verbrauch_regelzone_ch_ausland"
