"""Random small series against direct recomputation."""

from datetime import date, timedelta

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.operators import aggregate, quality, season, windows
from wattfolio.settings import SeasonSpan

FEW = settings(
    max_examples=12, deadline=None, derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
LEVEL = st.one_of(st.none(), st.integers(-50, 50).map(float))
# (series, day number, value), one row per series and day
DAILY = st.dictionaries(
    st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 900)), LEVEL, min_size=1, max_size=60
)
START = date(2020, 12, 1)


def frame(spark, cells):
    rows = [(s, START + timedelta(n), v) for (s, n), v in cells.items()]
    return spark.createDataFrame(rows, "s string, d date, v double").repartition(3)


def series_of(cells, name):
    days = sorted((START + timedelta(n), v) for (s, n), v in cells.items() if s == name)
    index = pd.DatetimeIndex([d for d, _ in days])
    return pd.Series([float("nan") if v is None else v for _, v in days], index=index, dtype=float)


def none(x):
    return None if pd.isna(x) else x


@FEW
@given(DAILY)
def test_weekly_sums(spark, cells):
    got = aggregate.weekly_sum(frame(spark, cells), "v", "d", ["s"]).collect()
    for name in {s for s, _ in cells}:
        want = series_of(cells, name).resample("W").sum()
        assert sorted((r.week_end, r.v) for r in got if r.s == name) == [(d.date(), v) for d, v in want.items()]


@FEW
@given(DAILY, st.integers(1, 8))
def test_rolling_median(spark, cells, rows):
    df = frame(spark, cells)
    got = df.select("s", "d", windows.rolling_median(F.col("v"), "d", ["s"], rows).alias("m")).collect()
    for name in {s for s, _ in cells}:
        want = series_of(cells, name).rolling(rows).median()
        assert sorted([(r.d, r.m) for r in got if r.s == name], key=lambda x: x[0]) == [
            (d.date(), none(v)) for d, v in want.items()
        ]


@FEW
@given(DAILY)
def test_gate_column_equals_gate_table(spark, cells):
    df = frame(spark, cells)
    for mode in ("reference", "exclude_last"):
        table = {r.s: r.plausible for r in quality.plausibility(df, "v", "d", ["s"], mode).collect()}
        column = {(r.s, r.plausible) for r in quality.with_plausibility(df, "v", "d", ["s"], mode).collect()}
        assert column == set(table.items())
    for name, plausible in ((n, p) for n, p in table.items()):
        change = series_of(cells, name).diff()
        before = change.iloc[:-1]
        want = before.max() * 1.25 > change.iloc[-1] > before.min() * 1.5
        assert plausible == bool(want)


@FEW
@given(DAILY)
def test_season_table(spark, cells):
    span = SeasonSpan(curr_year=2023)
    df = frame(spark, cells).withColumn("k", F.date_format("d", "MM-dd"))
    history, current = season.calendar_span("d", span)
    once = season.seasonal_table(df, "k", "v", F.year("d"), span.years, history, current, ["s"])
    joined = season.join_season(
        season.years_as_columns(df, "k", "v", F.year("d"), span.years, ["s"]),
        season.envelope(df, "k", "v", history, ["s"]), "k", ["s"],
    )
    columns = ["s", "k", "2023", "2022", fixed.MEAN, fixed.MAXIMUM, fixed.MINIMUM]
    a, b = (sorted(map(tuple, t.select(*columns).collect()), key=str) for t in (once, joined))
    assert a == b
    assert len({r[:2] for r in a}) == len(a) == len({(s, (START + timedelta(n)).strftime("%m-%d")) for s, n in cells})
    for r in a:
        if r[4] is not None:
            assert r[6] <= r[4] <= r[5]


@FEW
@given(DAILY)
def test_shares_sum_to_one(spark, cells):
    got = aggregate.share_of_total(frame(spark, cells), "v", ["s"]).collect()
    for name in {s for s, _ in cells}:
        shares = [r.share for r in got if r.s == name and r.share is not None]
        if shares:
            assert sum(shares) == pytest.approx(1.0)


@FEW
@given(DAILY)
def test_dense_days(spark, cells):
    got = windows.on_every_day(frame(spark, cells), "d", ["s"]).collect()
    for name in {s for s, _ in cells}:
        want = series_of(cells, name).asfreq("D")
        assert sorted([(r.d, r.v) for r in got if r.s == name], key=lambda x: x[0]) == [
            (d.date(), none(v)) for d, v in want.items()
        ]
