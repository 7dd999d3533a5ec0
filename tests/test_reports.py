"""Reports on small rows: invariants, gates, publishing and a plain recomputation."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from pathlib import Path
from statistics import median

import pytest
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.operators import aggregate
from wattfolio.plans import annotations, gas_balance, generation, month_compare, national_use, storage
from wattfolio.settings import Offset, SeasonSpan
from wattfolio.sinks import daily_store, files

from reading import table_of

SPAN = SeasonSpan(curr_year=2023)


def days(first, last):
    d = first
    while d <= last:
        yield d
        d += timedelta(1)


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def storage_rows():
    rng = random.Random(5)
    rows = []
    for country in ("de", "fr"):
        level = 50.0
        for d in days(date(2019, 1, 1), date(2023, 3, 10)):
            level = min(100.0, max(0.0, level + rng.uniform(-1, 1)))
            rows.append((country, d, round(level, 2)))
    return rows


def test_storage_report(spark, storage_rows):
    df = spark.createDataFrame(storage_rows, "country string, date date, full double")
    report = storage.storage_report(df, SPAN)
    assert report.columns == [
        "country", "date_datawrapper", "2023", "2022", "Mittelwert", "Maximum", "Minimum", "plausible"
    ]
    rows = report.collect()
    assert len(rows) == 2 * 365
    assert all(r.plausible for r in rows)
    level = {(c, d): v for c, d, v in storage_rows}
    for r in rows:
        m, d = map(int, r.date_datawrapper.split("-")[1:])
        past = [level[(r.country, date(y, m, d))] for y in (2019, 2020, 2021)]
        assert r.Maximum == max(past) and r.Minimum == min(past)
        assert r.Mittelwert == pytest.approx(sum(past) / 3)
        assert r.Minimum <= r.Mittelwert <= r.Maximum
        assert r["2022"] == level[(r.country, date(2022, m, d))]
        assert r["2023"] == level.get((r.country, date(2023, m, d)))
    assert "2023-02-29" not in {r.date_datawrapper for r in rows}


def test_a_repeated_day_is_an_error(spark, storage_rows):
    twice = [r for r in storage_rows if r[0] == "de"] + [("de", date(2022, 5, 5), 1.0)]
    df = spark.createDataFrame(twice, "country string, date date, full double")
    with pytest.raises(Exception, match="more than one value"):
        storage.storage_report(df, SPAN).collect()


def test_publish_only_plausible_series(spark, storage_rows, tmp_path):
    backups, current = str(tmp_path / "backups"), str(tmp_path / "data")
    df = spark.createDataFrame(storage_rows, "country string, date date, full double")
    storage.publish(storage.storage_report(df, SPAN, mode="exclude_last"), backups, current, "2023-03-10")
    # next day: a false low reading in one series, an unchanged level in the other
    rows = storage_rows + [("de", date(2023, 3, 11), 0.21), ("fr", date(2023, 3, 11), storage_rows[-1][2])]
    df = spark.createDataFrame(rows, "country string, date date, full double")
    report = storage.storage_report(df, SPAN, mode="exclude_last")
    storage.publish(report, backups, current, "2023-03-11")
    assert sorted(p.name for p in Path(backups).glob("snapshot_date=2023-03-10/versions/*/c*")) == ["country=de", "country=fr"]
    assert sorted(p.name for p in Path(backups).glob("snapshot_date=2023-03-11/versions/*/c*")) == ["country=fr"]
    rows = table_of(f"{backups}/snapshot_date=2023-03-10", "de")
    assert list(rows[0]) == ["date_datawrapper", "2023", "2022", "Mittelwert", "Maximum", "Minimum"]
    keys = [r["date_datawrapper"] for r in rows]
    assert keys == sorted(set(keys)) and len(keys) == 365
    assert rows[-1]["2023"] == ""
    assert table_of(current, "de") == rows
    newest = {r["date_datawrapper"]: r for r in table_of(current, "fr")}
    assert newest["2023-03-11"]["2023"] == str(storage_rows[-1][2])


def test_snapshot_of_a_day_is_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "snap")
    for day, value in (("2023-01-01", 1.0), ("2023-01-02", 2.0), ("2023-01-02", 3.0)):
        df = spark.createDataFrame([("02", value), ("01", None)], "week_num string, x double")
        files.write_snapshot(df, path, day, ["week_num"])
    assert table_of(f"{path}/snapshot_date=2023-01-01") == [
        {"week_num": "01", "x": ""}, {"week_num": "02", "x": "1.0"}
    ]
    assert table_of(f"{path}/snapshot_date=2023-01-02")[1] == {"week_num": "02", "x": "3.0"}
    stored = files.read_snapshot(spark, path, "2023-01-02", df)
    assert sorted(map(tuple, stored.collect())) == [("01", None), ("02", 3.0)]


def test_stored_days_replace_their_year(spark, tmp_path):
    path = str(tmp_path / "days")
    schema = "country string, date date, full double"
    first = [("de", date(2021, 5, 1), 1.0), ("de", date(2022, 5, 1), 2.0), ("fr", date(2022, 5, 1), 3.0)]
    daily_store.store_days(spark.createDataFrame(first, schema), path)
    daily_store.store_days(spark.createDataFrame([("de", date(2022, 5, 1), 9.0)], schema), path)
    got = daily_store.read_days(spark, path)
    assert got.columns == ["country", "date", "full"]
    assert sorted(map(tuple, got.collect())) == [first[0], ("de", date(2022, 5, 1), 9.0)]
    late = daily_store.read_days(spark, path, first_year=2022, last_year=2022)
    assert "PartitionFilters: [isnotnull(stored_year" in late._jdf.queryExecution().executedPlan().toString()
    assert late.count() == 1


def test_storage_annotations(spark, storage_rows):
    rows = storage_rows + [("de", date(2023, 3, 11), None)]
    df = spark.createDataFrame(rows, "country string, date date, full double")
    got = by_key(annotations.latest_annotations(df, "full", "date", "country"), "country")
    last = {c: v for c, _, v in storage_rows}
    shown = f"{last['de']:.1f}".replace(".", ",")
    assert got["de"]["date"] == date(2023, 3, 10)
    assert got["de"]["title"] == f"Füllstand der deutschen Gasspeicher: <u>{shown} Prozent</u> 🇩🇪"
    assert "Datenstand: 10. März 2023." in got["fr"]["note"]
    report = storage.storage_report(df, SPAN)
    again = annotations.season_annotations(report, "date_datawrapper", 2023, "country")
    assert by_key(again, "country") == got


# --- gas


@pytest.fixture(scope="module")
def flow_rows():
    rng = random.Random(11)
    rows = []
    for d in days(date(2020, 12, 1), date(2023, 4, 2)):
        for _ in range(2):
            rows.append(("import", datetime(d.year, d.month, d.day, 6), float(rng.randrange(10**6, 10**8))))
        if d != date(2022, 7, 1):
            rows.append(("export", datetime(d.year, d.month, d.day, 6), float(rng.randrange(0, 10**6))))
    return rows


def plain_gas_table(rows):
    """The same table by dictionaries."""
    sums = {"import": defaultdict(float), "export": defaultdict(float)}
    for direction, t, v in rows:
        sums[direction][t.date()] += v
    order = sorted(sums["import"])[:-1]
    use = {d: (sums["import"][d] - sums["export"][d]) / 10**6 if d in sums["export"] else None for d in order}
    year = {d: v for d, v in use.items() if d.year == 2021}
    whole = sum(year.values())
    weight = {(d.month, d.day): v / whole for d, v in year.items()}
    for d in order:
        if use[d] is not None and d >= date(2021, 1, 1):
            use[d] += 9190 * weight.get((d.month, d.day), 0)
    smooth = {}
    for i, d in enumerate(order):
        last = [use[x] for x in order[max(0, i - 6): i + 1]]
        smooth[d] = median(last) if len(last) == 7 and None not in last else None
    return {
        f"2023-{d:%m-%d}": [smooth.get(date(y, d.month, d.day)) for y in (2023, 2022, 2021)]
        for d in year
        if (d.month, d.day) != (2, 29)
    }


def test_gas_balance_report_against_plain_python(spark, flow_rows):
    df = spark.createDataFrame(flow_rows, "direction string, periodFrom timestamp_ntz, value double").repartition(5)
    report = gas_balance.gas_balance_report(df, SPAN)
    assert report.columns == ["date_show", "2023", "2022", "2021"]
    got = {r[0]: list(r[1:]) for r in report.collect()}
    want = plain_gas_table(flow_rows)
    assert set(got) == set(want) and len(got) == 365
    for key, values in want.items():
        assert got[key] == [v if v is None else pytest.approx(v) for v in values]
    # a day without exports blanks the seven medians that see it, from the day itself on
    assert [got[f"2023-07-0{i}"][1] is None for i in range(1, 9)] == [True] * 7 + [False]
    # the last day is left out
    assert got["2023-04-01"][0] is not None and got["2023-04-02"][0] is None


def test_gas_report_of_several_series(spark, flow_rows):
    schema = "area string, direction string, periodFrom timestamp_ntz, value double"
    rows = [("a", *r) for r in flow_rows] + [("b", d, t, v * 2) for d, t, v in flow_rows]
    report = gas_balance.gas_balance_report(spark.createDataFrame(rows, schema), SPAN, series=["area"])
    single = plain_gas_table(flow_rows)
    rows_a = {r.date_show: r["2022"] for r in report.filter("area = 'a'").collect()}
    assert rows_a == {k: v[1] if v[1] is None else pytest.approx(v[1]) for k, v in single.items()}
    assert report.filter("area = 'b'").count() == 365


def test_other_offset(spark, flow_rows):
    df = spark.createDataFrame(flow_rows, "direction string, periodFrom timestamp_ntz, value double")
    none = Offset(total=0, reference_year=2021, start="2021-01-01")
    with_offset = gas_balance.daily_use(df, "direction", "value", "periodFrom")
    without = gas_balance.daily_use(df, "direction", "value", "periodFrom", none)
    year = F.year("date") == 2021
    total = [x.filter(year).agg(F.sum("diff")).first()[0] for x in (with_offset, without)]
    assert total[0] - total[1] == pytest.approx(9190)


# --- weekly tables


@pytest.fixture(scope="module")
def hourly_rows():
    rng = random.Random(3)
    rows = []
    for d in days(date(2019, 12, 28), date(2023, 12, 19)):
        if date(2021, 3, 1) <= d <= date(2021, 3, 7):
            continue
        for hour in (0, 12):
            rows.append((datetime(d.year, d.month, d.day, hour), str(rng.randrange(20_000, 60_000))))
    return rows


def test_weekly_generation_report(spark, hourly_rows):
    repeated = hourly_rows + hourly_rows[:500]
    df = spark.createDataFrame(repeated, "date timestamp_ntz, quantity string").repartition(4)
    report = generation.weekly_generation_report(df, SPAN, "2023-12-20")
    assert report.columns == ["week_num", "2023", "2022", "Mittelwert", "Maximum", "Minimum"]
    sums = defaultdict(float)
    for t, q in hourly_rows:
        sums[t.date() + timedelta(6 - t.weekday())] += int(q) / 1000
    sums[date(2021, 3, 7)] = 0.0
    got = by_key(report, "week_num")
    assert sorted(got) == [f"{w:02d}" for w in range(1, 53)]
    for week, r in got.items():
        past = [v for d, v in sums.items() if d <= date(2021, 12, 31) and d.strftime("%V") == week]
        assert r["Mittelwert"] == pytest.approx(sum(past) / len(past))
        assert (r["Maximum"], r["Minimum"]) == (pytest.approx(max(past)), pytest.approx(min(past)))
        for y in ("2022", "2023"):
            values = [v for d, v in sums.items() if d.strftime("%G-%V") == f"{y}-{week}" and d <= date(2023, 12, 20)]
            assert r[y] == (pytest.approx(values[0]) if values else None)
    assert got["09"]["Minimum"] == 0.0
    # the week that ends after the run day and week 53 of 2020 are left out
    assert got["51"]["2023"] is None and got["50"]["2023"] is not None
    # Sunday 2 January 2022 belongs to the last week of 2021 and to no year column
    assert got["52"]["2022"] == pytest.approx(sums[date(2023, 1, 1)])


def test_generation_annotations(spark, hourly_rows):
    df = spark.createDataFrame(hourly_rows, "date timestamp_ntz, quantity string")
    report = generation.weekly_generation_report(df, SPAN, "2023-12-20")
    fresh = annotations.generation_annotations(report, "week_num", 2023, "2023-12-20").first()
    assert (fresh.last_week, fresh.monday, fresh.fresh) == (50, date(2023, 12, 11), True)
    assert fresh.note.endswith("zuletzt am 20. Dezember 2023.")
    stale = annotations.generation_annotations(report, "week_num", 2023, "2023-12-28").first()
    assert stale.fresh is False and stale.note is None


def test_weekly_envelope_of_one_year(spark):
    rows = [
        (datetime(d.year, d.month, d.day, h), 10**6 * (d.year - 2018))
        for d in days(date(2020, 12, 28), date(2022, 12, 31)) for h in (0, 1)
    ]
    df = spark.createDataFrame(rows, "date timestamp_ntz, energy long")
    span = SeasonSpan(curr_year=2022)
    got = by_key(generation.weekly_envelope(df, span, "energy", "date", open_week=39), "week_num")
    assert list(got[1]) == ["week_num", "2022", "Mittelwert", "Maximum", "Minimum"]
    assert sorted(got) == list(range(1, 54))
    assert got[39]["2022"] is None and got[39]["Mittelwert"] == 42.0
    assert got[38]["2022"] == 56.0
    # the last days of 2022 end on 1 January 2023, still week 52 of 2022
    assert got[52]["2022"] == 48.0
    assert got[53]["2022"] is None and got[53]["Maximum"] == 4 * 4 + 6 * 3


def test_weekly_total_equals_daily_total(spark, hourly_rows):
    df = spark.createDataFrame([(t, float(q)) for t, q in hourly_rows], "t timestamp_ntz, v double")
    whole = df.agg(F.sum("v")).first()[0]
    assert aggregate.daily_sum(df, "v", "t").agg(F.sum("v")).first()[0] == whole
    assert aggregate.weekly_sum(df, "v", "t").agg(F.sum("v")).first()[0] == whole


# --- national use, month


def test_consumption_tables(spark):
    national = [(d, 1.0, 2.0, None, 3.0, 4.0, 5.0) for d in ("2022-12-31", "2023-01-03", "2023-01-01")]
    national.append(("2023-01-04", None, None, 9.0, 3.0, 4.0, 5.0))
    final = [("2023-01-01", 6.0, 7.0, 8.0, 9.0, 10.0)]
    a = spark.createDataFrame(national, ", ".join(f"{n} {'string' if n == 'date' else 'double'}" for n in fixed.NATIONAL_USE_NAMES))
    b = spark.createDataFrame(final, ", ".join(f"{n} {'string' if n == 'date' else 'double'}" for n in fixed.FINAL_USE_NAMES))
    table = national_use.consumption_tables(a, b)
    assert table.columns[:7] == list(fixed.NATIONAL_USE_NAMES.values())
    assert table.filter("usage = 'landesverbrauch'").count() == 3
    row = table.filter("usage = 'endverbrauch'").first()
    assert (row["Endverbrauch gemeldet"], row["Endverbrauch geschätzt"], row["Mittelwert"]) == (6.0, 7.0, 8.0)
    notes = by_key(annotations.use_annotations(national_use.use_table(a, fixed.NATIONAL_USE_NAMES)), "usage")
    assert notes["endverbrauch"]["last_updated"] == date(2023, 1, 4)
    assert notes["landesverbrauch"]["note"].endswith("zuletzt am 4. Januar 2023.\n")


def test_month_against_its_mean(spark):
    rows = [
        (datetime(2020, 9, 1), 10.0e6), (datetime(2020, 9, 30, 23, 45), 20.0e6), (datetime(2021, 9, 5), 50.0e6),
        (datetime(2021, 10, 1), 999.0e6), (datetime(2022, 9, 1), 33.0e6), (datetime(2022, 9, 30, 23, 45), 17.04e6),
        (datetime(2022, 10, 1), 999.0e6), (datetime(2022, 8, 31, 23, 45), 999.0e6),
    ]
    df = spark.createDataFrame(rows, "date timestamp_ntz, energy double")
    table = month_compare.month_vs_average(df, "energy", "date", 9, "2022-09-01", "2022-09-30 23:45:00", "2022-01-01")
    assert tuple(table.first()) == (50.0, 40.0, 10.0, 25.1)
    lines = month_compare.summary_lines(table, 9, "2022-09-01", "2022-09-30 23:45:00").first()
    assert lines.average_line == "Durchschnitts-Verbrauch im Monat 9: 40.0 Gigawattstunden"
    assert lines.difference_line == "Differenz zum Durchschnittsverbrauch: 10.0 GWh oder 25.1 Prozent"
