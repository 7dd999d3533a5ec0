"""Versions, the table of files, merged days and states of a history."""

import json
import os
import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from wattfolio import jobs
from wattfolio.operators import aggregate, quality, season_state, windows
from wattfolio.plans import storage
from wattfolio.settings import SeasonSpan
from wattfolio.sinks import daily_store, files, season_store, versions
from wattfolio.sources import gas_flows, manifest, storage_pages, weekly_routes

from reading import folder_of, table_of

SERIES = "country string, n int, x double"


def put(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- published versions


def test_readers_see_the_old_result_until_the_last_step(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    table = lambda x: spark.createDataFrame([("a", 1, x), ("b", 2, x)], SERIES)
    assert files.read_current(spark, path, table(0.0)).count() == 0
    files.write_current(table(1.0), path, ["n"])
    real = versions.point

    def killed(*arguments):
        raise RuntimeError("killed before the pointer was written")

    monkeypatch.setattr(versions, "point", killed)
    with pytest.raises(RuntimeError, match="killed"):
        files.write_current(table(2.0), path, ["n"])
    assert rows_of(files.read_current(spark, path, table(0.0))) == [("a", 1, 1.0), ("b", 2, 1.0)]
    assert [r["x"] for r in table_of(path)] == ["1.0", "1.0"]
    # a run that fails while it writes
    bad = table(3.0).withColumn("x", F.when(F.col("n") == 2, F.raise_error(F.lit("bad")).cast("double")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="bad"):
        files.write_current(bad, path, ["n"], ready=True)
    assert [r["x"] for r in table_of(path)] == ["1.0", "1.0"]
    monkeypatch.setattr(versions, "point", real)
    files.write_current(table(4.0), path, ["n"])
    assert [r["x"] for r in table_of(path)] == ["4.0", "4.0"]
    left = len(list((tmp_path / "out" / "versions").iterdir()))
    removed = versions.tidy(spark, path, keep=1)
    assert len(removed) == left - 1
    assert rows_of(files.read_current(spark, path, table(0.0))) == [("a", 1, 4.0), ("b", 2, 4.0)]
    assert versions.tidy(spark, path) == [] and versions.tidy(spark, str(tmp_path / "none")) == []


def test_parts_change_together_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "out")
    first = [("a", 1, 1.0), ("01", 2, 1.0), (None, 3, 1.0), ("x/y=z", 4, None)]
    files.write_current(spark.createDataFrame(first, SERIES), path, ["n"], ["country"])
    files.write_current(spark.createDataFrame([("a", 5, 2.0), ("new", 6, 2.0)], SERIES), path, ["n"], ["country"])
    schema = spark.createDataFrame([], SERIES)
    want = [("a", 5, 2.0), ("new", 6, 2.0), *first[1:]]
    assert rows_of(files.read_current(spark, path, schema, ["country"])) == sorted(want, key=repr)
    assert folder_of(path, "a") != folder_of(path, "01")
    # an empty table with parts changes nothing, one without parts is a result
    files.write_current(schema, path, ["n"], ["country"])
    assert files.read_current(spark, path, schema, ["country"]).count() == 5
    files.write_current(spark.createDataFrame(first, SERIES), f"{path}2", ["n"])
    files.write_current(schema, f"{path}2", ["n"])
    assert files.read_current(spark, f"{path}2", schema).count() == 0
    # the first version is still current for three parts
    assert versions.tidy(spark, path, keep=0) != [] and files.read_current(spark, path, schema, ["country"]).count() == 5


def test_two_writers_at_once(spark, tmp_path):
    """Both count to the same number; every reader sees one and the same of the two."""
    path = str(tmp_path / "out")
    table = spark.createDataFrame([("a", 1, 1.0)], SERIES)
    for name in ("00000001-aaa", "00000001-bbb"):
        table.withColumn("x", F.lit(float(name.endswith("bbb")))).write.options(**files.WRITTEN).csv(f"{path}/versions/version={name}")
        versions.point(spark.range(1).select(versions.part_of(()).alias("part")), path, 1, name)
    assert rows_of(files.read_current(spark, path, table)) == [("a", 1, 1.0)]


# --- the table of files

HEADER = "unit,directionKey,operatorLabel,pointLabel,periodFrom,periodTo,value"


def flow(day, value):
    return f"kWh/d,exit,x,Basel,{day},{day},{value}"


def opened(spark, df):
    """Rows read by the scans of a query: lines of the files it opened."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if node.nodeName().startswith("Scan text"):
            found += node.metrics().apply("numFiles").value()
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return found


def test_files_are_read_once(spark, tmp_path, monkeypatch):
    path, store = tmp_path / "in", str(tmp_path / "store")
    for i in range(20):
        put(path / "direction=import" / f"{i}.csv", HEADER, flow("2021-01-01", i))
    put(path / "direction=import" / "empty.csv")
    (path / "direction=import" / "nothing.csv").write_text("")
    assert manifest.unread(spark, str(path), store).count() == 21
    assert sorted(r.value for r in gas_flows.collect_flows(spark, str(path), store).collect()) == list(range(20))
    assert manifest.unread(spark, str(path), store).isEmpty()
    # a new file of another column order, and a changed one
    put(path / "direction=import" / "new.csv", "value,new," + HEADER.rsplit(",", 1)[0], "77,?," + flow("2022-01-01", 0).rsplit(",", 1)[0])
    put(path / "direction=import" / "3.csv", HEADER, flow("2021-01-01", 33), flow("2021-01-02", 34))
    later = os.stat(path / "direction=import" / "0.csv").st_mtime + 10
    for name in ("new", "3"):
        os.utime(path / "direction=import" / f"{name}.csv", (later, later))
    seen = []
    real = gas_flows.headers.lines
    monkeypatch.setattr(gas_flows.headers, "lines", lambda *a: seen.append(real(*a)) or seen[-1])
    got = sorted(r.value for r in gas_flows.collect_flows(spark, str(path), store).collect())
    assert got == sorted([*range(3), *range(4, 20), 33, 34, 77])
    assert opened(spark, seen[0]) == 2
    assert manifest.entries(spark, store).count() == 23


def test_a_run_that_fails_is_not_found(spark, tmp_path, monkeypatch):
    path, store = tmp_path / "in", str(tmp_path / "store")
    put(path / "direction=import" / "a.csv", HEADER, flow("2021-01-01", 1))
    monkeypatch.setattr(manifest.versions, "point", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        gas_flows.collect_flows(spark, str(path), store)
    assert manifest.collected(spark, store) is None and manifest.unread(spark, str(path), store).count() == 1
    monkeypatch.undo()
    assert gas_flows.collect_flows(spark, str(path), store).count() == 1
    assert len(list((tmp_path / "store" / "rows").iterdir())) == 2
    put(tmp_path / "none" / "a.csv")
    with pytest.raises(ValueError, match="no file with a header"):
        gas_flows.collect_flows(spark, str(tmp_path / "none"), f"{store}2")


def test_ten_thousand_small_files(spark, tmp_path):
    folder = tmp_path / "in" / "direction=import"
    folder.mkdir(parents=True)
    names = HEADER.split(",")
    for i in range(10_000):
        cells = dict(zip(names, flow("2021-01-01", i).split(","), strict=True))
        order = names if i % 3 else names[::-1]
        (folder / f"{i}.csv").write_text(",".join(order) + "\n" + ",".join(cells[n] for n in order) + "\n")
    flows = gas_flows.read_flow_files(spark, str(tmp_path / "in"), by_name=True)
    assert "9999.csv" not in flows._jdf.queryExecution().toString()
    assert flows.agg(F.sum("value"), F.count("unit")).first()[:] == (sum(range(10_000)), 10_000)


def test_dated_routes_are_read_once(spark, tmp_path):
    put(tmp_path / "in" / "2023-01-04" / "r.csv", "week,A_2022,B_min", '1,"1,000",', ",,")
    glob, store = f"{tmp_path}/in/*", str(tmp_path / "store")
    assert rows_of(weekly_routes.collect_snapshots(spark, glob, store)) == [
        (date(2023, 1, 4), 1, "A", "2022", 1000.0), (date(2023, 1, 4), 1, "B", "min", None)
    ]
    put(tmp_path / "in" / "2023-01-11" / "r.csv", "week,A_2022,A_23", "1,2,3")
    got = rows_of(weekly_routes.collect_snapshots(spark, glob, store))
    assert len(got) == 4 and (date(2023, 1, 11), 1, "A", "2023", 3.0) in got
    assert got == rows_of(weekly_routes.read_snapshots(spark, glob))
    jobs.run_routes(spark, glob, str(tmp_path / "out"), dated=True, store=store)
    assert rows_of(files.read_table(spark, f"{tmp_path}/out/data/routes")) == got


def test_generated_code_of_routes_compiles(spark, data, capfd):
    from wattfolio.checks.queries import QUERIES

    level = spark.sparkContext._jvm.org.apache.logging.log4j.Level.ERROR
    spark.sparkContext._jvm.org.apache.logging.log4j.core.config.Configurator.setLevel("org.apache.spark.sql.catalyst.expressions.codegen", level)
    for name in ("source_route_snapshots", "source_weekly_routes", "source_route_store"):
        assert QUERIES[name](spark, data).count() > 0
    assert "Failed to compile" not in "".join(capfd.readouterr())


# --- days and states


def days(first, last):
    return [first + timedelta(i) for i in range((last - first).days + 1)]


def levels(seed, first=date(2019, 1, 1), last=date(2023, 3, 10)):
    rng = random.Random(seed)
    return [(c, d, round(rng.uniform(0, 100), 2)) for c in ("de", "fr") for d in days(first, last) if rng.random() < 0.97]


DAYS = "country string, date date, full double"


def test_days_are_merged_by_key(spark, tmp_path):
    path = str(tmp_path / "days")
    first = levels(1)
    assert daily_store.merge_days(spark.createDataFrame(first, DAYS), path, ["country"]) == [2019, 2020, 2021, 2022, 2023]
    before = {f.name for f in (tmp_path / "days" / "versions").iterdir()}
    late = [("de", date(2021, 5, 5), 1.0), ("it", date(2021, 5, 5), 2.0), ("fr", date(2021, 12, 31), None)]
    assert daily_store.merge_days(spark.createDataFrame(late, DAYS), path, ["country"]) == [2021]
    want = {(c, d): v for c, d, v in first} | {(c, d): v for c, d, v in late}
    assert {(r.country, r.date): r.full for r in daily_store.read_days(spark, path).collect()} == want
    (version,) = {f.name for f in (tmp_path / "days" / "versions").iterdir()} - before
    assert [f.name for f in (tmp_path / "days" / "versions" / version).iterdir() if f.is_dir()] == ["stored_year=2021"]
    assert daily_store.merge_days(spark.createDataFrame([], DAYS), path, ["country"]) == []
    with pytest.raises(ValueError, match="twice"):
        daily_store.merge_days(spark.createDataFrame([late[0], late[0]], DAYS), path, ["country"])
    with pytest.raises(ValueError, match="no days"):
        daily_store.read_days(spark, f"{path}2")


def page(root, country, number, last, rows):
    data = [{"gasDayStart": d.isoformat(), "full": str(v)} for _, d, v in rows]
    put(root / f"country={country}" / f"page-{number}.json", json.dumps({"last_page": last, "data": data}))


def test_a_late_page_changes_its_days_alone(spark, tmp_path):
    root, store = tmp_path / "in", str(tmp_path / "store")
    rows = [r for r in levels(2) if r[0] == "de"]
    page(root, "de", 1, 1, rows)
    jobs.refresh_storage_days(spark, str(root), store)
    assert jobs.refresh_storage_days(spark, str(root), store) == []
    # two pages with a day in common: the one that lands last counts
    page(root, "de", 2, 3, [("de", rows[5][1], 7.0), ("de", rows[6][1], 8.0)])
    page(root, "de", 3, 3, [("de", rows[6][1], 9.0)])
    for i, name in ((10, 2), (20, 3)):
        os.utime(root / "country=de" / f"page-{name}.json", (os.stat(root).st_mtime + i,) * 2)
    assert jobs.refresh_storage_days(spark, str(root), store) == [2019]
    got = {r.date: r.full for r in daily_store.read_days(spark, store).collect()}
    assert got == {d: v for _, d, v in rows} | {rows[5][1]: 7.0, rows[6][1]: 9.0}
    landed = manifest.collected(spark, f"{store}/ledger")
    assert [tuple(r) for r in storage_pages.completeness(landed).collect()] == [("de", 3, 3, True)]


@pytest.mark.parametrize("mode", ["reference", "exclude_last"])
def test_report_from_states_equals_the_report_from_days(spark, tmp_path, mode):
    store, span = str(tmp_path / "days"), SeasonSpan(curr_year=2023)
    rows = levels(3) + [("old", date(2020, 2, 29), 1.0), ("old", date(2020, 3, 1), 2.0), ("new", date(2023, 1, 1), 5.0)]
    daily_store.store_days(spark.createDataFrame(rows, DAYS), store)

    def same():
        got = jobs.stored_storage_report(spark, store, span, mode)
        want = storage.storage_report(daily_store.read_days(spark, store), span, mode=mode)
        assert got.columns == want.columns
        rounded = lambda df: Counter(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())
        assert rounded(got) == rounded(want)
        return got

    same()
    daily_store.merge_days(spark.createDataFrame([("de", date(2020, 7, 1), 500.0), ("fr", date(2021, 12, 31), -300.0)], DAYS), store, ["country"])
    assert season_store.stale_years(spark, store, f"{store}/states", 2021) == [2020, 2021]
    report = same()
    assert season_store.stale_years(spark, store, f"{store}/states", 2021) == []
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "stored_year#" in plan and ">= 2022" in plan
    with pytest.raises(ValueError, match="no merged state"):
        season_store.merged(spark, f"{store}/states", "season", 1990)


def test_states_merge_in_any_grouping(spark):
    rows = [("a", d, v) for _, d, v in levels(4)[:300]] + [("a", date(2018, 1, 1), None), ("b", date(2018, 1, 1), float("nan"))]
    df = spark.createDataFrame(rows, DAYS).withColumn("k", F.month("date"))
    whole = season_state.season_state(df, "k", "full", ["country"])
    parts = season_state.season_state(df.withColumn("part", F.dayofmonth("date") % 3), "k", "full", ["part", "country"])
    merged = season_state.merged_season(parts, "k", ["country"])
    shown = lambda t: rows_of(t.select("country", "k", *(F.round(c, 9) for c in season_state.PARTS)))
    assert shown(whole) == shown(merged)


# --- revisions, pages, long series


def test_the_newest_document_counts(spark):
    rows = [(1, "5", 10), (1, "7", 20), (1, "6", 20), (2, "1", None), (3, "1", None), (3, "2", 1), (4, "9", 1), (4, None, 2), (None, "1", 1)]
    df = spark.createDataFrame(rows, "date int, quantity string, age long")
    got = rows_of(aggregate.newest_readings(df, "date", "quantity", "age"))
    assert got == sorted([(1, "7"), (2, "1"), (3, "2"), (4, None), (None, "1")], key=repr)
    assert aggregate.without_repeats(df, "date", "quantity").count() == 9
    assert aggregate.without_repeats(df, "date", "quantity", mode="newest").count() == 5
    with pytest.raises(ValueError):
        aggregate.without_repeats(df, "date", "quantity", mode="oldest")


def test_generation_takes_the_file_written_last(spark, tmp_path):
    series = "<D><TimeSeries><Period><timeInterval><start>2021-01-04T00:00Z</start></timeInterval><resolution>PT60M</resolution>{}</Period></TimeSeries></D>"
    point = "<Point><position>1</position><quantity>{}</quantity></Point>"
    for name, value, age in (("a", 1000, 100), ("b", 3000, 300), ("c", 2000, 200)):
        put(tmp_path / "in" / f"{name}.xml", series.format(point.format(value)))
        os.utime(tmp_path / "in" / f"{name}.xml", (1_700_000_000 + age,) * 2)
    arguments = ["generation", "--input", str(tmp_path / "in"), "--year", "2022", "--as-of", "2022-01-10"]
    for mode, total in (("reference", "6.0"), ("newest", "3.0")):
        jobs.main([*arguments, "--output", f"{tmp_path}/{mode}", "--revisions", mode], spark)
        assert [r["Maximum"] for r in table_of(f"{tmp_path}/{mode}/data/generation") if r["week_num"] == "01"] == [total]


def test_page_drift_finds_shifted_rows(spark):
    day = lambda i: date(2023, 1, 1) + timedelta(i)
    pages = {1: range(20, 30), 2: range(10, 20), 3: [*range(1, 5), *range(6, 11)], 5: [-3, -2]}
    rows = [("de", p, day(i)) for p, ds in pages.items() for i in ds] + [("de", 5, None), ("fr", 1, day(0)), ("fr", 2, day(1))]
    df = spark.createDataFrame(rows, "country string, page int, date date")
    got = {(r.country, r.page): (r.days, r.inside, r.follows, r.overlap, r.missing) for r in quality.page_drift(df, "page", "date", ["country"]).collect()}
    assert got == {
        ("de", 1): (10, 0, 2, 0, 0), ("de", 2): (10, 0, 3, 1, 0), ("de", 3): (9, 1, 5, 0, 2), ("de", 5): (2, 0, None, None, None),
        ("fr", 1): (1, 0, 2, 0, 0), ("fr", 2): (1, 0, None, None, None),
    }


def test_a_shifted_fetch_is_refused(spark, tmp_path):
    rows = [("de", d, 50 + d.day % 3) for d in days(date(2020, 1, 1), date(2023, 1, 2))]
    page(tmp_path / "in", "de", 1, 2, rows[500:][::-1])
    page(tmp_path / "in", "de", 2, 2, rows[:501][::-1])
    with pytest.raises(ValueError, match="share days"):
        jobs.run_storage(spark, str(tmp_path / "in"), str(tmp_path / "out"), SeasonSpan(curr_year=2023), "2023-01-02")
    assert not (tmp_path / "out").exists()


@pytest.mark.parametrize("size", [1, 7, 400])
def test_blocks_give_the_windows_of_whole_series(spark, size):
    rng = random.Random(size)
    rows = [(rng.choice(["a", None]), date(2020, 1, 1) + timedelta(rng.randrange(900)), rng.choice([None, 1.5, 2.5, rng.random()])) for _ in range(500)]
    rows = list({(s, d): (s, d, v) for s, d, v in rows}.values()) + [("a", None, 3.0)]
    df = spark.createDataFrame(rows, "s string, d date, v double")
    for n in (2, 7, 40):
        plain = df.withColumn("median", windows.rolling_median(F.col("v"), "d", ["s"], n))
        assert rows_of(windows.long_rolling_median(df, "v", "d", ["s"], n, size)) == rows_of(plain)
    plain = df.withColumn("change", windows.difference(F.col("v"), "d", ["s"]))
    assert rows_of(windows.long_difference(df, "v", "d", ["s"], size)) == rows_of(plain)
    one = df.where("s = 'a' and d is not null")
    assert rows_of(windows.long_with_gaps(one, "d", 7, (), size)) == rows_of(windows.with_gaps(one, "d", 7))
    assert windows.long_difference(df.limit(0), "v", "d").count() == 0


def test_a_long_series_is_worked_on_by_several_tasks(spark):
    """No task holds a third of a single series of 15-minute readings."""
    df = spark.range(96 * 400).select(
        F.expr("timestampadd(MINUTE, cast(id AS INT) * 15, timestamp_ntz'2020-01-01')").alias("d"), F.rand(1).alias("v")
    )
    got = windows.long_rolling_median(df, "v", "d", days=10)
    sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    text = got._jdf.queryExecution().executedPlan().toString()
    assert sum(sizes) == 96 * 400 and "hashpartitioning(_block" in text and "SinglePartition" not in text.split("Window")[1]
