"""Whole runs from landed files to published files."""

import json
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest

from wattfolio import fixed, jobs
from wattfolio.session import scratch_folder
from wattfolio.settings import SeasonSpan
from wattfolio.sinks import daily_store, files

from reading import folder_of, table_of


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def days(first, last):
    return [first + timedelta(i) for i in range((last - first).days + 1)]


def storage_file(root, country, page, last_page, levels):
    data = [{"gasDayStart": d.isoformat(), "full": str(v)} for d, v in levels]
    put(root / f"country={country}" / f"page-{page}.json", json.dumps({"last_page": last_page, "data": data}))


def test_storage_run(spark, tmp_path):
    span = days(date(2020, 1, 1), date(2023, 2, 10))
    levels = [(d, 50 + (i * 7 % 11)) for i, d in enumerate(span)]
    storage_file(tmp_path / "in", "de", 1, 2, levels[:600])
    storage_file(tmp_path / "in", "fr", 1, 1, levels[:-1] + [(span[-1], "NaN")])
    out = str(tmp_path / "out")
    arguments = ["storage", "--input", str(tmp_path / "in"), "--output", out, "--year", "2023", "--as-of", "2023-02-10"]
    with pytest.raises(ValueError, match="pages"):
        jobs.main(arguments, spark)
    storage_file(tmp_path / "in", "de", 2, 2, levels[600:])
    jobs.main(arguments, spark)
    rows = table_of(f"{out}/data/storage", "de")
    assert list(rows[0]) == ["date_datawrapper", "2023", "2022", "Mittelwert", "Maximum", "Minimum"]
    assert len(rows) == 365
    assert rows == table_of(f"{out}/backups/storage/snapshot_date=2023-02-10", "de")
    note = table_of(f"{out}/annotations/storage", "de")[0]
    assert note["title"] == f"Füllstand der deutschen Gasspeicher: <u>{levels[-1][1]},0 Prozent</u> 🇩🇪"
    assert "Datenstand: 10. Februar 2023." in note["note"]
    # the last change of the other series is unknown, so it is held back
    assert folder_of(f"{out}/data/storage", "fr") is None


def test_storage_run_with_every_series_held_back(spark, tmp_path):
    levels = [(d, "1") for d in days(date(2022, 1, 1), date(2023, 1, 2))]
    storage_file(tmp_path / "in", "de", 1, 1, levels)
    out = str(tmp_path / "out")
    jobs.run_storage(spark, str(tmp_path / "in"), out, SeasonSpan(curr_year=2023), "2023-01-02")
    assert not list(Path(out).rglob("*.csv"))


def test_stored_days_of_one_year(spark, tmp_path):
    old = [(d, 40 + i % 7) for i, d in enumerate(days(date(2021, 1, 1), date(2022, 3, 1)))]
    storage_file(tmp_path / "in", "de", 1, 1, old)
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    arguments = ["storage", "--input", str(tmp_path / "in"), "--output", out, "--store", store, "--year", "2022"]
    jobs.main([*arguments, "--as-of", "2022-03-01"], spark)
    assert daily_store.read_days(spark, store).count() == len(old)
    # the next day's pages hold the current year only, with one revised value
    new = [(d, v) for d, v in old if d.year == 2022] + [(date(2022, 3, 2), 41)]
    new[5] = (new[5][0], 46.5)
    storage_file(tmp_path / "in", "de", 1, 1, new)
    jobs.main([*arguments, "--as-of", "2022-03-02", "--renew-year", "2022"], spark)
    rows = {r["date_datawrapper"]: r for r in table_of(f"{out}/data/storage", "de")}
    assert rows["2022-01-06"]["2022"] == "46.5"
    assert rows["2022-03-02"]["2022"] == "41.0"
    assert rows["2022-12-31"]["Maximum"] == str(float(dict(old)[date(2021, 12, 31)]))


def test_gas_run(spark, tmp_path):
    header = "unit,directionKey,operatorLabel,pointLabel,periodFrom,periodTo,value"

    def lines(span, key, value):
        return "\n".join([header, *[f"kWh/d,{key},x,Basel,{d} 06:00:00,{d} 06:00:00,{value}" for d in span]])

    put(tmp_path / "old" / "direction=import" / "a.csv", lines(days(date(2021, 1, 1), date(2021, 12, 31)), "exit", 3e6))
    put(tmp_path / "old" / "direction=export" / "a.csv", lines(days(date(2021, 1, 1), date(2021, 12, 31)), "entry", 1e6))
    new = days(date(2022, 1, 1), date(2023, 1, 31))
    put(tmp_path / "new" / "direction=import" / "point=Basel" / "a.csv", lines(new, "exit", 3e6))
    put(tmp_path / "new" / "direction=export" / "point=Basel" / "a.csv", lines(new, "entry", 1e6))
    out = str(tmp_path / "out")
    jobs.main(
        ["gas", "--input", str(tmp_path / "new"), "--second-input", str(tmp_path / "old"), "--output", out,
         "--year", "2023", "--as-of", "2023-02-01"], spark)
    rows = table_of(f"{out}/data/gas_use")
    assert list(rows[0]) == ["date_show", "2023", "2022", "2021"]
    assert len(rows) == 365
    assert float(rows[10]["2022"]) == pytest.approx(2 + 9190 / 365)
    assert [rows[0]["2021"], rows[6]["2021"] != ""] == ["", True]
    assert [r["date_show"] for r in rows if r["2023"] == ""][0] == "2023-01-31"
    assert table_of(f"{out}/annotations/gas_use")[0]["note"].endswith("zuletzt am 1. Februar 2023.")
    assert files.read_table(spark, f"{out}/checks/gas_overlaps").count() == 0
    # a day in both is listed; history may have its columns in another order
    again = "value,unit,directionKey,operatorLabel,pointLabel,periodFrom,periodTo\n5,kWh/d,exit,x,Basel,2022-05-01 06:00:00,2022-05-01 06:00:00"
    put(tmp_path / "old" / "direction=import" / "b.csv", again)
    jobs.main(
        ["gas", "--input", str(tmp_path / "new"), "--second-input", str(tmp_path / "old"), "--output", out + "2",
         "--year", "2023", "--as-of", "2023-02-01", "--offset-total", "0", "--unchecked-history"], spark)
    twice = files.read_table(spark, f"{out}2/checks/gas_overlaps").collect()
    assert [(r.direction, r.point, r.periodFrom, r["rows"]) for r in twice] == [("import", "Basel", datetime(2022, 5, 1, 6), 2)]
    assert float(table_of(f"{out}2/data/gas_use")[10]["2022"]) == pytest.approx(2)
    # a run that fails its unit check leaves the last result in place
    bad = lines(new, "entry", 1e6)
    put(tmp_path / "new" / "direction=import" / "point=Oltingue" / "a.csv", bad)
    with pytest.raises(Exception, match="unexpected value"):
        jobs.run_gas(spark, str(tmp_path / "new"), out, SeasonSpan(curr_year=2023), "2023-02-02", str(tmp_path / "old"))
    assert table_of(f"{out}/data/gas_use") == rows


def test_generation_run(spark, tmp_path):
    points = "".join(f"<Point><position>{i + 1}</position><quantity>1000</quantity></Point>" for i in range(24 * 729))
    for name in ("a", "b"):
        put(
            tmp_path / "in" / f"{name}.xml",
            "<GL_MarketDocument><TimeSeries><Period><timeInterval><start>2021-01-04T00:00Z</start></timeInterval>"
            f"<resolution>PT60M</resolution>{points}</Period></TimeSeries></GL_MarketDocument>",
        )
    out = str(tmp_path / "out")
    jobs.main(["generation", "--input", str(tmp_path / "in"), "--output", out, "--year", "2022", "--as-of", "2023-01-02"], spark)
    rows = table_of(f"{out}/data/generation")
    assert [r["week_num"] for r in rows] == [f"{w:02d}" for w in range(1, 53)]
    assert {r["2022"] for r in rows} == {"168.0"}
    assert rows == table_of(f"{out}/backups/generation/snapshot_date=2023-01-02")
    assert table_of(f"{out}/annotations/generation")[0]["last_week"] == "52"
    assert files.read_table(spark, f"{out}/checks/generation_conflicts").count() == 0
    other = (tmp_path / "in" / "b.xml").read_text().replace("<position>5</position><quantity>1000", "<position>5</position><quantity>7")
    put(tmp_path / "in" / "b.xml", other)
    jobs.main(["generation", "--input", str(tmp_path / "in"), "--output", out, "--year", "2022", "--as-of", "2023-01-02",
               "--zone", "Europe/Paris"], spark)
    conflicts = files.read_table(spark, f"{out}/checks/generation_conflicts").collect()
    assert [tuple(r) for r in conflicts] == [(datetime(2021, 1, 4, 5), 2)]


def test_national_use_run(spark, tmp_path):
    national = [{n: 1.0 for n in fixed.NATIONAL_USE_NAMES} | {"date": f"2023-01-0{i}"} for i in (3, 1, 2)]
    final = [{n: 2.0 for n in fixed.FINAL_USE_NAMES} | {"date": f"2022-12-3{i}"} for i in (0, 1)]
    put(tmp_path / "a" / "n.json", json.dumps({"entries": national}))
    put(tmp_path / "b" / "f.json", json.dumps(final + [final[0] | {"date": "2023-01-01"}]))
    out = str(tmp_path / "out")
    jobs.main(["national-use", "--input", str(tmp_path / "a"), "--second-input", str(tmp_path / "b"), "--output", out], spark)
    assert [r["date"] for r in table_of(f"{out}/data/landesverbrauch")] == ["2023-01-01", "2023-01-02", "2023-01-03"]
    assert [r["Endverbrauch gemeldet"] for r in table_of(f"{out}/data/endverbrauch")] == ["2.0"]
    notes = table_of(f"{out}/annotations/use")
    assert [n["usage"] for n in notes] == ["endverbrauch", "landesverbrauch"]
    assert "4. Januar 2023" in notes[0]["note"]


def test_grid_routes_and_links_runs(spark, tmp_path):
    names = fixed.grid_measures()
    rows = [",".join(["", *names]), ",".join(["x", *["kWh"] * 64])]
    for d in days(date(2021, 1, 4), date(2022, 12, 31)):
        rows.append(",".join([datetime(d.year, d.month, d.day).strftime("%d.%m.%Y %H:%M"), "1000000", *[""] * 63]))
    put(tmp_path / "grid" / "a.csv", "\n".join(rows))
    out = str(tmp_path / "out")
    jobs.main(["grid", "--input", str(tmp_path / "grid"), "--output", out, "--year", "2022",
               "--as-of", "2022-10-01", "--open-week", "39"], spark)
    table = {r["week_num"]: r for r in table_of(f"{out}/data/grid")}
    assert (table["38"]["2022"], table["39"]["2022"], table["39"]["Mittelwert"]) == ("7.0", "", "7.0")
    put(tmp_path / "routes" / "r.csv", 'week,A_2022\n1,"1,000"\n')
    jobs.main(["routes", "--input", str(tmp_path / "routes"), "--output", out], spark)
    assert [tuple(r) for r in files.read_table(spark, f"{out}/data/routes").collect()] == [(1, "A", "2022", 1000.0)]
    put(tmp_path / "dated" / "2023-01-04" / "r.csv", 'week,A_2022\n1,"1,000"\n')
    jobs.main(["routes", "--input", str(tmp_path / "dated" / "*"), "--output", f"{out}/dated", "--dated"], spark)
    assert [tuple(r) for r in files.read_table(spark, f"{out}/dated/data/routes").collect()] == [(date(2023, 1, 4), 1, "A", "2022", 1000.0)]
    pages = spark.createDataFrame([(1, "<a title='Download data' href='/z'>")], "id int, html string")
    pages.write.parquet(str(tmp_path / "pages"))
    jobs.main(["links", "--input", str(tmp_path / "pages"), "--output", out], spark)
    assert [tuple(r) for r in files.read_table(spark, f"{out}/data/links").collect()] == [(1, "/z")]


def test_month_run(spark, tmp_path):
    names = fixed.grid_measures()
    rows = [",".join(["", *names]), ",".join(["x", *["kWh"] * 64])]
    for d in days(date(2020, 8, 25), date(2022, 10, 5)):
        value = {2020: 1, 2021: 3, 2022: 5}[d.year] * 1_000_000
        rows.append(",".join([d.strftime("%d.%m.%Y 00:15"), str(value), str(2 * value), *[""] * 62]))
    put(tmp_path / "in" / "a.csv", "\n".join(rows))
    arguments = ["month", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"),
                 "--start", "2022-09-01", "--end", "2022-09-30 23:45:00"]
    with pytest.raises(SystemExit):
        jobs.main(arguments, spark)
    jobs.main([*arguments, "--history-before", "2022-01-01"], spark)
    assert table_of(tmp_path / "out" / "data" / "month") == [
        {"usage": "150.0", "average": "60.0", "difference": "90.0", "percent": "150.0"}
    ]
    lines = table_of(tmp_path / "out" / "annotations" / "month")[0]
    assert "150.0" in lines["usage_line"] and "60.0" in lines["average_line"]
    jobs.main([*arguments, "--history-before", "2022-01-01", "--measure", names[1]], spark)
    assert table_of(tmp_path / "out" / "data" / "month")[0]["usage"] == "300.0"


def test_storage_run_misses_a_country(spark, tmp_path):
    storage_file(tmp_path / "in", "de", 1, 1, [(d, "1") for d in days(date(2022, 1, 1), date(2023, 1, 2))])
    arguments = ["storage", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--year", "2023",
                 "--as-of", "2023-01-02", "--countries", "de,fr"]
    with pytest.raises(ValueError, match="pages"):
        jobs.main(arguments, spark)
    jobs.main([*arguments, "--some-pages"], spark)


def test_missing_parameters_are_refused(spark):
    with pytest.raises(SystemExit):
        jobs.main(["storage", "--input", "x", "--output", "y"], spark)
    with pytest.raises(SystemExit):
        jobs.main(["national-use", "--input", "x", "--output", "y"], spark)
    with pytest.raises(ValueError):
        SeasonSpan(curr_year=2020)


class Cluster:
    """A session on a cluster without a shared folder."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "spark://host:7077"
        getConf = staticmethod(dict)


def test_scratch_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first.startswith(f"{shared}/x-") and first != second
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        Cluster.sparkContext.master = master
        with pytest.raises(ValueError, match="shared folder"):
            scratch_folder(Cluster, "x")
    Cluster.sparkContext.master = "local[4]"
    assert Path(scratch_folder(Cluster, "x")).parent.is_dir()
