"""Readers on small landed files."""

import json
import re
from datetime import date, datetime
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.operators import aggregate, balance
from wattfolio.sources import (
    gas_flows,
    generation_xml,
    grid_sheets,
    national_use,
    storage_pages,
    web_links,
    weekly_routes,
)

HEADER = "indicator,unit,directionKey,operatorLabel,pointLabel,periodFrom,periodTo,value"


def flow(operator, start, value, unit="kWh/d", key="exit", label="P"):
    return f"Physical Flow,{unit},{key},{operator},{label},{start},{start},{value}"


def put(path, *lines, end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((end.join(lines) + end).encode("utf-8"))


@pytest.fixture
def flow_files(tmp_path):
    root = tmp_path / "flows"
    put(
        root / "direction=import" / "point=Wallbach" / "a.csv",
        HEADER,
        flow("Fluxys TENP", "2022-01-01 06:00:00", "10"),
        flow("Open Grid", "2022-01-01 06:00:00", "99"),
        flow("Fluxys TENP", "2022-01-02 06:00:00", ""),
    )
    put(
        root / "direction=import" / "point=Oltingue" / "a.csv",
        HEADER, flow("Open Grid", "2022-01-01T06:00:00+01:00", "5"),
    )
    put(
        root / "direction=export" / "point=Wallbach" / "a.csv",
        HEADER, flow("Open Grid", "2022-01-01 06:00:00", "3", key="entry"),
    )
    return root


def test_flows_by_name_with_checks_and_operator_rule(spark, flow_files):
    flows = gas_flows.read_flows(spark, str(flow_files))
    got = {(r.direction, r.point, r.operatorLabel, r.value) for r in flows.collect()}
    assert got == {
        ("import", "Wallbach", "Fluxys TENP", 10.0), ("import", "Wallbach", "Fluxys TENP", None),
        ("import", "Oltingue", "Open Grid", 5.0), ("export", "Wallbach", "Open Grid", 3.0),
    }
    days = balance.flow_balance(flows, "direction", "value", "periodFrom").orderBy("date").collect()
    assert [(r.date, r["import"], r.export, r["diff"]) for r in days] == [
        (date(2022, 1, 1), 15.0, 3.0, 12.0), (date(2022, 1, 2), 0.0, None, None)
    ]


def test_flow_scan_skips_folders(spark, flow_files):
    flows = gas_flows.read_flow_files(spark, str(flow_files)).filter("direction = 'export'")
    assert "PartitionFilters: [isnotnull(direction" in flows._jdf.queryExecution().executedPlan().toString()
    assert flows.count() == 1


def test_files_with_other_headers_are_refused(spark, flow_files):
    put(
        flow_files / "direction=import" / "point=Basel" / "a.csv",
        "unit,indicator,directionKey,operatorLabel,pointLabel,periodFrom,periodTo,value",
        "kWh/d,Physical Flow,exit,x,P,2022-01-01,2022-01-02,1",
    )
    with pytest.raises(Exception, match="header"):
        gas_flows.read_flow_files(spark, str(flow_files)).select("unit", "value").collect()


def test_files_with_other_headers_are_appended_by_name(spark, flow_files):
    put(
        flow_files / "direction=import" / "point=Passo Gries" / "a+b c.csv",
        "value,unit,new,directionKey,operatorLabel,pointLabel,periodFrom,periodTo",
        "1,kWh/d,?,exit,x,P,2022-01-01,2022-01-02", "2,kWh/d,?,exit,x,P,2022-01-02,2022-01-03",
    )
    put(flow_files / "direction=import" / "point=None" / "empty.csv", end="")
    flows = gas_flows.read_flow_files(spark, str(flow_files), by_name=True)
    got = [(r.unit, r.value) for r in flows.where("point = 'Passo Gries'").orderBy("value").collect()]
    assert got == [("kWh/d", 1.0), ("kWh/d", 2.0)]
    assert flows.count() == 7
    put(flow_files / "direction=import" / "point=Basel" / "a.csv", "unit,value", "kWh/d,1")
    with pytest.raises(ValueError, match="directionKey, operatorLabel"):
        gas_flows.read_flow_files(spark, str(flow_files), by_name=True)


@pytest.fixture
def history_files(tmp_path):
    root = tmp_path / "history"
    put(
        root / "direction=import" / "2021.csv",
        HEADER,
        flow("Open Grid", "2021-12-31 06:00:00", "7", label="Wallbach"),
        flow("Fluxys TENP", "2021-12-31 06:00:00", "8", label="Wallbach"),
    )
    return root


def test_history_is_appended_checked_or_as_it_is(spark, flow_files, history_files):
    def december(**options):
        flows = gas_flows.read_flows(spark, str(flow_files), str(history_files), **options)
        rows = flows.filter(F.year("periodFrom") == 2021).collect()
        return sorted(r.value for r in rows)

    assert december() == [8.0]
    assert december(check_history=False) == [7.0, 8.0]
    assert december(start="2022-01-01", end="2022-01-01") == [8.0]


def test_unit_modes_on_files(spark, flow_files, history_files):
    put(
        flow_files / "direction=import" / "point=Basel" / "a.csv",
        HEADER, flow("x", "2022-01-01 06:00:00", "1", unit="MWh/d"),
    )
    put(
        flow_files / "direction=import" / "point=Thayngen" / "a.csv",
        HEADER, flow("x", "2022-01-01 06:00:00", "1"),
    )
    path = str(flow_files)
    with pytest.raises(Exception, match="unexpected value"):
        gas_flows.read_flows(spark, path).collect()

    def imports(mode):
        flows = gas_flows.read_flows(spark, path, str(history_files), mode, check_history=False)
        return {r.point for r in flows.filter("direction = 'import'").collect()}

    assert imports("quarantine") == {"Wallbach", "Oltingue", "Thayngen"}
    assert imports("stop") == {"Wallbach", "Oltingue"}
    checked = gas_flows.read_flows(spark, path, str(history_files), "stop")
    assert checked.filter(F.year("periodFrom") == 2021).count() == 1


def test_storage_pages(spark, tmp_path):
    root = tmp_path / "pages"
    for country, page, last, data in [
        ("de", 1, 2, [("2022-09-02", "86.49"), ("2022-09-01", "0.21")]),
        ("de", 2, 2, [("2022-08-31", "86.1")]),
        ("fr", 1, 2, [("2022-09-02", None)]),
    ]:
        body = {"last_page": last, "total": 3, "data": [{"gasDayStart": d, "full": f, "trend": "0"} for d, f in data]}
        put(root / f"country={country}" / f"page-{page}.json", json.dumps(body, indent=2))
    pages = storage_pages.read_pages(spark, str(root))
    assert sorted((r.country, r.page) for r in pages.collect()) == [("de", 1), ("de", 2), ("fr", 1)]
    got = sorted(map(tuple, storage_pages.levels(pages).collect()), key=str)
    assert got == [
        ("de", date(2022, 8, 31), 86.1), ("de", date(2022, 9, 1), 0.21),
        ("de", date(2022, 9, 2), 86.49), ("fr", date(2022, 9, 2), None),
    ]
    check = {r.country: r.complete for r in storage_pages.completeness(pages).collect()}
    assert check == {"de": True, "fr": False}


def test_storage_pages_bad_number(spark, tmp_path):
    body = {"last_page": 1, "data": [{"gasDayStart": "2022-09-01", "full": "-"}]}
    put(tmp_path / "p" / "country=de" / "page-1.json", json.dumps(body))
    pages = storage_pages.read_pages(spark, str(tmp_path / "p"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        storage_pages.levels(pages).collect()
    assert storage_pages.levels(pages, lenient=True).first().full is None


def document(*series):
    def one(start, points, resolution="PT60M"):
        body = "".join(
            f"<Point><position>{p}</position><quantity>{q}</quantity></Point>" for p, q in points
        )
        return (
            f"<TimeSeries><mRID>1</mRID><Period><timeInterval><start>{start}</start><end>x</end></timeInterval>"
            f"<resolution>{resolution}</resolution>{body}</Period></TimeSeries>"
        )

    inner = "\n".join(one(*s) for s in series)
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<GL_MarketDocument xmlns="urn:x">{inner}</GL_MarketDocument>'


def test_generation_documents(spark, tmp_path):
    put(
        tmp_path / "2022.xml",
        document(("2022-12-31T22:00Z", [(1, 100), (2, 200), (4, 400)]), ("2023-01-01T00:00Z", [(1, 300)])),
    )
    put(tmp_path / "2023.xml", document(("2023-01-01T00:00Z", [(1, 300)])))
    readings = generation_xml.readings(generation_xml.read_series(spark, str(tmp_path)))
    got = sorted(map(tuple, readings.collect()))
    assert got == [
        (datetime(2022, 12, 31, 22), "100"), (datetime(2022, 12, 31, 23), "200"),
        (datetime(2023, 1, 1, 0), "300"), (datetime(2023, 1, 1, 0), "300"), (datetime(2023, 1, 1, 1), "400"),
    ]
    assert aggregate.drop_repeats(readings, "date", "quantity").count() == 4
    paris = generation_xml.readings(generation_xml.read_series(spark, str(tmp_path)), "Europe/Paris", 15)
    assert min(r.date for r in paris.collect()) == datetime(2022, 12, 31, 23)
    assert max(r.date for r in paris.collect()) == datetime(2023, 1, 1, 1)


def test_national_use_shapes(spark, tmp_path):
    entry = {n: 1.5 for n in fixed.NATIONAL_USE_NAMES} | {"date": "2023-01-02", "landesverbrauch": None, "other": 1}
    put(tmp_path / "a" / "national.json", json.dumps({"currentEntry": {}, "entries": [entry, entry]}, indent=1))
    rows = national_use.read_national_use(spark, str(tmp_path / "a")).collect()
    assert len(rows) == 2
    assert rows[0].asDict() == {k: v for k, v in entry.items() if k != "other"}
    record = {n: 2 for n in fixed.FINAL_USE_NAMES} | {"date": "2022-12-31"}
    put(tmp_path / "b" / "final.json", json.dumps([record, record, record], indent=1))
    rows = national_use.read_final_use(spark, str(tmp_path / "b")).collect()
    assert len(rows) == 3
    assert rows[0].endverbrauch == 2.0


def test_grid_sheets_drop_the_units_row(spark, tmp_path):
    names = fixed.grid_measures()
    put(
        tmp_path / "2022.csv",
        "," + ",".join(f"Column {i}" for i in range(64)),
        "Zeitstempel," + ",".join(["kWh"] * 64),
        "30.09.2022 23:45," + ",".join(str(i) for i in range(64)),
        "01.10.2022 00:00," + ",".join([""] * 64),
    )
    layout = grid_sheets.named_by_position(["", *(f"column  {i}" for i in range(64))], names)
    rows = grid_sheets.read_sheets(spark, str(tmp_path), layouts=[layout]).orderBy("date").collect()
    assert [(r.date, r.date_normal) for r in rows] == [
        (datetime(2022, 9, 30, 23, 45), date(2022, 9, 30)), (datetime(2022, 10, 1), date(2022, 10, 1))
    ]
    assert [rows[0][n] for n in names] == [float(i) for i in range(64)]
    assert rows[1].verbrauch_sh_zh is None


def test_sheets_by_their_headers(spark, tmp_path):
    with pytest.raises(ValueError, match="expected 2 columns, found 3"):
        grid_sheets.named_by_position(["t", "x", "y"], ["a"])
    new = grid_sheets.named_by_position(["Zeit", "Use", "Loss"], ["use", "loss"])
    old = grid_sheets.named_by_position(["Time", "Loss (kWh)", "Use (kWh)", "Rest"], ["loss", "use", "rest"])
    put(tmp_path / "2022" / "a.csv", "Zeit,Use,Loss", "x,kWh,kWh", "01.10.2022 00:00,1,2")
    put(tmp_path / "2009" / "a.csv", '\ufeffTime,"Loss  (kWh)",use (kwh),Rest', "x,kWh,kWh,kWh", "01.10.2009 00:00,3,4,5")
    rows = grid_sheets.read_sheets(spark, f"{tmp_path}/*", layouts=[new, old]).orderBy("date").collect()
    assert [(r.use, r.loss, r.rest) for r in rows] == [(4.0, 3.0, 5.0), (1.0, 2.0, None)]
    with pytest.raises(ValueError, match="unknown header of .*2009/a.csv"):
        grid_sheets.read_sheets(spark, f"{tmp_path}/*", layouts=[new])
    # two columns in each other's place
    put(tmp_path / "2023" / "a.csv", "Zeit,Loss,Use", "01.10.2023 00:00,1,2")
    with pytest.raises(ValueError, match="2023/a.csv: column 2 is 'loss', expected 'use'"):
        grid_sheets.read_sheets(spark, f"{tmp_path}/*", layouts=[new, old])
    report = grid_sheets.header_report(spark, f"{tmp_path}/*", [new, old]).collect()
    assert sorted((r.known, r.files, r.header[:5]) for r in report) == [(False, 1, "Zeit,"), (True, 1, "Time,"), (True, 1, "Zeit,")]


def test_weekly_routes(spark, tmp_path):
    put(
        tmp_path / "route.csv",
        'week,Nord Stream_min,Nord Stream_2021,"Yamal (BY,PL)_2022",turkstream20',
        '1,807,"1,193",0,117', '53,,"1,173",,', ",,,,",
        end="\r\n",
    )
    got = {tuple(r) for r in weekly_routes.weekly_long(weekly_routes.read_weekly(spark, str(tmp_path))).collect()}
    assert got == {
        (1, "Nord Stream", "min", 807.0), (1, "Nord Stream", "2021", 1193.0),
        (1, "Yamal (BY,PL)", "2022", 0.0), (1, "turkstream", "2020", 117.0),
        (53, "Nord Stream", "min", None), (53, "Nord Stream", "2021", 1173.0),
        (53, "Yamal (BY,PL)", "2022", None), (53, "turkstream", "2020", None),
    }


def test_route_snapshots_keep_their_day(spark, tmp_path):
    put(tmp_path / "2023-12-20" / "route_data_2023-12-19.csv", "week,A_2023", '1,"1,000"')
    put(tmp_path / "2024-01-03" / "route_data_2024-01-02.csv", "week,A_2023,A_2024", "1,999,5", "2,,")
    put(tmp_path / "2024-01-03" / "reverse_flows_2024-01-02.csv", "week,R_2024", "1,7")
    put(tmp_path / "date=2024-01-10" / "route_data_2024-01-09.csv", "week,A_2023,A_2024", "1,998,4")
    rows = weekly_routes.read_snapshots(spark, f"{tmp_path}/*/route_data_*.csv")
    assert rows.columns == ["snapshot_date", "week", "series", "period", "value"]
    first, second, third = date(2023, 12, 20), date(2024, 1, 3), date(2024, 1, 10)
    assert {tuple(r) for r in rows.collect()} == {
        (first, 1, "A", "2023", 1000.0), (second, 1, "A", "2023", 999.0), (second, 1, "A", "2024", 5.0),
        (second, 2, "A", "2023", None), (second, 2, "A", "2024", None),
        (third, 1, "A", "2023", 998.0), (third, 1, "A", "2024", 4.0),
    }
    assert weekly_routes.read_snapshots(spark, f"{tmp_path}/*/reverse_flows_*.csv").count() == 1
    put(tmp_path / "undated" / "route_data.csv", "week,A_2023", "1,2")
    with pytest.raises(Exception, match="no day in the folder"):
        weekly_routes.read_snapshots(spark, f"{tmp_path}/*/route_data*.csv").collect()


PAGES = [
    (1, '<p><a href="/x">x</a><A class=b title="Download data" href="https://e.org/f.zip">y</A>'
        '<a title="Download data" href="/second">z</a>'),
    (2, "<a href='/q?a=1&amp;b=2' title='Download data'>y</a>"),
    (3, '<!-- <a title="Download data" href="/hidden"> --><script>"<a title=\'Download data\' href=\'/s\'>"</script>'
        "<a title='Download data' href=/bare>"),
    (4, '<a href="/x">Download data</a>'),
    (5, '<a\n  data-title="Download data"\n  href="/x"><a\n  href="/lines"\n  title="Download data">'),
    (6, '<!-- never closed <a title="Download data" href="/x">'),
    (7, None),
]


def test_first_fitting_link(spark):
    df = spark.createDataFrame(PAGES, "id int, html string")
    got = web_links.page_links(df, "html", "title", "^Download data$").collect()
    assert {r.id: r.link for r in got} == {
        1: "https://e.org/f.zip", 2: "/q?a=1&b=2", 3: "/bare", 5: "/lines"
    }


class Anchors(HTMLParser):
    """Attributes of each anchor as the standard library reads them; the first of a name counts."""

    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.found.append({k: v or "" for k, v in reversed(attrs)})


def first_link(html, name, pattern):
    parser = Anchors()
    parser.feed(html or "")
    parser.close()
    fitting = (a for a in parser.found if re.search(pattern, a.get(name, "\0")))
    return next(({"link": a.get("href")} for a in fitting), None)


UNUSUAL = [
    '<a title="Download data" data-x="a > b" href="/ok1">x</a>',
    '<a title="Download data" data-note="see href=/wrong" href="/right">x</a>',
    "<a title='Download data' href='/q?n=&eacute;&#x2f;&#47;&apos;&amp;&unknown;&#x1F600;&'>x</a>",
    "<a title='Download &#100;ata' href=/bare/path/>x</a>",
    '<A HREF = "/spaced" TITLE\n=\n"Download data" href="/second">x</A>',
    "<a/title='Download data'/href='/slashes'>x</a>",
    "<a title='Download data' href>x</a>",
    "<a title='Download data' href=''>x</a>",
    "<a title='Download data'>no link</a>",
    "<abbr title='Download data' href='/no'><a title=\"Download data\" href='/it&apos;s'>",
    "<a " + "data-long='x' " * 20_000 + "title='Download data' href='/long'>",
]


def test_links_as_an_html_parser_finds_them(spark, data):
    df = spark.createDataFrame(list(enumerate(UNUSUAL)), "id int, html string")
    got = {r.id: r.link for r in web_links.page_links(df, "html", "title", "^Download data$").collect()}
    want = {i: first_link(h, "title", "^Download data$") for i, h in enumerate(UNUSUAL)}
    assert got == {i: w["link"] for i, w in want.items() if w}
    assert got[0] == "/ok1" and got[1] == "/right" and got[2] == "/q?n=é//'&&unknown;😀&"
    pages = spark.read.parquet(f"{data}/pages.parquet").select("page_id", "html")
    got = {r.page_id: r.link for r in web_links.page_links(pages, "html", "href", "^/[a-m]").collect()}
    want = {r.page_id: first_link(r.html, "href", "^/[a-m]") for r in pages.collect()}
    assert got == {i: w["link"] for i, w in want.items() if w}


def test_grid_sheets_stop_at_a_bad_date_or_number(spark, tmp_path):
    names = ["a", "b"]
    for i, line in enumerate(["2022-10-01 00:00,1,2", "01.10.2022 00:00,1'234,2", ",1,2"]):
        put(tmp_path / str(i) / "sheet.csv", "x,y,z", "Zeitstempel,kWh,kWh", line)
        with pytest.raises(Exception):  # noqa: B017
            layout = grid_sheets.named_by_position(["x", "y", "z"], names)
            grid_sheets.read_sheets(spark, str(tmp_path / str(i)), layouts=[layout]).collect()


def test_all_periods_and_their_own_steps(spark, tmp_path):
    period = "<Period><timeInterval><start>{}</start></timeInterval><resolution>{}</resolution>{}</Period>"
    points = "".join(f"<Point><position>{i}</position><quantity>{i}</quantity></Point>" for i in (1, 2))
    both = period.format("2021-01-04T00:00Z", "PT15M", points) + period.format("2021-01-05T00:00Z", "P1D", points)
    put(tmp_path / "a.xml", f"<D><TimeSeries>{both}</TimeSeries></D>")
    rows = generation_xml.readings(generation_xml.read_series(spark, str(tmp_path))).orderBy("date").collect()
    days = [(4, 0, 0), (4, 0, 15), (5, 0, 0), (6, 0, 0)]
    assert [r.date for r in rows] == [datetime(2021, 1, d, h, m) for d, h, m in days]
    put(tmp_path / "b" / "b.xml", f"<D><TimeSeries>{period.format('2021-01-04T00:00Z', 'PT7M', points)}</TimeSeries></D>")
    with pytest.raises(Exception, match="unknown resolution: PT7M"):
        generation_xml.readings(generation_xml.read_series(spark, str(tmp_path / "b"))).collect()


def test_page_number_comes_from_below_the_country(spark, tmp_path):
    root = tmp_path / "homepage9"
    put(root / "country=de" / "page-2.json", json.dumps({"last_page": 2, "data": []}))
    assert [r.page for r in storage_pages.read_pages(spark, str(root)).collect()] == [2]


def test_texts_survive_a_written_file(spark, tmp_path):
    from wattfolio.sinks import files

    texts = ["    blanks    ", "a break\n", 'say "hi"', "a, b", "", None]
    table = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    files.write_current(table, str(tmp_path / "out"), ["n"])
    back = files.read_current(spark, str(tmp_path / "out"), table).orderBy("n").collect()
    assert [r.t for r in back] == texts
