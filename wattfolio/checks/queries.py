"""One query per operator and report, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattfolio import fixed, jobs
from wattfolio.checks import inputs, landed
from wattfolio.checks.inputs import AS_OF, GRID_SPAN, OFFSET, SPAN
from wattfolio.functions import dates, numbers, texts
from wattfolio.operators import aggregate, balance, filters, quality, season, windows
from wattfolio.plans import (
    annotations,
    gas_balance,
    generation,
    month_compare,
    national_use,
    storage,
)
from wattfolio.session import scratch_folder
from wattfolio.sinks import daily_store, files, versions
from wattfolio.sources import (
    gas_flows,
    generation_xml,
    grid_sheets,
    storage_pages,
    web_links,
    weekly_routes,
)
from wattfolio.sources import national_use as use_source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
COUNTRY = ["country"]


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Dates as text and doubles rounded, so that two engines can be compared."""
    columns = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            c = F.round(c, digits)
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampNTZType):
            text = c.cast("string")
            c = F.rpad(F.when(text.contains("."), text).otherwise(F.concat(text, F.lit("."))), 26, "0")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, folder: shown(build(spark, folder))
    return build


# --- sums, duplicates, totals


@query
def daily_sum(spark, folder):
    return inputs.levels(spark, folder)


@query
def weekly_sum(spark, folder):
    weeks = aggregate.weekly_sum(inputs.prices(spark, folder), "full", "time", ["country", "status"])
    return generation.weekly_keys(weeks)


@query
def monthly_mean_of_sums(spark, folder):
    past = filters.within(inputs.prices(spark, folder), "time", end="1999-12-31")
    inner = {"country": F.col("country"), "year": F.year("time"), "month": F.month("time")}
    return aggregate.mean_of_sums(past, "full", inner, ["country", "month"])


@query
def totals(spark, folder):
    table = aggregate.totals(inputs.prices(spark, folder), "full", COUNTRY)
    return numbers.scaled(table, ["total", "maximum", "minimum"], 1_000)


@query
def dedup_readings(spark, folder):
    return aggregate.drop_repeats(inputs.positioned(spark, folder), "date", "quantity", ["unit"])


@query
def newest_readings(spark, folder):
    return aggregate.newest_readings(inputs.aged_readings(spark, folder), "date", "quantity", "age", ["unit"])


@query
def weekly_newest_report(spark, folder):
    """The weekly report with one reading for each time, that of the newest document."""
    return generation.weekly_generation_report(inputs.aged_readings(spark, folder), SPAN, AS_OF, revisions="newest")


@query
def position_to_timestamp(spark, folder):
    events = inputs.table(spark, folder, "events")
    k = F.from_json("props", "k INT")["k"]
    return events.select("event_id", dates.at_position(F.col("ts"), k).alias("reading_time"))


@query
def share_of_total(spark, folder):
    days = balance.flow_balance(inputs.balanced_flows(spark, folder), "direction", "value", "time")
    year = filters.within(days, "date", "1997-01-01", "1997-12-31")
    return aggregate.share_of_total(year, "import").select("date", "import", "share")


@query
def union_all(spark, folder):
    """Daily imports below daily exports and transits that carry one more column."""
    flows = inputs.flows(spark, folder)
    imports, exports, transits = (
        aggregate.daily_sum(flows.filter(F.col("direction") == d), "value", "time")
        for d in ("import", "export", "transit")
    )
    named = [exports.withColumn("direction", F.lit("export")), transits.withColumn("direction", F.lit("transit"))]
    return aggregate.union_all([imports, *named])


# --- windows


@query
def rolling_median_7(spark, folder):
    days = inputs.levels(spark, folder)
    return days.withColumn("median", windows.rolling_median(F.col("full"), "date", COUNTRY))


@query
def rolling_median_dense(spark, folder):
    """The rolling median with a row for every calendar day."""
    days = windows.on_every_day(inputs.levels(spark, folder), "date", COUNTRY)
    return days.withColumn("median", windows.rolling_median(F.col("full"), "date", COUNTRY))


@query
def rolling_median_15min(spark, folder):
    """One series of quarter hours, worked on in blocks of 30 days."""
    return windows.long_rolling_median(inputs.quarter_hours(spark, folder), "energy", "date", days=30)


@query
def difference_15min(spark, folder):
    return windows.long_difference(inputs.quarter_hours(spark, folder), "energy", "date", days=30)


@query
def weeks_filled_in_blocks(spark, folder):
    """Empty weeks between the weeks of high amounts, in blocks of 70 days."""
    high = inputs.prices(spark, folder).where(F.col("full") > inputs.HIGH_PRICE)
    week = dates.week_end(F.to_date("time")).alias("week_end")
    weeks = high.groupBy("country", "status", week).agg(numbers.total(F.col("full")).alias("full"))
    gap = F.col("_gap")
    return windows.long_with_gaps(weeks, "week_end", 7, ["country", "status"], days=70).select(
        "country", "status", F.date_add("week_end", gap * 7).alias("week_end"), F.when(gap == 0, F.col("full")).otherwise(0.0).alias("full")
    )


@query
def day_over_day_diff(spark, folder):
    days = inputs.levels(spark, folder)
    return days.withColumn("change", windows.difference(F.col("full"), "date", COUNTRY))


@query
def latest_value(spark, folder):
    return windows.latest(inputs.levels(spark, folder), "full", "date", COUNTRY)


@query
def last_day_dropped(spark, folder):
    return windows.without_last_day(inputs.levels(spark, folder), "date", COUNTRY)


# --- seasonal tables


def _season_days(spark, folder) -> DataFrame:
    days = inputs.levels(spark, folder)
    return days.filter(~dates.leap_day(F.col("date"))).withColumn(
        "season_key", dates.month_day(F.col("date"))
    )


@query
def seasonal_envelope(spark, folder):
    history, current = season.calendar_span("date", SPAN)
    table = season.seasonal_table(
        _season_days(spark, folder), "season_key", "full", F.year("date"), SPAN.years,
        history, current, COUNTRY,
    )
    return season.newest_first(table, ["country", "season_key"])


@query
def season_outer_join(spark, folder):
    """The same table as a join of two tables that exist already."""
    days = _season_days(spark, folder)
    history, _ = season.calendar_span("date", SPAN)
    current = season.years_as_columns(days, "season_key", "full", F.year("date"), SPAN.years, COUNTRY)
    past = season.envelope(days, "season_key", "full", history, COUNTRY)
    table = season.join_season(current, past, "season_key", COUNTRY)
    return season.newest_first(table, ["country", "season_key"])


@query
def pivot_years(spark, folder):
    days = _season_days(spark, folder)
    return season.years_as_columns(
        days, "season_key", "full", F.year("date"), list(range(1995, 2002)), COUNTRY
    )


@query
def year_over_year(spark, folder):
    days = _season_days(spark, folder)
    table = season.year_over_year(
        days, "season_key", "full", F.year("date"), 1999, SPAN.years, COUNTRY
    )
    return season.newest_first(table, ["country", "season_key"], [])


# --- balance


@query
def flow_balance(spark, folder):
    return balance.flow_balance(inputs.balanced_flows(spark, folder), "direction", "value", "time", ["operator"])


@query
def flow_balance_join(spark, folder):
    flows = inputs.balanced_flows(spark, folder)
    sides = [
        aggregate.daily_sum(flows.filter(F.col("direction") == d), "value", "time", ["operator"])
        for d in ("import", "export")
    ]
    return balance.join_balance(*sides, "value", "date", ["operator"])


@query
def seasonal_weight_offset(spark, folder):
    days = balance.flow_balance(inputs.balanced_flows(spark, folder), "direction", "value", "time")
    weighted = balance.with_weights(days, "import", "date", OFFSET.reference_year)
    return balance.add_offset(weighted, "import", "date", OFFSET).select("date", "weight", "import")


@query
def weight_join(spark, folder):
    """The same weights from a separate table joined by month-day."""
    days = balance.flow_balance(inputs.balanced_flows(spark, folder), "direction", "value", "time")
    weights = balance.seasonal_weights(days, "import", "date", OFFSET.reference_year)
    weighted = balance.join_weights(days, weights, "date")
    return balance.add_offset(weighted, "import", "date", OFFSET).select("date", "weight", "import")


# --- quality


@query
def unit_check(spark, folder):
    checks = {"unit": F.lit(fixed.FLOW_UNIT)}
    report = quality.check_report(inputs.unit_flows(spark, folder), ["direction", "point"], checks)
    return report.withColumn("passes", F.col("passes").cast("int"))


@query
def flow_check(spark, folder):
    """Units and direction keys at once; keys of one import point are wrong from a day on."""
    report = quality.check_report(inputs.keyed_flows(spark, folder), ["direction", "point"], quality.flow_checks())
    return report.withColumn("passes", F.col("passes").cast("int"))


@query
def unit_quarantine(spark, folder):
    checks = {"unit": F.lit(fixed.FLOW_UNIT)}
    flows = quality.enforce_expected(inputs.unit_flows(spark, folder), checks, "quarantine")
    return aggregate.daily_sum(flows, "value", "time", ["direction", "point"])


@query
def unit_stop(spark, folder):
    checks = {"unit": F.lit(fixed.FLOW_UNIT)}
    order = {d: inputs.PRIORITIES for d in ("F", "O", "P")}
    flows = quality.enforce_expected(inputs.unit_flows(spark, folder), checks, "stop", order=order)
    return aggregate.daily_sum(flows, "value", "time", ["direction", "point"])


@query
def plausibility_gate(spark, folder):
    days = inputs.levels(spark, folder)
    both = [
        quality.plausibility(days, "full", "date", COUNTRY, mode).withColumn("mode", F.lit(mode))
        for mode in ("reference", "exclude_last")
    ]
    return aggregate.union_all(both).withColumn("plausible", F.col("plausible").cast("int"))


@query
def freshness_gate(spark, folder):
    weekly = generation.weekly_generation_report(
        inputs.positioned(spark, folder), SPAN, AS_OF, series=["unit"]
    )
    both = [
        quality.freshness(weekly, "week_num", "2001", AS_OF, ["unit"], iso=iso).withColumn(
            "rule", F.lit("iso" if iso else "first_monday")
        )
        for iso in (False, True)
    ]
    return aggregate.union_all(both).withColumn("fresh", F.col("fresh").cast("int"))


@query
def page_completeness(spark, folder):
    pages = inputs.table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("page"), F.col("l_linenumber").alias("last")
    )
    report = quality.page_completeness(pages, "page", "last", ["l_orderkey"])
    return report.withColumn("complete", F.col("complete").cast("int"))


@query
def page_drift(spark, folder):
    """Pages of two countries shift while they are fetched."""
    return quality.page_drift(inputs.shifting_pages(spark, folder), "page", "date", COUNTRY)


@query
def conflicting_readings(spark, folder):
    return quality.conflicting_readings(
        inputs.positioned(spark, folder), "date", "quantity", ["unit"]
    )


@query
def overlapping_rows(spark, folder):
    return quality.overlapping_rows(inputs.flows(spark, folder), ["direction", "operator", "time"])


# --- scalar functions


@query
def calendar_keys(spark, folder):
    day = F.col("date")
    days = inputs.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return days.select(
        "date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        dates.month_day(day).alias("month_day"),
        dates.on_display_year(dates.month_day(day), 2001).alias("shown_date"),
        dates.week_end(day).alias("week_end"),
        dates.iso_year_week(day).alias("year_week"),
        dates.part(dates.iso_year_week(day), 1).alias("week_num"),
        F.weekofyear(day).alias("week"),
        F.date_add(day, 1).alias("next_day"),
        dates.german_date(day).alias("german"),
        dates.monday_of_week(F.year(day), F.weekofyear(day)).alias("monday"),
        dates.monday_of_iso_week(dates.iso_year(day), F.weekofyear(day)).alias("iso_monday"),
    )


@query
def scalar_functions(spark, folder):
    orders = inputs.table(spark, folder, "orders")
    price, mid = F.col("o_totalprice"), F.lit(250_000.0)
    first = dates.part(F.col("o_orderpriority"), 0)
    level = F.round(price / 4000, 2)
    return orders.select(
        "o_orderkey",
        first.cast("int").alias("rank"),
        numbers.number(F.col("o_orderstatus"), lenient=True).alias("no_number"),
        numbers.or_zero(numbers.only_if(F.col("o_orderstatus") == "F", price)).alias("filled"),
        texts.decimal_comma(level).alias("comma"),
        numbers.one_digit(level).alias("one_digit"),
        numbers.percent_change(price, mid).alias("percent"),
    )


@query
def page_links(spark, folder):
    pages = inputs.table(spark, folder, "pages").select("page_id", "html")
    return web_links.page_links(pages, "html", "href", "^/[a-m]").select("page_id", "link")


# --- reports


def _gas_report(spark, folder) -> DataFrame:
    return gas_balance.gas_balance_report(
        inputs.balanced_flows(spark, folder), SPAN, time="time", offset=OFFSET, divisor=1_000
    )


@query
def gas_balance_report(spark, folder):
    return _gas_report(spark, folder)


@query
def gas_balance_by_operator(spark, folder):
    """The report for several series at once."""
    return gas_balance.gas_balance_report(
        inputs.balanced_flows(spark, folder), SPAN, time="time", offset=OFFSET,
        series=["operator"], divisor=1_000,
    )


@query
def storage_report(spark, folder):
    report = storage.storage_report(inputs.levels(spark, folder), SPAN)
    return report.withColumn("plausible", F.col("plausible").cast("int"))


@query
def weekly_generation_report(spark, folder):
    return generation.weekly_generation_report(inputs.positioned(spark, folder), SPAN, AS_OF)


@query
def weekly_envelope_15min(spark, folder):
    return generation.weekly_envelope(
        inputs.positioned(spark, folder, minutes=15), GRID_SPAN, "energy", "date",
        open_week=39, divisor=100,
    )


@query
def consumption_tables(spark, folder):
    return national_use.consumption_tables(
        inputs.national_use(spark, folder), inputs.final_use(spark, folder), "2000-01-01"
    )


@query
def month_vs_average(spark, folder):
    return month_compare.month_vs_average(
        inputs.positioned(spark, folder, minutes=15), "energy", "date",
        9, "2000-09-01", "2000-09-30 23:45:00", "2000-01-01",
    )


@query
def month_summary(spark, folder):
    return month_compare.summary_lines(
        month_vs_average(spark, folder), 9, "2000-09-01", "2000-09-30 23:45:00"
    )


@query
def annotations_table(spark, folder):
    titles = {p: f"Füllstand {p}: <u>%s Prozent</u>" for p in inputs.PRIORITIES}
    days = numbers.scaled(inputs.levels(spark, folder), ["full"], 100_000)
    return annotations.latest_annotations(days, "full", "date", "country", titles)


QUERIES["annotations"] = QUERIES.pop("annotations_table")


@query
def use_annotations(spark, folder):
    table = national_use.use_table(
        inputs.national_use(spark, folder), fixed.NATIONAL_USE_NAMES, "2000-01-01"
    )
    return annotations.use_annotations(table)


@query
def generation_annotations(spark, folder):
    weekly = generation.weekly_generation_report(
        inputs.positioned(spark, folder), SPAN, AS_OF, series=["unit"]
    )
    table = annotations.generation_annotations(weekly, "week_num", 2001, AS_OF, ["unit"])
    return table.withColumn("fresh", F.col("fresh").cast("int"))


@query
def gas_annotations(spark, folder):
    return annotations.gas_annotations(_gas_report(spark, folder), AS_OF)


# --- files: written from the tables, then read by the readers


@query
def source_gas_flow_csv(spark, folder):
    flows = gas_flows.read_flows(spark, landed.gas_flow_csv(spark, folder))
    return balance.flow_balance(flows, "direction", "value", "periodFrom")


@query
def source_flow_history(spark, folder):
    """New files and history in two column orders; no row of them is lost or read twice."""
    flows = gas_flows.read_flows(spark, *landed.gas_flow_history(spark, folder))
    return balance.flow_balance(flows, "direction", "value", "periodFrom")


@query
def source_flow_store(spark, folder):
    """History read into a store in two runs, the second of which opens the files that landed since."""
    store = scratch_folder(spark, "store")

    def run(path: str) -> None:
        gas_flows.collect_flows(spark, path, store)

    flows = gas_flows.read_flows(spark, *landed.gas_flow_runs(spark, folder, run), store=store)
    return balance.flow_balance(flows, "direction", "value", "periodFrom")


@query
def source_storage_pages(spark, folder):
    return storage_pages.levels(storage_pages.read_pages(spark, landed.storage_pages(spark, folder)))


@query
def source_page_check(spark, folder):
    """Below a folder whose name looks like a page, with a country that never landed."""
    pages = storage_pages.read_pages(spark, landed.storage_pages(spark, folder))
    report = storage_pages.completeness(pages, [*inputs.PRIORITIES, "6-MISSING"])
    return report.withColumn("complete", F.col("complete").cast("int"))


@query
def source_generation_xml(spark, folder):
    series = generation_xml.read_series(spark, landed.generation_xml(spark, folder))
    return generation_xml.readings(series)


@query
def source_national_use(spark, folder):
    records = use_source.read_national_use(spark, landed.national_use_json(spark, folder))
    return national_use.use_table(records, fixed.NATIONAL_USE_NAMES, "2000-01-01")


@query
def source_final_use(spark, folder):
    records = use_source.read_final_use(spark, landed.final_use_json(spark, folder))
    return national_use.use_table(records, fixed.FINAL_USE_NAMES, "2000-01-01")


@query
def source_grid_sheets(spark, folder):
    rows = grid_sheets.read_sheets(spark, landed.grid_sheets(spark, folder))
    day = F.to_date("date").alias("day")
    return rows.groupBy(day).agg(*[numbers.total(F.col(m)).alias(m) for m in fixed.grid_measures()])


@query
def source_grid_layouts(spark, folder):
    """Sheets of two layouts, the older one with other titles in another order."""
    layouts = [grid_sheets.own_layout(), grid_sheets.named_by_position(*landed.older_titles())]
    rows = grid_sheets.read_sheets(spark, landed.grid_layouts(spark, folder), layouts=layouts)
    day = F.to_date("date").alias("day")
    return rows.groupBy(day).agg(*[numbers.total(F.col(m)).alias(m) for m in fixed.grid_measures()])


@query
def sheet_headers(spark, folder):
    """The different headers of these sheets, one of which is not known without its layout."""
    report = grid_sheets.header_report(spark, landed.grid_layouts(spark, folder))
    return report.select(F.col("known").cast("int").alias("known"), "header", F.col("files").cast("long").alias("files"))


@query
def source_weekly_routes(spark, folder):
    wide = weekly_routes.read_weekly(spark, landed.weekly_routes(spark, folder))
    return weekly_routes.weekly_long(wide)


@query
def source_route_snapshots(spark, folder):
    return weekly_routes.read_snapshots(spark, f"{landed.route_snapshots(spark, folder)}/*")


@query
def source_route_store(spark, folder):
    """The same snapshots read into a store, each of them once."""
    store = scratch_folder(spark, "store")

    def run(path: str) -> None:
        weekly_routes.collect_snapshots(spark, f"{path}/*", store)

    path = landed.route_snapshots(spark, folder, run)
    return weekly_routes.collect_snapshots(spark, f"{path}/*", store)


@query
def sink_texts(spark, folder):
    """Texts with blanks, line breaks, quotes and commas, empty and NULL, written and read back."""
    table = inputs.texts(spark, folder)
    path = f"{scratch_folder(spark, 'texts')}/current"
    files.write_current(table, path, ["page_id"], ["kind", "part"])
    back = files.read_current(spark, path, table, ["kind", "part"])
    return back.select("page_id", "kind", F.col("text").isNull().cast("int").alias("missing"), F.md5("text").alias("digest"))


@query
def sink_snapshot(spark, folder):
    """A gated report written as snapshots of two days and as current files."""
    report = storage.storage_report(inputs.levels(spark, folder), SPAN)
    root = scratch_folder(spark, "published")
    for day in ("2001-08-01", "2001-08-01", "2001-08-02"):
        storage.publish(report, f"{root}/backups", f"{root}/data", day)
    passed = report.drop("plausible")
    days = [
        files.read_snapshot(spark, f"{root}/backups", day, passed, COUNTRY).withColumn("snapshot", F.lit(day))
        for day in ("2001-08-01", "2001-08-02")
    ]
    current = files.read_current(spark, f"{root}/data", passed, COUNTRY)
    return aggregate.union_all([*days, current.withColumn("snapshot", F.lit("current"))])


@query
def sink_row_order(spark, folder):
    """The place of each row in its written file: levels by day, and a season table by its key."""
    season_rows = _season_days(spark, folder).groupBy("country", "season_key").agg(F.count("full").alias("years"))
    out = []
    for table, key in ((inputs.levels(spark, folder), "date"), (season_rows, "season_key")):
        path = scratch_folder(spark, "ordered")
        files.write_current(table, path, [key], COUNTRY)
        names = [c for c in table.columns if c != "country"]
        lines = versions.current(
            spark, path, lambda folders, p=path: spark.read.option("basePath", f"{p}/versions").text(folders), COUNTRY
        )
        # a file is read by one task, in the order of its lines; the header is its first
        at = F.row_number().over(W.partitionBy("country").orderBy(F.monotonically_increasing_id())) - 1
        placed = lines.select("country", "value", at.alias("place")).where("place > 0")
        cell = F.from_csv("value", ", ".join(f"{n} STRING" for n in names))[key]
        out.append(placed.select("country", F.lit(key).alias("ordered_by"), "place", cell.alias("key")))
    return aggregate.union_all(out)


@query
def published_parts(spark, folder):
    """Levels published by country and year; then some of them again, then a write that fails before it is current."""
    days = inputs.levels(spark, folder).withColumn("year", F.year("date"))
    path = scratch_folder(spark, "parts")
    parts = ["country", "year"]
    files.write_current(days, path, ["date"], parts)
    again = days.where((F.col("country") < "3") & F.col("year").isin(1997, 1999)).withColumn("full", -F.col("full"))
    files.write_current(again, path, ["date"], parts)
    lost = days.withColumn("full", F.lit(0.0))
    _, version = versions.new_version(spark, path)
    lost.drop("year", "country").write.csv(f"{path}/versions/{versions.VERSION}={version}")
    return files.read_current(spark, path, days, parts)


@query
def daily_store_update(spark, folder):
    """The storage report from stored days after one year was stored again."""
    path = scratch_folder(spark, "days")
    prices = inputs.prices(spark, folder)
    daily_store.store_days(inputs.levels(spark, folder), path)
    latest_year = filters.within(prices, "time", "2001-01-01", "2001-12-31")
    daily_store.store_days(aggregate.daily_sum(latest_year, "full", "time", COUNTRY), path)
    report = storage.storage_report(daily_store.read_days(spark, path), SPAN)
    return report.withColumn("plausible", F.col("plausible").cast("int"))


@query
def daily_store_corrections(spark, folder):
    """Stored days of all pages, merged with those of a late page; only unread pages are opened."""
    store = scratch_folder(spark, "days")

    def run(path: str) -> None:
        jobs.refresh_storage_days(spark, path, store)

    run(landed.corrected_pages(spark, folder, run))
    return daily_store.read_days(spark, store)


@query
def season_state_report(spark, folder):
    """The storage report from current days and the state of the history, after a year of it was corrected."""
    store = scratch_folder(spark, "days")
    days = inputs.levels(spark, folder)
    daily_store.store_days(days, store)
    jobs.stored_storage_report(spark, store, SPAN)
    daily_store.store_days(days.where(F.year("date") == 1998).withColumn("full", F.col("full") * 2), store)
    report = jobs.stored_storage_report(spark, store, SPAN)
    return report.withColumn("plausible", F.col("plausible").cast("int"))
