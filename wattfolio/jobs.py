"""Daily jobs: landed files in, published tables and annotations out.

Each function is a whole run. From the shell, with any spark-submit options::

    spark-submit --py-files wattfolio.zip run.py storage --input /landed/storage \\
        --output /published --year 2023 --as-of 2023-12-20
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.operators import aggregate, filters, quality
from wattfolio.plans import annotations, gas_balance, generation, month_compare, national_use, storage
from wattfolio.session import recommend
from wattfolio.settings import Offset, SeasonSpan
from wattfolio.sinks import daily_store, files, season_store
from wattfolio.sources import (
    gas_flows,
    generation_xml,
    grid_sheets,
    manifest,
    storage_pages,
    web_links,
    weekly_routes,
)
from wattfolio.sources import national_use as use_source


def run_gas(
    spark: SparkSession,
    path: str,
    output: str,
    span: SeasonSpan,
    as_of: str,
    history: str | None = None,
    mode: str = "fail",
    check_history: bool = True,
    offset: Offset | None = None,
    store: str | None = None,
) -> None:
    """With ``history`` the new files count from the first current year on.

    Rows that history and new files both hold count twice; they are listed below ``checks``.
    With ``store`` each history file is opened once and its rows are kept there.
    """
    start = span.first_day if history else None
    flows = gas_flows.read_flows(
        spark, path, history, mode, check_history, start=start, end=span.last_day, store=store
    )
    report = files.computed(gas_balance.gas_balance_report(flows, span, offset=offset))
    files.write_current(report, f"{output}/data/gas_use", [gas_balance.KEY], ready=True)
    notes = annotations.gas_annotations(report, as_of)
    files.write_current(notes, f"{output}/annotations/gas_use", [])
    if history:
        twice = quality.overlapping_rows(flows, ["direction", "point", "operatorLabel", "periodFrom"])
        files.write_table(twice, f"{output}/checks/gas_overlaps")


def refresh_storage_days(spark: SparkSession, path: str, store: str, year: int | None = None) -> list[int]:
    """Merge the days of pages that were not read yet into the store; the years that changed.

    With ``year`` only days of that year are taken from the pages.
    """
    changed: list[int] = []

    def keep(days: DataFrame) -> None:
        if year is not None:
            days = filters.within(days, "date", f"{year}-01-01", f"{year}-12-31")
        changed.extend(daily_store.merge_days(days, store, ["country"]))

    storage_pages.collect_levels(spark, path, f"{store}/ledger", keep)
    return changed


def stored_storage_report(spark: SparkSession, store: str, span: SeasonSpan, mode: str = "reference") -> DataFrame:
    """The report from the current days and the state of the history; states of changed years are made anew first.

    A history that does not end with the year before the current ones is read in full.
    """
    states, end = f"{store}/states", span.first_year - 1
    if span.history_end == f"{end:04d}-12-31":
        if changed := season_store.stale_years(spark, store, states, end):
            season_store.refresh(spark, store, states, changed)
        if season_store.merge(spark, states, end):
            return storage.storage_report_from_state(spark, store, states, span, mode=mode)
    return storage.storage_report(daily_store.read_days(spark, store), span, mode=mode)


def run_storage(
    spark: SparkSession,
    path: str,
    output: str,
    span: SeasonSpan,
    as_of: str,
    mode: str = "reference",
    need_all_pages: bool = True,
    store: str | None = None,
    year: int | None = None,
    countries: Sequence[str] = (),
) -> None:
    """The gate holds back a series in whole: no snapshot, no result, no note.

    Pages must be complete for the countries that landed, and for all of ``countries``; pages
    of one fetch must not share days, as rows that shift between two requests do. With
    ``store`` the daily levels are kept there, pages are opened once, and the report starts
    from the stored days; with ``year`` the pages renew that year only.
    """
    if store is None:
        pages = storage_pages.read_pages(spark, path)
        landed, records = pages, storage_pages.records(pages)
        days = storage_pages.levels(pages)
        report = storage.storage_report(days, span, mode=mode)
    else:
        refresh_storage_days(spark, path, store, year)
        landed, records = manifest.collected(spark, f"{store}/ledger"), None
        report = stored_storage_report(spark, store, span, mode)
    if need_all_pages:
        missing = storage_pages.completeness(landed, countries).filter(~F.col("complete"))
        if not missing.isEmpty():
            raise ValueError("some storage pages have not landed")
        if records is not None:
            shifted = quality.page_drift(records, "page", "date", ["country"]).where("overlap > 0")
            if not shifted.isEmpty():
                raise ValueError("storage pages share days: rows shifted while they were fetched")
    backups = f"{output}/backups/storage"
    storage.publish(report, backups, f"{output}/data/storage", as_of)
    passed = files.read_snapshot(spark, backups, as_of, report.drop("plausible"), ["country"])
    notes = annotations.season_annotations(passed, storage.KEY, span.curr_year, "country")
    files.write_current(notes, f"{output}/annotations/storage", [], ["country"])


def run_generation(
    spark: SparkSession,
    path: str,
    output: str,
    span: SeasonSpan,
    as_of: str,
    zone: str = "UTC",
    minutes: int | None = None,
    revisions: str = "reference",
) -> None:
    """Files are always written; only the note depends on freshness.

    Times with different values are listed below ``checks``; all of them count, or with
    ``revisions="newest"`` the one of the file written last.
    """
    readings = generation_xml.readings(generation_xml.read_series(spark, path), zone, minutes, with_age=True)
    report = generation.weekly_generation_report(readings, span, as_of, revisions=revisions)
    backups = f"{output}/backups/generation"
    files.publish(report, backups, f"{output}/data/generation", as_of, [generation.WEEK])
    written = files.read_snapshot(spark, backups, as_of, report)
    notes = annotations.generation_annotations(written, generation.WEEK, span.curr_year, as_of)
    files.write_current(notes, f"{output}/annotations/generation", [])
    conflicts = quality.conflicting_readings(readings, "date", "quantity")
    files.write_table(conflicts, f"{output}/checks/generation_conflicts")


def run_national_use(
    spark: SparkSession,
    national_path: str,
    final_path: str,
    output: str,
    start: str = fixed.USE_START,
) -> None:
    national = national_use.use_table(
        use_source.read_national_use(spark, national_path), fixed.NATIONAL_USE_NAMES, start
    )
    final = national_use.use_table(
        use_source.read_final_use(spark, final_path), fixed.FINAL_USE_NAMES, start
    )
    national = files.computed(national)
    files.write_current(national, f"{output}/data/landesverbrauch", ["date"], ready=True)
    files.write_current(final, f"{output}/data/endverbrauch", ["date"])
    notes = annotations.use_annotations(national)
    files.write_current(notes, f"{output}/annotations/use", ["usage"])


def run_grid(
    spark: SparkSession,
    path: str,
    output: str,
    span: SeasonSpan,
    as_of: str,
    measure: str = "endverbrauchte_energie",
    open_week: int | None = None,
    layouts: Sequence[grid_sheets.Layout] | None = None,
) -> None:
    report = generation.weekly_envelope(
        grid_sheets.read_sheets(spark, path, layouts=layouts), span, measure, "date", open_week
    )
    files.publish(
        report, f"{output}/backups/grid", f"{output}/data/grid", as_of, [generation.WEEK]
    )


def run_month(
    spark: SparkSession,
    path: str,
    output: str,
    start: str,
    end: str,
    history_before: str,
    measure: str = "endverbrauchte_energie",
    layouts: Sequence[grid_sheets.Layout] | None = None,
) -> None:
    """The month of ``start`` up to ``end`` against the same month of the years before ``history_before``."""
    month = date.fromisoformat(start[:10]).month
    readings = grid_sheets.read_sheets(spark, path, layouts=layouts)
    row = month_compare.month_vs_average(readings, measure, "date", month, start, end, history_before)
    row = files.computed(row)
    files.write_current(row, f"{output}/data/month", [], ready=True)
    files.write_current(month_compare.summary_lines(row, month, start, end), f"{output}/annotations/month", [])


def run_routes(spark: SparkSession, path: str, output: str, dated: bool = False, store: str | None = None) -> None:
    """Weekly routes as a long table, stored as Parquet; ``dated`` keeps the day of each folder.

    With ``store`` each dated file is opened once and its rows are kept there.
    """
    if dated and store:
        long = weekly_routes.collect_snapshots(spark, path, store)
    elif dated:
        long = weekly_routes.read_snapshots(spark, path)
    else:
        long = weekly_routes.weekly_long(weekly_routes.read_weekly(spark, path))
    files.write_table(long, f"{output}/data/routes")


def run_links(
    pages: DataFrame, output: str, name: str = "title", pattern: str = "^Download data$"
) -> None:
    links = web_links.page_links(pages, "html", name, pattern)
    files.write_table(links, f"{output}/data/links")


def arguments_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="wattfolio")
    parser.add_argument(
        "job", choices=["gas", "storage", "generation", "national-use", "grid", "month", "routes", "links"]
    )
    parser.add_argument("--input", required=True)
    parser.add_argument("--second-input", help="history files of gas, final use of national-use")
    parser.add_argument("--output", required=True)
    parser.add_argument("--year", type=int, help="current year")
    parser.add_argument("--as-of", help="day of the run, yyyy-mm-dd")
    parser.add_argument("--mode", help="unit check of gas, gate of storage")
    parser.add_argument("--unchecked-history", action="store_true", help="append the history of gas as it is")
    parser.add_argument("--offset-total", type=float, default=Offset.total, help="yearly amount added to gas")
    parser.add_argument("--offset-year", type=int, default=Offset.reference_year, help="year whose shares spread it")
    parser.add_argument("--offset-start", default=Offset.start, help="first day it is added to")
    parser.add_argument("--store", help="folder of what was read before: days of storage, history of gas, dated routes")
    parser.add_argument("--renew-year", type=int, help="only year the pages of storage renew")
    parser.add_argument("--some-pages", action="store_true", help="run storage though pages are missing")
    parser.add_argument("--countries", default="", help="countries that storage must hold, with commas between")
    parser.add_argument("--zone", default="UTC", help="zone of the times of generation")
    parser.add_argument("--revisions", choices=aggregate.REVISIONS, default="reference", help="readings of generation that differ")
    parser.add_argument("--minutes", type=int, help="step of generation in place of the documents' own")
    parser.add_argument("--measure", default="endverbrauchte_energie", help="column of grid and month")
    parser.add_argument("--layouts", help="JSON file of known sheet headers: a list of objects with titles and measures")
    parser.add_argument("--open-week", type=int, help="started week of grid")
    parser.add_argument("--start", help="first time of month")
    parser.add_argument("--end", help="last time of month")
    parser.add_argument("--history-before", help="end of the earlier years of month")
    parser.add_argument("--dated", action="store_true", help="routes lie in folders named by their day")
    return parser


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = arguments_parser()
    given = parser.parse_args(arguments)

    def needed(*names: str) -> list:
        values = [getattr(given, n) for n in names]
        if None in values:
            parser.error(f"{given.job} needs " + " and ".join("--" + n.replace("_", "-") for n in names))
        return values

    def seasonal() -> tuple[SeasonSpan, str]:
        year, as_of = needed("year", "as_of")
        return SeasonSpan(curr_year=year), as_of

    def layouts() -> list[grid_sheets.Layout] | None:
        if given.layouts is None:
            return None
        entries = json.loads(Path(given.layouts).read_text(encoding="utf-8"))
        return [grid_sheets.named_by_position(e["titles"], e["measures"]) for e in entries]

    spark = spark or recommend(SparkSession.builder.appName(f"wattfolio {given.job}")).getOrCreate()
    if given.job == "gas":
        offset = Offset(given.offset_total, given.offset_year, given.offset_start)
        run_gas(
            spark, given.input, given.output, *seasonal(), given.second_input, given.mode or "fail",
            not given.unchecked_history, offset, given.store,
        )
    elif given.job == "storage":
        run_storage(
            spark, given.input, given.output, *seasonal(), given.mode or "reference", not given.some_pages,
            given.store, given.renew_year, [c for c in given.countries.split(",") if c],
        )
    elif given.job == "generation":
        run_generation(spark, given.input, given.output, *seasonal(), given.zone, given.minutes, given.revisions)
    elif given.job == "national-use":
        run_national_use(spark, given.input, *needed("second_input"), given.output)
    elif given.job == "grid":
        run_grid(spark, given.input, given.output, *seasonal(), given.measure, given.open_week, layouts())
    elif given.job == "month":
        run_month(spark, given.input, given.output, *needed("start", "end", "history_before"), given.measure, layouts())
    elif given.job == "routes":
        run_routes(spark, given.input, given.output, given.dated, given.store)
    else:
        run_links(spark.read.parquet(given.input), given.output)
