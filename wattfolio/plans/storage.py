"""Storage levels: current years against history, with a plausibility gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.functions import dates
from wattfolio.operators import filters, quality, season, season_state
from wattfolio.settings import SeasonSpan
from wattfolio.sinks import daily_store, files, season_store

KEY = fixed.STORAGE_KEY


def storage_report(
    daily: DataFrame,
    span: SeasonSpan,
    value: str = "full",
    date: str = "date",
    series: Sequence[str] = ("country",),
    mode: str = "reference",
) -> DataFrame:
    """Season table of all series at once, with ``plausible`` per series.

    The gate is a window over each series and the season table an aggregate on
    top of it: both use the partitioning by series, the source is read once.
    """
    judged = quality.with_plausibility(daily, value, date, series, mode)
    month_day = dates.month_day(F.col(date))
    history, current = season.calendar_span(date, span)
    table = season.seasonal_table(
        judged.filter(~dates.leap_day(F.col(date))).withColumn(
            KEY, dates.on_display_year(month_day, span.curr_year)
        ),
        KEY,
        value,
        F.year(date),
        span.years,
        history,
        current,
        series,
        carry=[F.bool_and("plausible").alias("plausible")],
    )
    return season.newest_first(table, [*series, KEY], [*season.STATISTICS, "plausible"])


def storage_report_from_state(
    spark: SparkSession,
    days: str,
    states: str,
    span: SeasonSpan,
    value: str = "full",
    date: str = "date",
    series: Sequence[str] = ("country",),
    mode: str = "reference",
) -> DataFrame:
    """The same report from the days of the current years and the merged state of the history before them.

    Of the daily store only the folders of the current years are read. The history must end
    with the year before ``first_year``, as its state holds whole years.
    """
    end = span.first_year - 1
    if span.history_end != f"{end:04d}-12-31":
        raise ValueError("the history must end with the year before the first current one")
    daily = daily_store.read_days(spark, days, span.first_year, span.curr_year)
    changes = season_store.merged(spark, states, "changes", end)
    gate = season_state.gate_from_state(daily, changes, value, date, series, mode).select(*series, "plausible")
    month_day = dates.month_day(F.col(date))
    current = season.years_as_columns(
        daily.filter(~dates.leap_day(F.col(date))).withColumn(KEY, dates.on_display_year(month_day, span.curr_year)),
        KEY, value, F.year(date), span.years, series,
    )
    shown = dates.on_display_year(F.col(season_store.KEY), span.curr_year)
    past = season_store.merged(spark, states, "season", end).withColumn(KEY, shown).drop(season_store.KEY)
    table = season_state.season_from_state(current, past, KEY, series)
    judged = table.join(gate.select(*(F.col(s).alias(f"_of_{s}") for s in series), "plausible"),
                        filters.every(*(F.col(s).eqNullSafe(F.col(f"_of_{s}")) for s in series)), "left")
    judged = judged.select(*table.columns, "plausible")
    return season.newest_first(judged, [*series, KEY], [*season.STATISTICS, "plausible"])


def publish(
    report: DataFrame,
    snapshot_path: str,
    current_path: str,
    snapshot_date: str,
    series: Sequence[str] = ("country",),
) -> None:
    """Write the series that passed the gate; the others keep their last files."""
    passed = report.filter("plausible").drop("plausible")
    files.publish(passed, snapshot_path, current_path, snapshot_date, [KEY], series)
