"""Weekly sums of sub-daily readings against history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.functions import dates, numbers
from wattfolio.operators import aggregate, filters, season
from wattfolio.settings import SeasonSpan

WEEK = fixed.WEEK_KEY


def weekly_keys(weeks: DataFrame, week_end: str = "week_end") -> DataFrame:
    """ISO year-week, year and week number of the Sunday label."""
    year_week = dates.iso_year_week(F.col(week_end))
    return weeks.withColumn("year_week", year_week).withColumns(
        {"year": dates.part(F.col("year_week"), 0), WEEK: dates.part(F.col("year_week"), 1)}
    )


def week_span(
    span: SeasonSpan, as_of: str | None, week_end: str = "week_end"
) -> tuple[Column, Column]:
    """History and current weeks by their Sunday label.

    The Sunday that still belongs to the last ISO week of the year before
    ``first_year`` is in neither; weeks that end after ``as_of`` are incomplete.
    """
    end = F.col(week_end)
    history = end <= F.lit(span.history_end).cast("date")
    conditions = [
        end >= F.lit(span.first_day).cast("date"),
        F.col("year").cast("int").between(span.first_year, span.curr_year),
    ]
    if as_of is not None:
        conditions.append(end <= F.lit(as_of).cast("date"))
    return history, filters.every(*conditions)


def weekly_generation_report(
    readings: DataFrame,
    span: SeasonSpan,
    as_of: str,
    value: str = "quantity",
    time: str = "date",
    series: Sequence[str] = (),
    divisor: float = fixed.MWH_PER_GWH,
    revisions: str = "reference",
    age: str = "age",
) -> DataFrame:
    """Weeks 01 to 52 of the current years with the statistics of the history.

    Repeated readings go first. That is the one full shuffle of this report, on
    series, time and value, so that no series or week gathers in one task. Of different
    readings for one time all count, or with ``revisions="newest"`` the one of the newest
    document, by the column ``age``.
    """
    single = aggregate.without_repeats(readings, time, value, series, revisions, age)
    typed = single.withColumn(value, F.col(value).cast("int"))
    weeks = aggregate.weekly_sum(typed, value, time, series)
    weeks = weekly_keys(numbers.scaled(weeks, [value], divisor))
    history, current = week_span(span, as_of)
    table = season.seasonal_table(
        filters.numbered_weeks(weeks, WEEK),
        WEEK,
        value,
        F.col("year").cast("int"),
        span.years,
        history,
        current,
        series,
    )
    return season.newest_first(table, [*series, WEEK])


def weekly_envelope(
    readings: DataFrame,
    span: SeasonSpan,
    value: str,
    time: str,
    open_week: int | None = None,
    series: Sequence[str] = (),
    divisor: float = fixed.KWH_PER_GWH,
) -> DataFrame:
    """The same comparison for 15-minute grid readings and one current year.

    ``open_week`` is a started week whose current value is left out.
    """
    weeks = aggregate.weekly_sum(readings, value, time, series)
    weeks = weeks.withColumns(
        {WEEK: F.weekofyear("week_end"), "year": dates.iso_year(F.col("week_end"))}
    )
    history, current = week_span(span, None)
    table = season.seasonal_table(
        weeks, WEEK, value, F.col("year"), span.years, history, current, series
    )
    numeric = [c for c in table.columns if c not in (*series, WEEK)]
    table = numbers.scaled(table, numeric, divisor)
    if open_week is not None:
        table = season.mask_cells(table, F.col(WEEK) == open_week, str(span.curr_year))
    return season.newest_first(table, [*series, WEEK])
