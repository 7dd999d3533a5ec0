"""Seasonal tables: years side by side with statistics of a history.

A seasonal table is one hash aggregate by season key. Its year cells and its
statistics are conditional aggregates of the same pass, which gives the rows of a
full outer join of the pivoted years with the statistics without computing the
input twice. ``join_season`` is that join for two tables made elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.settings import SeasonSpan

STATISTICS = [fixed.MEAN, fixed.MAXIMUM, fixed.MINIMUM]


def only_cell(value: Column, condition: Column, label: str) -> Column:
    """The value of the one row that fits; more than one such row is an error."""
    repeated = F.raise_error(F.lit(f"more than one value for a season key in {label}"))
    return F.when(F.count_if(condition) > 1, repeated.cast("double")).otherwise(
        F.max(F.when(condition, value))
    )


def year_cells(value: Column, year: Column, years: Iterable[int], current: Column) -> list[Column]:
    return [
        only_cell(value, current & (year == y), str(y)).alias(str(y))
        for y in sorted(years, reverse=True)
    ]


def statistics(value: Column, history: Column | None = None) -> list[Column]:
    past = value if history is None else F.when(history, value)
    return [
        F.avg(past).alias(fixed.MEAN),
        F.max(past).alias(fixed.MAXIMUM),
        F.min(past).alias(fixed.MINIMUM),
    ]


def seasonal_table(
    long: DataFrame,
    key: str,
    value: str,
    year: Column,
    years: Iterable[int],
    history: Column,
    current: Column,
    series: Sequence[str] = (),
    carry: Sequence[Column] = (),
) -> DataFrame:
    """Newest year first, then the statistics of the history, per season key.

    ``history`` and ``current`` choose the rows for statistics and year cells;
    ``current`` must hold rows of ``years`` only. A key of either side is kept.
    Bounds on the date in them reach the scan. ``carry`` adds further aggregates.
    """
    return (
        long.filter(history | current)
        .groupBy(*series, key)
        .agg(
            *year_cells(F.col(value), year, years, current),
            *statistics(F.col(value), history),
            *carry,
        )
    )


def calendar_span(date: str, span: SeasonSpan) -> tuple[Column, Column]:
    """Rows of the history and of the current years, as bounds on the date."""
    day = F.col(date)
    history = day <= F.lit(span.history_end).cast("date")
    current = day.between(
        F.lit(span.first_day).cast("date"), F.lit(span.last_day).cast("date")
    )
    return history, current


def envelope(
    long: DataFrame, key: str, value: str, history: Column, series: Sequence[str] = ()
) -> DataFrame:
    """Mean, maximum and minimum of the history per season key."""
    return long.filter(history).groupBy(*series, key).agg(*statistics(F.col(value)))


def years_as_columns(
    long: DataFrame,
    key: str,
    value: str,
    year: Column,
    years: Iterable[int],
    series: Sequence[str] = (),
) -> DataFrame:
    """Strict pivot: one column per year, an error for a repeated cell."""
    years = list(years)
    wanted = year.isin(years)
    return (
        long.filter(wanted)
        .groupBy(*series, key)
        .agg(*year_cells(F.col(value), year, years, wanted))
    )


def join_season(
    current: DataFrame, past: DataFrame, key: str, series: Sequence[str] = ()
) -> DataFrame:
    """Full outer join of year columns with statistics on the season key."""
    return current.join(past, [*series, key], "full_outer")


def year_over_year(
    long: DataFrame,
    key: str,
    value: str,
    year: Column,
    reference_year: int,
    years: Iterable[int],
    series: Sequence[str] = (),
) -> DataFrame:
    """Years against one reference year; keys that year lacks are dropped."""
    every = sorted({*years, reference_year})
    return (
        long.filter(year.isin(every))
        .groupBy(*series, key)
        .agg(
            *year_cells(F.col(value), year, every, F.lit(True)),
            F.count_if(year == reference_year).alias("_reference"),
        )
        .filter(F.col("_reference") > 0)
        .drop("_reference")
    )


def newest_first(df: DataFrame, leading: Sequence[str], last: Sequence[str] = STATISTICS) -> DataFrame:
    """Order columns: keys, other columns in descending order, statistics."""
    middle = [c for c in df.columns if c not in (*leading, *last)]
    tail = [c for c in last if c in df.columns]
    return df.select(*leading, *sorted(middle, reverse=True), *tail)


def mask_cells(df: DataFrame, at: Column, column: str) -> DataFrame:
    """Set a column to NULL in the rows chosen by ``at``."""
    return df.withColumn(column, F.when(~F.coalesce(at, F.lit(False)), F.col(column)))
