"""Filters on dates, values and positions.

Bounds are written on the column itself, so Spark moves them into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattfolio import fixed


def within(df: DataFrame, time: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows from the day ``start`` to the day ``end``, both included."""
    if start is not None:
        df = df.filter(F.col(time) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(time) < F.date_add(F.lit(end).cast("date"), 1))
    return df


def filled(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def every(*conditions: Column) -> Column:
    """All conditions hold."""
    joined = F.lit(True)
    for condition in conditions:
        joined = joined & condition
    return joined


def numbered_weeks(season: DataFrame, week: str, last: str = fixed.LAST_WEEK) -> DataFrame:
    """Weeks up to ``last``: the first 52 rows, by their number and not by place."""
    return season.filter(F.col(week) <= last)


def some(*conditions: Column) -> Column:
    """True if at least one condition holds; none given: false."""
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out
