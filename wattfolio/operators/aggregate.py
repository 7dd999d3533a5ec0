"""Sums per day and week, duplicates, totals and shares.

The raw table is met only by hash aggregates with a map-side part, so a series
that holds a third of all rows sends one partial row per task and group into the
shuffle, not its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattfolio.functions import dates, numbers
from wattfolio.operators.windows import whole_series, with_gaps


def daily_sum(
    readings: DataFrame, value: str, time: str, series: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """Sum of all readings of a day; a day with only missing values sums to 0."""
    return (
        readings.filter(F.col(time).isNotNull())
        .groupBy(*series, F.to_date(time).alias(date))
        .agg(numbers.total(F.col(value)).alias(value))
    )


def weekly_sum(
    readings: DataFrame, value: str, time: str, series: Sequence[str] = (), week_end: str = "week_end"
) -> DataFrame:
    """Sum per week, labelled by the Sunday that ends it; empty weeks are 0."""
    weeks = (
        readings.filter(F.col(time).isNotNull())
        .groupBy(*series, dates.week_end(F.to_date(time)).alias(week_end))
        .agg(numbers.total(F.col(value)).alias(value))
    )
    return fill_weeks(weeks, value, week_end, series)


def fill_weeks(
    weeks: DataFrame, value: str, week_end: str, series: Sequence[str] = ()
) -> DataFrame:
    """Add the weeks missing between the first and last week of each series as 0."""
    gap = F.col("_gap")
    return with_gaps(weeks, week_end, 7, series).select(
        *series,
        F.date_add(week_end, gap * 7).alias(week_end),
        F.when(gap == 0, F.col(value)).otherwise(0.0).alias(value),
    )


def drop_repeats(readings: DataFrame, time: str, value: str, series: Sequence[str] = ()) -> DataFrame:
    """Keep one of several equal ``(time, value)`` readings.

    Values are compared as they stand (text before any cast). Two different
    values at one time are both kept and count both: see ``newest_readings`` and
    ``quality.conflicting_readings``.
    """
    return readings.select(*series, time, value).distinct()


def newest_readings(
    readings: DataFrame, time: str, value: str, age: str, series: Sequence[str] = ()
) -> DataFrame:
    """One reading for each time: that of the newest document, by ``age``.

    An unknown age is the oldest; of readings of one age the greatest value stays, so the
    result does not depend on the order of rows. A newer reading without a value replaces
    an older one that has one: it was withdrawn. One hash-partitioned aggregate with a
    map-side part, on a key as fine as that of ``drop_repeats``.
    """
    return readings.groupBy(*series, time).agg(F.max_by(value, F.struct(age, value)).alias(value))


REVISIONS = ("reference", "newest")


def without_repeats(
    readings: DataFrame, time: str, value: str, series: Sequence[str] = (), mode: str = "reference", age: str = "age"
) -> DataFrame:
    """Readings for sums: ``reference`` drops equal ones alone, ``newest`` keeps one for each time."""
    if mode == "reference":
        return drop_repeats(readings, time, value, series)
    if mode == "newest":
        return newest_readings(readings, time, value, age, series)
    raise ValueError(f"mode must be one of {REVISIONS}")


def mean_of_sums(
    readings: DataFrame,
    value: str,
    inner: dict[str, Column],
    outer: Sequence[str],
    mean: str = "mean",
) -> DataFrame:
    """Sum per inner group, then the mean of these sums per outer group."""
    return (
        readings.groupBy(*[c.alias(n) for n, c in inner.items()])
        .agg(numbers.total(F.col(value)).alias("_sum"))
        .groupBy(*outer)
        .agg(F.avg("_sum").alias(mean))
    )


def totals(readings: DataFrame, value: str, series: Sequence[str] = ()) -> DataFrame:
    """Sum, maximum and minimum of each series."""
    clean = numbers.number(F.col(value))
    return readings.groupBy(*series).agg(
        numbers.total(F.col(value)).alias("total"),
        F.max(clean).alias("maximum"),
        F.min(clean).alias("minimum"),
    )


def share_of_total(
    daily: DataFrame, value: str, series: Sequence[str] = (), share: str = "share"
) -> DataFrame:
    """Each row's part of the sum of its series; NULL where that sum is 0."""
    whole = numbers.total_over(F.col(value), whole_series(series))
    return daily.withColumn(share, F.try_divide(F.col(value), whole))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
