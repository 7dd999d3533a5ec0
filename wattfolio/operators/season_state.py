"""Statistics of a history as states that can be merged.

A year of daily rows becomes two small tables: sum, count, maximum and minimum for each
series and season key, and for each series what the plausibility gate needs, the first
and last day and the bounds of its daily changes. States of several years merge into one of
the same form, so the statistics of any history need its states and not its days. A
corrected year replaces its own state, then the states are merged again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.functions import numbers
from wattfolio.operators import quality, season
from wattfolio.operators.windows import by_series

SUM, COUNT, MOST, LEAST = "state_sum", "state_count", "state_maximum", "state_minimum"
PARTS = [SUM, COUNT, MOST, LEAST]


def season_state(long: DataFrame, key: str, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """The state of each season key; NULL values count for nothing, NaN is NULL."""
    known = numbers.number(F.col(value))
    return long.groupBy(*groups, key).agg(
        F.sum(known).alias(SUM), F.count(known).alias(COUNT), F.max(known).alias(MOST), F.min(known).alias(LEAST)
    )


def merged_season(states: DataFrame, key: str, groups: Sequence[str] = ()) -> DataFrame:
    """One state of each season key out of several."""
    return states.groupBy(*groups, key).agg(
        F.sum(SUM).alias(SUM), F.sum(COUNT).alias(COUNT), F.max(MOST).alias(MOST), F.min(LEAST).alias(LEAST)
    )


def state_statistics() -> list[Column]:
    """Mean, maximum and minimum of a state, as ``season.statistics`` gives them from rows."""
    return [
        F.try_divide(SUM, COUNT).alias(fixed.MEAN),
        F.col(MOST).alias(fixed.MAXIMUM),
        F.col(LEAST).alias(fixed.MINIMUM),
    ]


def season_from_state(current: DataFrame, state: DataFrame, key: str, series: Sequence[str] = ()) -> DataFrame:
    """Year columns beside the statistics of a state: the full outer join on the season key."""
    return season.join_season(current, state.select(*series, key, *state_statistics()), key, series)


def change_state(daily: DataFrame, value: str, date: str, groups: Sequence[str] = ()) -> DataFrame:
    """First and last day of each group, and the bounds of the changes between its days."""
    change = F.col(value) - F.lag(value).over(by_series(groups, date))
    return daily.withColumn("_change", change).groupBy(*groups).agg(
        F.min(date).alias("first_day"),
        F.min_by(value, date).alias("first_value"),
        F.max(date).alias("last_day"),
        F.max_by(value, date).alias("last_value"),
        F.max("_change").alias("max_diff"),
        F.min("_change").alias("min_diff"),
    )


def merged_changes(states: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """One state of each series out of states of spans of days that do not overlap.

    The change from the last day of a span to the first day of the next one counts too.
    """
    step = F.col("first_value") - F.lag("last_value").over(by_series(series, "first_day"))
    return states.withColumn("_step", step).groupBy(*series).agg(
        F.min("first_day").alias("first_day"),
        F.min_by("first_value", "first_day").alias("first_value"),
        F.max("last_day").alias("last_day"),
        F.max_by("last_value", "last_day").alias("last_value"),
        F.max(F.greatest("max_diff", "_step")).alias("max_diff"),
        F.min(F.least("min_diff", "_step")).alias("min_diff"),
    )


def gate_from_state(
    daily: DataFrame, state: DataFrame, value: str, date: str, series: Sequence[str] = (), mode: str = "reference"
) -> DataFrame:
    """``quality.plausibility`` of days that follow a history known by its state.

    The history's last day stands before the days, so the first of them has a change; its
    bounds join those of the days. A series of the history without later days is judged as
    well: its last change is then unknown, and it does not pass.
    """
    ends = state.select(*series, F.col("last_day").alias(date), F.col("last_value").alias(value))
    days = daily.select(*series, date, value).unionByName(ends)
    judged = quality.plausibility(days, value, date, series, mode)
    past = state.select(*(F.col(s).alias(f"_of_{s}") for s in series), F.col("max_diff").alias("_max"), F.col("min_diff").alias("_min"))
    same = F.lit(True)
    for s in series:
        same = same & F.col(s).eqNullSafe(F.col(f"_of_{s}"))
    both = judged.join(past, same, "left").withColumns(
        {"max_diff": F.greatest("max_diff", "_max"), "min_diff": F.least("min_diff", "_min")}
    )
    gate = quality.gate(F.col("max_diff"), F.col("min_diff"), F.col("last_diff"))
    return both.select(*judged.columns).withColumn("plausible", gate)
