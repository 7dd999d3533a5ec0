"""States of a history kept beside its daily store, a part per year and one merged state.

``years`` holds the states of each year; ``merged`` those of a whole history, for every end
of it that was asked for. Both are published as versions. A report of the current years
reads their days and the merged state; a corrected year reads its own days and the small
states of the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfolio.functions import dates
from wattfolio.operators import season_state
from wattfolio.operators.aggregate import union_all
from wattfolio.sinks import daily_store, versions
from wattfolio.sinks.files import computed

YEAR = "state_year"
KEY = "month_day"
# In the order they are published: a year whose season state is there has all of them.
KINDS = ("changes", "season")
SOURCE = "days_version"


def _publish(table: DataFrame, path: str, parts: Sequence[str]) -> None:
    versions.publish(computed(table), path, lambda t, folder: t.write.partitionBy(*parts).parquet(folder), parts)


def _read(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame | None:
    def read(folders: list[str]) -> DataFrame:
        return spark.read.option("basePath", f"{path}/versions").parquet(*folders)

    return versions.current(spark, path, read, parts)


def stale_years(spark: SparkSession, days: str, store: str, last: int) -> list[int]:
    """Years up to ``last`` whose days were stored again since their state was made, or that have none."""
    year = F.get_json_object("part", "$[0]").cast("int")
    known = versions.pointers(spark, days).select(year.alias(YEAR), F.col(versions.VERSION).alias(SOURCE))
    known = known.where(F.col(YEAR) <= last)
    states = _read(spark, f"{store}/years/{KINDS[-1]}", [YEAR])
    if states is not None:
        known = known.join(states.select(YEAR, SOURCE).distinct(), [YEAR, SOURCE], "left_anti")
    return [r[0] for r in known.select(YEAR).orderBy(YEAR).collect()]


def refresh(
    spark: SparkSession,
    days: str,
    store: str,
    years: Sequence[int],
    value: str = "full",
    date: str = "date",
    series: Sequence[str] = ("country",),
) -> None:
    """Make the states of ``years`` anew from the daily store ``days``; other years are not read."""
    year = F.get_json_object("part", "$[0]").cast("int")
    source = versions.pointers(spark, days).where(year.isin(list(years))).select(
        year.alias(YEAR), F.col(versions.VERSION).alias(SOURCE)
    )
    wanted = [daily_store.read_days(spark, days, y, y).withColumn(YEAR, F.lit(y)) for y in years]
    for kind in KINDS:
        parts = []
        for rows in wanted:
            if kind == "season":
                ordinary = rows.where(~dates.leap_day(F.col(date))).withColumn(KEY, dates.month_day(F.col(date)))
                parts.append(season_state.season_state(ordinary, KEY, value, [YEAR, *series]))
            else:
                parts.append(season_state.change_state(rows, value, date, [YEAR, *series]))
        _publish(union_all(parts).join(source, YEAR), f"{store}/years/{kind}", [YEAR])


def merge(spark: SparkSession, store: str, history_end: int, series: Sequence[str] = ("country",)) -> bool:
    """Merge the states of all years up to ``history_end`` into one; False if there is none."""
    for kind in KINDS:
        every = _read(spark, f"{store}/years/{kind}", [YEAR])
        past = None if every is None else every.where(F.col(YEAR) <= history_end)
        if past is None or past.isEmpty():
            return False
        if kind == "season":
            state = season_state.merged_season(past, KEY, series)
        else:
            state = season_state.merged_changes(past, series)
        _publish(state.withColumn("history_end", F.lit(history_end)), f"{store}/merged/{kind}", ["history_end"])
    return True


def merged(spark: SparkSession, store: str, kind: str, history_end: int) -> DataFrame:
    """The merged state of a history; asking for one that was not merged is an error."""
    every = _read(spark, f"{store}/merged/{kind}", ["history_end"])
    state = None if every is None else every.where(F.col("history_end") == history_end).drop("history_end")
    if state is None or state.isEmpty():
        raise ValueError(f"no merged state up to {history_end} in {store}")
    return state
