"""Titles, notes and dates shown with a chart, as a table by series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.functions import dates, texts
from wattfolio.operators import quality, windows


def latest_annotations(
    daily: DataFrame,
    value: str,
    date: str,
    series: str,
    titles: dict[str, str] = fixed.STORAGE_TITLES,
    note: str = fixed.STORAGE_NOTE,
) -> DataFrame:
    """Title with the latest value and note with its date, one row per series."""
    last = windows.latest(daily, value, date, [series])
    shown = texts.decimal_comma(F.col(value))
    return last.select(
        series,
        date,
        shown.alias("latest_value"),
        F.replace(texts.template_of(F.col(series), titles), F.lit("%s"), shown).alias("title"),
        texts.filled(note, dates.german_date(F.col(date))).alias("note"),
    )


def season_annotations(
    season: DataFrame,
    key: str,
    year: int,
    series: str,
    titles: dict[str, str] = fixed.STORAGE_TITLES,
    note: str = fixed.STORAGE_NOTE,
) -> DataFrame:
    """The same from a finished season table and its current year column."""
    rows = season.select(series, F.to_date(key).alias("date"), F.col(f"`{year}`").alias("value"))
    return latest_annotations(rows, "value", "date", series, titles, note)


def use_annotations(national: DataFrame, filled: str = "Verbrauch geschätzt") -> DataFrame:
    """Notes of both national use charts; both carry the date of the first table."""
    last = windows.latest(national, filled, "date")
    updated = F.date_add("date", 1)
    shown = dates.german_date(updated)
    notes = {"landesverbrauch": fixed.NATIONAL_USE_NOTE, "endverbrauch": fixed.FINAL_USE_NOTE}
    rows = F.array(
        *[F.struct(F.lit(u).alias("usage"), texts.filled(n, shown).alias("note")) for u, n in notes.items()]
    )
    return last.select(updated.alias("last_updated"), F.inline(rows))


def run_note(note: str, as_of: str) -> Column:
    """Note dated by the day of the run."""
    return texts.filled(note, dates.german_date(F.lit(as_of).cast("date")))


def generation_annotations(
    season: DataFrame, week: str, year: int, as_of: str, series: Sequence[str] = ()
) -> DataFrame:
    """Freshness per series, and the note to publish; NULL for a stale series."""
    fresh = quality.freshness(season, week, str(year), as_of, series)
    return fresh.withColumn("note", F.when(F.col("fresh"), run_note(fixed.GENERATION_NOTE, as_of)))


def gas_annotations(season: DataFrame, as_of: str, series: Sequence[str] = ()) -> DataFrame:
    """The note of the gas use chart, one row per series."""
    return season.groupBy(*series).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "note", run_note(fixed.GAS_NOTE, as_of)
    )
