"""Wide weekly CSV files of gas routes and reverse flows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfolio.sources import headers, manifest

# Last part of a column name: a year, a statistic, or two digits of a year.
SUFFIX = re.compile(r"(.*?)_?(\d{4}|\d{2}|min|max)")
# A folder named by the day its files were fetched, alone or as ``key=day``.
FOLDER_DATE = r"[/=](\d{4}-\d{2}-\d{2})/[^/]*$"
SNAPSHOT = "snapshot_date"


def read_weekly(spark: SparkSession, path: str) -> DataFrame:
    """The wide table as text."""
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def series_period(name: str) -> tuple[str, str]:
    """Series and period that a column's name stands for; two digits are a year of this century."""
    found = SUFFIX.fullmatch(name)
    if not found:
        return "", ""
    series, period = found.groups()
    return series, f"20{period}" if len(period) == 2 else period


def _cell(name: str, text: Column) -> Column:
    series, period = series_period(name)
    return F.struct(F.lit(series).alias("series"), F.lit(period).alias("period"), text.alias("text"))


def _long(rows: DataFrame, keys: Sequence[str], week: Column, cells: Column) -> DataFrame:
    cut = rows.select(*keys, week.cast("int").alias("week"), cells.alias("cells")).where("week is not null")
    value = F.replace("text", F.lit(","), F.lit("")).cast("double").alias("value")
    return cut.select(*keys, "week", F.inline("cells")).select(*keys, "week", "series", "period", value)


def weekly_long(wide: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``week, series, period, value`` after ``keys``; blank rows are dropped, empty cells kept as NULL.

    ``keys`` are columns that do not come from the file, such as those of folders. Series
    and period come from the column names when the plan is built.
    """
    columns = [c for c in wide.columns if c not in ("week", *keys)]
    return _long(wide, keys, F.col("week"), F.array(*(_cell(c, F.col(f"`{c}`")) for c in columns)))


def _snapshots(text: DataFrame, files: DataFrame) -> DataFrame:
    found = headers.parsed(text, files)
    for names, example in zip(found.names, found.examples, strict=True):
        if "week" not in names:
            raise ValueError(f"no column week in some files, such as {example}")
    day = F.to_date(F.nullif(F.regexp_extract(headers.FILE, FOLDER_DATE, 1), F.lit("")))
    missing = F.raise_error(F.concat(F.lit("no day in the folder of "), headers.FILE)).cast("date")
    cells = found.cells(
        [[_cell(n, F.col(f"_row{k}")[n]) for n in names if n != "week"] for k, names in enumerate(found.names)]
    )
    rows = found.rows.withColumn(SNAPSHOT, F.coalesce(day, missing))
    return _long(rows, [headers.FILE, SNAPSHOT], found.column("week"), cells)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """``snapshot_date, week, series, period, value`` of files in folders named by their day.

    The files of one call are of one kind, told apart by a glob such as
    ``*/route_data_*.csv``; their columns may differ from day to day, all are read in one
    scan. A file outside of such a folder is an error.
    """
    return _snapshots(headers.lines(spark, path), manifest.with_headers(spark, path)).drop(headers.FILE)


def collect_snapshots(spark: SparkSession, path: str, store: str) -> DataFrame:
    """The same of all files read so far; only files that no run has read are opened (``manifest.collect``)."""

    def read(files: DataFrame, since: int) -> DataFrame:
        return _snapshots(headers.lines(spark, path, since), files)

    manifest.collect(spark, path, store, read)
    rows = manifest.collected(spark, store)
    if rows is None:
        raise ValueError(f"no file with a header in {path}")
    return rows
