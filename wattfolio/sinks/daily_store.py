"""The daily table kept as Parquet by year.

Reports, gate and annotations all start from the same daily sums. Stored, these
are computed once, survive lost executors, and a later run needs the readings of
the years it refreshes only. Every write is a new version of the years it holds
(``sinks.versions``): readers see all of them change at once, or none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfolio.operators import filters
from wattfolio.session import scratch_folder
from wattfolio.sinks import versions

PART = "stored_year"


def store_days(daily: DataFrame, path: str, date: str = "date") -> None:
    """Write daily rows; every year among them is replaced, others are kept.

    The input must hold its years in full. Rebalancing sizes the files: a year
    with many series is split over tasks, a small one is one file.
    """

    def write(table: DataFrame, folder: str) -> None:
        table.hint("rebalance", PART).write.partitionBy(PART).parquet(folder)

    versions.publish(_computed(daily.withColumn(PART, F.year(date))), path, write, [PART])


def merge_days(daily: DataFrame, path: str, keys: Sequence[str], date: str = "date") -> list[int]:
    """Store single days: each replaces the stored day of its keys, all other days are kept.

    Returns the years that were written anew. Only these are read from the store. A day
    given twice is an error.
    """
    spark = daily.sparkSession
    new = _computed(daily.withColumn(PART, F.year(date)))
    years = [r[0] for r in new.select(PART).distinct().orderBy(PART).collect()]
    if not years:
        return []
    key = [*keys, date]
    twice = new.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    if not twice.isEmpty():
        raise ValueError(f"a day is given twice: {twice.first()}")
    stored = _read(spark, path)
    if stored is not None:
        ids = new.select(*(F.col(k).alias(f"_new_{k}") for k in key))
        same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in key]
        renewed = filters.some(*(F.col(PART).eqNullSafe(F.lit(y).cast("int")) for y in years))
        kept = stored.where(renewed).join(ids, filters.every(*same), "left_anti")
        new = new.unionByName(kept)
    store_days(new.drop(PART), path, date)
    return years


def _computed(table: DataFrame) -> DataFrame:
    path = scratch_folder(table.sparkSession, "days")
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    def read(folders: list[str]) -> DataFrame:
        return spark.read.option("basePath", f"{path}/versions").parquet(*folders)

    return versions.current(spark, path, read, [PART])


def read_days(
    spark: SparkSession, path: str, first_year: int | None = None, last_year: int | None = None
) -> DataFrame:
    """Stored daily rows; bounds on the year skip whole folders."""
    stored = _read(spark, path)
    if stored is None:
        raise ValueError(f"no days are stored in {path}")
    if first_year is not None:
        stored = stored.filter(F.col(PART) >= first_year)
    if last_year is not None:
        stored = stored.filter(F.col(PART) <= last_year)
    return stored.drop(PART)
