"""Generation documents in XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfolio.functions import dates

# A declared array takes a single Period or Point element as an array of one.
SCHEMA = (
    "Period array<struct<timeInterval: struct<start: string>, resolution: string, "
    "Point: array<struct<position: int, quantity: string>>>>"
)
# Minutes between two points.
RESOLUTIONS = {"PT15M": 15, "PT30M": 30, "PT60M": 60, "PT1H": 60, "P1D": 1440}
AGE = "age"
START_FORMAT = "yyyy-MM-dd'T'HH:mmX"


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """A row per series, with the age of its document. One task reads a whole document, so documents must stay small (a year of points).

    A document's age is the time its file was written, in microseconds: a later one revises
    those before.
    """
    series = (
        spark.read.format("xml")
        .schema(SCHEMA)
        .option("rowTag", "TimeSeries")
        .option("mode", "FAILFAST")
        .load(path)
    )
    return series.select("Period", F.unix_micros("_metadata.file_modification_time").alias(AGE))


def minutes_of(resolution: Column) -> Column:
    """Minutes of a resolution; an unknown one is an error."""
    known = F.create_map(*(F.lit(x) for pair in RESOLUTIONS.items() for x in pair))
    failed = F.concat(F.lit("unknown resolution: "), F.coalesce(resolution, F.lit("none")))
    return F.coalesce(F.try_element_at(known, resolution), F.raise_error(failed).cast("int"))


def readings(
    series: DataFrame, zone: str = "UTC", minutes: int | None = None, with_age: bool = False
) -> DataFrame:
    """One row per point of all periods, with the time computed from its position.

    Steps are those of the period's resolution; ``minutes`` overrides them. ``with_age``
    keeps the age of the document, for ``aggregate.newest_readings``.
    ``quantity`` stays text here: repeated readings are compared as written.
    """
    age = [AGE] if with_age else []
    periods = series.select(*age, F.explode("Period").alias("_period"))
    start = dates.in_zone(F.col("_period.timeInterval.start"), START_FORMAT, zone)
    step = minutes_of(F.col("_period.resolution")) if minutes is None else F.lit(minutes)
    points = periods.select(*age, start.alias("_start"), step.alias("_step"), F.explode("_period.Point").alias("_point"))
    return points.select(
        dates.at_position(F.col("_start"), F.col("_point.position"), F.col("_step")).alias("date"),
        F.col("_point.quantity").alias("quantity"),
        *age,
    )
