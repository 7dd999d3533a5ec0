"""Storage level pages, JSON files below ``country=...`` folders (S3, Q4)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattfolio.functions import numbers
from wattfolio.operators.aggregate import newest_readings
from wattfolio.operators.quality import page_completeness
from wattfolio.sources import manifest
from wattfolio.sources.headers import FILE

SCHEMA = T.StructType(
    [
        T.StructField("last_page", T.IntegerType()),
        T.StructField(
            "data",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("gasDayStart", T.StringType()),
                        T.StructField("full", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)
PAGE_NUMBER = r"/country=[^/]*/(?:.*/)?page[-_=]?(\d+)[^/]*(?:/[^/]*)?$"


def read_pages(spark: SparkSession, path: str, page_number: str = PAGE_NUMBER) -> DataFrame:
    """One row per landed page; its number is taken from the path below ``country=``.

    One task reads a whole page, so pages must stay small.
    """
    raw = spark.read.schema(SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return raw.select(
        "country",
        F.regexp_extract("_metadata.file_path", page_number, 1).cast("int").alias("page"),
        "last_page",
        "data",
    )


def levels(pages: DataFrame, lenient: bool = False) -> DataFrame:
    """Fill level per country and day from the records of all pages."""
    full = F.col("record.full")
    return pages.select("country", F.explode("data").alias("record")).select(
        "country",
        F.to_date("record.gasDayStart").alias("date"),
        numbers.number(full, lenient).alias("full"),
    )


def records(pages: DataFrame) -> DataFrame:
    """Country, page and day of each record, for ``quality.page_drift``."""
    days = pages.select("country", "page", F.explode("data").alias("record"))
    return days.select("country", "page", F.to_date("record.gasDayStart").alias("date"))


def collect_levels(
    spark: SparkSession,
    path: str,
    ledger: str,
    keep: Callable[[DataFrame], None],
    lenient: bool = False,
    page_number: str = PAGE_NUMBER,
) -> bool:
    """Read the pages that no run has read as they are now, and hand their levels on; False if there are none.

    The ledger keeps the records with their pages (``manifest.collected``), for ``completeness``.
    ``keep`` gets (country, date, full), one row a day: that of the page that landed last. It
    must store them so that a second time changes nothing, as pages are noted in the ledger
    after it: a run that fails in between reads them again.
    """

    def read(files: DataFrame, since: int) -> DataFrame:
        raw = spark.read.schema(SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)
        raw = raw.where(F.col("_metadata.file_modification_time") >= F.timestamp_micros(F.lit(since)))
        number = F.regexp_extract("_metadata.file_path", page_number, 1).cast("int")
        pages = raw.select("country", number.alias("page"), "last_page", "data", F.col("_metadata.file_path").alias(FILE))
        pages = pages.join(files.select(F.col("file").alias(FILE), "modified"), FILE)
        record = pages.select(FILE, "modified", "country", "page", "last_page", F.explode_outer("data").alias("record"))
        return record.select(
            FILE, "modified", "country", "page", "last_page", F.to_date("record.gasDayStart").alias("date"),
            numbers.number(F.col("record.full"), lenient).alias("full"),
        )

    def newest(rows: DataFrame) -> None:
        days = rows.where("date is not null")
        keep(newest_readings(days, "date", "full", "modified", ["country"]))

    return manifest.collect(spark, path, ledger, read, with_header=False, keep=newest)


def completeness(pages: DataFrame, countries: Sequence[str] = ()) -> DataFrame:
    """Whether all pages of each country have landed; one of ``countries`` without any page has not."""
    report = page_completeness(pages, "page", "last_page", ["country"])
    if not countries:
        return report
    expected = pages.sparkSession.createDataFrame([(c,) for c in countries], "country string")
    return report.join(expected, "country", "full").select(
        "country",
        F.coalesce("pages", F.lit(0)).alias("pages"),
        "last_page",
        F.coalesce("complete", F.lit(False)).alias("complete"),
    )
