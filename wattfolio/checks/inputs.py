"""General tables brought into the shapes the library works on.

=========  ==========================================================
orders     daily levels; the order priority is the country
lineitem   flows: flag N is import, R export; sub-daily readings by
           ship date and line number
events     readings with a position inside a period
pages      stored web pages
=========  ==========================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.functions import dates
from wattfolio.operators import aggregate
from wattfolio.settings import Offset, SeasonSpan

SPAN = SeasonSpan(curr_year=2001, history_end="1999-12-31", first_year=2000)
GRID_SPAN = SeasonSpan(curr_year=2000, history_end="1999-12-31", first_year=2000)
OFFSET = Offset(total=fixed.OFFSET_TOTAL, reference_year=1997, start="1997-01-01")
AS_OF = "2001-08-01"
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
HIGH_PRICE = 400_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def prices(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("country"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("time"),
        F.col("o_totalprice").alias("full"),
    )


def levels(spark: SparkSession, folder: str) -> DataFrame:
    return aggregate.daily_sum(prices(spark, folder), "full", "time", ["country"])


def balanced_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Imports and exports alone, chosen by a column of the table so that the choice reaches the scan."""
    return table(spark, folder, "lineitem").filter(F.col("l_returnflag").isin("N", "R"))


def balanced_flows(spark: SparkSession, folder: str) -> DataFrame:
    return _flows(balanced_lines(spark, folder))


def flows(spark: SparkSession, folder: str) -> DataFrame:
    """All rows; the third flag is a direction of its own."""
    return _flows(table(spark, folder, "lineitem"))


def _flows(rows: DataFrame) -> DataFrame:
    flag = F.col("l_returnflag")
    return rows.select(
        F.when(flag == "N", "import").when(flag == "R", "export").otherwise("transit").alias("direction"),
        F.col("l_linestatus").alias("operator"),
        F.col("l_shipdate").alias("time"),
        F.col("l_quantity").alias("value"),
    )


def positioned(spark: SparkSession, folder: str, minutes: int = 60) -> DataFrame:
    """Readings of a day placed by their position in it."""
    return table(spark, folder, "lineitem").select(
        F.col("l_linestatus").alias("unit"),
        dates.at_position(F.col("l_shipdate"), F.col("l_linenumber"), minutes).alias("date"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
        F.col("l_extendedprice").alias("energy"),
        F.col("l_orderkey").alias("age"),
    )


def unit_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Flows by status and priority; high ones of three points are in another unit."""
    status, rank = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    odd_point = ((status == "F") & (rank == "3")) | ((status == "O") & (rank >= "4"))
    odd = odd_point & (F.col("o_totalprice") > HIGH_PRICE)
    return table(spark, folder, "orders").select(
        F.col("o_orderstatus").alias("direction"),
        F.col("o_orderpriority").alias("point"),
        F.when(odd, "MWh/d").otherwise(fixed.FLOW_UNIT).alias("unit"),
        F.col("o_orderdate").alias("time"),
        F.col("o_totalprice").alias("value"),
    )


def keyed_flows(spark: SparkSession, folder: str) -> DataFrame:
    """All lines by direction and line number; the imports of point 3 carry the key of exports from 1998 on."""
    line = table(spark, folder, "lineitem")
    flag = F.col("l_returnflag")
    wrong = (F.col("l_linenumber") == 3) & (F.col("l_shipdate") >= "1998-01-01")
    return line.select(
        F.when(flag == "N", "import").when(flag == "R", "export").otherwise("transit").alias("direction"),
        F.col("l_linenumber").alias("point"),
        F.lit(fixed.FLOW_UNIT).alias("unit"),
        F.when((flag == "N") & ~wrong, fixed.IMPORT_DIRECTION_KEY).otherwise(fixed.EXPORT_DIRECTION_KEY).alias("directionKey"),
    )


def aged_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Readings by the hour; the order they come with is their document, and a greater number a later one."""
    return positioned(spark, folder).withColumn("unit", F.lit("all")).select("unit", "date", "quantity", "age")


def quarter_hours(spark: SparkSession, folder: str) -> DataFrame:
    """One long series of sums by quarter hours."""
    return positioned(spark, folder, minutes=15).groupBy("date").agg(F.sum("energy").alias("energy"))


def shifting_pages(spark: SparkSession, folder: str, size: int = 300) -> DataFrame:
    """Days on pages of 300, newest first; while two countries are fetched, rows come and go after page 1.

    A row that comes moves the last row of page 1 to page 2 as well; one that goes moves the
    first row of page 2 to page 1, which was fetched before.
    """
    rank = F.row_number().over(W.partitionBy("country").orderBy(F.desc("date")))
    days = levels(spark, folder).select("country", "date", rank.alias("rank"))
    came = F.array(F.col("rank") - 1, F.col("rank"))
    spots = F.when((F.col("country") == "2-HIGH") & (F.col("rank") == size), came)
    spots = spots.when((F.col("country") == "2-HIGH") & (F.col("rank") > size), F.array("rank"))
    spots = spots.when((F.col("country") == "5-LOW") & (F.col("rank") == size + 1), F.array().cast("array<int>"))
    spots = spots.when((F.col("country") == "5-LOW") & (F.col("rank") > size + 1), F.array(F.col("rank") - 2))
    spots = spots.otherwise(F.array(F.col("rank") - 1))
    return days.select("country", "date", F.explode(spots).alias("spot")).select(
        "country", "date", (F.floor(F.col("spot") / size) + 1).cast("int").alias("page")
    )


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Whole pages, and what files tend to change in a text, by kind; a part holds up to 1000 pages."""
    html = F.col("html")
    kinds = {
        "page": html,
        "blanks": F.concat(F.lit("    "), F.col("url"), F.lit("  ")),
        "break": F.concat(F.col("url"), F.lit("\n")),
        "quotes": F.concat(F.lit('say "'), F.col("url"), F.lit('", twice')),
        "empty": F.lit(""),
        "missing": F.lit(None).cast("string"),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("text")) for k, v in kinds.items()])
    part = F.floor(F.col("page_id") / 1000).alias("part")
    return table(spark, folder, "pages").select("page_id", part, F.inline(rows))


def exact_mean(amount: Column) -> Column:
    """Mean of amounts with two digits from whole cents, the same in any order of rows."""
    return F.sum(F.round(amount * 100).cast("bigint")) / F.count(amount) / 100


def national_use(spark: SparkSession, folder: str) -> DataFrame:
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return (
        table(spark, folder, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .agg(
            F.sum(F.when(status == "F", price)).alias("landesverbrauch"),
            F.sum(F.when(status == "O", price)).alias("landesverbrauchGeschaetzt"),
            F.sum(F.when(status == "P", price)).alias("landesverbrauchPrognose"),
            exact_mean(price).alias("fiveYearMittelwert"),
            F.min(price).alias("fiveYearMin"),
            F.max(price).alias("fiveYearMax"),
        )
    )


def final_use(spark: SparkSession, folder: str) -> DataFrame:
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("date"))
        .agg(
            F.sum(F.when(F.col("l_linestatus") == "O", quantity)).alias("endverbrauch"),
            F.sum(F.when(F.col("l_linestatus") == "F", quantity)).alias("prognoseMittelwert"),
            exact_mean(price).alias("fiveYearMittelwert"),
            F.min(price).alias("fiveYearMin"),
            F.max(price).alias("fiveYearMax"),
        )
    )
