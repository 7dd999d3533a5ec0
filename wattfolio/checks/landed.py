"""Source files written from the general tables, to be read back by the readers.

Each writer first brings the table to the grain of the real source, so a file or
an array holds a bounded number of records: days of a year, 300 records of a page.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wattfolio import fixed
from wattfolio.checks import inputs
from wattfolio.functions import dates
from wattfolio.operators import aggregate
from wattfolio.session import scratch_folder

PAGE_SIZE = 300


def _shown(time: str, day: str, after: str = "") -> Column:
    """Day in a format and clock time to the minute, without any time zone."""
    clock = F.substring(F.col(time).cast("string"), 12, 5)
    return F.concat(F.date_format(F.to_date(time), day), clock, F.lit(after))


def _gas_flows(spark: SparkSession, folder: str) -> DataFrame:
    line = inputs.table(spark, folder, "lineitem")
    imported = F.col("l_returnflag") == "N"
    day = F.col("day")
    return (
        line.groupBy(
            F.when(imported, "import").when(F.col("l_returnflag") == "R", "export").otherwise("transit").alias("direction"),
            F.when(F.col("l_linestatus") == "O", "Oltingue")
            .otherwise(fixed.SINGLE_OPERATOR_POINT)
            .alias("point"),
            F.when(F.col("l_linenumber") > 2, fixed.SINGLE_OPERATOR)
            .otherwise("Open Grid Europe")
            .alias("operatorLabel"),
            F.to_date("l_shipdate").alias("day"),
        )
        .agg(F.sum("l_quantity").alias("value"))
        .select(
            "direction",
            "point",
            F.lit("extra").alias("indicator"),
            F.col("point").alias("pointLabel"),
            "operatorLabel",
            F.when(F.col("direction") == "import", fixed.IMPORT_DIRECTION_KEY)
            .otherwise(fixed.EXPORT_DIRECTION_KEY)
            .alias("directionKey"),
            F.date_format(day, "yyyy-MM-dd '06:00:00'").alias("periodFrom"),
            F.date_format(F.date_add(day, 1), "yyyy-MM-dd '06:00:00'").alias("periodTo"),
            "value",
            F.lit(fixed.FLOW_UNIT).alias("unit"),
        )
    )


def _flow_files(flows: DataFrame, path: str) -> None:
    flows.write.mode("append").option("header", True).partitionBy("direction", "point").csv(path)


def gas_flow_csv(spark: SparkSession, folder: str) -> str:
    path = scratch_folder(spark, "flows")
    _flow_files(_gas_flows(spark, folder), path)
    return path


def _history_parts(flows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """History until 1996 in the columns of new files, and from 1997 to 1999 in another order with one more."""
    year = F.substring("periodFrom", 1, 4).cast("int")
    other = flows.withColumn("flowStatus", F.lit("Confirmed")).select(*sorted({*flows.columns, "flowStatus"}, reverse=True))
    return flows.where(year <= 1996), other.where(year.between(1997, 1999))


def gas_flow_history(spark: SparkSession, folder: str) -> tuple[str, str]:
    """New files from 2000 on, and history in two column orders."""
    new, old = scratch_folder(spark, "flows"), scratch_folder(spark, "history")
    flows = _gas_flows(spark, folder)
    _flow_files(flows.where(F.substring("periodFrom", 1, 4).cast("int") >= 2000), new)
    for part in _history_parts(flows):
        _flow_files(part, old)
    return new, old


def gas_flow_runs(spark: SparkSession, folder: str, run: Callable[[str], None]) -> tuple[str, str]:
    """The same, but the second part of the history lands after ``run`` was called for the first one."""
    new, old = scratch_folder(spark, "flows"), scratch_folder(spark, "history")
    flows = _gas_flows(spark, folder)
    _flow_files(flows.where(F.substring("periodFrom", 1, 4).cast("int") >= 2000), new)
    first, second = _history_parts(flows)
    _flow_files(first, old)
    run(old)
    _flow_files(second, old)
    return new, old


def storage_pages(spark: SparkSession, folder: str) -> str:
    path = scratch_folder(spark, "page9")
    _page_files(inputs.levels(spark, folder), path)
    return path


def generation_xml(spark: SparkSession, folder: str) -> str:
    """One series per day with two periods: the odd positions by hours, the even ones by half hours."""
    path = scratch_folder(spark, "generation")
    number = F.col("l_linenumber").cast("int")
    # counted so that both periods give each position the time it had by hours
    position = F.when(number % 2 == 0, 2 * number - 1).otherwise(number)
    (
        inputs.table(spark, folder, "lineitem")
        .groupBy("l_shipdate", "l_linenumber")
        .agg(F.sum("l_quantity").cast("int").cast("string").alias("quantity"))
        .withColumn("half", F.col("l_linenumber") % 2 == 0)
        .groupBy("l_shipdate", "half")
        .agg(F.collect_list(F.struct(position.alias("position"), "quantity")).alias("Point"))
        .select(
            "l_shipdate",
            F.struct(
                F.struct(
                    _shown("l_shipdate", "yyyy-MM-dd'T'", "Z").alias("start")
                ).alias("timeInterval"),
                F.when(F.col("half"), "PT30M").otherwise("PT60M").alias("resolution"),
                "Point",
            ).alias("period"),
        )
        .groupBy("l_shipdate")
        .agg(F.collect_list("period").alias("Period"))
        .select("Period")
        .write.format("xml")
        .option("rootTag", "GL_MarketDocument")
        .option("rowTag", "TimeSeries")
        .save(path)
    )
    return path


def _records_by_year(days: DataFrame) -> DataFrame:
    record = F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        *[c for c in days.columns if c != "date"],
    )
    return days.groupBy(F.year("date").alias("year")).agg(F.collect_list(record).alias("entries"))


def national_use_json(spark: SparkSession, folder: str) -> str:
    path = scratch_folder(spark, "national")
    years = _records_by_year(inputs.national_use(spark, folder))
    years.write.partitionBy("year").json(path)
    return path


def final_use_json(spark: SparkSession, folder: str) -> str:
    path = scratch_folder(spark, "final")
    years = _records_by_year(inputs.final_use(spark, folder))
    years.select("year", F.to_json("entries").alias("value")).write.partitionBy("year").text(path)
    return path


def _grid_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Year, time and measures of the 15-minute rows as text, below a row of units for each year."""
    measures = fixed.grid_measures()
    stamps = (
        inputs.positioned(spark, folder, minutes=15)
        .groupBy("date")
        .agg(F.sum("energy").alias("energy"), F.count(F.lit(1)).alias("n"))
    )
    filled = {m: F.col("n") * i for i, m in enumerate(measures)} | {measures[0]: F.col("energy")}
    rows = stamps.select(
        F.year("date").alias("year"),
        _shown("date", "dd.MM.yyyy ").alias("date"),
        *[filled[m].cast("string").alias(m) for m in measures],
    )
    units = rows.select("year").distinct().select(
        "year", F.lit("Zeitstempel").alias("date"), *[F.lit("kWh").alias(m) for m in measures]
    )
    return aggregate.union_all([units, rows])


def _sheet_files(rows: DataFrame, path: str) -> None:
    rows.repartition("year").write.mode("append").option("header", True).partitionBy("year").csv(path)


def grid_sheets(spark: SparkSession, folder: str) -> str:
    """A sheet per year: header, a row of units, then the 15-minute rows."""
    path = scratch_folder(spark, "grid")
    _sheet_files(_grid_rows(spark, folder), path)
    return path


def older_titles() -> tuple[list[str], list[str]]:
    """Titles of older sheets, and the measures in their order: the last ten stand first."""
    measures = fixed.grid_measures()
    moved = measures[-10:] + measures[:-10]
    return ["Zeit", *(f"Summe {m.replace('_', ' ')} (kWh)" for m in moved)], moved


def grid_layouts(spark: SparkSession, folder: str) -> str:
    """The same sheets; those before 1998 have other titles and another order."""
    path = scratch_folder(spark, "grid")
    rows = _grid_rows(spark, folder)
    titles, moved = older_titles()
    names = [F.col(c).alias(t) for c, t in zip(["date", *moved], titles, strict=True)]
    _sheet_files(rows.where("year < 1998").select("year", *names), path)
    _sheet_files(rows.where("year >= 1998"), path)
    return path


ROUTES = {"O": "Nord Stream", "F": "Yamal (BY,PL)"}
ROUTE_YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]


def _routes(spark: SparkSession, folder: str, years: list[int]) -> DataFrame:
    """Weeks as rows, route and year as columns, numbers with thousands commas."""
    end = dates.week_end(F.to_date("l_shipdate"))
    cell = F.col("l_quantity")
    year = dates.iso_year(end)
    unknown = F.raise_error(F.concat(F.lit("no column for the year "), year.cast("string"))).cast("int")
    known = F.when(year.isin(ROUTE_YEARS), year).otherwise(unknown)
    return (
        inputs.table(spark, folder, "lineitem")
        .select("l_linestatus", "l_quantity", F.weekofyear(end).alias("week"), known.alias("year"))
        .groupBy("week")
        .agg(
            *[
                F.format_number(
                    F.sum(F.when((F.col("l_linestatus") == s) & (F.col("year") == y), cell)), 0
                ).alias(f"{name}_{y}")
                for s, name in ROUTES.items()
                for y in years
            ]
        )
    )


def weekly_routes(spark: SparkSession, folder: str) -> str:
    path = scratch_folder(spark, "routes")
    _routes(spark, folder, ROUTE_YEARS).write.option("header", True).csv(path)
    return path


# Snapshots of the route table: the day, and the years it knows by then.
ROUTE_SNAPSHOTS = {"2001-01-10": ROUTE_YEARS[:-1], "2002-01-09": ROUTE_YEARS}


def route_snapshots(spark: SparkSession, folder: str, run: Callable[[str], None] | None = None) -> str:
    """Snapshots of two days; ``run`` is called between them."""
    path = scratch_folder(spark, "routes")
    for day, years in ROUTE_SNAPSHOTS.items():
        _routes(spark, folder, years).write.option("header", True).csv(f"{path}/{day}")
        if run is not None and day == min(ROUTE_SNAPSHOTS):
            run(path)
    return path


def _page_files(days: DataFrame, path: str) -> None:
    """One object per page of 300 days, newest day first."""
    by_country = W.partitionBy("country")
    rank = F.row_number().over(by_country.orderBy(F.desc("date")))
    (
        days.withColumn("page", F.ceil(rank / PAGE_SIZE).cast("int"))
        .withColumn("last_page", F.max("page").over(by_country))
        .groupBy("country", "page", "last_page")
        .agg(
            F.collect_list(
                F.struct(
                    F.date_format("date", "yyyy-MM-dd").alias("gasDayStart"),
                    F.format_string("%.2f", "full").alias("full"),
                )
            ).alias("data")
        )
        .write.mode("append")
        .partitionBy("country", "page")
        .json(path)
    )


def corrected_pages(spark: SparkSession, folder: str, run: Callable[[str], None]) -> str:
    """Pages of all days; after ``run`` one page more of each country lands, with the doubled levels of March 1997."""
    path = scratch_folder(spark, "pages")
    days = inputs.levels(spark, folder)
    _page_files(days, path)
    run(path)
    march = days.where((F.year("date") == 1997) & (F.month("date") == 3))
    _page_files(march.withColumn("full", F.col("full") * 2), path)
    return path
