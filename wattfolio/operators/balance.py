"""Imports against exports with a weighted offset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.functions import dates, numbers
from wattfolio.operators.windows import whole_series
from wattfolio.settings import Offset


def single_operator(
    direction: Column,
    point: Column,
    operator: Column,
    only_point: str = fixed.SINGLE_OPERATOR_POINT,
    only_operator: str = fixed.SINGLE_OPERATOR,
) -> Column:
    """At one import point one operator counts; exports keep all of them."""
    return (direction != "import") | (point != only_point) | operator.eqNullSafe(F.lit(only_operator))


def flow_balance(
    flows: DataFrame,
    direction: str,
    value: str,
    time: str,
    series: Sequence[str] = (),
    incoming: str = "import",
    outgoing: str = "export",
    date: str = "date",
) -> DataFrame:
    """Daily imports with the exports of the same day, in one aggregate.

    Only days with an import row appear. A day without any export row has a
    NULL export and a NULL difference; it does not count as 0.
    """
    is_in = F.col(direction) == incoming
    is_out = F.col(direction) == outgoing
    amount = F.col(value)
    sums = (
        flows.filter(F.col(direction).isin(incoming, outgoing) & F.col(time).isNotNull())
        .groupBy(*series, F.to_date(time).alias(date))
        .agg(
            numbers.total(F.when(is_in, amount)).alias("import"),
            F.when(F.count_if(is_out) > 0, numbers.total(F.when(is_out, amount))).alias("export"),
            F.count_if(is_in).alias("_imports"),
        )
    )
    return sums.filter(F.col("_imports") > 0).select(
        *series, date, "import", "export", (F.col("import") - F.col("export")).alias("diff")
    )


def join_balance(
    imports: DataFrame, exports: DataFrame, value: str, date: str, series: Sequence[str] = ()
) -> DataFrame:
    """The same balance from two daily tables that exist already."""
    left = imports.withColumnRenamed(value, "import")
    right = exports.withColumnRenamed(value, "export")
    return left.join(right, [*series, date], "left").select(
        *series, date, "import", "export", (F.col("import") - F.col("export")).alias("diff")
    )


def seasonal_weights(
    daily: DataFrame, value: str, date: str, year: int, series: Sequence[str] = ()
) -> DataFrame:
    """Share of each month-day in the total of one year."""
    whole = numbers.total_over(F.col(value), whole_series(series))
    return daily.filter(
        F.col(date).between(F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date"))
    ).select(
        *series,
        dates.month_day(F.col(date)).alias("month_day"),
        F.try_divide(F.col(value), whole).alias("weight"),
    )


def join_weights(
    daily: DataFrame, weights: DataFrame, date: str, series: Sequence[str] = ()
) -> DataFrame:
    """Left join of a weight table by month-day.

    No broadcast hint: the table has up to 366 rows per series, so Spark decides
    by its measured size.
    """
    keyed = daily.withColumn("month_day", dates.month_day(F.col(date)))
    return keyed.join(weights, [*series, "month_day"], "left").drop("month_day")


def with_weights(
    daily: DataFrame, value: str, date: str, year: int, series: Sequence[str] = ()
) -> DataFrame:
    """Put the reference year's shares beside every day, without a join.

    All windows share the partitioning by series, so the balance is computed
    once and shuffled once.
    """
    in_year = F.year(date) == year
    whole = numbers.total_over(F.when(in_year, F.col(value)), whole_series(series))
    same_day = whole_series([*series, "_month_day"])
    return (
        daily.withColumn("_month_day", dates.month_day(F.col(date)))
        .withColumn("_share", F.when(in_year, F.try_divide(F.col(value), whole)))
        .withColumn("weight", F.max("_share").over(same_day))
        .drop("_month_day", "_share")
    )


def add_offset(weighted: DataFrame, value: str, date: str, offset: Offset) -> DataFrame:
    """Add the day's part of the yearly offset, from the start day on."""
    started = F.col(date) >= F.lit(offset.start).cast("date")
    extra = numbers.only_if(started, F.lit(float(offset.total)) * F.col("weight"))
    return weighted.withColumn(value, F.col(value) + numbers.or_zero(extra))
