"""One month against the mean of that month in earlier years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.functions import numbers, texts


def month_vs_average(
    readings: DataFrame,
    value: str,
    time: str,
    month: int,
    start: str,
    end: str,
    history_before: str,
    divisor: float = fixed.KWH_PER_GWH,
) -> DataFrame:
    """One row: the month's sum, the mean of earlier sums, difference and percent.

    ``start`` and ``end`` are both inclusive. One pass over the readings; only
    sums per year leave the first aggregate.
    """
    at = F.col(time)
    in_month = at.between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    earlier = (at < F.lit(history_before).cast("timestamp_ntz")) & (F.month(time) == month)
    sums = (
        readings.filter(in_month | earlier)
        .groupBy(F.year(time).alias("year"))
        .agg(
            numbers.total(F.when(in_month, F.col(value))).alias("_month"),
            F.when(F.count_if(earlier) > 0, numbers.total(F.when(earlier, F.col(value)))).alias("_past"),
        )
    )
    use, average = F.col("usage"), F.col("average")
    return (
        sums.agg(
            (F.sum("_month") / divisor).alias("usage"), (F.avg("_past") / divisor).alias("average")
        )
        .withColumns({"difference": use - average, "percent": numbers.percent_change(use, average)})
        .select(*[numbers.one_digit(F.col(c)).alias(c) for c in ("usage", "average", "difference", "percent")])
    )


def summary_lines(comparison: DataFrame, month: int, start: str, end: str) -> DataFrame:
    """The printed form of the comparison as one text column per line (K4)."""

    def shown(column: str) -> Column:
        return F.format_string("%.1f", F.col(column))

    return comparison.select(
        texts.filled(fixed.MONTH_USAGE_LINE, F.lit(start), F.lit(end), shown("usage")).alias("usage_line"),
        texts.filled(fixed.MONTH_AVERAGE_LINE, F.lit(str(month)), shown("average")).alias("average_line"),
        texts.filled(fixed.MONTH_DIFFERENCE_LINE, shown("difference"), shown("percent")).alias(
            "difference_line"
        ),
    )
