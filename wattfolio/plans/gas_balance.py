"""Gas use: imports minus exports plus a weighted offset, smoothed, year over year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.functions import dates, numbers
from wattfolio.operators import balance, season, windows
from wattfolio.settings import Offset, SeasonSpan

KEY = fixed.GAS_KEY


def daily_use(
    flows: DataFrame,
    direction: str,
    value: str,
    time: str,
    offset: Offset | None = None,
    series: Sequence[str] = (),
    divisor: float = fixed.KWH_PER_GWH,
) -> DataFrame:
    """Daily use in scaled units, its offset and its rolling median.

    After the daily aggregate everything is a window over one series, so the
    whole chain needs one further shuffle, of daily rows only.
    """
    offset = offset or Offset()
    days = balance.flow_balance(flows, direction, value, time, series)
    days = windows.without_last_day(days, "date", series)
    days = numbers.scaled(days, ["import", "export"], divisor).withColumn(
        "diff", F.col("import") - F.col("export")
    )
    days = balance.with_weights(days, "diff", "date", offset.reference_year, series)
    days = balance.add_offset(days, "diff", "date", offset)
    return days.withColumn(
        fixed.GAS_VALUE, windows.rolling_median(F.col("diff"), "date", series)
    )


def gas_balance_report(
    flows: DataFrame,
    span: SeasonSpan,
    direction: str = "direction",
    value: str = "value",
    time: str = "periodFrom",
    offset: Offset | None = None,
    series: Sequence[str] = (),
    divisor: float = fixed.KWH_PER_GWH,
) -> DataFrame:
    """Month-days of the reference year against the years since ``span.first_year``."""
    offset = offset or Offset()
    days = daily_use(flows, direction, value, time, offset, series, divisor)
    key = dates.on_display_year(dates.month_day(F.col("date")), span.curr_year)
    table = season.year_over_year(
        days.filter(~dates.leap_day(F.col("date"))).withColumn(KEY, key),
        KEY,
        fixed.GAS_VALUE,
        F.year("date"),
        offset.reference_year,
        span.years,
        series,
    )
    return season.newest_first(table, [*series, KEY], [])
