"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F


def number(column: Column, lenient: bool = False) -> Column:
    """Cast to double with NaN as NULL. ``lenient`` turns bad texts into NULL."""
    cast = column.try_cast("double") if lenient else column.cast("double")
    return F.nanvl(cast, F.lit(None).cast("double"))


def total(value: Column) -> Column:
    """Sum that is 0 for a group without any value."""
    return F.coalesce(F.sum(number(value)), F.lit(0.0))


def total_over(value: Column, window: WindowSpec) -> Column:
    """The same sum over a window."""
    return F.coalesce(F.sum(number(value)).over(window), F.lit(0.0))


def scaled(df: DataFrame, columns: list[str], divisor: float) -> DataFrame:
    """Divide columns by a constant, for example kWh to GWh."""
    return df.withColumns({c: F.col(c) / F.lit(divisor) for c in columns})


def only_if(condition: Column, value: Column) -> Column:
    return F.when(condition, value)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def one_digit(value: Column) -> Column:
    """Round to one digit, half to even."""
    return F.bround(value, 1)


def plain_text(value: Column) -> Column:
    """A double as its shortest text, without exponent from 0.0001 up to 10^16."""
    size = F.abs(value)

    def digits(scale: int) -> Column:
        text = value.cast(f"decimal(38,{scale})").cast("string")
        return F.regexp_replace(text, r"(\.\d+?)0*$", "$1")

    return (
        F.when((size >= 1e7) & (size < 1e16), digits(17))
        .when((size >= 1e-4) & (size < 1e-3), digits(22))
        .otherwise(value.cast("string"))
    )


def percent_change(value: Column, base: Column) -> Column:
    return F.try_divide(value - base, base) * 100
