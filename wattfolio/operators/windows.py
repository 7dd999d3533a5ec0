"""Row windows within a series.

On daily or weekly tables one partition holds the days of one series, at most 366 a year,
whatever the number of raw readings behind them. A long series, such as quarter hours of
many years, is cut into blocks of days (``in_blocks``): each block gets the rows its frames
reach back or ahead to, so a task holds a block and not the series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.operators import filters


def whole_series(series: Sequence[str]) -> WindowSpec:
    return W.partitionBy(*series) if series else W.partitionBy(F.lit(0))


def by_series(series: Sequence[str], *order: str) -> WindowSpec:
    return whole_series(series).orderBy(*order)


def rolling_median(
    value: Column, date: str, series: Sequence[str] = (), rows: int = fixed.ROLLING_ROWS
) -> Column:
    """Median of the last ``rows`` rows; NULL until all of them have a value."""
    return _median(value, by_series(series, date), rows)


def _median(value: Column, order: WindowSpec, rows: int) -> Column:
    frame = order.rowsBetween(1 - rows, 0)
    median = F.percentile(value, F.lit(0.5)).over(frame)
    return F.when(F.count(value).over(frame) == rows, median)


def difference(value: Column, date: str, series: Sequence[str] = ()) -> Column:
    """Change from the row before."""
    return value - F.lag(value).over(by_series(series, date))


def latest(
    daily: DataFrame, value: str, date: str, series: Sequence[str] = ()
) -> DataFrame:
    """The last value that is not NULL and its date, per series."""
    known = filters.filled(filters.filled(daily, value), date)
    return known.groupBy(*series).agg(
        F.max(date).alias(date), F.max_by(value, date).alias(value)
    )


def without_last_day(daily: DataFrame, date: str, series: Sequence[str] = ()) -> DataFrame:
    """Drop the last, usually incomplete, day of each series."""
    last = F.max(date).over(whole_series(series))
    return daily.withColumn("_last", last).filter(F.col(date) < F.col("_last")).drop("_last")


def with_gaps(rows: DataFrame, date: str, step: int, series: Sequence[str] = ()) -> DataFrame:
    """Repeat each row once per step up to the next row; ``_gap`` counts from 0.

    A row stands for itself and the gap after it, so filling needs neither a
    calendar table nor a join.
    """
    return _repeated(rows.withColumn("_missing", _missing(by_series(series, date), date, step)), rows.columns)


def _missing(order: WindowSpec, date: str, step: int) -> Column:
    steps = F.floor(F.datediff(F.lead(date).over(order), date) / step).cast("int")
    return F.greatest(steps - 1, F.lit(0))


def _repeated(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.select(*columns, F.explode_outer(F.sequence(F.lit(0), F.col("_missing"))).alias("_gap"))


def on_every_day(daily: DataFrame, date: str, series: Sequence[str] = ()) -> DataFrame:
    """Add the missing days of each series with NULL values.

    An option for windows that shall count days instead of rows.
    """
    gap = F.col("_gap")
    others = [c for c in daily.columns if c not in (*series, date)]
    return with_gaps(daily, date, 1, series).select(
        *series,
        F.date_add(date, gap).alias(date),
        *[F.when(gap == 0, F.col(c)).alias(c) for c in others],
    )


def _neighbours(sizes: DataFrame, series: Sequence[str], reach: int, ahead: bool) -> DataFrame:
    """(series, _block, _to, _rows): the blocks that need rows of a block, and how many of its nearest ones.

    ``sizes`` has a row per block that holds rows, so at most ``reach`` blocks matter.
    """
    order = W.partitionBy(*series).orderBy(F.desc("_block") if ahead else F.col("_block"))
    near = F.collect_list(F.struct("_block", "_n")).over(order.rowsBetween(1, reach))
    # rows between the two blocks
    between = lambda i: F.aggregate(F.slice("_near", 1, i), F.lit(0).cast("long"), lambda s, x: s + x["_n"])
    to = F.transform("_near", lambda x, i: F.struct(x["_block"].alias("_to"), (F.lit(reach) - between(i)).alias("_rows")))
    return sizes.withColumn("_near", near).select(*series, "_block", F.inline(to)).where("_rows > 0")


def in_blocks(
    rows: DataFrame,
    date: str,
    columns: dict[str, Callable[[WindowSpec], Column]],
    series: Sequence[str] = (),
    days: int = 366,
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """Add window columns to the rows of long series, ``days`` days of one series at a time.

    Each of ``columns`` makes a column from a window ordered by ``date``. It may use the
    ``before`` rows before a row and the ``after`` rows after it: a block gets so many from its
    neighbours, and from theirs where a neighbour has too few. The result is that of the
    same windows over whole series, for rows whose dates differ. Rows without a date come
    first. The rows are shuffled once by series and block; of the rest, only the few rows at
    the ends of blocks and a row per block are.
    """
    number = F.coalesce(F.floor(F.datediff(date, F.lit("1970-01-01").cast("date")) / days), F.lit(-(1 << 40)))
    own = rows.withColumns({"_block": number, "_own": F.lit(True)})
    sizes = own.groupBy(*series, "_block").agg(F.count(F.lit(1)).alias("_n"))
    parts = [own]
    for reach, ahead in ((before, False), (after, True)):
        if not reach:
            continue
        # the rank is limited before the shuffle, so only rows at the ends of blocks move
        end = W.partitionBy(*series, "_block").orderBy(F.col(date) if ahead else F.desc(date))
        ends = own.withColumn("_rank", F.row_number().over(end)).where(F.col("_rank") <= reach)
        to = _neighbours(sizes, series, reach, ahead).select(
            *(F.col(s).alias(f"_of_{s}") for s in series), F.col("_block").alias("_from"), "_to", "_rows"
        )
        same = [F.col(s).eqNullSafe(F.col(f"_of_{s}")) for s in series]
        met = ends.join(to, filters.every(*same, F.col("_block") == F.col("_from"), F.col("_rank") <= F.col("_rows")))
        parts.append(met.select(*rows.columns, F.col("_to").alias("_block"), F.lit(False).alias("_own")))
    every = reduce(DataFrame.unionAll, parts)
    order = W.partitionBy(*series, "_block").orderBy(date)
    return every.withColumns({name: make(order) for name, make in columns.items()}).where("_own").drop("_block", "_own")


def long_rolling_median(
    rows: DataFrame, value: str, date: str, series: Sequence[str] = (), reach: int = fixed.ROLLING_ROWS,
    days: int = 366, name: str = "median",
) -> DataFrame:
    """``rolling_median`` of long series, worked on in blocks of days."""
    return in_blocks(rows, date, {name: lambda order: _median(F.col(value), order, reach)}, series, days, before=reach - 1)


def long_difference(
    rows: DataFrame, value: str, date: str, series: Sequence[str] = (), days: int = 366, name: str = "change"
) -> DataFrame:
    """``difference`` of long series, worked on in blocks of days."""
    change = lambda order: F.col(value) - F.lag(value).over(order)
    return in_blocks(rows, date, {name: change}, series, days, before=1)


def long_with_gaps(
    rows: DataFrame, date: str, step: int, series: Sequence[str] = (), days: int = 366
) -> DataFrame:
    """``with_gaps`` of long series, worked on in blocks of days."""
    missing = {"_missing": lambda order: _missing(order, date, step)}
    return _repeated(in_blocks(rows, date, missing, series, days, after=1), rows.columns)
