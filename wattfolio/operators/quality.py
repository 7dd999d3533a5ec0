"""Checks of readings and gates before publishing (Q1-Q4, A5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.functions import dates
from wattfolio.operators import filters
from wattfolio.operators.windows import by_series, difference, whole_series

MODES = ("fail", "quarantine", "stop")


def flow_checks(direction: str = "direction") -> dict[str, Column]:
    """The one value each checked column of a gas flow must hold."""
    key = F.when(F.col(direction) == "import", fixed.IMPORT_DIRECTION_KEY).otherwise(
        fixed.EXPORT_DIRECTION_KEY
    )
    return {"unit": F.lit(fixed.FLOW_UNIT), "directionKey": key}


def unexpected(checks: dict[str, Column]) -> Column:
    """True for a row that differs from an expected value or lacks it."""
    bad = F.lit(False)
    for column, expected in checks.items():
        bad = bad | ~F.col(column).eqNullSafe(expected)
    return bad


def check_report(rows: DataFrame, keys: Sequence[str], checks: dict[str, Column]) -> DataFrame:
    """Rows and unexpected values per key, and whether the key passes."""
    return (
        rows.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            *[
                F.count_if(~F.col(c).eqNullSafe(expected)).alias(f"bad_{c}")
                for c, expected in checks.items()
            ],
        )
        .withColumn("passes", sum((F.col(f"bad_{c}") for c in checks), F.lit(0)) == 0)
    )


def fail_on_unexpected(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Pass rows on; the job fails at the first unexpected value. No shuffle."""
    columns = ", ".join(checks)
    error = F.raise_error(F.lit(f"unexpected value in one of: {columns}")).cast("boolean")
    return rows.filter(F.when(unexpected(checks), error).otherwise(True))


def without_bad_keys(rows: DataFrame, keys: Sequence[str], checks: dict[str, Column]) -> DataFrame:
    """Drop every key that holds an unexpected value.

    One plan, no job when called: the distinct bad keys have a map-side part, and Spark
    chooses the join by their size, which it knows after their shuffle.
    """
    bad_keys = [F.col(k).alias(f"_bad_{k}") for k in keys]
    bad = rows.filter(unexpected(checks)).select(*bad_keys).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_bad_{k}")) for k in keys]
    return rows.join(bad, filters.every(*same), "left_anti")


def until_first_bad(
    rows: DataFrame,
    group: str,
    point: str,
    checks: dict[str, Column],
    order: dict[str, Sequence[str]],
) -> DataFrame:
    """Keep the points read before the first bad one, in configured order.

    ``order`` lists the points of each group. Points that are not listed come
    last, all in one place; a group that is not listed is an error. A group
    without a bad point is kept whole. The first bad places are one row per
    listed group, a table bounded by ``order``, which therefore may be broadcast.
    """
    places = F.create_map(
        *[
            F.lit(x)
            for name, points in order.items()
            for place, p in enumerate(points)
            for x in (f"{name}\x1f{p}", place)
        ]
    )
    last = max(len(points) for points in order.values())
    place = F.try_element_at(places, F.concat_ws("\x1f", F.col(group), F.col(point)))
    unknown = F.raise_error(F.concat(F.lit("no reading order for "), F.col(group)))
    placed = rows.withColumn(
        "_place",
        F.when(F.col(group).isin(list(order)), F.coalesce(place, F.lit(last))).otherwise(
            unknown.cast("int")
        ),
    )
    stops = (
        placed.filter(unexpected(checks))
        .groupBy(group)
        .agg(F.min("_place").alias("_stop"))
    )
    return (
        placed.join(F.broadcast(stops), group, "left")
        .filter(F.col("_stop").isNull() | (F.col("_place") < F.col("_stop")))
        .drop("_place", "_stop")
    )


def enforce_expected(
    rows: DataFrame,
    checks: dict[str, Column],
    mode: str = "fail",
    keys: Sequence[str] = ("direction", "point"),
    order: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Apply the checks in one of the modes ``fail``, ``quarantine`` or ``stop``."""
    if mode == "fail":
        return fail_on_unexpected(rows, checks)
    if mode == "quarantine":
        return without_bad_keys(rows, keys, checks)
    if mode == "stop":
        if order is None:
            raise ValueError("mode 'stop' needs the order of the points")
        return until_first_bad(rows, keys[0], keys[1], checks, order)
    raise ValueError(f"mode must be one of {MODES}")


def gate(largest: Column, smallest: Column, last: Column) -> Column:
    """The last change lies inside the widened range; unknown counts as no."""
    inside = (last < largest * fixed.GATE_MAX_FACTOR) & (last > smallest * fixed.GATE_MIN_FACTOR)
    return F.coalesce(inside, F.lit(False))


def _bounding(mode: str, last_row: Column) -> Column:
    if mode not in ("reference", "exclude_last"):
        raise ValueError("mode must be 'reference' or 'exclude_last'")
    change = F.col("_change")
    return change if mode == "reference" else F.when(~last_row, change)


def plausibility(
    daily: DataFrame, value: str, date: str, series: Sequence[str] = (), mode: str = "reference"
) -> DataFrame:
    """One row per series: bounds, last change and whether it is plausible.

    ``reference`` lets the last change widen its own bounds; ``exclude_last``
    takes them from the earlier rows only.
    """
    last_row = F.lead(date).over(by_series(series, date)).isNull()
    changes = daily.select(
        *series,
        date,
        difference(F.col(value), date, series).alias("_change"),
        last_row.alias("_last_row"),
    )
    bounding = _bounding(mode, F.col("_last_row"))
    return (
        changes.groupBy(*series)
        .agg(
            F.max(bounding).alias("max_diff"),
            F.min(bounding).alias("min_diff"),
            F.max_by("_change", date).alias("last_diff"),
        )
        .withColumn("plausible", gate(F.col("max_diff"), F.col("min_diff"), F.col("last_diff")))
    )


def with_plausibility(
    daily: DataFrame, value: str, date: str, series: Sequence[str] = (), mode: str = "reference"
) -> DataFrame:
    """The same gate as a column on every day, for use inside a report.

    The windows share one partitioning by series, so no second pass over the
    readings and no join is needed.
    """
    everything = whole_series(series)
    last_row = F.lead(date).over(by_series(series, date)).isNull()
    changes = daily.withColumns(
        {"_change": difference(F.col(value), date, series), "_last_row": last_row}
    )
    bounding = _bounding(mode, F.col("_last_row"))
    return changes.withColumns(
        {
            "_max": F.max(bounding).over(everything),
            "_min": F.min(bounding).over(everything),
            "_last": F.max_by("_change", date).over(everything),
        }
    ).select(
        *daily.columns, gate(F.col("_max"), F.col("_min"), F.col("_last")).alias("plausible")
    )


def freshness(
    season: DataFrame,
    week: str,
    column: str,
    as_of: str,
    series: Sequence[str] = (),
    days: int = fixed.FRESH_DAYS,
    iso: bool = False,
) -> DataFrame:
    """Whether the Monday of the last filled week is recent enough at ``as_of``.

    ``as_of`` is a date or timestamp text. ``iso`` takes the Monday of the ISO
    week in place of weeks counted from the first Monday of the year.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    last_week = F.max(F.when(F.col(column).isNotNull(), F.col(week).cast("int")))
    monday = dates.monday_of_iso_week if iso else dates.monday_of_week
    return (
        season.groupBy(*series)
        .agg(last_week.alias("last_week"))
        .withColumn("monday", monday(F.year(now), F.col("last_week")))
        .withColumn(
            "fresh",
            F.coalesce(
                now - F.make_dt_interval(F.lit(days)) <= F.col("monday").cast("timestamp_ntz"),
                F.lit(False),
            ),
        )
    )


def page_completeness(
    pages: DataFrame, page: str, last_page: str, series: Sequence[str] = ()
) -> DataFrame:
    """Whether the landed pages of each series cover ``1..last_page``."""
    inside = F.col(page).between(F.lit(1), F.col(last_page))
    return (
        pages.groupBy(*series)
        .agg(
            F.count_distinct(F.when(inside, F.col(page))).alias("pages"),
            F.max(last_page).alias("last_page"),
        )
        .withColumn("complete", F.col("pages") == F.col("last_page"))
    )


def page_drift(
    records: DataFrame,
    page: str,
    date: str,
    series: Sequence[str] = (),
) -> DataFrame:
    """Whether neighbouring pages of daily records meet day to day; one row per page.

    Rows that are added or removed while pages are fetched shift the later pages, which page
    numbers cannot show. A page holds the days ``first_day`` to ``last_day``; ``overlap``
    counts the days that it shares with the page after it, ``missing`` the days between the
    two that neither holds, ``inside`` the days missing within its own span. ``follows`` is
    the number of the next landed page, NULL for the last one. Pages may go from new to old
    or from old to new. Records without a day are not counted. One aggregate with a map-side part, then a window over rows of pages.
    """
    spans = records.where(F.col(date).isNotNull()).groupBy(*series, page).agg(
        F.min(date).alias("first_day"),
        F.max(date).alias("last_day"),
        F.count_distinct(date).alias("days"),
    )
    after = by_series(series, page)
    # from the last day of the older of two neighbours to the first day of the newer one
    step = F.greatest(
        F.datediff("first_day", F.lead("last_day").over(after)),
        F.datediff(F.lead("first_day").over(after), "last_day"),
    )
    return spans.select(
        *series,
        page,
        "first_day",
        "last_day",
        "days",
        (F.datediff("last_day", "first_day") + 1 - F.col("days")).alias("inside"),
        F.lead(page).over(after).alias("follows"),
        F.greatest(F.lit(0), 1 - step).alias("overlap"),
        F.greatest(F.lit(0), step - 1).alias("missing"),
    ).withColumns(
        {
            "overlap": F.when(F.col("follows").isNotNull(), F.col("overlap")),
            "missing": F.when(F.col("follows").isNotNull(), F.col("missing")),
        }
    )


def conflicting_readings(
    readings: DataFrame, time: str, value: str, series: Sequence[str] = ()
) -> DataFrame:
    """Times at which a series has more than one different value."""
    return (
        readings.groupBy(*series, time)
        .agg(F.count_distinct(value).alias("values"))
        .filter(F.col("values") > 1)
    )


def overlapping_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, for example in history and new files."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
