"""Calendar expressions (D1-D12). All of them stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattfolio import fixed

# Offset at the end of a timestamp text, such as Z, +01:00 or +0100.
OFFSET_PATTERN = r"(Z|[+-]\d{2}:?\d{2})$"


def utc_clock(instant: Column) -> Column:
    """The clock time of an instant in UTC, whatever the session's zone."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def wall_clock(text: Column, *formats: str, strict: bool = True) -> Column:
    """Parse a text to the clock time it shows; a trailing offset is dropped.

    The formats are tried in turn. A text that fits none raises an error, or
    becomes NULL with ``strict=False``. The shown time is read as UTC, so no
    clock change of the session's zone can move it.
    """
    shown = F.concat(F.regexp_replace(F.trim(text), OFFSET_PATTERN, ""), F.lit("Z"))
    tries = [F.try_to_timestamp(shown, F.lit(f"{f}X")) for f in formats]
    parsed = F.coalesce(*tries)
    if strict:
        failed = F.concat(F.lit("not a timestamp: "), text)
        parsed = F.when(text.isNull(), None).otherwise(
            F.coalesce(parsed, F.raise_error(failed).cast("timestamp"))
        )
    return utc_clock(parsed)


def in_zone(text: Column, fmt: str, zone: str) -> Column:
    """Parse a text that carries an offset and show it on the clock of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_clock(F.to_timestamp(text, fmt)))


def month_day(date: Column) -> Column:
    return F.date_format(date, "MM-dd")


def leap_day(date: Column) -> Column:
    """29 February, by number: cheap enough for every raw row."""
    return (F.month(date) == 2) & (F.dayofmonth(date) == 29)


def on_display_year(key: Column, year: int) -> Column:
    """Put a month-day key on the year shown by a chart: ``2023-02-28``."""
    return F.concat(F.lit(f"{year}-"), key)


def week_end(date: Column) -> Column:
    """The Sunday that ends the week of a date."""
    return F.next_day(F.date_sub(date, 1), "SUN")


def iso_year(date: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), date)


def iso_week_key(date: Column) -> Column:
    """ISO week as two digits, so that text order is week order."""
    return F.lpad(F.weekofyear(date).cast("string"), 2, "0")


def iso_year_week(date: Column) -> Column:
    return F.concat_ws("-", iso_year(date).cast("string"), iso_week_key(date))


def part(text: Column, index: int, separator: str = "-") -> Column:
    return F.split(text, separator)[index]


def at_position(
    start: Column, position: Column, minutes: int | Column = fixed.RESOLUTION_MINUTES
) -> Column:
    """Time of the n-th reading (counted from 1) of a period."""
    return F.timestamp_add("MINUTE", (position - 1) * F.lit(minutes), start)


def monday_of_week(year: Column, week: Column) -> Column:
    """Monday of a week counted from the first Monday of the year."""
    first = F.next_day(F.date_sub(F.make_date(year, F.lit(1), F.lit(1)), 1), "MON")
    return F.date_add(first, (week - 1) * 7)


def monday_of_iso_week(year: Column, week: Column) -> Column:
    """Monday of an ISO week; 4 January always lies in week 1."""
    first = F.date_sub(F.next_day(F.make_date(year, F.lit(1), F.lit(4)), "MON"), 7)
    return F.date_add(first, (week - 1) * 7)


def german_date(date: Column) -> Column:
    """Day in German long form: ``3. März 2023``."""
    months = F.array(*[F.lit(m) for m in fixed.GERMAN_MONTHS])
    return F.format_string(
        "%d. %s %d", F.dayofmonth(date), F.element_at(months, F.month(date)), F.year(date)
    )
