"""Yearly 15-minute grid sheets landed as CSV.

Columns of a sheet are named by their place, and a place means what the sheet's header says.
So each file's header is looked up first and must be a known one: a layout gives the titles
of a header, in order, and the measures they stand for. Sheets of other years may have
other layouts; a sheet with moved, new or missing columns is an error, not a mix-up.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.functions import dates, numbers
from wattfolio.operators import filters
from wattfolio.sources import headers, manifest

TIME_FORMAT = "dd.MM.yyyy HH:mm"
DATE = "date"


class Layout(NamedTuple):
    """Titles of a sheet's header and the measures they stand for.

    The first column is the time; its title counts only if the layout and the sheet have one.
    """

    titles: tuple[str, ...]
    measures: tuple[str, ...]


def plain(title: str) -> str:
    """A title without blanks around it and in lower case, with one blank between words."""
    return " ".join(title.split()).lower()


def named_by_position(titles: Sequence[str], measures: Sequence[str]) -> Layout:
    """The layout that gives measures to titles by their place; a different count is an error."""
    if len(titles) != len(measures) + 1:
        raise ValueError(f"expected {len(measures) + 1} columns, found {len(titles)}")
    return Layout(tuple(titles), tuple(measures))


def own_layout() -> Layout:
    """The library's own names as titles, as a landing step writes them."""
    names = fixed.grid_measures()
    return named_by_position([DATE, *names], names)


def measures_of(titles: Sequence[str], layouts: Sequence[Layout], example: str) -> list[str]:
    """The column names that a header stands for; one that no layout knows is an error."""
    found = [plain(t) for t in titles]
    known = [[plain(t) for t in layout.titles] for layout in layouts]
    for layout, own in zip(layouts, known, strict=True):
        if found[1:] == own[1:] and (found[0] == own[0] or not found[0] or not own[0]):
            return [DATE, *layout.measures]
    near = max(known, key=lambda k: sum(a == b for a, b in zip(k, found, strict=False)))
    place = next((i for i, (a, b) in enumerate(zip(near, found, strict=False)) if a != b), min(len(near), len(found)))
    here, there = (x[place] if place < len(x) else "no column" for x in (found, near))
    raise ValueError(f"unknown header of {example}: column {place + 1} is '{here}', expected '{there}'")


def header_report(spark: SparkSession, path: str, layouts: Sequence[Layout] | None = None) -> DataFrame:
    """(fingerprint, header, files, first_file, known): the different headers of the sheets below a path.

    The fingerprint is the SHA-256 of the header line; ``known`` tells whether a layout has it.
    """
    files = headers.first_lines(spark, path).groupBy("header").agg(
        F.count("file").alias("files"), F.min("file").alias("first_file")
    )
    known = [r.header for r in files.select("header").collect() if _is_known(headers.names_of(r.header), layouts or [own_layout()])]
    same = F.col("header").isin(known)
    return files.select(F.sha2("header", 256).alias("fingerprint"), "header", "files", "first_file", same.alias("known"))


def _is_known(titles: Sequence[str], layouts: Sequence[Layout]) -> bool:
    try:
        measures_of(titles, layouts, "")
    except ValueError:
        return False
    return True


def read_sheets(
    spark: SparkSession, path: str, measures: Sequence[str] | None = None, layouts: Sequence[Layout] | None = None
) -> DataFrame:
    """Typed rows of all sheets, without the units row.

    ``layouts`` are the known headers, the library's own names by default; a measure that a
    sheet's layout lacks is NULL in its rows. The units row is one whose date holds no digit
    and none of whose measures is a number. Any other date or number that does not parse is
    an error; an empty cell is NULL.
    """
    layouts = list(layouts or [own_layout()])
    measures = list(measures or dict.fromkeys(m for layout in layouts for m in layout.measures))
    found = headers.parsed(
        headers.lines(spark, path), manifest.with_headers(spark, path), lambda titles, file: measures_of(titles, layouts, file)
    )
    raw = found.rows.select(found.column(DATE).alias(DATE), *(found.column(m).alias(m) for m in measures))
    numeric = [F.col(m).try_cast("double").isNotNull() for m in measures]
    units = ~F.coalesce(F.col(DATE), F.lit("")).rlike(r"\d") & ~filters.some(*numeric)
    missing = F.raise_error(F.lit("a row without a date holds numbers")).cast("timestamp_ntz")
    time = F.coalesce(dates.wall_clock(F.col(DATE), TIME_FORMAT), missing)
    return (
        raw.filter(~units)
        .withColumn(DATE, time)
        .select(
            DATE,
            F.to_date(DATE).alias("date_normal"),
            *[numbers.number(F.col(m)).alias(m) for m in measures],
        )
    )
