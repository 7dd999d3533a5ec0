"""CSV files whose headers differ, read in one scan by column name.

The header of each file comes from a table of files (``sources.manifest``). Lines of all
files are read once as text and joined to that table by their file's name, a join that
Spark broadcasts or shuffles by the table's size; each line is then parsed by its own
file's names. Only different headers reach the driver, a handful, never file names.
"""

from __future__ import annotations

import csv
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE = "_file"
KIND = "_kind"
# More different headers than this are no tables of one kind.
MOST_HEADERS = 200


class Parsed(NamedTuple):
    """``rows`` holds ``_file``, the columns of folders, ``_kind`` and, for the header of that number, ``_row<kind>``."""

    names: list[list[str]]
    examples: list[str]
    rows: DataFrame

    def column(self, name: str) -> Column:
        """A column by name, NULL in files that lack it."""
        cells = [F.when(F.col(KIND) == k, F.col(f"_row{k}")[name]) for k, names in enumerate(self.names) if name in names]
        return F.coalesce(*cells) if cells else F.lit(None).cast("string")

    def cells(self, entries: list[list[Column]]) -> Column:
        """For each row the array of its own header's entries."""
        return F.coalesce(*(F.when(F.col(KIND) == k, F.array(*e)) for k, e in enumerate(entries)))


def lines(spark: SparkSession, path: str, since: int | None = None) -> DataFrame:
    """All lines with their file's name and the columns of its folders; ``since`` (microseconds) leaves older files unopened."""
    text = spark.read.text(path)
    if since is not None:
        text = text.where(F.col("_metadata.file_modification_time") >= F.timestamp_micros(F.lit(since)))
    return text.select(F.col("_metadata.file_path").alias(FILE), "*")


def first_lines(spark: SparkSession, path: str, since: int | None = None) -> DataFrame:
    """(file, header): the first line of each file, where it is not blank. Of each first block one line a file is shuffled."""
    text = spark.read.option("recursiveFileLookup", True).text(path)
    if since is not None:
        text = text.where(F.col("_metadata.file_modification_time") >= F.timestamp_micros(F.lit(since)))
    # ids grow with the lines of a block, which one task reads
    text = text.where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("id"), "value"
    )
    return text.groupBy("file").agg(F.min_by("value", "id").alias("header")).where(F.trim("header") != "")


def names_of(header: str) -> list[str]:
    """The names in a header line."""
    return next(csv.reader([header.lstrip("\ufeff")]))


def parsed(text: DataFrame, files: DataFrame, rename: Callable[[list[str], str], list[str]] | None = None) -> Parsed:
    """The rows of the files (file, header) among the lines, each parsed by its file's header.

    ``rename(names, example)`` may give the columns of a header other names, or refuse it
    with an error that names an example of its files. A row with more or fewer fields than its header is an error, a line that repeats the
    header or is blank is no row, and a field cannot hold a line break. Without any header
    there is nothing to read, which is an error.
    """
    known = files.groupBy("header").agg(F.min("file").alias("file")).orderBy("header").limit(MOST_HEADERS + 1).collect()
    if not known:
        raise ValueError("no file with a header")
    if len(known) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers, the first in {known[0].file}")
    headers = [r.header for r in known]
    names = [names_of(h) for h in headers]
    if rename is not None:
        names = [rename(own, row.file) for own, row in zip(names, known, strict=True)]
    for own, row in zip(names, known, strict=True):
        if len(set(own)) < len(own):
            raise ValueError(f"a name twice in the header of {row.file}")
    number = F.array_position(F.array(*map(F.lit, headers)), F.col("header")) - 1
    kinds = files.select(F.col("file").alias(FILE), number.cast("int").alias(KIND))
    header = F.get(F.array(*map(F.lit, headers)), F.col(KIND))
    rows = text.join(kinds, FILE)
    folders = [c for c in text.columns if c not in (FILE, "value")]
    parse = [
        F.when(F.col(KIND) == k, F.from_csv("value", _schema(own), {"mode": "FAILFAST"})).alias(f"_row{k}")
        for k, own in enumerate(names)
    ]
    # made by a generator, so that no check of the rows is moved before this choice of lines
    row = F.when((F.col("value") != header) & (F.trim("value") != ""), F.array(F.struct(*parse)))
    return Parsed(names, [r.file for r in known], rows.select(FILE, *folders, KIND, F.inline(row)))


def _schema(names: list[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
