"""Current results and dated snapshots as CSV (K1-K3).

Final tables hold at most 366 rows per series. With ``series`` each series is
written to its own folder by its own task; only a single-series table is written
by one task. Every result is published as a version (``sinks.versions``): readers see
the old one until the new one is complete.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattfolio.functions import numbers
from wattfolio.session import scratch_folder
from wattfolio.sinks import versions

# Texts come back as they were: blanks and line breaks stay, a quote is doubled, NULL is
# an empty field and an empty text a quoted one.
WRITTEN = {
    "header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "escape": '"', "nullValue": "", "emptyValue": '""',
}
# The reader tells the two apart by a mark that stands for an empty field. Columns are
# compared by name: a series that was held back with other columns is an error, not a mix-up.
READ = WRITTEN | {"emptyValue": "", "nullValue": "\u0001", "multiLine": "true", "enforceSchema": "false"}


def _arranged(table: DataFrame, order_by: Sequence[str], series: Sequence[str]) -> DataFrame:
    placed = table.repartition(*series) if series else table.repartition(1)
    keys = [*series, *order_by]
    placed = placed.sortWithinPartitions(*keys) if keys else placed
    return placed.select(
        *[
            numbers.plain_text(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and f.name not in series
            else F.col(f"`{f.name}`")
            for f in table.schema
        ]
    )


def _typed(stored: DataFrame, schema: T.StructType) -> DataFrame:
    return stored.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def computed(table: DataFrame) -> DataFrame:
    """The table written to the shared folder and read from there.

    A table computed beforehand is computed once for all its uses, and a failing check
    ends the run before any version is written.
    """
    path = scratch_folder(table.sparkSession, "computed")
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def write_current(
    table: DataFrame,
    path: str,
    order_by: Sequence[str],
    series: Sequence[str] = (),
    ready: bool = False,
) -> None:
    """Publish the current result; a missing value becomes an empty field.

    With ``series`` only the series present in the table are replaced, all of them at once:
    one that was held back keeps its last result. ``ready`` tells that the table is read
    from files already.
    """
    if not ready:
        table = computed(table)

    def write(table: DataFrame, folder: str) -> None:
        _arranged(table, order_by, series).write.options(**WRITTEN).partitionBy(*series).csv(folder)

    versions.publish(table, path, write, series)


def read_current(
    spark: SparkSession, path: str, table: DataFrame | T.StructType, series: Sequence[str] = ()
) -> DataFrame:
    """The current result with the columns and types of the table it came from; empty if there is none yet."""
    schema = table if isinstance(table, T.StructType) else table.schema
    texts = T.StructType(
        [T.StructField(f.name, T.StringType()) for f in schema if f.name not in series]
        + [T.StructField(name, T.StringType()) for name in (*series, versions.VERSION)]
    )

    def read(folders: list[str]) -> DataFrame:
        return spark.read.schema(texts).options(**READ).option("basePath", f"{path}/versions").csv(folders)

    rows = versions.current(spark, path, read, series)
    return spark.createDataFrame([], schema) if rows is None else _typed(rows, schema)


def _day(path: str, snapshot_date: str) -> str:
    return f"{path}/snapshot_date={snapshot_date}"


def write_snapshot(
    table: DataFrame,
    path: str,
    snapshot_date: str,
    order_by: Sequence[str],
    series: Sequence[str] = (),
) -> None:
    """Publish the result of a day; a second run on that day replaces only that day's series it holds."""
    write_current(table, _day(path, snapshot_date), order_by, series)


def read_snapshot(
    spark: SparkSession, path: str, snapshot_date: str, table: DataFrame | T.StructType, series: Sequence[str] = ()
) -> DataFrame:
    """The snapshot of a day with the columns and types of the table it came from.

    Only the folder of that day is listed; a day without any is an empty snapshot, as one
    on which every series was held back.
    """
    return read_current(spark, _day(path, snapshot_date), table, series)


def publish(
    table: DataFrame,
    snapshot_path: str,
    current_path: str,
    snapshot_date: str,
    order_by: Sequence[str],
    series: Sequence[str] = (),
) -> None:
    """Publish snapshot and current result.

    The current result is written from the stored snapshot, so the report itself
    is computed once even if executors are lost in between.
    """
    write_snapshot(table, snapshot_path, snapshot_date, order_by, series)
    stored = read_snapshot(table.sparkSession, snapshot_path, snapshot_date, table, series)
    write_current(stored, current_path, order_by, series, ready=True)


def write_table(table: DataFrame, path: str, ready: bool = False) -> None:
    """Publish a long table as Parquet."""
    versions.publish(table if ready else computed(table), path, lambda t, folder: t.write.parquet(folder))


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The current long table, None if there is none yet."""

    def read(folders: list[str]) -> DataFrame:
        return spark.read.option("basePath", f"{path}/versions").parquet(*folders)

    return versions.current(spark, path, read)
