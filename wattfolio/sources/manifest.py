"""A table of the files that were read, so that each file is opened once.

A store is a folder with two parts. ``rows`` holds what was read, a folder of Parquet files
per run. ``files`` is the table of files: name, length, time of change, header and the run
that read it. It is published last (``sinks.versions``), and only rows of runs it names are
ever read: a run that fails in between leaves nothing to be found, and its files are read
again by the next one.

A file that changed is read anew; its rows of earlier runs are left out from then on. A
file that was removed keeps its rows. Listing and comparing are Spark jobs; file names never
reach the driver, which sees the time of the oldest unread file and the names of runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfolio.session import scratch_folder
from wattfolio.sinks import versions
from wattfolio.sources import headers

RUN = "_run"
ENTRY = "file string, length long, modified long, header string, number long"


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, modified) of all files with bytes below a path or glob; none is opened. Times are microseconds."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("length"),
        F.unix_micros("_metadata.file_modification_time").alias("modified"),
    )


def with_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header) of all files, for a read without a store; computed once."""
    out = scratch_folder(spark, "headers")
    found = headers.first_lines(spark, path)
    found.write.parquet(out)
    return spark.read.schema(found.schema).parquet(out)


def entries(spark: SparkSession, store: str) -> DataFrame:
    """All files read so far, one row per file and run."""

    def read(folders: list[str]) -> DataFrame:
        every = spark.read.schema(f"{ENTRY}, {RUN} string, {versions.VERSION} string")
        return every.option("basePath", f"{store}/files/versions").parquet(*folders)

    known = versions.current(spark, f"{store}/files", read, [RUN])
    return spark.createDataFrame([], f"{ENTRY}, {RUN} string") if known is None else known


def unread(spark: SparkSession, path: str, store: str) -> DataFrame:
    """Files below the path that no run has read as they are now."""
    known = entries(spark, store).select("file", "length", "modified")
    return listed(spark, path).join(known, ["file", "length", "modified"], "left_anti")


def collect(
    spark: SparkSession,
    path: str,
    store: str,
    read: Callable[[DataFrame, int], DataFrame],
    with_header: bool = True,
    keep: Callable[[DataFrame], None] | None = None,
) -> bool:
    """Read the unread files and keep their rows; False if there was no such file.

    ``read(files, since)`` gets (file, length, modified, header) and the time of the oldest
    of them, and returns rows with ``_file``, the file they come from. Files older than
    ``since`` are left out before any is opened. A file without a line has no header and no
    rows; it counts as read. Without ``with_header`` no header is looked up. ``keep`` gets
    the stored rows before the files are noted as read.
    """
    new = unread(spark, path, store)
    folder = scratch_folder(spark, "unread")
    new.write.parquet(folder)
    new = spark.read.schema(new.schema).parquet(folder)
    since = new.agg(F.min("modified")).first()[0]
    if since is None:
        return False
    if with_header:
        new = new.join(headers.first_lines(spark, path, since), "file", "left")
        folder = scratch_folder(spark, "unread")
        new.write.parquet(folder)
        new = spark.read.schema(new.schema).parquet(folder)
    else:
        new = new.withColumn("header", F.lit(""))
    run = uuid.uuid4().hex[:16]
    filled = new.where("header is not null")
    if not filled.isEmpty():
        read(filled, since).write.parquet(f"{store}/rows/{RUN}={run}")
        if keep is not None:
            keep(_rows(spark, store, [run]).drop(RUN))
    number, _ = versions.new_version(spark, f"{store}/files")
    noted = new.select("file", "length", "modified", "header", F.lit(number).cast("long").alias("number"), F.lit(run).alias(RUN))
    versions.publish(noted, f"{store}/files", lambda t, f: t.write.partitionBy(RUN).parquet(f), [RUN])
    return True


def _rows(spark: SparkSession, store: str, runs: list[str]) -> DataFrame:
    folders = [f"{store}/rows/{RUN}={run}" for run in runs]
    rows = spark.read.option("basePath", f"{store}/rows").parquet(*folders)
    return rows.withColumn(RUN, F.col(RUN).cast("string"))


def collected(spark: SparkSession, store: str) -> DataFrame | None:
    """The rows of all files in their newest state, without ``_file``; None before the first row.

    Names of runs choose folders, one folder a run. Rows of files that were read again
    later are taken out by a join with these files alone.
    """
    known = entries(spark, store)
    runs = [r[0] for r in known.where("header is not null").select(RUN).distinct().orderBy(RUN).collect()]
    if not runs:
        return None
    newest = known.groupBy("file").agg(F.max("number").alias("newest"))
    stale = known.join(newest, "file").where("number < newest").select(F.col("file").alias(headers.FILE), RUN)
    return _rows(spark, store, runs).join(stale, [headers.FILE, RUN], "left_anti").drop(headers.FILE, RUN)
