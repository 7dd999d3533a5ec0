"""Results that no reader sees half done (K1-K3).

Below a result's folder every write gets a folder of its own, ``versions/version=...``, and
touches no other. It becomes the current one by its last step: a small file below
``pointers`` that names it, which Spark moves into place when it is complete. Readers look
up the pointers first. A run that fails before that step leaves the result as it was, and
what it wrote is found by no reader.

A result may have parts, by the values of some columns, such as a series or a year. A write
then replaces the parts it holds, all at once, and the others keep their last version.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "version"
POINTER = "number long, version string, part string"


def part_of(columns: Sequence[str]) -> Column:
    """The part a row belongs to, as text; without columns all rows are one part."""
    return F.to_json(F.array(*(F.col(f"`{c}`").cast("string") for c in columns))) if columns else F.lit("[]")


def pointers(spark: SparkSession, path: str) -> DataFrame:
    """(part, version): the current version of each part; no row where nothing was published yet."""
    try:
        every = spark.read.schema(POINTER).json(f"{path}/pointers")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        every = spark.createDataFrame([], POINTER)
    # two writers at once may count to the same number; the name decides then, for every reader alike
    return every.groupBy("part").agg(F.max_by("version", F.struct("number", "version")).alias(VERSION))


def new_version(spark: SparkSession, path: str) -> tuple[int, str]:
    """A number above all published ones, and the name of a version that sorts by it."""
    try:
        last = spark.read.schema(POINTER).json(f"{path}/pointers").agg(F.max("number")).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        last = 0
    return last + 1, f"{last + 1:08d}-{uuid.uuid4().hex[:12]}"


def point(parts: DataFrame, path: str, number: int, version: str) -> None:
    """Make a version the current one of ``parts`` (column part): one file, so all of them at once."""
    rows = parts.select(F.lit(number).cast("long").alias("number"), F.lit(version).alias(VERSION), "part")
    rows.coalesce(1).write.mode("append").json(f"{path}/pointers")


def publish(table: DataFrame, path: str, write: Callable[[DataFrame, str], None], parts: Sequence[str] = ()) -> None:
    """Write ``table`` by ``write(table, folder)`` as a new version and make it current for the parts it holds.

    The table should be read from files, as it is read twice when it has parts. Without
    parts an empty table is a result as well; with parts it changes nothing.
    """
    spark = table.sparkSession
    number, version = new_version(spark, path)
    write(table, f"{path}/versions/{VERSION}={version}")
    held = table.select(part_of(parts).alias("part")).distinct() if parts else spark.range(1).select(part_of(()).alias("part"))
    point(held, path, number, version)


def current(spark: SparkSession, path: str, read: Callable[[list[str]], DataFrame], parts: Sequence[str] = ()) -> DataFrame | None:
    """The rows of the current versions, None where nothing was published.

    ``read`` gets the folders of these versions and reads them with ``parts`` and the
    version as columns. Folders of versions that are not current for any part are not listed.
    A version that is current for some of its parts is read for these alone.
    """
    known = pointers(spark, path)
    names = [r[0] for r in known.select(VERSION).distinct().orderBy(VERSION).collect()]
    if not names:
        return None
    rows = read([f"{path}/versions/{VERSION}={n}" for n in names])
    if not parts:
        return rows.drop(VERSION)
    now = known.select(F.col("part").alias("_part"), F.col(VERSION).alias("_version"))
    same = (part_of(parts) == F.col("_part")) & (F.col(VERSION).cast("string") == F.col("_version"))
    return rows.join(now, same, "left_semi").drop(VERSION)


def tidy(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove versions that no part points to, but for the ``keep`` newest; returns their names.

    Readers that started before a newer version came still find theirs, and so do writers
    that have not yet set their pointer.
    """
    used = {r[VERSION] for r in pointers(spark, path).collect()}
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(f"{path}/versions")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    names = sorted(s.getPath().getName().partition("=")[2] for s in files.listStatus(root))
    old = [n for n in names[: len(names) - keep] if n not in used]
    for name in old:
        files.delete(hadoop.Path(f"{path}/versions/{VERSION}={name}"), True)
    return old
