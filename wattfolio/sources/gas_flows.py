"""Gas flow CSV files below ``direction=.../point=...`` folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.functions import dates, numbers
from wattfolio.operators import filters
from wattfolio.operators.aggregate import union_all
from wattfolio.operators.balance import single_operator
from wattfolio.operators.quality import enforce_expected, flow_checks
from wattfolio.sources import headers, manifest

COLUMNS = ["unit", "directionKey", "operatorLabel", "pointLabel", "periodFrom", "periodTo", "value"]
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd")


def read_flow_files(
    spark: SparkSession, path: str, lenient: bool = False, by_name: bool = False
) -> DataFrame:
    """Read flow files by column name; further columns in the files are ignored.

    ``direction`` and, where the folders name it, ``point`` come from the path,
    so a filter on them skips whole folders. All files must have one header, or the
    job fails; with ``by_name`` the header lines are looked up first and files with
    other columns or another order are read by name, all in one scan. A file that lacks a
    needed column is an error either way.
    """
    if by_name:
        raw = _by_name(headers.lines(spark, path), manifest.with_headers(spark, path))
    else:
        raw = spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    return _typed(raw, lenient)


def _by_name(text: DataFrame, files: DataFrame) -> DataFrame:
    found = headers.parsed(text, files)
    for names, example in zip(found.names, found.examples, strict=True):
        lacking = [c for c in COLUMNS if c not in names]
        if lacking:
            raise ValueError(f"columns missing in some files, such as {example}: {', '.join(lacking)}")
    folders = [c for c in found.rows.columns if c in ("direction", "point")]
    return found.rows.select(headers.FILE, *folders, *(found.column(c).alias(c) for c in COLUMNS))


def _typed(raw: DataFrame, lenient: bool, *others: str) -> DataFrame:
    point = F.col("point") if "point" in raw.columns else F.col("pointLabel")
    return raw.select(
        F.col("direction").cast("string").alias("direction"),
        point.cast("string").alias("point"),
        *COLUMNS,
        *others,
    ).withColumns(
        {
            "periodFrom": dates.wall_clock(F.col("periodFrom"), *TIME_FORMATS),
            "periodTo": dates.wall_clock(F.col("periodTo"), *TIME_FORMATS),
            "value": numbers.number(F.col("value"), lenient),
        }
    )


def collect_flows(spark: SparkSession, path: str, store: str, lenient: bool = False) -> DataFrame:
    """All flows read so far from files below the path, of any column order; only unread files are opened.

    See ``manifest.collect``. The rows are as the files hold them: checks are made on reading.
    """

    def read(files: DataFrame, since: int) -> DataFrame:
        return _typed(_by_name(headers.lines(spark, path, since), files), lenient, headers.FILE)

    manifest.collect(spark, path, store, read)
    flows = manifest.collected(spark, store)
    if flows is None:
        raise ValueError(f"no file with a header in {path}")
    return flows


def read_flows(
    spark: SparkSession,
    path: str,
    history_path: str | None = None,
    mode: str = "fail",
    check_history: bool = True,
    order: dict | None = None,
    start: str | None = None,
    end: str | None = None,
    store: str | None = None,
) -> DataFrame:
    """Checked flows of all points with earlier files appended.

    ``start`` and ``end`` bound the new files of both directions. With
    ``check_history=False`` the earlier files are appended unchecked and keep
    all operators; they may have other headers. ``order`` is the reading order used by the mode ``stop``;
    earlier files are not part of it, their checks then fail the job. With ``store`` the
    earlier files are read once in their life and kept there (``collect_flows``).
    """
    order = order or {"import": fixed.IMPORT_POINTS, "export": fixed.EXPORT_POINTS}

    def checked(flows: DataFrame, mode: str = mode) -> DataFrame:
        good = enforce_expected(flows, flow_checks(), mode, order=order)
        return good.filter(single_operator(F.col("direction"), F.col("point"), F.col("operatorLabel")))

    current = filters.within(read_flow_files(spark, path), "periodFrom", start, end)
    if history_path is None:
        return checked(current)
    history = collect_flows(spark, history_path, store) if store else read_flow_files(spark, history_path, by_name=True)
    if not check_history:
        return union_all([checked(current), history])
    if mode == "stop":
        return union_all([checked(current), checked(history, "fail")])
    return checked(union_all([current, history]))
