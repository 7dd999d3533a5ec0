"""Shared helpers: tables, cut lineage, slices of bounded size."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfolio.session import shared_root

# Bytes of text that one step of a Python task holds at a time; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Spark's folder for checkpoints, below the shared folder of the session."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_root(spark))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The same rows without their history, kept in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str, by: Sequence[str] = (), compression: str = "snappy") -> DataFrame:
    """The same rows written as Parquet below the shared folder, in folders ``by`` columns, and read again."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many marks put behind it as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def text_slices(batches: Iterable[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``size`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def whole_groups(
    batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 100_000
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches regrouped: tables of whole groups, with the row each group starts at.

    A table ends at a group's end once it holds ``rows`` rows, so memory is bounded by
    that number and the largest group.
    """
    held: list[pa.RecordBatch] = []
    n = 0

    def cut_at(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, dtype=bool)
        new[:1] = True
        for key in keys:
            values = table.column(key).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            starts = cut_at(table)
            if len(starts) > 1:
                last = int(starts[-1])
                yield table.slice(0, last), starts[:-1]
                held = table.slice(last).to_batches()
                n = table.num_rows - last
    if n:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, cut_at(table)
