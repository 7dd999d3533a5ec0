"""Near-duplicates among embeddings: sign hashing in several tables, exact cosines, components.

Vectors that fall on the same sides of all hyperplanes of a table share a bucket there.
Cosines are taken in double precision between the rows of a bucket; a pair that shared a
bucket of an earlier table is not counted again. Bits and tables follow from the data:
buckets of about ``bucket_rows`` evenly spread rows, and as many tables as keep the
probability to miss a pair at the threshold below ``miss``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfolio.llm.common import cut, whole_groups
from wattfolio.llm.components import Forest, components
from wattfolio.llm.vectors import matrix, usable

# Rows of a bucket that are compared as one block; a larger bucket becomes pairs of blocks.
BLOCK_ROWS = 2048
MOST_BITS = 30


def tables_for(rows: int, threshold: float, bucket_rows: int, miss: float) -> tuple[int, int]:
    """(bits, tables): more bits for more rows, and the tables that the bits then need."""
    bits = min(MOST_BITS, max(2, math.ceil(math.log2(max(rows, 1) / bucket_rows))))
    same_side = 1 - math.acos(threshold) / math.pi
    return bits, math.ceil(math.log(miss) / math.log(1 - same_side**bits))


def signatures(x: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    planes = np.random.default_rng([seed, x.shape[1]]).standard_normal((x.shape[1], bits * tables))
    sides = (x @ planes > 0).reshape(len(x), tables, bits)
    return (sides << np.arange(bits)).sum(axis=2).astype(np.int32)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows in double precision times powers of two that bring the largest component to between 1/2 and 1.

    Cosines stay what they are to the last bit, and no square overflows or vanishes.
    """
    x = x.astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])


def compare(
    x: np.ndarray, block: np.ndarray, at: int, threshold: float, marks_of: Callable[[np.ndarray], np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked rows (i, j) of a bucket, or of a pair of its blocks, and those that no earlier table had.

    Marks are taken anew, and only of rows that are linked.
    """
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    unit = x / norm[:, None]
    if block[0] == block[-1]:
        i, j = np.nonzero(np.triu(unit @ unit.T >= threshold - 1e-9, 1))
    else:
        edge = int(np.searchsorted(block, block[-1]))
        i, j = np.nonzero(unit[:edge] @ unit[edge:].T >= threshold - 1e-9)
        j = j + edge
    keep = np.empty(len(i), dtype=bool)
    for k in range(0, len(i), 100_000):
        p, q = i[k : k + 100_000], j[k : k + 100_000]
        keep[k : k + len(p)] = np.einsum("ij,ij->i", x[p], x[q]) / (norm[p] * norm[q]) >= threshold
    i, j = i[keep], j[keep]
    first = np.ones(len(i), dtype=bool)
    if at and len(i):
        rows, spot = np.unique(np.concatenate([i, j]), return_inverse=True)
        marks = marks_of(x[rows])[:, :at]
        p, q = spot[: len(i)], spot[len(i) :]
        for k in range(0, len(i), 100_000):
            part = slice(k, k + 100_000)
            first[part] = ~(marks[p[part]] == marks[q[part]]).any(axis=1)
    return i, j, first


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.93,
    bucket_rows: int = 32,
    miss: float = 0.0005,
    seed: int = 7,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of (vec_id, embedding, label).

    Rows link if their labels are equal and not null, their vectors of one length, and
    the cosine is at least ``threshold``. Vectors that are null, zero, empty, or hold
    null or non-finite components link with nothing. Equal vectors of a label are one
    node with a weight, so copies are never expanded; each row counts as a vector of its
    own, also if its id repeats. A null id is never the smallest, and is not kept.
    Further columns are ignored.
    """
    rows = vectors.select("vec_id", F.col("embedding").alias("v"), "label")
    fits = usable(F.col("v")) & F.col("label").isNotNull() & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("fits", F.coalesce(fits, F.lit(False)))
    nodes = (
        rows.where("fits")
        .groupBy("label", "v")
        .agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"))
        .select(
            F.monotonically_increasing_id().alias("node"), "label", F.size("v").alias("dim"),
            "v", "weight", "least",
        )
    )
    nodes = cut(nodes)
    most = nodes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 1
    bits, tables = tables_for(most, threshold, bucket_rows, miss)

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                marks = signatures(scaled(matrix(part.column("v"), int(dim))), bits, tables, seed)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(marks.ravel()), tables).cast(pa.list_(pa.int32()))
                columns = [part.column(c) for c in ("node", "label", "dim", "v", "weight")]
                yield pa.RecordBatch.from_arrays([*columns, lists], ["node", "label", "dim", "v", "weight", "marks"])

    # vectors travel as they came, and their marks are not sent along
    kind, vector = (nodes.schema[c].dataType.simpleString() for c in ("label", "v"))
    marked = nodes.select("node", "label", "dim", "v", "weight").mapInArrow(
        mark, f"node long, label {kind}, dim int, v {vector}, weight long, marks array<int>"
    )
    # labels of any type are numbered by their hash next to the label itself
    bucket = ["label", "dim", "at", "mark"]
    placed = marked.select("node", "label", "dim", "v", "weight", F.posexplode("marks").alias("at", "mark"))
    sizes = placed.groupBy(*bucket).agg(F.ceil(F.count("node") / block_rows).alias("blocks"))
    placed = placed.join(sizes.where("blocks > 1"), bucket, "left").fillna(1, ["blocks"])
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    placed = placed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("with"))
    placed = placed.select(
        F.xxhash64("label").alias("group"), "dim", "at", "mark", F.least("block", "with").alias("one"),
        F.greatest("block", "with").alias("two"), "block", "node", "v", "weight",
    )
    cell = ["group", "dim", "at", "mark", "one", "two"]

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, starts in whole_groups(batches, cell, 10_000):
            node, weight, block = (part.column(c).to_numpy() for c in ("node", "weight", "block"))
            dim, at, one, two = (part.column(c).to_numpy() for c in ("dim", "at", "one", "two"))
            count = np.zeros(len(node), dtype=np.int64)
            forest = Forest(len(node))
            for a, b in zip(starts, [*starts[1:], len(node)], strict=True):
                if b - a < 2 or (one[a] != two[a] and block[a] == block[b - 1]):
                    continue
                x = scaled(matrix(part.column("v").slice(a, b - a), int(dim[a])))
                i, j, first = compare(x, block[a:b], int(at[a]), threshold, lambda y: signatures(y, bits, tables, seed))
                i, j = i + a, j + a
                forest.link(i, j)
                np.add.at(count, i[first], weight[j[first]])
                np.add.at(count, j[first], weight[i[first]])
            counted = np.flatnonzero(count)
            item, root = forest.links()
            a, b = np.append(node[counted], node[item]), np.append(count[counted], node[root])
            edge = np.arange(len(a)) >= len(counted)
            yield pa.RecordBatch.from_arrays([pa.array(y) for y in (edge, a, b)], ["edge", "a", "b"])

    found = placed.repartition(*cell).sortWithinPartitions(*cell, "block")
    found = cut(found.mapInArrow(verify, "edge boolean, a long, b long"))
    counts = found.where("not edge").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links"))
    roots = components(found.where("edge").select("a", "b"))
    named = nodes.select("node", "label", "v", "weight", "least").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node")).join(counts, "node", "left")
    ids = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(ids, "root").select(
        "label", "v", "component", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    linked = rows.where("fits").join(named, ["label", "v"]).select("vec_id", "n_links", F.col("component").alias("component_id"))
    alone = rows.where("not fits").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return linked.unionAll(alone).select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
