"""SimHash near-duplicates: fingerprints and a self-join of their binary trie.

Two fingerprints within ``max_bits`` bits agree in one of ``max_bits + 1`` blocks of
bits, so each fingerprint is placed once per block, rotated so that the block leads.
A cell is a trie node (the rows with one leading block); within it pairs of nodes are
walked together, bit by bit, their differing bits are added up, and a pair is dropped
once they exceed the budget. A cell that holds too many rows is opened on the cluster
first, into the pairs of its child nodes that are still within the budget.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattfolio.llm.common import cut, free, text_slices, whole_groups
from wattfolio.llm.components import Forest, components

SEED = 42
# Rows of one cell that a single task compares, bits by which a larger cell is opened,
# and node pairs that a task walks at a time.
CELL_ROWS = 50_000
OPEN_BITS = 6
PAIRS = 200_000


def shingle_hashes(text: bytes, shingle: int) -> list[int]:
    """XXH64 of each run of ``shingle`` words, repeats included; fewer words are one run."""
    words = text.lower().split()
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return [digest(b" ".join(words), SEED)] if words else []
    return [digest(b" ".join(run), SEED) for run in zip(*(words[i:] for i in range(shingle)), strict=False)]


def majority(hashes: list[list[int]]) -> np.ndarray:
    """For each list the 64 bits that more than half of its hashes have; none: zero."""
    sizes = np.array([len(x) for x in hashes], dtype=np.int64)
    out = np.zeros(len(hashes), dtype=np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        flat = np.fromiter((h for x in hashes for h in x), dtype=np.uint64, count=int(sizes.sum()))
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        for bit in range(64):
            ones = np.add.reduceat((flat >> np.uint64(bit)) & np.uint64(1), starts).astype(np.int64)
            out[full] |= (2 * ones > sizes[full]).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, mark, fp) for each row of (doc_id, text); a null or empty text has fingerprint zero, mark is a hash of the text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts = part.column("text").cast(pa.binary()).to_pylist()
            fp = majority([shingle_hashes(x or b"", shingle) for x in texts])
            columns = [part.column("doc_id"), part.column("mark"), pa.array(fp.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(run, f"doc_id {kind}, mark long, fp long")


def cells(distinct: DataFrame, max_bits: int, cell_rows: int) -> DataFrame:
    """(turn, depth, a, b, x): rotated fingerprints by the pair of trie nodes they are compared in."""
    blocks = max_bits + 1
    width = 64 // blocks
    turned = distinct.select("fp", F.explode(F.array(*(F.lit(i * width) for i in range(blocks)))).alias("turn"))
    turned = turned.select(
        "turn", F.expr("shiftleft(fp, turn) | shiftrightunsigned(fp, 64 - turn)").alias("x")
    )

    def node(depth: int) -> Column:
        return F.shiftrightunsigned("x", 64 - depth)

    first = turned.select("turn", F.lit(width).alias("depth"), node(width).alias("a"), node(width).alias("b"), "x")
    sizes = first.groupBy("turn", "a").agg(F.count("x").alias("n"))
    hot = cut(sizes.where(F.col("n") > cell_rows).select("turn", "a", F.col("a").alias("b"), F.lit(0).alias("bits")))
    if hot.isEmpty():
        return first
    out = first.join(hot.select("turn", "a"), ["turn", "a"], "left_anti").select(first.columns)
    depth = width
    pairs = hot
    while True:
        step = min(OPEN_BITS, 64 - depth)
        ends = pairs.select("turn", "a").unionAll(pairs.select("turn", "b")).distinct()
        rows = turned.withColumn("a", node(depth)).join(ends, ["turn", "a"], "left_semi")
        depth += step
        sizes = rows.groupBy("turn", "a", node(depth).alias("child")).agg(F.count("x").alias("n"))
        left = sizes.select("turn", "a", F.col("child").alias("a2"), F.col("n").alias("n_a"))
        right = sizes.select("turn", F.col("a").alias("b"), F.col("child").alias("b2"), F.col("n").alias("n_b"))
        opened = cut(
            pairs.join(left, ["turn", "a"])
            .join(right, ["turn", "b"])
            .withColumn("bits", F.col("bits") + F.bit_count(F.expr(f"(a2 ^ b2) & {2**step - 1}")))
            .where(F.col("bits") <= max_bits)
            .where("a2 <= b2")
            .select("turn", F.col("a2").alias("a"), F.col("b2").alias("b"), "bits", (F.col("n_a") + F.col("n_b")).alias("n"))
        )
        ready = opened if depth == 64 else opened.where(F.col("n") <= 2 * cell_rows)
        at = turned.withColumn("at", node(depth))
        sides = ready.select("turn", "a", "b", F.col("a").alias("at")).unionAll(
            ready.where("a <> b").select("turn", "a", "b", F.col("b").alias("at"))
        )
        out = out.unionAll(at.join(sides, ["turn", "at"]).select("turn", F.lit(depth).alias("depth"), "a", "b", "x"))
        pairs = opened.where(F.col("n") > 2 * cell_rows).select("turn", "a", "b", "bits")
        if depth == 64 or pairs.isEmpty():
            return out


def trie_links(x: np.ndarray, starts: np.ndarray, depth: int, max_bits: int) -> Forest:
    """Components of sorted fingerprints, within each group that shares its first ``depth`` bits.

    A node is a range of the sorted rows. Pairs that one component already holds are
    dropped, as they add nothing to it.
    """
    forest = Forest(len(x))
    ends = np.append(starts[1:], len(x))
    large = ends - starts > 1
    none = np.zeros(int(large.sum()), dtype=np.int64)
    stack = [(depth, starts[large], ends[large], starts[large], ends[large], none)]
    ones: dict[int, np.ndarray] = {}
    while stack:
        d, a, a_end, b, b_end, bits = stack.pop()
        if len(a) > PAIRS:
            half = len(a) // 2
            stack.append((d, a[half:], a_end[half:], b[half:], b_end[half:], bits[half:]))
            stack.append((d, a[:half], a_end[:half], b[:half], b_end[:half], bits[:half]))
            continue
        single = (a_end - a == 1) & (b_end - b == 1)
        if single.any():
            p, q = a[single], b[single]
            new = forest.root[p] != forest.root[q]
            p, q = p[new], q[new]
            near = np.bitwise_count(x[p] ^ x[q]) <= max_bits
            forest.link(p[near], q[near])
            a, a_end, b, b_end, bits = (y[~single] for y in (a, a_end, b, b_end, bits))
        if d == 64 or not len(a):
            continue
        if d not in ones:
            ones[d] = np.concatenate([[0], np.cumsum((x >> np.uint64(63 - d)) & np.uint64(1)).astype(np.int64)])
        count = ones[d]
        a_mid, b_mid = a_end - (count[a_end] - count[a]), b_end - (count[b_end] - count[b])
        own = a == b
        other = ~own
        # zero-zero, one-one, zero-one; one-zero only for two different nodes
        children = [
            (a, a_mid, b, b_mid, bits),
            (a_mid, a_end, b_mid, b_end, bits),
            (a, a_mid, b_mid, b_end, bits + 1),
            (a_mid[other], a_end[other], b[other], b_mid[other], bits[other] + 1),
        ]
        a, a_end, b, b_end, bits = (np.concatenate(y) for y in zip(*children, strict=True))
        live = (a_end > a) & (b_end > b) & (bits <= max_bits) & ~((a == b) & (a_end - a == 1))
        if live.any():
            stack.append((d + 1, a[live], a_end[live], b[live], b_end[live], bits[live]))
    return forest


def links(distinct: DataFrame, max_bits: int = 3, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b): links that join all fingerprints (column fp, each once) within ``max_bits`` bits."""
    width = 64 // (max_bits + 1)
    keys = ["turn", "depth", "a", "b"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_groups(batches, keys):
            x = rows.column("x").to_numpy().view(np.uint64)
            turn = rows.column("turn").to_numpy().astype(np.uint64)
            item, root = trie_links(x, starts, width, max_bits).links()
            back = [
                (x[i] >> turn[i]) | (x[i] << ((np.uint64(64) - turn[i]) % np.uint64(64))) for i in (item, root)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(y.view(np.int64)) for y in back], ["a", "b"])

    placed = cells(distinct, max_bits, cell_rows).repartition(*keys).sortWithinPartitions(*keys, "x")
    return placed.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """(doc_id, mark, fp, fingerprint, root, component_id) for each row of (doc_id, text).

    ``component_id`` is the smallest doc_id that is reachable over links between
    fingerprints of at most ``max_bits`` differing bits; ``root`` names the component and
    ``mark`` the text. Equal fingerprints are one
    node, so exact copies are never compared with each other. Texts that are null,
    empty or without words have fingerprint zero and are linked like any other; rows
    that repeat an id are rows of their own; null ids are never the smallest (a component of null ids
    alone has a null id). Columns beside doc_id and text are ignored.
    """
    marked = cut(fingerprints(docs, shingle))
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes.select("fp"), max_bits, cell_rows))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left")
    named = named.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    out = marked.join(named.join(ids, "root").select("fp", "root", "component_id"), "fp")
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return out.select("doc_id", "mark", "fp", fingerprint, "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of (doc_id, text, ...) that stay: one of each component, that of the smallest id.

    A null id comes last; rows with one id go by a hash of the text. Columns and their
    order stay.
    """
    found = near_duplicates(docs, shingle, max_bits)
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    id_, mark, nth = free(docs, "id", "mark", "nth")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark", name.alias("name"))).alias("first")
    kept = found.groupBy("root").agg(first).select(F.col("first.name").alias(id_), F.col("first.mark").alias(mark))
    rows = docs.withColumns({id_: name, mark: F.xxhash64("text")}).join(kept, [id_, mark])
    order = Window.partitionBy(id_, mark).orderBy(id_, mark)
    rows = rows.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1)
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))
