"""Exact top-k by inner product: vectors by descending length, rotated partial sums, residual bounds.

Equal vectors are one node, which is searched and found once; the ids of its copies are
put in at the end, the k + 1 smallest of each, as no answer needs more. Nodes are dealt
into blocks by descending length. All queries meet the longest block first, which gives
each a score to beat, then in rounds some times as many blocks as before, with the score
risen in between; a block is read for a query only if the product of lengths can reach
that score. Queries that give up at about the same length of candidates stand together,
so that a block is sent to those groups of queries alone that still ask for it. Within a
block the candidates are taken by descending length, in the basis of the block's singular
vectors: the inner product of the leading coordinates plus the product of the residual
lengths bounds the score, and only pairs whose bound reaches the score to beat get their
exact integer product.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattfolio.llm.common import cut, whole_groups
from wattfolio.llm.vectors import matrix, usable

BLOCK_ROWS = 8192
QUERY_ROWS = 2048
CHUNK = 1024
# Blocks of a round, as a multiple of those before.
GROWTH = 8
# Groups that the queries are dealt into by the length at which they give up.
GROUPS = 64
# Integers up to this size, and their sums, are exact in double precision.
EXACT = 2.0**53
LIMIT = (1 << 63) - 1
LEADING = 0.9


def integers(vector: str, scale: int) -> F.Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows, each with each; beyond a long they are cut to its largest value, or less that."""
    reach = max(np.abs(q).max(initial=0), 1) * float(max(np.abs(c).max(initial=0), 1)) * max(q.shape[1], 1)
    if reach < EXACT:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return np.clip(q.astype(object) @ c.astype(object).T, -LIMIT, LIMIT).astype(np.int64)


class Best:
    """The k highest scores of each query so far, ties to the smaller id."""

    def __init__(self, queries: int, k: int, beat: np.ndarray) -> None:
        self.k, self.beat, self.n = k, beat.copy(), queries
        self.rows = [np.empty(0, dtype=np.int64) for _ in range(4)]  # query, score, id, row

    def add(self, query: np.ndarray, score: np.ndarray, vec: np.ndarray, row: np.ndarray) -> None:
        query, score, vec, row = (
            np.concatenate(x) for x in zip(self.rows, (query, score, vec, row), strict=True)
        )
        order = np.lexsort((row, vec, -score, query))
        query, score, vec, row = (x[order] for x in (query, score, vec, row))
        first = np.searchsorted(query, np.arange(self.n))
        rank = np.arange(len(query)) - first[query]
        last = rank == self.k - 1
        self.beat[query[last]] = np.maximum(self.beat[query[last]], score[last])
        self.rows = [x[rank < self.k] for x in (query, score, vec, row)]


def search(
    q: np.ndarray, beat: np.ndarray, c: np.ndarray, c_id: np.ndarray, c_row: np.ndarray, k: int
) -> Best:
    """Candidates come by descending length."""
    qf, cf = q.astype(np.float64), c.astype(np.float64)
    spread, basis = np.linalg.eigh(cf.T @ cf) if c.shape[1] else (np.empty(0), np.empty((0, 0)))
    basis, spread = basis[:, ::-1], np.maximum(spread[::-1], 0)
    lead = int(np.searchsorted(np.cumsum(spread), LEADING * spread.sum())) + 1 if spread.sum() else c.shape[1]
    qr, cr = qf @ basis, cf @ basis
    q_len, c_len = np.sqrt((qf**2).sum(axis=1)), np.sqrt((cf**2).sum(axis=1))
    q_rest, c_rest = np.sqrt((qr[:, lead:] ** 2).sum(axis=1)), np.sqrt((cr[:, lead:] ** 2).sum(axis=1))
    best = Best(len(q), k, beat)
    for start in range(0, len(c), CHUNK):
        part = slice(start, start + CHUNK)
        slack = 1e-9 * (1 + q_len * c_len[start])
        live = np.flatnonzero(q_len * c_len[start] + slack >= best.beat)
        if not len(live):
            break
        bound = qr[live, :lead] @ cr[part, :lead].T + q_rest[live, None] * c_rest[None, part] + slack[live, None]
        open_ = bound >= best.beat[live, None]
        some = open_.any(axis=1)
        live, open_ = live[some], open_[some]
        if not len(live):
            continue
        scores = products(q[live], c[part])
        i, j = np.nonzero(open_ & (scores >= best.beat[live, None]))
        # of one chunk at most k of a query can stay
        best.add(live[i], scores[i, j], c_id[part][j], c_row[part][j])
    return best


def by_reach(queries: DataFrame, n_blocks: int) -> DataFrame:
    """Queries with a new ``query_block``: those of one block give up at about the same length of candidates.

    A query is done with candidates shorter than its score to beat over its length.
    Equal ones that fill several groups are spread over these by a hash.
    """
    reach = F.coalesce(F.try_divide("beat", "length"), F.lit(float("-inf")))
    groups = min(GROUPS, n_blocks)
    inner = [i / groups for i in range(1, groups)]
    bounds = queries.agg(F.percentile_approx(reach, F.array(*map(F.lit, inner)), 1000)).first()[0] if inner else None
    bounds = F.array(*map(F.lit, bounds or [])).cast("array<double>")
    below, up_to = (F.size(F.filter(bounds, f)) for f in (lambda x: x < reach, lambda x: x <= reach))
    spread = F.xxhash64("row")
    group = below + F.pmod(spread, (up_to - below + 1).cast("long"))
    each = -(-n_blocks // groups)
    within = F.pmod(F.xxhash64("row", F.lit("block")), F.lit(each))
    return queries.withColumn("query_block", group * each + within)


def top_k(
    vectors: DataFrame,
    every: int = 20,
    k: int = 20,
    scale: int = 64,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query row.

    Components become floor(scale * x), a long; one beyond that is the largest or smallest
    long. A score beyond a long is cut to 2**63 - 1, or less that; scores that are cut tie. Queries are the rows whose vec_id is divisible
    by ``every``; candidates are all other rows, also those that repeat the query's id
    or vector. Vectors are compared with those of their own length. Rows whose vector is
    null or holds null or non-finite components take no part, nor do rows with a null
    id. Ties go to the smaller vec_id. Further columns are ignored.
    """
    rows = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), integers("embedding", scale).alias("x"))
    is_query = F.col("vec_id") % every == 0
    n, n_query = rows.agg(F.count("vec_id"), F.count_if(is_query)).first()
    n_blocks, n_query_blocks = max(1, -(-n // block_rows)), max(1, -(-n_query // query_rows))
    asking = rows.where(is_query).select("x").distinct().withColumn("asks", F.lit(True))
    copies = Window.partitionBy("x").orderBy("vec_id")
    nodes = rows.withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= k + 1)
    nodes = nodes.groupBy("x").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).join(asking, "x", "left")
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    nodes = nodes.select(
        F.col("ids")[0].alias("vec_id"), "x", F.size("x").alias("dim"), length.alias("length"), "ids",
        F.coalesce("asks", F.lit(False)).alias("asks"),
    )
    dealt = nodes.repartitionByRange(n_blocks, F.col("dim"), F.desc("length"), F.col("vec_id"))
    base = cut(dealt.select("*", F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("row")))
    queries = base.where("asks").drop("ids", "block")
    queries = queries.withColumn("query_block", F.pmod(F.xxhash64("row"), F.lit(n_query_blocks)))
    place = F.row_number().over(Window.partitionBy("dim").orderBy("block")) - 1
    blocks = base.groupBy("dim", "block").agg(F.max("length").alias("longest")).withColumn("place", place)
    last = blocks.agg(F.max("place")).first()[0] or 0
    by_node = Window.partitionBy("row").orderBy(F.desc("score"), "least")
    keys = ["dim", "block", "query_block"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, starts in whole_groups(batches, keys, 1):
            side, row, vec, beat = (part.column(c).to_numpy() for c in ("side", "row", "vec_id", "beat"))
            for a, b in zip(starts, [*starts[1:], part.num_rows], strict=True):
                edge = a + int(np.searchsorted(side[a:b], 1))
                if edge in (a, b):
                    continue
                dim = int(part.column("dim")[int(a)].as_py())
                x = matrix(part.column("x").slice(a, b - a), dim)
                best = search(x[: edge - a], beat[a:edge], x[edge - a :], vec[edge:b], row[edge:b], k + 1)
                query, score, least, found = best.rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(y) for y in (row[a:edge][query], found, least, score)], ["row", "found", "least", "score"]
                )

    def meet(asked: DataFrame) -> DataFrame:
        """Best candidates of the queries in the blocks; asked has a block for each row."""
        offered = base.join(asked.select(*keys).distinct(), ["dim", "block"])
        columns = [*keys, "row", "vec_id", "x", "length"]
        both = asked.select(*columns, F.lit(0).alias("side"), "beat").unionAll(
            offered.select(*columns, F.lit(1).alias("side"), F.lit(0.0).alias("beat"))
        )
        sorted_ = both.repartition(*keys).sortWithinPartitions(*keys, "side", F.desc("length"), "row")
        return sorted_.mapInArrow(run, "row long, found long, least long, score long")

    found, low, high = None, 0, 1
    while low <= last:
        here = blocks.where(F.col("place").between(low, high - 1)).drop("place")
        if found is None:
            held = queries.withColumn("beat", F.lit(float("-inf")))
        else:
            kth = found.groupBy("row").agg(F.count("score").alias("n"), F.min("score").alias("worst"))
            beat = F.coalesce(F.when(F.col("n") > k, F.col("worst")).cast("double"), F.lit(float("-inf")))
            held = by_reach(queries.join(kth, "row", "left").withColumn("beat", beat), n_query_blocks)
        asked = held.join(here, "dim").where(F.col("length") * F.col("longest") * (1 + 1e-9) >= F.col("beat"))
        new = meet(asked)
        if found is not None:
            new = found.unionAll(new).withColumn("nth", F.row_number().over(by_node)).where(F.col("nth") <= k + 1).drop("nth")
        found = cut(new)
        low, high = high, high * GROWTH
    ids = base.select(F.col("row").alias("found"), "ids")
    each = found.join(ids, "found").select("row", "found", "score", F.explode("ids").alias("vec_id"))
    by_copy = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "found")
    each = each.withColumn("nth", F.row_number().over(by_copy)).where(F.col("nth") <= k + 1)
    best = F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score", "found"))).alias("best")
    answers = each.groupBy("row").agg(best).join(base.where("asks").select("row", "x"), "row")
    # a query is left out of its own answer, once
    own = F.transform("best", lambda b: (b["vec_id"] == F.col("query_id")) & (b["found"] == F.col("row")))
    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "x").join(answers, "x")
    others = F.filter("best", lambda b, i: i + 1 != F.col("own"))
    ranked = asked.withColumn("own", F.array_position(own, True)).select(
        "query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "b")
    )
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), "b.vec_id", "b.score")
