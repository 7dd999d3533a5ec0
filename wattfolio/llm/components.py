"""Connected components of an edge table, as joins and aggregates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfolio.llm.common import cut


# Parts that the neighbours of a node are dealt into.
PARTS = 64


def with_least(pairs: DataFrame, own: bool) -> DataFrame:
    """(u, v, m): the pairs with the smallest v of their u, or u itself where that is smaller and ``own`` is set.

    The smallest is found over parts of a node's pairs, and goes back to these parts, so
    that the pairs of one node are spread over tasks on both ways.
    """
    pairs = pairs.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(PARTS)))
    least = pairs.groupBy("u", "part").agg(F.min("v").alias("m"))
    least = least.groupBy("u").agg(F.min("m").alias("m"), F.collect_list("part").alias("parts"))
    m = F.least("u", "m") if own else F.col("m")
    return pairs.join(least.select("u", m.alias("m"), F.explode("parts").alias("part")), ["u", "part"]).drop("part")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of an edge (a, b); the root is its component's smallest node.

    Alternates two steps until nothing changes: each node's larger neighbours are
    linked to its smallest one, then its smaller neighbours are. A node's neighbours
    are never gathered in one task (``with_least``). Edges with a null end and loops are
    left out.
    """
    u, v, m = F.col("u"), F.col("v"), F.col("m")
    now = cut(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("a is not null and b is not null and a <> b")
        .distinct()
    )
    state = None
    while (seen := now.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).first()) != state:
        state = seen
        if not seen[0]:
            break
        both = now.unionAll(now.select(v.alias("u"), u.alias("v")))
        large = with_least(both, True).where(v > u).select(v.alias("u"), m.alias("v"))
        small = with_least(large, False).select(F.when(v == m, u).otherwise(v).alias("u"), m.alias("v"))
        now = cut(small.where(u != v).distinct())
    return now.select(u.alias("node"), v.alias("root")).unionAll(now.select(v.alias("node"), v.alias("root")).distinct())


class Forest:
    """Components of numbered items within one task; the root is the smallest number."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            a, b = root[a], root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := root[root], root):
                root = up
        self.root = root

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """As few links as hold the same components: each item with its root."""
        item = np.flatnonzero(self.root != np.arange(len(self.root)))
        return item, self.root[item]
