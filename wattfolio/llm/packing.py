"""Conflict-constrained best-fit packing of documents into sequences of fixed capacity.

Whole pieces of long documents fill sequences of their own. The rests are dealt into
shards of bounded size, spread by a hash, and each shard is packed by itself: rests by
descending size, each into the bin with the least room that still fits and has no
conflict. A bin carries a bitmap of its sources and one of its duplicate clusters; it
takes a source once and a cluster once. The search walks from the tightest bin upwards
until it finds a compatible one; bins of the same room and sources are kept together,
so it does not walk past bins that all conflict in the same way.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfolio.llm.common import cut
from wattfolio.llm.mixing import words

CAPACITY = 1024
SHARD_ROWS = 8192


class Bins:
    """Open bins of one shard, ordered by their room."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.rooms: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]  # sources to bins
        self.filled = 0  # bit r is set if a bin has room r
        self.clusters: list[int] = []

    def put(self, bin_: int, room: int, sources: int) -> None:
        self.rooms[room].setdefault(sources, []).append(bin_)
        self.filled |= 1 << room

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, place within it) for a rest; source and cluster are bits."""
        room = size
        while left := self.filled >> room:
            room += (left & -left).bit_length() - 1
            for sources, bins in self.rooms[room].items():
                if sources & source:
                    continue
                at = next((i for i, b in enumerate(bins) if not self.clusters[b] & cluster), None)
                if at is None:
                    continue
                bin_ = bins.pop(at)
                if not bins:
                    del self.rooms[room][sources]
                    if not self.rooms[room]:
                        self.filled &= ~(1 << room)
                self.clusters[bin_] |= cluster
                self.put(bin_, room - size, sources | source)
                return bin_, self.capacity - room
            room += 1
        self.clusters.append(cluster)
        self.put(len(self.clusters) - 1, self.capacity - size, source)
        return len(self.clusters) - 1, 0


def pack_shard(size: np.ndarray, source: np.ndarray, cluster: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, place) of each rest; sizes come in descending order, sources and clusters as small numbers.

    Clusters of one rest conflict with nothing, so only the others get a bit.
    """
    bins = Bins(capacity)
    shared = np.bincount(cluster, minlength=1) > 1
    bit = np.cumsum(shared) - 1
    got = [
        bins.place(int(n), 1 << int(s), 1 << int(bit[c]) if shared[c] else 0)
        for n, s, c in zip(size, source, cluster, strict=True)
    ]
    pairs = np.array(got, dtype=np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def pack(
    docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, clusters: DataFrame | None = None
) -> DataFrame:
    """(doc_id, source, piece, first_word, n_words, bin_id, at_word), a row per piece of each row of (doc_id, text, source).

    A piece is a run of at most ``capacity`` words of one document; a bin holds at most
    that many words, at most one piece of each source (a null source is one) and of each
    duplicate cluster. Clusters are given by (doc_id, mark, cluster) as one row or more for
    each row of ``docs``, ``mark`` being the text's xxhash64, equal rows being equal here; without
    them, rows of the same text are one. ``at_word`` is where the piece starts in
    its bin. A text that is null or has no words is one piece of no words in no bin
    (bin_id null). Rows that repeat are packed as often; ties go by id, text and copy, so the
    same rows give the same bins however they are dealt into partitions. An empty table
    gives no rows. Further columns are ignored.
    """
    mark = F.xxhash64("text")
    rows = docs.select("doc_id", "source", words(F.col("text")).alias("size"), mark.alias("mark"), mark.alias("cluster"))
    if clusters is not None:
        given = clusters.select(F.col("doc_id").alias("id"), F.col("mark").alias("of"), F.col("cluster").alias("given")).distinct()
        rows = rows.join(given, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("of")), "left")
        rows = rows.select("doc_id", "source", "size", "mark", F.coalesce("given", "cluster").alias("cluster"))
    # equal rows are told apart by their number among themselves, so nothing depends on how the input is dealt
    same = rows.groupBy("doc_id", "source", "size", "mark", "cluster").agg(F.count(F.lit(1)).alias("n"))
    key = F.concat_ws("-", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.hex(F.xxhash64("doc_id", "source", "mark")), "copy")
    each = same.select("doc_id", "source", "size", "mark", "cluster", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
    rows = cut(each.select("doc_id", "source", "size", "cluster", key.alias("row")))
    full = F.expr(f"size div {capacity}")
    piece = F.explode(F.sequence(F.lit(0).cast("long"), full - 1))
    whole = rows.where(F.col("size") >= capacity).select("doc_id", "source", piece.alias("piece"), "row")
    whole = whole.select(
        "doc_id", "source", "piece", (F.col("piece") * capacity).alias("first_word"), F.lit(capacity).cast("long").alias("n_words"),
        F.concat_ws("-", F.lit("full"), "row", "piece").alias("bin_id"), F.lit(0).cast("long").alias("at_word"),
    )
    rests = rows.withColumn("rest", F.col("size") % capacity).where("rest > 0")
    n_shards = max(1, -(-rows.count() // shard_rows))
    shard = F.pmod(F.xxhash64("row"), F.lit(n_shards)).alias("shard")
    rests = rests.select("doc_id", "source", full.alias("piece"), "rest", "cluster", "row", shard)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rest", "doc_id", "cluster", "row"], ascending=[False, True, True, True], ignore_index=True)
        source = pd.factorize(pdf["source"], use_na_sentinel=False)[0]
        bins, at = pack_shard(pdf["rest"].to_numpy(), source, pd.factorize(pdf["cluster"])[0], capacity)
        pdf["bin_id"] = [f"{s}-{b}" for s, b in zip(pdf["shard"], bins, strict=True)]
        pdf["first_word"], pdf["at_word"] = pdf["piece"] * capacity, at
        return pdf.rename(columns={"rest": "n_words"})[names]

    names = ["doc_id", "source", "piece", "first_word", "n_words", "bin_id", "at_word"]
    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", "source")]
    schema = ", ".join([*kinds, "piece long, first_word long, n_words long, bin_id string, at_word long"])
    packed = rests.groupBy("shard").applyInPandas(run, schema)
    nothing = rows.where("size = 0").selectExpr("doc_id", "source", "0L", "0L", "0L", "CAST(null AS string)", "CAST(null AS long)")
    return packed.unionAll(whole.select(*names)).unionAll(nothing.toDF(*names))
