"""Phrases whose words stand together more often than by chance, by dynamic itemset counting.

The documents lie in ``shards`` written once. Step t scans shard t modulo their number and
counts all phrases that are active, of all lengths at once. Words are active from the
first step. A longer phrase becomes active in the step after both its parts, without the
last and without the first word, have reached the threshold, while these are still being
counted; it is counted for one full cycle, so over every document once, and is done
then. Steps go on until none is active.

What has reached the threshold is known to the tasks by a table of a fixed number of
cells: a phrase falls into one by a hash, and the cell holds the step in which the first
phrase of it got there. So the table's size does not grow with the data. Two phrases in
one cell can only make a longer one active before its time; it is counted for a full cycle
from then on, and its count is as exact as others.

Phrases are counted as texts. Tasks add up what they find in a slice, Spark adds up
slices before its shuffle, and each step's counts are written once and never moved again:
what reached the threshold within a cycle has a share of it in one of its steps, so the
counts of the cycle are joined to these few phrases alone. The driver sees numbers of
cells only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattfolio.llm.common import ASCII_UPPER, stored, text_slices
from wattfolio.llm.suffix_dedup import Hashes

LONGEST = 5
SHARDS = 3
CELLS = 1 << 24
UNSET = 255
# Phrases that are broadcast to the counts of a cycle; more are joined by a shuffle.
MOST_BROADCAST = 500_000
UNKNOWN = "und"
# Bytes of text whose phrases are added up before they leave the task.
SLICE = 8 << 20
BREAK = b"."
PLAIN = bytes.maketrans(
    ASCII_UPPER.encode() + b",;:!?\n\x0b\x0c\r\t", ASCII_UPPER.lower().encode() + BREAK * 9 + b" "
)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(27))


def pieces(texts: Iterable[bytes | None]) -> tuple[np.ndarray, pa.Array]:
    """Words of all texts as numbers, -1 at the end of a piece, and the words that the numbers stand for."""
    words = (BREAK.join(t or b"" for t in texts) + BREAK).translate(PLAIN).replace(BREAK, b" . ").split()
    coded = pa.array(words, pa.binary()).dictionary_encode()
    number = coded.indices.to_numpy().astype(np.int64)
    end = coded.dictionary.index(BREAK).as_py()
    number[number == end] = -1
    return number, coded.dictionary


def found(number: np.ndarray, words: pa.Array, seed: int, table: np.ndarray, step: int, shards: int, longest: int) -> Iterator[tuple]:
    """(length, phrases, cells, first steps, counts) of the phrases that are active in the step."""

    def cells(h: np.ndarray) -> np.ndarray:
        return (mixed(h) & np.uint64(len(table) - 1)).astype(np.int64)

    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    code = Hashes(np.frombuffer(data, dtype=np.uint8)[: ends[-1]]).of(ends[:-1], ends[1:])
    own = mixed(code ^ np.uint64(seed))
    cell = cells(own)
    if step < shards:
        count = np.bincount(number[number >= 0], minlength=len(words))
        held = np.flatnonzero(count)
        yield 1, words.take(pa.array(held)), cell[held], np.zeros(len(held), dtype=np.int64), count[held]
    # a longer phrase needs both its parts to have reached the threshold: the one here, and the one a word later
    reached = table[cell].astype(np.int64)
    there = np.append(reached < UNSET, False)[number]
    spot = np.flatnonzero(there[:-1] & there[1:])
    since = np.maximum(reached[number[spot]], reached[number[spot + 1]]) + 1
    h = own[number[spot]]
    for length in range(2, longest + 1):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + code[number[spot + length - 1]])
        cell = cells(h)
        now = np.flatnonzero((since <= step) & (step < since + shards))
        if len(now):
            # equal phrases are told by the numbers of their words
            at = spot[now]
            kind = number[at]
            for k in range(1, length):
                kind = np.unique(kind * len(words) + number[at + k], return_inverse=True)[1]
            _, first, count = np.unique(kind, return_index=True, return_counts=True)
            parts = [words.take(pa.array(number[at[first] + k])) for k in range(length)]
            yield length, pc.binary_join_element_wise(*parts, b" "), cell[now[first]], since[now[first]], count
        reached = table[cell].astype(np.int64)
        pair = np.flatnonzero((reached[:-1] < UNSET) & (reached[1:] < UNSET) & (spot[1:] == spot[:-1] + 1))
        # another phrase's cell may be older than the part itself, which must be active first
        since = np.maximum.reduce([reached[pair] + 1, reached[pair + 1] + 1, since[pair], since[pair + 1]])
        h, spot = h[pair], spot[pair]


# A language and a phrase with a tab between, which no phrase holds; length, first step and cell as one number.
ROWS = "key string, code long, n long"
LENGTH, SINCE = 40, 32


def counted(shard: DataFrame, held: Broadcast, step: int, shards: int, longest: int) -> DataFrame:
    """Partial counts of the phrases active in the step by the table held; length 0 counts all words."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, size=SLICE):
            langs = part.column("lang").to_numpy(zero_copy_only=False)
            texts = part.column("text").cast(pa.binary())
            for lang in sorted(set(langs)):
                number, words = pieces(texts.filter(pa.array(langs == lang)).to_pylist())
                seed = int.from_bytes(sha256(lang.encode()).digest()[:8], "little")
                none = np.zeros(1, dtype=np.int64)
                rows = [(0, pa.array([b""]), none, none, np.array([int((number >= 0).sum())]))] if step < shards else []
                for length, names, cells, since, n in [*rows, *found(number, words, seed, held.value, step, shards, longest)]:
                    keys = pc.binary_join_element_wise(pa.scalar(lang.encode()), names, b"\t")
                    code = (length << LENGTH) | (since << SINCE) | cells
                    yield pa.RecordBatch.from_arrays([keys.cast(pa.string()), pa.array(code), pa.array(n)], ["key", "code", "n"])

    return shard.mapInArrow(count, ROWS)


def together(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def frequent(docs: DataFrame, least: int, longest: int, shards: int, cells: int) -> DataFrame:
    """(lang, length, phrase, n) of all phrases with ``least`` occurrences; length 0 counts a language's words."""
    dealt = docs.select(
        F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).alias("shard"),
    )
    every = stored(dealt, "shards", by=["shard"], compression="zstd")
    table = np.full(cells, UNSET, dtype=np.uint8)
    share = -(-least // shards)
    counts: list[DataFrame] = []
    often: list[DataFrame] = []
    done: list[DataFrame] = []
    length, since = F.shiftright("code", LENGTH), F.shiftright("code", SINCE).bitwiseAND(F.lit(UNSET))
    step = 0
    while step < shards or ((table < UNSET) & (table > step - 1 - shards)).any():
        if step >= UNSET:
            raise ValueError("too many steps for the table; take fewer shards or shorter phrases")
        held = docs.sparkSession.sparkContext.broadcast(table)
        new = counted(every.where(F.col("shard") == step % shards).select("lang", "text"), held, step, shards, longest)
        counts = [*counts, stored(new.groupBy("key", "code").agg(F.sum("n").alias("n")), f"phrases-{step}", compression="zstd")][-shards:]
        often = [*often, counts[-1].where(F.col("n") >= share).select("key")][-shards:]
        # of the counts of a cycle those of phrases that have a share of the threshold in one of its steps
        keys = stored(together(often).distinct(), f"often-{step}")
        if keys.count() <= MOST_BROADCAST:
            keys = F.broadcast(keys)
        rows = together(counts).join(keys, "key", "left_semi").groupBy("key", "code").agg(F.sum("n").alias("n"))
        rows = stored(rows.where(F.col("n") >= least), f"reached-{step}")
        # those that started a cycle ago are complete
        done.append(rows.where(since == step - shards + 1))
        # the table bounds the number of cells
        cell = F.col("code").bitwiseAND(F.lit((1 << SINCE) - 1)).alias("cell")
        at = rows.where(length.between(1, longest - 1)).select(cell).distinct().toArrow().column("cell").to_numpy()
        table[at] = np.minimum(table[at], step)
        held.destroy()
        step += 1
    phrase = F.substring_index("key", "\t", -1)
    lang = F.expr("substr(key, 1, length(key) - length(substring_index(key, '\t', -1)) - 1)")
    return together(done).select(lang.alias("lang"), length.cast("int").alias("length"), phrase.alias("phrase"), "n")


def collocations(
    docs: DataFrame,
    least: int = 100,
    longest: int = LONGEST,
    top: int = 2000,
    inside: int = 100,
    shards: int = SHARDS,
    cells: int = CELLS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language by score, count and text.

    Texts are lower-cased (A-Z), split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into words at
    blanks and tabs. ``a`` counts a phrase of 2 to ``longest`` words in all pieces, overlaps
    included, and is ``least`` or more; ``n`` counts all words of the language. Of the cuts
    into a first part of ``l`` and a rest of ``r`` occurrences the one of the lowest
    ``floor(1000 a n / (l r))`` counts, the first of equal ones. A phrase is left out if a
    longer one that holds it has at least ``inside`` percent of its occurrences. A null
    language is ``und``, a null text empty; rows that repeat count each time; further columns
    are ignored. Products are exact up to 38 digits.
    """
    if not 2 <= longest or cells & (cells - 1) or not 1 <= shards < 50:
        raise ValueError("phrases have two words at least, cells are a power of two, shards below 50")
    rows = stored(frequent(docs, least, longest, shards, cells), "frequent")
    spots = F.sequence(F.lit(1), F.col("length") - 1)
    words = F.split("phrase", " ")
    joined = lambda a, n: F.array_join(F.slice(F.col("words"), a, n), " ")
    long = rows.where("length >= 2").select("lang", "length", "phrase", F.col("n").alias("a"), words.alias("words"))
    parts = rows.where("length >= 1").select("lang", "phrase", "n")
    cuts = long.select("lang", "phrase", "a", "words", "length", F.explode(spots).alias("k")).select(
        "lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"),
        joined(F.col("k") + 1, F.col("length") - F.col("k")).alias("rest"),
    )
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    totals = rows.where("length = 0").select("lang", "n")
    score = F.expr("1000 * CAST(a AS DECIMAL(38,0)) * n DIV (CAST(l AS DECIMAL(38,0)) * r)").alias("score")
    scored = cuts.join(totals, "lang").select("lang", "phrase", "a", "k", "l", "r", "n", score)
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # every shorter phrase of two words or more that a phrase holds
    starts = F.explode(F.sequence(F.lit(1), F.col("length"))).alias("start")
    held = long.where("length > 2").select("lang", "a", "words", "length", starts)
    held = held.select("*", F.explode(F.sequence(F.lit(1), F.col("length"))).alias("size"))
    held = held.where("size >= 2 and size < length and start + size - 1 <= length")
    outer = held.groupBy("lang", joined(F.col("start"), F.col("size")).alias("phrase")).agg(F.max("a").alias("outer"))
    free = best.join(outer, ["lang", "phrase"], "left").where(f"outer is null or 100 * outer < {inside} * a")
    order = W.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = free.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
