"""Removal of long repeated byte strings, across documents and within them.

Each string of ``length`` bytes picks one place within it, its anchor: the place whose
short gram has the smallest hash, the last such place on a tie. Equal strings pick the
same place, so two of them can only be found around equal anchors. Anchors that occur
once are done with. Around the others lies a context, the bytes of all strings that may
have picked it. A context that occurs twice is repeated as a whole. The rest differ
somewhere from all contexts of their anchor, and are sorted column by column.

The columns of all contexts of a task are taken from the last to the first, one symbol
per context and round. A round sorts the contexts by their new symbol and, within it, by
the order of the round before, which is the step by which a Burrows-Wheeler transform of
a collection grows; common prefixes of neighbours follow from the round before as well.
Where a neighbour's prefix has ``length`` symbols, the string that starts at the column
is repeated.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfolio.llm.common import cut, text_slices, whole_groups

LENGTH = 400
GRAM = 128
# Contexts of one anchor that a single task sorts, which bounds its memory; those of a more
# frequent anchor are compared as one hash per column, which finds the same strings.
CONTEXTS = 20_000
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


@cache
def byte_values() -> np.ndarray:
    return np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@cache
def powers(size: int, inverse: bool) -> np.ndarray:
    base = pow(BASE, -1, 1 << 64) if inverse else BASE
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads a hash over all its bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hashes:
    """Hashes of any run of bytes, the same wherever the run stands."""

    def __init__(self, data: np.ndarray) -> None:
        room = 1 << max(int(len(data)).bit_length(), 12)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(byte_values()[data] * powers(room, False)[: len(data)], dtype=np.uint64, out=self.sums[1:])
        self.inverse = powers(room, True)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


def least_in(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest value of each run of ``width`` values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, MASK, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(
    data: np.ndarray, ends: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in it, gram hash, context hash) of each anchor of texts that stand one after the other."""
    starts = np.concatenate([[0], ends[:-1]])
    wide = length - gram + 1
    none = np.empty(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none
    hashes = Hashes(data)
    grams = hashes.grams(gram)
    place = np.uint64(0xFFFFFFFF) - np.arange(len(grams), dtype=np.uint64)
    least = least_in((grams & np.uint64(0xFFFFFFFF00000000)) | place, wide)
    first = np.arange(len(least))
    text = np.repeat(np.arange(len(ends)), ends - starts)[: len(least)]
    inside = first + length <= ends[text]
    spot = (np.uint64(0xFFFFFFFF) - (least[inside] & np.uint64(0xFFFFFFFF))).astype(np.int64)
    text = text[inside]
    new = np.ones(len(spot), dtype=bool)
    new[1:] = spot[1:] != spot[:-1]
    spot, text = spot[new], text[new]
    a, z = np.maximum(starts[text], spot - wide + 1), np.minimum(ends[text], spot + length)
    context = mixed(hashes.of(a, z) ^ ((spot - a) * length + (z - spot)).astype(np.uint64))
    return text, spot - starts[text], grams[spot].view(np.int64), context.view(np.int64)


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each ends; a null text is empty."""
    parts = [x or b"" for x in texts.cast(pa.binary()).to_pylist()]
    return np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum([len(x) for x in parts], dtype=np.int64)


def repeated_starts(rows: np.ndarray, group: np.ndarray, length: int, columns: int) -> np.ndarray:
    """For each context and each of the first ``columns`` columns: does its string of that start occur in another.

    ``rows`` holds symbols, 0 where a context has none; ``group`` is sorted.
    """
    n = len(rows)
    order, common = np.arange(n), np.zeros(n + 1, dtype=np.int32)
    out = np.zeros((n, columns), dtype=bool)
    for column in range(rows.shape[1] - 1, -1, -1):
        symbol = rows[order, column].astype(np.int64)
        key = group[order] * 512 + symbol
        turn = np.argsort(key, kind="stable")
        key, symbol = key[turn], symbol[turn]
        same = np.flatnonzero((key[1:] == key[:-1]) & (symbol[1:] > 0))
        fresh = np.zeros(n + 1, dtype=np.int32)
        if len(same):
            # the rows between two neighbours in the order before
            span = np.stack([turn[same] + 1, turn[same + 1] + 1], axis=1).ravel()
            fresh[same + 1] = np.minimum.reduceat(common, span)[::2] + 1
        order, common = order[turn], fresh
        if column < columns:
            long = np.flatnonzero(common >= length)
            out[order[long], column] = True
            out[order[long - 1], column] = True
    return out


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of each run of true columns."""
    edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


def found_spans(docs: DataFrame, length: int, gram: int, contexts: int) -> DataFrame:
    """(mark, check, start, stop): bytes to remove by text, not yet cut to its length; docs has mark, check, text."""
    lead = length - gram
    width = lead + length
    key = ["mark", "check"]

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            text, place, h, c = anchors(*as_bytes(part.column("text")), length, gram)
            take = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [part.column("mark").take(take), part.column("check").take(take), pa.array(place), pa.array(h), pa.array(c)],
                [*key, "place", "h", "c"],
            )

    every = docs.mapInArrow(find, "mark long, check int, place long, h long, c long")
    # counts are cut before their rows are joined to them: a frequent key's rows are split only if both sides come from a shuffle
    shared = every.groupBy("h").agg(F.count("c").alias("n"), (F.min("c") < F.max("c")).alias("differ")).where("n > 1")
    shared = cut(shared.select("h", "differ"))
    rows = cut(every.join(shared, "h").select(*key, F.col("place").cast("int"), "h", "c", "differ"))
    mixed_ = rows.where("differ")
    kinds = cut(mixed_.groupBy("h", "c").agg(F.count("place").alias("n"), F.min(F.struct("place", *key)).alias("one")))
    whole = rows.where("not differ").select(*key, "place").unionAll(
        mixed_.join(kinds.where("n > 1").select("h", "c"), ["h", "c"]).select(*key, "place")
    )
    # one context of each kind; those that occur once are to be sorted
    asked = cut(kinds.groupBy("h").agg(F.min("n").alias("rarest"), F.count("c").alias("kinds")).where("rarest = 1"))
    ones = kinds.join(asked, "h").select("h", "one.*", (F.col("n") == 1).alias("own"), (F.col("kinds") > contexts).alias("hot"))
    wanted = ones.groupBy(*key).agg(F.collect_list(F.struct("place", "h", "own", "hot")).alias("wanted"))
    repeated = docs.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key, F.lit(True).alias("again"))
    wanted = wanted.join(repeated, key, "left").fillna(False, ["again"])

    def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*key, "place", "h", "own", "hot", "again", "before", "after"]
        for part in text_slices(batches):
            out: list[list] = [[] for _ in names]
            columns = (part.column(c).to_pylist() for c in (*key, "again", "wanted"))
            texts = part.column("text").cast(pa.binary()).to_pylist()
            for text, mark, check, again, spots in zip(texts, *columns, strict=True):
                for spot in spots:
                    at = spot["place"]
                    flags = (spot["own"], spot["hot"], again)
                    row = (mark, check, at, spot["h"], *flags, text[max(0, at - lead) : at], text[at : at + length])
                    for values, value in zip(out, row, strict=True):
                        values.append(value)
            kinds_ = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), *[pa.bool_()] * 3, *[pa.binary()] * 2)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds_, strict=True)], names)

    context = docs.join(wanted, key).mapInArrow(
        slices, "mark long, check int, place int, h long, own boolean, hot boolean, again boolean, before binary, after binary"
    )
    # equal rows gave the same contexts each
    context = cut(context)
    context = context.where("not again").unionAll(context.where("again").distinct())

    def matrix(part: pa.Table) -> np.ndarray:
        """Contexts as rows with the anchor in one column; symbols are bytes plus one."""
        out = np.zeros((part.num_rows, width), dtype=np.int16)
        for i, (before, after) in enumerate(zip(part.column("before").to_pylist(), part.column("after").to_pylist(), strict=True)):
            both = np.frombuffer(before + after, dtype=np.uint8)
            out[i, lead - len(before) : lead + len(after)] = both
            out[i, lead - len(before) : lead + len(after)] += 1
        return out

    def spans_of(part: pa.Table, row: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
        place = part.column("place").to_numpy()[row].astype(np.int64) - lead
        names_ = [*key, "start", "stop"]
        ids = [pa.array(part.column(c).to_numpy()[row]) for c in key]
        return pa.RecordBatch.from_arrays([*ids, pa.array(place + first), pa.array(place + last + length)], names_)

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, starts in whole_groups(batches, ["h"], 10_000):
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, part.num_rows)))
            flags = repeated_starts(matrix(part), group, length, lead + 1)
            flags &= part.column("own").to_numpy()[:, None]
            yield spans_of(part, *runs(flags))

    def columns_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = pa.Table.from_batches([batch.slice(k, 1000)])
                rows_ = matrix(part)
                full = np.cumsum(rows_ == 0, axis=1)
                for column in range(lead + 1):
                    tail = full[:, column + length - 1] - (full[:, column - 1] if column else 0)
                    held = np.flatnonzero(tail == 0)
                    data = (rows_[held, column : column + length] - 1).astype(np.uint8)
                    at = np.arange(len(held)) * length
                    h = Hashes(data.ravel()).of(at, at + length) if len(held) else np.empty(0, dtype=np.uint64)
                    ids = [part.column(c).combine_chunks().take(pa.array(held)) for c in (*key, "place", "h", "own")]
                    yield pa.RecordBatch.from_arrays(
                        [*ids, pa.array(np.full(len(held), column, dtype=np.int32)), pa.array(h.view(np.int64))],
                        [*key, "place", "h", "own", "column", "string"],
                    )

    spans = "mark long, check int, start long, stop long"
    calm = context.where("not hot").select(*key, "place", "h", "own", "before", "after")
    sorted_ = calm.repartition("h").sortWithinPartitions("h").mapInArrow(sort, spans)
    each = context.where("hot").mapInArrow(columns_of, "mark long, check int, place int, h long, own boolean, column int, string long")
    twice = cut(each.groupBy("h", "column", "string").agg(F.count("place").alias("n")).where("n > 1").drop("n"))
    start = F.col("place").cast("long") - lead + F.col("column")
    hot = each.where("own").join(twice, ["h", "column", "string"]).select(*key, start.alias("start"), (start + length).alias("stop"))
    place = F.col("place").cast("long")
    return whole.select(*key, (place - lead).alias("start"), (place + length).alias("stop")).unionAll(sorted_).unionAll(hot)


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, contexts: int = CONTEXTS) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for each row of (doc_id, text).

    ``spans`` are the maximal runs of bytes (start, stop) that a string of ``length``
    bytes covers which also starts anywhere else, in the row itself or in another one;
    ``kept`` the other bytes. Overlaps count; all strings are judged on the input. A
    null text is empty; a text shorter than ``length`` keeps all. Rows that repeat are
    documents of their own, so their texts are repeated. Further columns are ignored.
    """
    if not 0 < gram < length:
        raise ValueError("gram must be shorter than length")
    # a text is known by its hashes together with its id; equal rows have equal spans
    keyed = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("doc_id", "text").alias("mark"), F.hash("text", "doc_id").alias("check"),
    )
    key = ["mark", "check"]
    found = found_spans(keyed.select("text", *key), length, gram, contexts)
    # a set, as equal rows find the same spans
    spans = found.groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("found"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            sizes, spans_, kept = [], [], []
            for text, found_ in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("found").to_pylist(), strict=True):
                merged: list[list[int]] = []
                for s in found_ or ():
                    start, stop = max(0, s["start"]), min(len(text), s["stop"])
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], stop)
                    else:
                        merged.append([start, stop])
                edges = [0, *(x for m in merged for x in m), len(text)]
                sizes.append(len(text))
                spans_.append([{"start": a, "stop": b} for a, b in merged])
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            columns = [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans_, span), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "spans", "kept"])

    joined = keyed.join(spans, key, "left").select("doc_id", "text", "found")
    return joined.mapInArrow(keep, f"doc_id {kind}, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")
