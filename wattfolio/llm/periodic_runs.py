"""Periodic runs of words in whole texts, and texts with their repetitions collapsed.

A run is a stretch of words that repeats itself with a smallest period, and that no
neighbouring word extends. Each text is looked at alone, inside its row: nothing is
shuffled, and texts of one length cost the same whatever they hold.

The runs of a stretch come from two suffix trees by Ukkonen's algorithm, of the stretch
and of its reversal. An Euler tour of each tree with a sparse table of minima gives the
lowest common ancestor of two leaves in constant time, and so how far the words from two
places on, or up to two places, agree. Every run has a Lyndon root, which is the longest
Lyndon word at its place under the order of words or under the reversed order. So each
place gives two candidates, which are extended in both directions.

Words of a run stand in groups of three that occur often within it. Places whose group is
too rare in the text end a stretch before any tree is built; no run crosses them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wattfolio.llm.common import text_slices

GROUP = 3


class SuffixTree:
    """Ukkonen's tree of a list of numbers, none negative; an end symbol of -1 is added."""

    def __init__(self, word: list[int]) -> None:
        text = [*word, -1]
        self.size = size = len(text)
        start, stop, link = [0], [0], [0]
        child: list[dict[int, int] | None] = [{}]

        def node(a: int, b: int, inner: bool) -> int:
            start.append(a)
            stop.append(b)
            link.append(0)
            child.append({} if inner else None)
            return len(start) - 1

        # the active place: ``reach`` symbols below ``at`` on the edge of text[edge]
        at = edge = reach = waiting = 0
        for i, symbol in enumerate(text):
            waiting += 1
            unlinked = 0
            while waiting:
                if not reach:
                    edge = i
                below = child[at].get(text[edge])
                if below is None:
                    child[at][text[edge]] = node(i, size, False)
                    if unlinked:
                        link[unlinked] = at
                        unlinked = 0
                else:
                    long = min(stop[below], i + 1) - start[below]
                    if reach >= long:
                        at, edge, reach = below, edge + long, reach - long
                        continue
                    if text[start[below] + reach] == symbol:
                        if unlinked:
                            link[unlinked] = at
                        reach += 1
                        break
                    split = node(start[below], start[below] + reach, True)
                    child[at][text[edge]] = split
                    child[split][symbol] = node(i, size, False)
                    start[below] += reach
                    child[split][text[start[below]]] = below
                    if unlinked:
                        link[unlinked] = split
                    unlinked = split
                waiting -= 1
                if at:
                    at = link[at]
                elif reach:
                    reach -= 1
                    edge = i - waiting + 1
        self.start, self.stop, self.child = start, stop, child

    def tour(self, falling: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Depths along an Euler tour, and the visit of each suffix; children in rising or falling order, the end first."""
        start, stop, child = self.start, self.stop, self.child
        depth = [0] * len(start)
        depths: list[int] = []
        visit = [0] * self.size
        path = [0]
        while path:
            x = path.pop()
            if x < 0:
                depths.append(depth[~x])
                continue
            here = depth[x]
            depths.append(here)
            if child[x] is None:
                visit[self.size - here] = len(depths) - 1
                continue
            order = sorted(child[x], key=(lambda s: s if s >= 0 else 1 << 62) if falling else (lambda s: -s))
            for symbol in order:
                below = child[x][symbol]
                depth[below] = here + stop[below] - start[below]
                path.append(~x)
                path.append(below)
        return np.array(depths, dtype=np.int32), np.array(visit, dtype=np.int64)


class CommonPrefixes:
    """Length of the common prefix of any two suffixes, in constant time each."""

    def __init__(self, depths: np.ndarray, visit: np.ndarray) -> None:
        self.visit = visit
        self.least = [depths]
        wide = 1
        while 2 * wide <= len(depths):
            last = self.least[-1]
            self.least.append(np.minimum(last[:-wide], last[wide:]))
            wide *= 2

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = self.visit[a], self.visit[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(a), dtype=np.int64)
        for k in np.unique(level):
            row, here = self.least[k], level == k
            out[here] = np.minimum(row[low[here]], row[high[here] - (1 << int(k)) + 1])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each place the next one of smaller rank; the last place, the end, is the smallest of all."""
    out = np.zeros(len(rank) - 1, dtype=np.int64)
    held: list[int] = []
    for i, r in enumerate(ranks := rank.tolist()):
        while held and ranks[held[-1]] > r:
            out[held.pop()] = i
        held.append(i)
    return out


def runs(word: np.ndarray, least: int, times: int) -> np.ndarray:
    """Rows (start, length, period) of all runs of at least ``least`` words and ``times`` periods, sorted."""
    n = len(word)
    tree = SuffixTree(word.tolist())
    depths, visit = tree.tour()
    ahead = CommonPrefixes(depths, visit)
    behind = CommonPrefixes(*SuffixTree(word[::-1].tolist()).tour())
    place = np.arange(n)
    i = np.concatenate([place, place])
    j = np.concatenate([next_smaller(visit), next_smaller(tree.tour(falling=True)[1])])
    short = (j - i) * times <= n
    i, j = i[short], j[short]
    start = i - behind.of(n - i, n - j)
    length = j + ahead.of(i, j) - start
    found = np.stack([start, length, j - i], axis=1)
    found = found[length >= np.maximum(least, times * (j - i))]
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def stretches(word: np.ndarray, text: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, stop) of parts of the texts outside of which no run has a word.

    A run of period q and ``times`` * q words holds each of its groups of three at least
    ``times`` - 1 times, or ``least`` - 2 times if q is 1. Groups are told apart by a hash:
    two that are taken for one can only make a part longer.
    """
    often = min(times - 1, least - GROUP + 1)
    part = text.astype(np.uint64)
    w = word.astype(np.uint64)
    spot = np.arange(len(word) - GROUP + 1)
    spot = spot[text[spot] == text[spot + GROUP - 1]]
    while True:
        h = part[spot] * np.uint64(0x9E3779B97F4A7C15)
        for k in range(GROUP):
            h = (h ^ w[spot + k]) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        _, kind, count = np.unique(h, return_inverse=True, return_counts=True)
        left = spot[count[kind] >= often]
        new = np.ones(len(left), dtype=bool)
        new[1:] = (left[1:] != left[:-1] + 1) | (part[left[1:]] != part[left[:-1]])
        size = np.diff(np.append(np.flatnonzero(new), len(left)))
        long = np.repeat(size >= least - GROUP + 1, size)
        number = np.cumsum(new)[long]
        left = left[long]
        if len(left) == len(spot):
            first = np.flatnonzero(np.diff(number, prepend=-1))
            return left[first], left[np.append(first[1:], len(left)) - 1] + GROUP if len(left) else left
        part = np.zeros(len(word), dtype=np.uint64)
        part[left] = number
        spot = left


def collapse(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """(doc_id, n_words, runs, kept) for each row of (doc_id, text).

    ``runs`` are (start, length, period) of all runs of at least ``least`` words and
    ``times`` periods, by start and period; words are ``[^\\x20\\x09-\\x0D]+`` of the whole
    text, counted from 0. ``kept`` joins by one blank the words that no run holds after its
    first period. A null or empty text has no words, no runs and keeps an empty text. A
    row stands for itself: rows that repeat and null ids come back as they came. Further
    columns are ignored.
    """
    if times < 2 or least < GROUP:
        raise ValueError(f"a run has two periods and {GROUP} words at least")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            split = [(t or b"").split() for t in part.column("text").cast(pa.binary()).to_pylist()]
            sizes = np.array([len(s) for s in split], dtype=np.int64)
            ends = np.cumsum(sizes)
            word = pa.array([w for s in split for w in s], pa.binary()).dictionary_encode().indices.to_numpy()
            text = np.repeat(np.arange(len(split)), sizes)
            found: list[list[dict]] = [[] for _ in split]
            gone = np.zeros(len(word) + 1, dtype=np.int64)
            if len(word) >= least:
                for a, b in zip(*stretches(word, text, least, times), strict=True):
                    here = text[a]
                    offset = a - (ends[here] - sizes[here])
                    for start, length, period in runs(word[a:b], least, times).tolist():
                        found[here].append({"start": start + offset, "length": length, "period": period})
                        gone[a + start + period] += 1
                        gone[a + start + length] -= 1
            stays = np.cumsum(gone[:-1]) == 0
            kept = []
            for s, end, rows in zip(split, ends, found, strict=True):
                if rows:
                    s = [s[k] for k in np.flatnonzero(stays[end - len(s) : end])]
                kept.append(b" ".join(s))
            run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            columns = [part.column("doc_id"), pa.array(sizes), pa.array(found, run), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "kept"])

    return docs.select("doc_id", "text").mapInArrow(
        find, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, kept string"
    )
