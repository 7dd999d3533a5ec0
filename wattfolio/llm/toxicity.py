"""Toxicity: a support vector machine over a subsequence string kernel with Nyström landmarks.

The kernel of two words is the product of their subsequences of three letters, each
weighted down by the letters it skips, so that a letter put in or left out costs little.
Marks between letters are dropped and single letters that follow each other are one
word, which undoes spaced writing. A sentence counts as its strongest word; a document's
probability follows from its strongest sentence and the share of its words that the
machine puts on the toxic side.

Documents carry the labels, so sentences are labelled in turns: the strongest words of
a toxic document stand for its toxic sentences, those of clean documents are the
counterexamples, a machine is trained, and the words are chosen anew. Landmarks are the
words most typical of toxic documents and a sample of others. A trained machine over
landmarks is one weight per subsequence, so a text costs a few lookups per letter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfolio.llm.codes import joined, letters, spaces
from wattfolio.llm.common import fold, text_slices
from wattfolio.llm.sampling import labelled_sample

# All letters are told apart: code points, and one more number for the start of a word.
START = 0x110000
# Entries of a weight table that holds every subsequence of its letters; a larger one holds those of landmarks alone.
TABLE = 1 << 22
# Steps between letters, weight of a skipped letter.
STEPS = (1, 2, 3)
DECAY = 0.5
# Share of words that counts as none.
RARE = 0.001
# Words of clean documents that are counterexamples: the most frequent, and as many others.
COUNTER = 10_000
# Words of a toxic document that may stand for its sentences, and words whose kernel is taken at a time.
CANDIDATES = 20
CHUNK = 500


def word_letters(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of all texts, where each word starts among them, and the text of each word."""
    keep = np.flatnonzero(letters()[codes])
    blank = np.cumsum(spaces()[codes])
    token = blank[keep]
    head = np.flatnonzero(np.diff(token, prepend=-1))
    text = np.searchsorted(starts, keep[head], side="right") - 1
    single = np.diff(np.append(head, len(keep))) == 1
    follows = np.zeros(len(head), dtype=bool)
    follows[1:] = single[1:] & single[:-1] & (text[1:] == text[:-1])
    return codes[keep], head[~follows], text[~follows]


def subsequences(x: np.ndarray, word: np.ndarray, base: int = START + 1) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(first letter's place, subsequence number, weight) for each way to step through a word."""
    for a in STEPS:
        for b in STEPS:
            s = a + b
            if len(x) > s:
                at = np.flatnonzero(word[s:] == word[:-s])
                yield at, (x[at] * base + x[at + a]) * base + x[at + s], DECAY ** (s - 2)


def lengths(sizes: np.ndarray) -> np.ndarray:
    """The norm a word of that many letters has if none of its subsequences repeats."""
    total = np.zeros(len(sizes))
    for a in STEPS:
        for b in STEPS:
            total += DECAY ** (2 * (a + b - 2)) * np.maximum(sizes - a - b, 0)
    return np.sqrt(np.maximum(total, 1.0))


def marked(x: np.ndarray, head: np.ndarray, start: int = START) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letter numbers with ``start`` before each word; word of each letter, start and size of each word."""
    head = head + np.arange(len(head))
    x = np.insert(x, head - np.arange(len(head)), start)
    sizes = np.diff(np.append(head, len(x)))
    return x, np.repeat(np.arange(len(head), dtype=np.int32), sizes), head, sizes


@dataclass(frozen=True)
class Model:
    """alphabet: number of each code point of the landmarks, 0 for all others, which no landmark has; base: of
    subsequence numbers; weights: of each subsequence, or of those in ``known``; curve: evidence to probability."""

    alphabet: np.ndarray
    base: int
    weights: np.ndarray
    bias: float
    known: np.ndarray | None = None
    curve: tuple[float, ...] = (1.0, 0.0, 0.0)

    def gains(self, number: np.ndarray) -> np.ndarray:
        if self.known is None:
            return self.weights[number]
        spot = np.minimum(np.searchsorted(self.known, number), len(self.known) - 1)
        return np.where(self.known[spot] == number, self.weights[spot], np.float32(0))

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        """For each text the margin of its strongest word, and the logarithm of the share of words on the toxic side."""
        codes, starts = joined(texts)
        x, head, text = word_letters(codes, starts)
        most, share = np.full(len(texts), self.bias), np.zeros(len(texts))
        if len(head):
            x, word, head, sizes = marked(self.alphabet[x], head, self.base - 1)
            gain = np.zeros(len(x), dtype=np.float32)
            for at, number, weight in subsequences(x, word, self.base):
                gain[at] += self.gains(number) * np.float32(weight)
            words = np.add.reduceat(gain, head) / lengths(sizes) + self.bias
            first = np.flatnonzero(np.diff(text, prepend=-1))
            most[text[first]] = np.maximum.reduceat(words, first)
            count = np.diff(np.append(first, len(words)))
            share[text[first]] = np.add.reduceat((words > 0.5).astype(np.float64), first) / count
        return np.stack([np.clip(most, -1, 1), np.log(share + RARE)], axis=1)

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        z = self.evidence(texts) @ np.array(self.curve[:-1]) + self.curve[-1]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def words_of(text: str) -> list[str]:
    codes, starts = joined([text])
    x, head, _ = word_letters(codes, starts)
    whole = x.astype("<u4").tobytes().decode("utf-32-le")
    return [whole[a:b] for a, b in zip(head, [*head[1:], len(x)], strict=True)]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normed kernel of each word with each landmark."""

    def sparse(some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        x, word, _, sizes = marked(code_points("".join(some)), np.cumsum([0, *map(len, some[:-1])]))
        parts = [(word[at], number, np.full(len(at), weight)) for at, number, weight in subsequences(x, word)]
        return *(np.concatenate(y) for y in zip(*parts, strict=True)), lengths(sizes)

    row, number, weight, norm = sparse(landmarks)
    known = np.unique(number)
    table = np.zeros((len(known), len(landmarks)))
    np.add.at(table, (np.searchsorted(known, number), row), weight / norm[row])
    out = np.zeros((len(words), len(landmarks)), dtype=np.float32)
    for k in range(0, len(words), CHUNK):
        row, number, weight, norm = sparse(words[k : k + CHUNK])
        spot = np.minimum(np.searchsorted(known, number), len(known) - 1)
        hit = known[spot] == number
        np.add.at(out, row[hit] + k, table[spot[hit]] * (weight / norm[row])[hit][:, None])
    return out


def train_machine(x: np.ndarray, y: np.ndarray, cost: float = 30.0, rounds: int = 30) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; both classes weigh the same. The last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * cost * len(y) / 100
    w, ridge = np.zeros(x.shape[1]), np.diag(np.append(np.ones(x.shape[1] - 1), 1e-6))
    active = np.ones(len(y), dtype=bool)
    for _ in range(rounds):
        a, s = x[active], share[active]
        w = np.linalg.solve(ridge + 2 * (a * s[:, None]).T @ a, 2 * (a * s[:, None]).T @ y[active])
        new = y * (x @ w) < 1
        if np.array_equal(new, active):
            break
        active = new
    return w


def train(sample: pd.DataFrame, prior: float = 0.5, landmarks: int = 144, turns: int = 3, seed: int = 5) -> Model:
    """From columns text and toxic (0 or 1). Every fourth document is kept to fit the probability, given the share of toxic ones."""
    rng = np.random.default_rng(seed)
    sample = sample.drop_duplicates("text")
    held = np.zeros(len(sample), dtype=bool)
    held[rng.permutation(len(sample))[::4]] = True
    toxic = sample["toxic"].to_numpy() == 1
    bad, good = Counter(), Counter()
    inside = []
    for text, is_toxic, is_held in zip(sample["text"], toxic, held, strict=True):
        if not is_held:
            bag = list(dict.fromkeys(w for w in words_of(text) if len(w) > 2))
            (bad if is_toxic else good).update(bag)
            if is_toxic and bag:
                inside.append(bag)
    flat = Model(np.zeros(START, dtype=np.int32), 2, np.zeros(2**3, dtype=np.float32), -1.0)
    n_bad, n_good = int((toxic & ~held).sum()), int((~toxic & ~held).sum())
    if not bad or not good:
        return flat

    def typical(w: str) -> float:
        """Signed likelihood ratio of a word's documents in the two classes."""
        p, q = bad[w] / n_bad, good[w] / n_good
        r = (bad[w] + good[w]) / (n_bad + n_good)
        gain = sum(n * np.log(n / (m * r)) for n, m in ((bad[w], n_bad), (good[w], n_good)) if n)
        return float(gain if p > q else -gain)

    strength = {w: typical(w) for w in bad}
    chosen: list[str] = []
    for w in sorted(bad, key=lambda w: (-strength[w], w))[: 20 * landmarks]:
        if len(chosen) < landmarks * 2 // 3 and (not chosen or kernel([w], chosen).max() < 0.7):
            chosen.append(w)
    others = sorted(good, key=lambda w: (-good[w], w))
    picked = rng.permutation(len(others))
    chosen += [w for w in (others[i] for i in picked[:landmarks]) if w not in bad][: landmarks - len(chosen)]
    values, vectors = np.linalg.eigh(kernel(chosen, chosen))
    project = vectors[:, values > 1e-6] / np.sqrt(values[values > 1e-6])
    # counterexamples: the words of most clean documents, and others drawn from the rest
    counter = others[:COUNTER] + [others[i] for i in picked[picked >= COUNTER][:COUNTER]]
    inside = [sorted(b, key=lambda w: -strength[w])[:CANDIDATES] for b in inside]
    pool = sorted({w for b in inside for w in b})
    in_pool = {w: i for i, w in enumerate(pool)}
    features = kernel(pool, chosen) @ project
    against = kernel(counter, chosen) @ project
    inside = [np.array([in_pool[w] for w in b]) for b in inside]
    typical_of = np.array([strength[w] for w in pool])

    def strongest(score: np.ndarray) -> np.ndarray:
        """The words that stand for the toxic sentences: two of each document."""
        return np.concatenate([b[np.argsort(-score[b], kind="stable")[:2]] for b in inside])

    witness = first = strongest(typical_of)
    for _ in range(turns):
        x = np.vstack([features[witness], against])
        w = train_machine(x, np.append(np.ones(len(witness)), -np.ones(len(against))))
        score = features @ w[:-1] + w[-1]
        # typical words stay unless the machine puts them on the clean side even as examples
        witness = np.concatenate([strongest(score)[score[strongest(score)] > 0], first[score[first] > -0.5]])
        if not len(witness):
            return flat
    per_landmark = project @ w[:-1]
    model = machine(chosen, per_landmark, float(w[-1]))
    texts = list(sample["text"][held])
    if len(set(toxic[held])) == 2:
        model = replace(model, curve=fit_curve(model.evidence(texts), toxic[held], prior))
    return model


def machine(landmarks: list[str], gain: np.ndarray, bias: float) -> Model:
    """The machine as one weight per subsequence of its landmarks; all other subsequences weigh nothing."""
    own = np.unique(code_points("".join(landmarks)))
    base = len(own) + 2
    alphabet = np.zeros(START, dtype=np.int32 if base**3 <= TABLE else np.int64)
    alphabet[own] = np.arange(1, len(own) + 1)
    numbers, amounts = [], []
    for landmark, u in zip(landmarks, gain, strict=True):
        x, word, _, sizes = marked(alphabet[code_points(landmark)], np.zeros(1, dtype=np.int64), base - 1)
        for _, number, weight in subsequences(x, word, base):
            numbers.append(number)
            amounts.append(np.full(len(number), u * weight / lengths(sizes)[0]))
    known, spot = np.unique(np.concatenate(numbers), return_inverse=True)
    weights = np.zeros(len(known))
    np.add.at(weights, spot, np.concatenate(amounts))
    if base**3 > TABLE:
        return Model(alphabet, base, weights.astype(np.float32), bias, known)
    table = np.zeros(base**3, dtype=np.float32)
    table[known] = weights
    return Model(alphabet, base, table, bias)


def fit_curve(evidence: np.ndarray, toxic: np.ndarray, prior: float, rounds: int = 50) -> tuple[float, ...]:
    """Weights and shift of the logistic curve by damped Newton steps; ``prior`` is the share of toxic documents."""
    n = max(toxic.sum(), 1), max((~toxic).sum(), 1)
    goal = np.where(toxic, (n[0] + 1) / (n[0] + 2), 1 / (n[1] + 2))
    weight = np.where(toxic, prior / n[0], (1 - prior) / n[1])
    x = np.hstack([evidence, np.ones((len(evidence), 1))])
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((weight * (np.logaddexp(0, z) - goal * z)).sum() + 1e-6 * (w @ w))

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (weight * (p - goal)) + 2e-6 * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 2e-6 * np.eye(len(w)), slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(slope).max() < 1e-9:
            break
    against = np.flatnonzero(w[:-1] < 0)
    if len(against):  # more evidence must not lower the probability
        kept = np.delete(evidence, against, axis=1)
        w = np.insert(np.array(fit_curve(kept, toxic, prior, rounds)), against - np.arange(len(against)), 0.0)
    return tuple(map(float, w))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 1500) -> Model | None:
    """Trains on about ``per_label`` labelled documents of each class outside fold 0.

    ``per_label`` bounds what the driver holds. An id with several labels is toxic if
    one of them is; texts that are null, and null labels, teach nothing. None if no
    labelled text is left.
    """
    marked = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.where(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != 0))
    # about the sample's ids only, so that texts of other rows are not moved
    counts = {r[0]: r[1] for r in marked.groupBy("toxic").count().collect()}
    if not counts:
        return None
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    shares = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_label / n))))
    ids = marked.where(spot < F.element_at(shares, F.col("toxic"))).limit(4 * per_label)
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    sample = labelled_sample(texts.join(F.broadcast(ids), "doc_id").select("text", "toxic"), "toxic", per_label)
    return train(sample, counts.get(1, 0) / sum(counts.values())) if len(sample) else None


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, toxic) for each row of (doc_id, text): probability, and whether it is 0.5 or more.

    A text that is null, empty or without letters gets the score of a text without any
    evidence, and so does every text without a model. Rows that repeat are scored as
    often. Further columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            p = model.probabilities(part.column("text").to_pylist()) if model is not None else np.zeros(part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p), pa.array(p >= 0.5)], ["doc_id", "score", "toxic"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, toxic boolean")


def without_toxic(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows whose text is not toxic, with all their columns; null texts stay."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            if model is not None:
                part = part.filter(pa.array(model.probabilities(part.column("text").to_pylist()) < 0.5))
            yield part

    return docs.mapInArrow(run, docs.schema)
