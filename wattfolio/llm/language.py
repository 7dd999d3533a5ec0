"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

A text is the mean of the embeddings of its hashed character n-grams, with blanks for
all that are not letters. Embeddings and softmax are trained by stochastic gradient
descent on a bounded sample. Softmax and mean commute, so a trained model is one score
per bucket and language, and a text costs a few lookups per character.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfolio.llm.codes import joined, letters
from wattfolio.llm.common import fold, text_slices
from wattfolio.llm.sampling import labelled_sample

BITS = 16
LENGTHS = (1, 2, 3)
UNKNOWN = "und"


def buckets(codes: np.ndarray) -> list[np.ndarray]:
    """For each n-gram length the bucket of the n-gram that starts at each place."""
    codes = np.where(letters()[codes], codes, 32).astype(np.uint32)
    out, held = [], np.zeros(len(codes), dtype=np.uint32)
    for n in LENGTHS:
        held = held * np.uint32(0x01000193)
        held[: len(codes) - n + 1] ^= codes[n - 1 :]
        mixed = held * np.uint32(0x9E3779B1) + np.uint32(n)
        out.append(((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS))
    return out


@dataclass(frozen=True)
class Model:
    """scores: bucket by language; temperature and the least probability that is not rejected are calibrated."""

    languages: tuple[str, ...]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float

    def logits(self, texts: list[str | None]) -> np.ndarray:
        codes, starts = joined(texts)
        sizes = np.diff(np.append(starts, len(codes)))
        out = np.zeros((len(texts), len(self.languages)))
        for grams in buckets(codes):
            for k in range(len(self.languages)):
                out[:, k] += np.add.reduceat(self.scores[k][grams], starts, dtype=np.float64)
        return out / (sizes * len(LENGTHS))[:, None] + self.bias

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        return softmax(self.logits(texts) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    sample: pd.DataFrame, size: int = 16, epochs: int = 12, rate: float = 20.0, seed: int = 3
) -> Model:
    """From columns text and lang. Every fifth text is kept for calibration."""
    languages = tuple(sorted(set(sample["lang"])))
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 1 / size, (1 << BITS, size))
    weight, bias = rng.normal(0, 1 / size, (size, len(languages))), np.zeros(len(languages))
    order = rng.permutation(len(sample))
    held, kept = order[::5], np.concatenate([order[i::5] for i in range(1, 5)])
    bags, target = [], sample["lang"].map({v: i for i, v in enumerate(languages)}).to_numpy()
    for text in sample["text"]:
        codes, _ = joined([text])
        ids, counts = np.unique(np.concatenate(buckets(codes)), return_counts=True)
        bags.append((ids, counts / counts.sum()))
    steps, done = epochs * max(len(kept), 1), 0
    for _ in range(epochs):
        for i in rng.permutation(kept):
            ids, share = bags[i]
            mean = share @ embed[ids]
            error = softmax((mean @ weight + bias)[None])[0]
            error[target[i]] -= 1
            pace = 1 - done / steps
            back = weight @ error
            weight -= 0.2 * pace * np.outer(mean, error)
            bias -= 0.02 * pace * error
            embed[ids] -= np.minimum(rate * pace * share, 0.5)[:, None] * back[None]
            done += 1
    scores = np.ascontiguousarray((embed @ weight).T.astype(np.float32))
    model = Model(languages, scores, bias, 1.0, 0.0)
    if not len(held):
        return model
    logits = model.logits(list(sample["text"].iloc[held]))
    right = target[held]

    def loss(t: float) -> float:
        return -np.log(softmax(logits / t)[np.arange(len(held)), right] + 1e-12).mean()

    temperature = min(np.geomspace(0.05, 20, 60), key=loss)
    p = softmax(logits / temperature)
    sure = p.max(axis=1)[p.argmax(axis=1) == right]
    # at most one right answer in a hundred is rejected, and none that is likelier than not
    least = min(0.5, float(np.quantile(sure, 0.01))) if len(sure) else 0.0
    return Model(languages, scores, bias, float(temperature), least)


def fit(docs: DataFrame, per_label: int = 1000) -> Model | None:
    """Trains on about ``per_label`` rows of each language outside fold 0; None if no row has a language.

    ``per_label`` bounds what the driver holds.
    """
    rows = docs.where(F.coalesce(fold(F.col("doc_id")) != 0, F.lit(False)) & F.col("text").rlike(r"\p{L}"))
    sample = labelled_sample(rows.select("text", F.col("lang").cast("string").alias("lang")), "lang", per_label)
    return train(sample) if len(sample) else None


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_best, lang_pred, score, rejected) for each row of (doc_id, text).

    ``lang_best`` is the likeliest language, ``und`` with score 0 for a text that is null
    or has no letter, or without a model; ``lang_pred`` is also ``und`` where the
    probability is too low. Rows that repeat are answered as often. Further columns,
    a language among them, are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts = part.column("text").to_pylist()
            best, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            known = np.array([any(map(str.isalpha, t or "")) for t in texts], dtype=bool)
            if model is not None:
                p = model.probabilities(texts)
                best = np.where(known, np.array(model.languages, dtype=object)[p.argmax(axis=1)], UNKNOWN)
                score = np.where(known, p.max(axis=1), 0.0)
            rejected = score < (model.least if model is not None else 0.0)
            pred = np.where(rejected, UNKNOWN, best)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(best, pa.string()), pa.array(pred, pa.string()), pa.array(score), pa.array(rejected)],
                ["doc_id", "lang_best", "lang_pred", "score", "rejected"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang_best string, lang_pred string, score double, rejected boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
