"""Toxicity scores by FTRL-proximal logistic regression over hashed word features.

A text is the set of its words, of their first letters, of pairs of neighbours and of pairs
with one word between (skip-grams), each hashed to one of ``BUCKETS`` places.  Follow-
the-regularized-leader learns with a rate for each place and an L1 term that leaves most
weights at zero; the others, a few thousand at most 2**20, go to all tasks.

It is fitted in one task on a bounded sample: about ``TOXIC`` and ``CLEAN`` labelled documents
at most, drawn by the hash of their ids.  Rows without a label, or with ids or labels that are null, are
not learned from; without any row to learn from all scores are 0.27 (label 0).
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedarb.llm.shared import ShortMemory, only, unit

BUCKETS = 1 << 20
#: Labelled documents of each kind that the model is fitted on, about.
TOXIC, CLEAN = 5_000, 10_000
#: Lengths of the beginnings that words may share.
STEMS = (4, 6)
ALPHA, BETA, L1, L2, PASSES = 2.0, 1.0, 3.0, 1.0, 6
#: Characters of a text that are worked on at a time.
BLOCK = 1 << 20

_words = re.compile(r"\w+").findall
_hash = ShortMemory(
    lambda word: (zlib.crc32(word.encode()), *(zlib.crc32(f"{n}^{word[:n]}".encode()) for n in STEMS)),
    50_000,
)


def _place(key: np.ndarray) -> np.ndarray:
    return (key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)


def _blocks(text: str) -> Iterator[list[str]]:
    start = 0
    while start < len(text):
        end = min(start + BLOCK, len(text))
        while end < len(text) and text[end].isalnum():
            end += 1
        yield _words(text[start:end].lower())
        start = end


def features(text: str | None) -> Iterator[np.ndarray]:
    """Places of a text's features, some of them twice, in parts."""
    carried: list[str] = []
    for words in _blocks(text or ""):
        words = carried + words
        keys = np.array([_hash[w] for w in words], np.uint64).reshape(-1, 1 + len(STEMS))
        word = keys[:, 0]
        yield _place(word)
        yield _place((keys[:, 1:] + np.uint64(1 << 32)).ravel())
        yield _place(word[:-1] * np.uint64(0xC2B2AE3D) + word[1:] + np.uint64(2 << 33))
        yield _place(word[:-2] * np.uint64(0x85EBCA77) + word[2:] + np.uint64(3 << 34))
        carried = words[-2:]


class Ftrl:
    """Per-coordinate FTRL-proximal for 0/1 features; the last place is the constant."""

    def __init__(self, size: int = BUCKETS):
        self.z = np.zeros(size + 1)
        self.n = np.zeros(size + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = sigmoid(w.sum()) - label
        n = self.n[at]
        self.z[at] += gradient - (np.sqrt(n + gradient**2) - np.sqrt(n)) / ALPHA * w
        self.n[at] += gradient**2


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def fit(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN) -> np.ndarray:
    """Weights by place; ``labels`` has doc_id and toxic (0 or 1)."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, toxic / max(1, counts.get(1, 0))).otherwise(clean / max(1, counts.get(0, 0)))
    # The sample's size is bounded by the two shares.
    sample = F.broadcast(known.where(unit(F.col("doc_id"), seed=7) < share))
    rows = docs.select("doc_id", "text").join(sample, "doc_id")
    rows = rows.select(F.xxhash64(F.lit(7), "doc_id").alias("turn"), "text", "toxic")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(__name__)
        for batch in batches:
            found = [np.unique(np.concatenate([*features(t.as_py()), [BUCKETS]])).astype("<i4").tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("turn"), batch.column("toxic"), pa.array(found, pa.binary())], ["turn", "toxic", "places"]
            )

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, held = Ftrl(), []
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("turn", "toxic", "places")))
        held.sort()
        for _ in range(PASSES):
            for _, label, data in held:
                model.learn(np.frombuffer(data, "<i4"), label)
        weights = model.weights()
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(weights[at])], ["place", "weight"])

    learned_rows = (
        rows.mapInArrow(places, "turn long, toxic int, places binary")
        .repartition(1)
        .mapInArrow(learned, "place long, weight double")
        .toArrow()
    )
    weights = np.zeros(BUCKETS + 1)
    weights[learned_rows["place"].to_numpy()] = learned_rows["weight"].to_numpy()
    if not len(learned_rows):
        weights[BUCKETS] = -1.0
    return weights


def score(text: str | None, weights: np.ndarray) -> float:
    """Likelihood of label 1, from the whole text."""
    hits = [at[weights[at] != 0] for at in features(text)]
    total = weights[BUCKETS]
    if hits:
        total += weights[np.unique(np.concatenate(hits))].sum()
    return sigmoid(total)


def scored(docs: DataFrame, weights: np.ndarray, text: str = "text") -> Column:
    """The score of a text column; the nonzero weights are sent to the tasks."""
    at = np.flatnonzero(weights)
    sent = docs.sparkSession.sparkContext.broadcast((at.astype(np.int32), weights[at]))
    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        only(__name__)
        places, values = sent.value
        own = np.zeros(BUCKETS + 1)
        own[places] = values
        for batch in batches:
            yield pa.array([score(t.as_py(), own) for t in batch], pa.float64())

    return scores(F.col(text))


def held_out(doc_id: Column) -> Column:
    """Is this id among the fifth that is never learned from?"""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
