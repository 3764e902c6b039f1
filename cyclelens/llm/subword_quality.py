"""Quality scores from supervised subword embeddings.

A text's features are its words, its pairs of neighbouring words (as the difference of
their hashes, so a word that follows itself is one feature whatever the word) and its runs
of three and of four characters, each hashed into the rows of a table of vectors that are
learned. The vectors of all features of a
document are averaged, and a softmax layer turns the average into the probabilities of the
two labels. Vectors and output layer are trained by stochastic gradient descent in numpy on
the driver, on a bounded sample of labelled documents: at most `per_label` distinct texts of
each label and `max_chars` characters in all. Tasks hash the sample's texts; the driver gets
counts of features only. The two labels are drawn alike, so their shares among all labelled
documents are put back into the bias afterwards.

The layer is linear in the average, so for scoring each vector is folded into the number
that it adds, and every character of every text is scored in one narrow stage.

A null text and one without characters have no features; their score is that of the bias.
Null ids are carried along and held back from learning, as are rows whose label is neither
0 nor 1. Repeated rows get equal scores; repeated labels of one id count once, and an id
with both labels is learned as both. Without labels the score is 0.5, with one label only
it is that label. Only the named columns are read, so further columns of any name do no
harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelens.llm import samples
from cyclelens.llm.batches import id_and_text, output_schema, text_groups

PER_LABEL, MAX_CHARS = 1000, 8_000_000  # of the training sample
THRESHOLD = 0.7
BITS = 15  # of a bucket number, in each family of features
GRAMS = (3, 4)
DIMENSIONS = 8
EPOCHS, RATE, SEED = 6, 0.4, 13
GROUP_BYTES = 1 << 17
_FAMILIES = 2 + len(GRAMS)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FACTOR, _SPIN = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def _buckets(hashes: np.ndarray, family: int) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint32(15))) * _SPIN
    return (mixed >> np.uint32(32 - BITS)).astype(np.int64) + (family << BITS)


def features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each family the buckets of all its features, and the text each belongs to."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    found = []
    # Words: a sum over their characters, each weighted by its distance from the word's start.
    inside = (codes > 32) | ((codes < 9) | (codes > 13)) & (codes < 32)
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(first)
    if len(starts):
        place = np.arange(len(codes), dtype=np.uint32)
        behind = place - np.maximum.accumulate(np.where(first, place, 0)).astype(np.uint32)
        values = np.where(inside, (codes + np.uint32(1)) * (behind * np.uint32(2) + np.uint32(1)) * _FACTOR, np.uint32(0))
        values ^= values >> np.uint32(13)
        words, of = np.add.reduceat(values * _SPIN, starts, dtype=np.uint32), owner[starts]
        found.append((_buckets(words, 0), of))
        pair = np.flatnonzero(of[1:] == of[:-1])
        found.append((_buckets(words[pair] ^ words[pair + 1], 1), of[pair]))
    grams = codes * _FACTOR
    for width in range(2, max(GRAMS) + 1):
        grams = ((grams[:-1] ^ (grams[:-1] >> np.uint32(16))) * _SPIN + codes[width - 1 :]) * _FACTOR if len(grams) > 1 else grams[:0]
        if width in GRAMS and len(grams):
            whole = owner[: len(grams)] == owner[width - 1 :]
            found.append((_buckets(grams[whole], 2 + GRAMS.index(width)), owner[: len(grams)][whole]))
    return found


@dataclass
class Scorer:
    """What each feature adds to the log odds of label 1, and the log odds without any."""

    adds: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        total, n = np.zeros(len(texts)), np.zeros(len(texts))
        for buckets, owner in features(texts):
            total += np.bincount(owner, self.adds[buckets], len(texts))
            n += np.bincount(owner, minlength=len(texts))
        odds = total / np.maximum(n, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def slopes(vectors: np.ndarray, weights: np.ndarray, bias: np.ndarray, share: np.ndarray, label: int):
    """Gradients of one document's loss: of its features' vectors (whose shares of the
    average are `share`), of the output weights and of the bias."""
    average = share @ vectors
    error = _softmax(average @ weights + bias)
    error[label] -= 1
    return np.outer(share, weights @ error), np.outer(average, error), error


def train(documents: list[tuple[np.ndarray, np.ndarray]], labels: list[int], odds: float = 0.0,
          epochs: int = EPOCHS, rate: float = RATE) -> Scorer:
    """Fit vectors and output layer to documents given as (buckets, share of each in the
    average). `odds` is added to the log odds in the end. Equal input, equal result."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (_FAMILIES << BITS, DIMENSIONS))
    weights, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    steps, done = epochs * len(documents), 0
    for _ in range(epochs):
        for i in rng.permutation(len(documents)).tolist():
            buckets, share = documents[i]
            now = rate * (1 - done / steps)
            by_vector, by_weight, by_bias = slopes(vectors[buckets], weights, bias, share, labels[i])
            # A feature has a small part in an average, so its vector moves by a larger rate.
            vectors[buckets] -= now / max(1e-9, float(share @ share)) * by_vector
            weights -= now * by_weight
            bias -= now * by_bias
            done += 1
    return Scorer((vectors @ (weights[:, 1] - weights[:, 0])).astype(np.float32), float(bias[1] - bias[0]) + odds)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in text_groups(batches, GROUP_BYTES):
        for row, text in zip(rows.column("row_id").to_pylist(), texts):
            found = features([(text or b"").decode()])
            if found:
                buckets, times = np.unique(np.concatenate([b for b, _ in found]), return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "label": pa.array([row["label"]], pa.int32()), "place": pa.array([row["place"]], pa.int64()),
                    "buckets": pa.array([buckets.astype(np.int32)], pa.list_(pa.int32())),
                    "times": pa.array([times.astype(np.int32)], pa.list_(pa.int32())),
                })


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", label_id_col: str = "doc_id", per_label: int = PER_LABEL,
        max_chars: int = MAX_CHARS) -> Scorer:
    """The scorer for documents that have a label."""
    text = F.col(text_col).cast("string")
    keys = documents.select(
        F.col(id_col).alias("key"), F.xxhash64(text).alias("place"), F.coalesce(F.length(text), F.lit(0)).alias("chars")
    )
    marks = labels.select(F.col(label_id_col).alias("key"), F.col(label_col).cast("int").alias("label"))
    marked = keys.join(marks.where("label in (0, 1)").distinct(), "key").select("key", "place", "chars", "label")
    sample = samples.draw(marked, per_label, 2, max_chars)
    # The sample is bounded, so its keys are broadcast and no text is shuffled.
    chosen = F.broadcast(sample.select(F.col("key").alias("chosen"), F.col("place").alias("its place"), "label"))
    met = documents.select(F.col(id_col).alias("key"), text.alias("text")).join(
        chosen, (F.col("key") == F.col("chosen")) & (F.xxhash64("text") == F.col("`its place`"))
    )
    counted = met.select(F.struct("label", F.col("`its place`").alias("place")).alias("row_id"), "text").mapInArrow(
        _counter, "label int, place long, buckets array<int>, times array<int>"
    ).dropDuplicates(["label", "place"]).collect()
    counted.sort(key=lambda r: (r["place"], r["label"]))
    seen = sorted({r["label"] for r in counted})
    if len(seen) < 2:
        return Scorer(np.zeros(_FAMILIES << BITS, np.float32), {(): 0.0, (0,): -1e3, (1,): 1e3}[tuple(seen)])
    everywhere = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = [sum(r["label"] == k for r in counted) for k in (0, 1)]
    odds = np.log(everywhere[1] / everywhere[0]) - np.log(drawn[1] / drawn[0])
    made = []
    for r in counted:
        times = np.array(r["times"], np.float64)
        made.append((np.array(r["buckets"]), times / times.sum()))
    return train(made, [r["label"] for r in counted], float(odds))


def _scorer(model: Scorer):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_groups(batches, GROUP_BYTES):
            scores = model.scores([(t or b"").decode() for t in texts])
            yield pa.RecordBatch.from_pydict({"row_id": rows.column("row_id"), "score": pa.array(scores, pa.float64())})

    return score


def score(df: DataFrame, model: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`row_id` and `score`, the probability of label 1, for every row."""
    return id_and_text(df, id_col, text_col).mapInArrow(_scorer(model), output_schema(df, id_col, "score double"))
