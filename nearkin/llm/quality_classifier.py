"""Operator 9: document quality by supervised subword embeddings.

A text is a bag of its words, their character n-grams and the pairs of words
that follow each other; each is hashed to one of ``buckets`` learned vectors. The
mean of the vectors goes through a linear layer and a softmax over the two
classes. Both are trained by stochastic gradient descent in numpy, in one task,
on a sample of labelled rows of bounded size (``train_rows``, the parameter that
bounds it; those with the smallest hash of their id). A pair of equal words is
one more feature, whatever the word.

As the output is linear in the mean, scoring needs one number per bucket. Every
worker keeps (sum, count) of the features of a word, so a text costs one lookup
per word and one hash per pair. Whole texts are read in training and in scoring.

Defined results: NULL and empty texts have no features and get the score of the
bias alone; with no label, or with labels of one class only, the score is the
share of label 1 (0.5 without labels); a document with several labels takes the
lowest; NULL labels are no labels; repeated rows are scored each; other columns
are ignored.
"""

from __future__ import annotations

import math
import operator
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.llm.common import held, slices
from nearkin.llm.pretokens import Memo

BUCKETS = 1 << 18
DIMENSION = 8
NGRAMS = (2, 3, 4)
TRAIN_ROWS = 3000
EPOCHS = 5
RATE = 0.5
LIMIT = 0.7
FOLDS, HELD_OUT = 4, 2
KEPT_WORDS = 300_000
LONG_WORD = 64

_WORD = re.compile(r"\S+")
_SAME = "\0same"


def _bucket(feature: str, buckets: int) -> int:
    return zlib.crc32(feature.encode()) % buckets


def word_features(word: str, buckets: int = BUCKETS) -> list[int]:
    """The buckets of a word and of the n-grams of ``<word>``."""
    marked = f"<{word}>"
    found = [_bucket("\1" + word, buckets)]
    for n in NGRAMS:
        found += [_bucket(marked[i : i + n], buckets) for i in range(len(marked) - n + 1)]
    return found


def pair_features(words: list[str], buckets: int = BUCKETS) -> list[int]:
    """The bucket of every pair of words that follow each other."""
    return [_bucket(f"\2{a} {b}", buckets) for a, b in zip(words, words[1:], strict=False)]


def text_features(text: str | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    words = _WORD.findall(text or "")
    counts: Counter[int] = Counter()
    for word, n in Counter(words).items():
        for bucket in word_features(word, buckets):
            counts[bucket] += n
    counts.update(pair_features(words, buckets))
    same = sum(map(operator.eq, words, words[1:]))
    if same:
        counts[_bucket(_SAME, buckets)] += same
    return np.fromiter(counts.keys(), np.int64, len(counts)), np.fromiter(counts.values(), np.float32, len(counts))


def train(
    texts: list[str | None],
    labels: list[int],
    buckets: int = BUCKETS,
    dimension: int = DIMENSION,
    epochs: int = EPOCHS,
    rate: float = RATE,
    seed: int = 1,
) -> tuple[np.ndarray, float]:
    """(weight of class 1 over class 0 per bucket, bias)."""
    n_one = sum(labels)
    if not labels or n_one in (0, len(labels)):
        share = (n_one + 1.0) / (len(labels) + 2.0) if labels else 0.5
        return np.zeros(buckets, np.float32), math.log(share / (1.0 - share))
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1.0 / dimension, 1.0 / dimension, (buckets, dimension)).astype(np.float32)
    layer = np.zeros((2, dimension), np.float32)
    bias = np.zeros(2, np.float32)
    bags = []
    for text in texts:
        features, counts = text_features(text, buckets)
        bags.append((features, counts / counts.sum() if len(counts) else counts))
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for i in random.permutation(len(bags)).tolist():
            features, shares = bags[i]
            mean = shares @ vectors[features]
            logits = layer @ mean + bias
            chances = np.exp(logits - logits.max())
            gap = chances / chances.sum()
            gap[labels[i]] -= 1.0
            step = np.float32(rate * (1.0 - done / steps))
            change = gap @ layer
            layer -= step * np.outer(gap, mean)
            bias -= step * gap * np.float32(0.1)
            vectors[features] -= step * np.outer(shares, change) * np.float32(len(features) ** 0.5)
            done += 1
    weights = (vectors @ (layer[1] - layer[0])).astype(np.float32)
    return weights, float(bias[1] - bias[0])


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the document id as text, modulo ``folds``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, keep: Column, train_rows: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """At most ``train_rows`` rows (text, label) of the labelled documents that ``keep`` lets in."""
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & keep)
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # The chosen rows are bounded by train_rows; of repeated document ids one text is used.
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def fit(rows: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, float]:
    """Train on the bounded rows in one task; the model is ``buckets`` numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("training", lambda: None)
        sample = []
        for batch in batches:
            sample += zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "label")), strict=True)
        sample.sort(key=lambda row: row[0])
        weights, bias = train([r[1] for r in sample], [r[2] for r in sample], buckets)
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.astype("<f4").tobytes()], pa.binary()), pa.array([bias], pa.float64())],
            names=["weights", "bias"],
        )

    row = rows.coalesce(1).mapInArrow(run, "weights binary, bias double").first()
    if row is None:  # no rows, and so no task
        return train([], [], buckets)
    return np.frombuffer(bytes(row["weights"]), "<f4"), row["bias"]


class Scorer:
    """Scores texts; a word's (sum of weights, number of features) is one complex number."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.words = Memo(self._word, KEPT_WORDS)
        self.same = complex(float(weights[_bucket(_SAME, len(weights))]), 1.0)

    def _word(self, word: str) -> complex:
        found = word_features(word, len(self.weights))
        return complex(float(self.weights[found].sum(dtype=np.float64)), len(found))

    def score(self, text: str | None) -> float:
        words = text.split() if text else []
        total = sum(map(self.words.__getitem__, words), 0j)
        pairs = pair_features(words, len(self.weights))
        total += complex(float(self.weights[pairs].sum(dtype=np.float64)) if pairs else 0.0, len(pairs))
        total += self.same * sum(map(operator.eq, words, words[1:]))
        logit = self.bias + (total.real / total.imag if total.imag else 0.0)
        return 1.0 / (1.0 + math.exp(-max(min(logit, 500.0), -500.0)))


def _scorer(name: str, model) -> Scorer:
    """The scorer of a model, kept by the name that the driver gave it."""

    def make() -> Scorer:
        packed, bias = model.value
        return Scorer(np.frombuffer(packed, "<f4"), bias)

    return held(name, make)


def scored(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", score: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score; nothing is shuffled."""
    weights, bias = model
    sent = docs.sparkSession.sparkContext.broadcast((weights.astype("<f4").tobytes(), bias))
    name = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(name, sent)
        for batch in slices(batches, text):
            found = pa.array([scorer.score(t) for t in batch.column(text).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, score])

    if score in docs.columns:
        raise ValueError(f"the table has a column {score!r} already")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())]))


def quality_scores(
    docs: DataFrame, labels: DataFrame, label: str = "quality", train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    keep = fold(F.col("doc_id"), FOLDS) != HELD_OUT
    model = fit(training_rows(docs, labels, label, keep, train_rows))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored(rows, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= LIMIT).cast("int").alias("predicted"),
    )
