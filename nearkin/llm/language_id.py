"""Operator 6: the language of a text, by unigram pieces summed over all segmentations.

The pieces are the fixed vocabulary of a public SentencePiece model. For every
language the pieces of sample texts are counted (at most ``texts_per_language``
texts each, those with the smallest hash of their id), and smoothed to
probabilities. A text is its words in lower case (runs of letters), each with
the mark of a word's beginning in front. The probability of a word is the sum
over all ways to cut it into pieces, by the forward algorithm; a character may
always stand alone, at a floor. Pieces do not cross words, so a text's
log-likelihood is the sum over its words. Whole texts are read.

The forward algorithm runs over the distinct words that a worker's table lacks,
words of one length at a time; the table is bounded and starts anew when full.

Defined results: ``und`` with score 0 for a text that is NULL or has no letter,
and for every text if there is nothing to learn from; equal likelihoods give the
language that comes first by name; repeated rows are scored each; an empty table
gives an empty result; other columns are ignored. The score is the posterior of
the predicted language under a uniform prior.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.llm.common import slices
from nearkin.llm.quality_classifier import fold

MARK = "▁"
TEXTS_PER_LANGUAGE = 400
SMOOTHING = 0.1
FLOOR = 1e-9
LONGEST_PIECE = 16
LONG_WORD = 32
KEPT_WORDS = 400_000
FOLDS, HELD_OUT = 3, 1
NO_LANGUAGE = "und"

_words = regex.compile(r"\p{L}+").findall


@lru_cache(maxsize=2)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def vocabulary(path: str) -> dict[str, int]:
    """Piece -> id, without control, unknown and byte pieces."""
    model = processor(path)
    return {
        model.id_to_piece(i): i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        and len(model.id_to_piece(i)) <= LONGEST_PIECE
    }


def piece_counts(rows: DataFrame, path: str) -> DataFrame:
    """language, piece, n over the rows (language, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = processor(path)
        counts: dict[tuple[str, int], int] = defaultdict(int)
        for batch in slices(batches, "text"):
            pairs = zip(batch.column("language").to_pylist(), batch.column("text").to_pylist(), strict=True)
            for language, text in pairs:
                found = " ".join(_words((text or "").lower()))
                for piece in model.encode(found, num_threads=1):
                    counts[language, piece] += 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in counts], pa.string()),
                pa.array([k[1] for k in counts], pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names=["language", "piece", "n"],
        )

    counted = rows.mapInArrow(run, "language string, piece int, n long")
    return counted.groupBy("language", "piece").agg(F.sum("n").alias("n"))


def training_rows(
    docs: DataFrame, per_language: int, doc_id: str = "doc_id", text: str = "text", language: str = "lang"
) -> DataFrame:
    """About ``per_language`` texts (language, text) of each language, all of a smaller one.

    A row is in by the hash of its id against the share of its language that is
    wanted; the shares come from a count over the id and language columns alone.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(language).cast("string").alias("language"),
        F.col(text).alias("text"),
    )
    known = rows.filter(F.col("language").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    sizes = {r["language"]: r["n"] for r in known.groupBy("language").agg(F.count("*").alias("n")).collect()}
    span = 1 << 30
    place = F.pmod(F.xxhash64("doc_id"), F.lit(span))
    wanted = F.lit(False)
    for name, n in sorted(sizes.items()):
        share = min(span, span * per_language // n + 1)
        wanted = wanted | ((F.col("language") == name) & (place < share))
    return known.filter(wanted).select("language", "text")


class Model:
    """Piece probabilities per language: ``chances[piece row, language]``."""

    def __init__(self, languages: list[str], pieces: dict[str, int], chances: np.ndarray):
        self.languages, self.rows, self.chances = languages, pieces, chances
        self._restart()

    def _restart(self) -> None:
        self.known: dict[str, int] = {}
        self.logs = np.zeros((1 << 12, len(self.languages)))

    def learn(self, words: set[str]) -> None:
        """Put the log-likelihoods of the words into the table."""
        missing = [w for w in words if w not in self.known]
        if len(self.known) + len(missing) > KEPT_WORDS and self.known:
            self._restart()
            missing = list(words)
        by_length = defaultdict(list)
        for word in missing:
            by_length[len(word)].append(word)
        for length, group in by_length.items():
            logs = self._forward(group) if length <= LONG_WORD else np.stack([self._forward_long(w) for w in group])
            start = len(self.known)
            while start + len(group) > len(self.logs):
                self.logs = np.concatenate([self.logs, np.zeros_like(self.logs)])
            self.logs[start : start + len(group)] = logs
            self.known.update(zip(group, range(start, start + len(group)), strict=True))

    def _forward(self, words: list[str]) -> np.ndarray:
        """log P of words of one length, all at once."""
        marked = [MARK + w for w in words]
        length = len(marked[0])
        get = self.rows.get
        forward = np.zeros((length + 1, len(words), len(self.languages)))
        forward[0] = 1.0
        for end in range(1, length + 1):
            for start in range(max(0, end - LONGEST_PIECE), end):
                rows = np.array([get(w[start:end], 0) for w in marked], np.int64)
                if start == end - 1:
                    forward[end] += forward[start] * np.maximum(self.chances[rows], FLOOR)
                else:
                    found = np.flatnonzero(rows)
                    if len(found):
                        forward[end, found] += forward[start, found] * self.chances[rows[found]]
        return np.log(forward[length])

    def _forward_long(self, word: str) -> np.ndarray:
        """The same in logarithms, for a word whose probability might vanish."""
        marked = MARK + word
        logs = np.log(np.maximum(self.chances, 1e-300))
        forward = [np.zeros(len(self.languages))]
        for end in range(1, len(marked) + 1):
            total = forward[-1] + np.log(np.maximum(self.chances[self.rows.get(marked[end - 1], 0)], FLOOR))
            for start in range(max(0, end - LONGEST_PIECE), end - 1):
                row = self.rows.get(marked[start:end], 0)
                if row:
                    total = np.logaddexp(total, forward[start] + logs[row])
            forward.append(total)
        return forward[-1]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        cut = [_words(t.lower()) if t else [] for t in texts]
        self.learn({w for words in cut for w in words})
        names, scores = [], []
        for words in cut:
            if not words or not self.languages:
                names.append(NO_LANGUAGE)
                scores.append(0.0)
                continue
            rows = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            logs = self.logs[rows].sum(axis=0)
            best = int(np.argmax(logs))
            names.append(self.languages[best])
            scores.append(float(1.0 / np.exp(logs - logs[best]).sum()))
        return names, scores


def fit(rows: DataFrame, path: str, smoothing: float = SMOOTHING) -> tuple[list[str], bytes]:
    """Languages and packed probabilities; the size is bounded by vocabulary times languages."""
    pieces = vocabulary(path)
    found = piece_counts(rows, path).collect()
    languages = sorted({r["language"] for r in found})
    counts = np.zeros((processor(path).get_piece_size(), len(languages)))
    for row in found:
        counts[row["piece"], languages.index(row["language"])] += row["n"]
    used = np.zeros((len(pieces) + 1, len(languages)))
    for place, number in enumerate(pieces.values(), 1):
        used[place] = counts[number] + smoothing
    used[0] = 0.0
    total = np.maximum(used.sum(axis=0), 1e-300)
    return languages, (used / total).astype("<f4").tobytes()


_models: dict[str, Model] = {}


def _model(key: str, sent, path: str) -> Model:
    """The model as the worker uses it, kept by the name that the driver gave it."""
    if key not in _models:
        _models.clear()
        languages, packed = sent.value
        rows = {piece: place for place, piece in enumerate(vocabulary(path), 1)}
        chances = np.frombuffer(packed, "<f4").astype(np.float64).reshape(len(rows) + 1, len(languages))
        _models[key] = Model(languages, rows, chances)
    return _models[key]


def identified(docs: DataFrame, model: tuple[list[str], bytes], path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every text; nothing is shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    name = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _model(name, sent, path)
        for batch in slices(batches, "text"):
            names, scores = own.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def languages(docs: DataFrame, path: str, per_language: int = TEXTS_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    model = fit(training_rows(docs, per_language), path)
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return identified(docs, model, path).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
