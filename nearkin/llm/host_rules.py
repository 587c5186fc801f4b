"""Operator 3: quality rules whose verdict is passed by host.

Every text is measured, and base rules say whether it fails. Failures are
counted per host (the ``source`` of a document). A beta prior is fitted to the
hosts' failure rates by moments, each host's rate is shrunk towards it, and the
verdict on the host is joined back to its documents: what comes from a host whose
shrunk rate exceeds ``max_rate``, or ``max_ratio`` times the rate of the corpus, is
not kept. A host of a clean corpus can so fail as well, but only by a rate that its
number of documents bears out: where hosts differ no more than by chance, all are
shrunk to the corpus and none is refused.

The measures are written once to the shared folder; hosts meet as one row per
host and task. Hosts with more than a 10,000th of all documents, so fewer than
10,000, are broadcast with their verdicts; the documents of the others, and of no
others, are joined by host.

Defined results: a NULL or empty text has no words and fails; a NULL host has no
verdict, its documents are judged by themselves; repeated rows count each; an
empty table gives an empty result; other columns are ignored. Lines and words are
told apart by two hashes, of 64 bits and modulo two primes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.llm import textarrays as ta
from nearkin.llm.common import kept, slices, utf8

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_RATE = 0.5
MAX_RATIO = 2.0
LARGE_SHARE = 10_000
SYMBOLS = b"#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _same_as_before(owners: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by owner and key, and which entries equal the one before in it."""
    order = np.lexsort((keys, owners))
    same = np.zeros(len(order), bool)
    same[1:] = (owners[order[1:]] == owners[order[:-1]]) & (keys[order[1:]] == keys[order[:-1]])
    return order, same


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The five measures of each of a slice of texts."""
    n = len(offsets) - 1
    starts, ends, bounds = ta.words(data, offsets)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    np.subtract.at(inside, ends, 1)
    in_word = np.cumsum(inside[:-1]) > 0
    symbols = np.zeros(256, bool)
    symbols[list(SYMBOLS)] = True
    rolling = ta.of_bytes(data)

    # Lines end at a line end or with their text.
    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_starts = line_starts[line_starts < len(data)]
    row = np.searchsorted(offsets, line_starts, side="right") - 1
    after = np.minimum(np.append(line_starts[1:], len(data)), offsets[row + 1]) if n else line_starts
    line_ends = np.where((after > line_starts) & (data[np.maximum(after - 1, 0)] == 10), after - 1, after)
    words_before = np.searchsorted(starts, np.stack([line_starts, line_ends]))
    worded = words_before[1] > words_before[0]
    row, line_starts, line_ends = row[worded], line_starts[worded], line_ends[worded]
    line_keys = rolling.windows(line_starts, line_ends) + (line_ends - line_starts).astype(np.uint64)
    line_keys ^= ta.mixed(ta.checks_of_bytes(data, line_starts, line_ends))
    order, same = _same_as_before(row, line_keys)
    n_dup_lines = np.bincount(row[order[same]], minlength=n)

    places = np.arange(len(starts))
    owner = np.repeat(np.arange(n), np.diff(bounds))
    fits = places + 3 <= bounds[owner + 1] if len(places) else places.astype(bool)
    places, owner = places[fits], owner[fits]
    windows = ta.Rolling(ta.safe_word_hashes(data, starts, ends)).windows(places, places + 3)
    order, same = _same_as_before(owner, windows)
    again = same.copy()
    again[:-1] |= same[1:]
    found = places[order[again]]
    covered = np.zeros(len(starts), bool)
    for shift in range(3):
        covered[found + shift] = True

    return {
        "n_words": np.diff(bounds).astype(np.int64),
        "word_chars": _per_text(in_word & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_text(symbols[data], offsets),
        "n_dup_lines": n_dup_lines.astype(np.int64),
        "n_repeat_words": _per_text(covered, bounds),
    }


def text_measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host, the five measures and base_failed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = measure(*utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("host"), *(pa.array(found[m]) for m in MEASURES)],
                names=["doc_id", "host", *MEASURES],
            )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        F.col(text).alias("text"),
    )
    schema = "doc_id long, host string, " + ", ".join(f"{m} long" for m in MEASURES)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return rows.mapInArrow(run, schema).withColumn("base_failed", failed)


def host_rates(measures: DataFrame, by: str = "host") -> DataFrame:
    """host, n_docs, n_failed, the failure rate shrunk by the empirical prior, the prior's
    mean (``usual``) and whether the host has a large part of all documents."""
    hosts = measures.filter(F.col(by).isNotNull()).groupBy(by).agg(
        F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")
    )
    hosts = kept(hosts)
    rate = F.col("n_failed") / F.col("n_docs")
    total = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum("n_docs").alias("n"),
        F.sum("n_failed").alias("f"),
        F.sum(F.col("n_docs") * rate * rate).alias("squares"),
    ).first()
    alpha, beta = beta_prior(total["hosts"], total["n"] or 0, total["f"] or 0, total["squares"] or 0.0)
    shrunk = (F.col("n_failed") + F.lit(alpha)) / (F.col("n_docs") + F.lit(alpha + beta))
    large = F.col("n_docs") * LARGE_SHARE > F.lit(total["n"] or 0)
    columns = {"rate": shrunk, "usual": F.lit(alpha / (alpha + beta)), "large": large}
    return hosts.withColumns(columns)


def beta_prior(hosts: int, n: int, failed: int, squares: float) -> tuple[float, float]:
    """Alpha and beta by moments; the spread between hosts is what exceeds chance.

    ``squares`` is the sum of n_i * rate_i ** 2 over the hosts.
    """
    if n == 0:
        return 1.0, 1.0
    mean = (failed + 0.5) / (n + 1.0)
    raw = failed / n
    spread = squares / n - raw * raw - mean * (1.0 - mean) * hosts / n
    spread = max(spread, 1e-6 * mean * (1.0 - mean))
    strength = max(mean * (1.0 - mean) / spread - 1.0, 1e-3)
    return mean * strength, (1.0 - mean) * strength


def host_verdicts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_rate: float = MAX_RATE,
    max_ratio: float = MAX_RATIO,
) -> DataFrame:
    """doc_id, the measures, base_failed, kept."""
    measures = kept(text_measures(docs, doc_id, text, host))
    refused = (F.col("rate") > max_rate) | (F.col("rate") > max_ratio * F.col("usual"))
    hosts = host_rates(measures).withColumn("refused", refused)
    large = hosts.filter("large").select("host", "refused")
    known = measures.join(F.broadcast(large), "host", "left")
    settled = known.filter(F.col("refused").isNotNull() | F.col("host").isNull())
    small = hosts.filter("refused AND NOT large").select("host", "refused")
    others = known.filter(F.col("refused").isNull() & F.col("host").isNotNull()).drop("refused")
    judged = settled.unionByName(others.join(small, "host", "left"))
    verdict = ~F.col("base_failed") & ~F.coalesce("refused", F.lit(False))
    return judged.select("doc_id", *MEASURES, "base_failed", verdict.alias("kept"))


_WORD_BREAK = r"[\x20\x09-\x0D]+"

ORACLE_SQL = f"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '{_WORD_BREAK}'), lambda w: w <> '') AS ws
  FROM documents),
windows AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS three
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM texts WHERE len(ws) >= 3)),
again AS (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS place
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, three) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT place) AS n FROM again GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM texts),
measured AS (
  SELECT t.doc_id, source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '{_WORD_BREAK}', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM texts t JOIN lines USING (doc_id) LEFT JOIN repeated r ON r.doc_id = t.doc_id),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed
  FROM measured),
hosts AS (
  SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (WHERE base_failed)::DOUBLE AS f
  FROM judged WHERE source IS NOT NULL GROUP BY source),
totals AS (
  SELECT count(*) AS hosts, sum(n) AS n, (sum(f) + 0.5) / (sum(n) + 1) AS mean, sum(f) / sum(n) AS raw,
         sum(f * f / n) / sum(n) AS squares FROM hosts),
spreads AS (
  SELECT *, greatest(squares - raw * raw - mean * (1 - mean) * hosts / n, 1e-6 * mean * (1 - mean)) AS spread
  FROM totals),
prior AS (SELECT mean, greatest(mean * (1 - mean) / spread - 1, 1e-3) AS strength FROM spreads),
refused AS (
  SELECT source FROM hosts, prior
  WHERE (f + mean * strength) / (n + strength) > least({MAX_RATE}, {MAX_RATIO} * mean))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM refused)) AS kept
FROM judged"""
