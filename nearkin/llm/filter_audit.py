"""Which filter removes what in which order: five filters, all 120 orders.

A document fails a filter or not, whatever the order; so its five answers are a
mask, and documents of one part and one mask form a cell with three weights: how
many they are, how many of them are good and how many toxic. Every cell folds its
mask over the array of all orders, which makes 120 x 5 weighted structs, and the
structs of a part are added up element by element.

Filters: A under 50 words; B 100 * distinct words < 65 * words; C 100 * capital
letters > 5 * characters; D holds one of ``#$%&*|``; E the text of a document with
a smaller id is the same, whatever else happens to that document.

Nothing but a digest of the text (SHA-256), the id, the part and the mask is
shuffled; equal rows are counted before they meet, and copies of one text are
counted per part, mask and labels before the smallest id is looked for.

Handling of odd rows: a NULL text is an empty one, a NULL part is the empty
string; a row without id has no label and never fails E, nor does it make another
fail. Rows that repeat an id all count; those with the smallest id of a text do
not fail E. A document is good (toxic) if any of its label rows says 1. An empty
table has no parts and gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITAL_PERCENT = 5
SYMBOLS = "[#$%&*|]"
WORD_BREAK = r"[\x20\x09-\x0D]+"
COPY = 1 << FILTERS.index("E")
NULL_SALTS = 64

WEIGHTS = ("n", "good", "toxic")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def orders() -> list[tuple[int, ...]]:
    """All orders of the filters, by their places in ``FILTERS``."""
    return list(permutations(range(len(FILTERS))))


def text_mask(text: Column) -> Column:
    """The answers of the filters A to D as bits."""
    words = F.array_remove(F.split(text, WORD_BREAK), "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    fails = [
        n_words < MIN_WORDS,
        n_distinct.cast("long") * 100 < n_words.cast("long") * MIN_DISTINCT_PERCENT,
        capitals * 100 > F.length(text).cast("long") * MAX_CAPITAL_PERCENT,
        text.rlike(SYMBOLS),
    ]
    bits = [F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)]
    return sum(bits[1:], bits[0])


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with ``good`` and ``toxic``; those without id are dealt out by digest."""
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id"))
    marks = known.agg(
        *[F.max(F.when(F.col(of) == 1, 1).otherwise(0)).alias(to) for of, to in (("quality", "good"), ("toxic", "toxic"))]
    ).withColumn("salt", F.lit(0))
    lost = F.pmod(F.xxhash64("digest"), F.lit(NULL_SALTS)).cast("int")
    salted = rows.withColumn("salt", F.when(F.col("id").isNull(), lost).otherwise(0))
    joined = salted.join(marks, ["id", "salt"], "left").drop("salt")
    return joined.fillna(0, ["good", "toxic"])


def cells(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, mask, n, good, toxic: the documents of one part and one mask, counted."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        text_mask(whole).alias("mask"),
        F.unhex(F.sha2(whole, 256)).alias("digest"),
    )
    copies = rows.groupBy("id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    # A text has one mask, so the mask is no further key of its group.
    texts = _labelled(copies, labels).groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("without_id"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least"),
    )
    first = F.min("least.id").over(W.partitionBy("digest"))
    n_first = F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0) + F.col("without_id")
    split = texts.withColumn("first", first).withColumn("n_first", n_first)
    both = F.array(
        F.struct("mask", F.col("n_first").alias("n")),
        F.struct((F.col("mask") + COPY).alias("mask"), (F.col("n") - F.col("n_first")).alias("n")),
    )
    counted = split.select("part", "good", "toxic", F.inline(both)).filter("n > 0")
    return counted.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col(name)).alias(name) for name in WEIGHTS[1:]]
    )


def _zero(condition: Column, weight: str) -> Column:
    return F.when(condition, F.col(weight)).otherwise(F.lit(0).cast("long"))


def _folded(order: Column) -> Column:
    """A cell's five steps under one order: what the fold has seen, and a struct per step."""

    def step(state: Column, place: Column) -> Column:
        bit = F.get(F.array(*[F.lit(1 << i) for i in range(len(FILTERS))]), place)
        fails, gone = F.col("mask").bitwiseAND(bit) != 0, state["gone"]
        here = fails & ~gone
        made = F.struct(
            _zero(~fails & ~gone, "n").alias("kept"),
            _zero(here, "n").alias("removed"),
            _zero(fails & gone, "n").alias("redundant"),
            _zero(F.col("mask") == bit, "n").alias("unique_fails"),
            _zero(here, "good").alias("good_lost"),
            _zero(here, "toxic").alias("toxic_lost"),
        )
        return F.struct((gone | fails).alias("gone"), F.concat(state["steps"], F.array(made)).alias("steps"))

    kind = "array<struct<" + ",".join(f"{name}:bigint" for name in COUNTS) + ">>"
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(kind).alias("steps"))
    return F.aggregate(order, start, step, lambda state: state["steps"])


def _added(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct(*[(x[name] + y[name]).alias(name) for name in COUNTS]))


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, filter_order, step, the counts of that step and shapley.

    ``docs`` has the id, the text and the part; ``labels`` has doc_id, quality and
    toxic. A part has at most 32 cells, so its sum is over at most 32 arrays.
    """
    every, size = orders(), len(FILTERS)
    literal = F.expr(f"array({', '.join(f'array{order}' for order in every)})")
    counted = cells(docs, labels, doc_id, text, part)
    weighted = counted.select("part", F.flatten(F.transform(literal, _folded)).alias("steps"))
    gathered = weighted.groupBy("part").agg(F.collect_list("steps").alias("all"))
    others = F.slice("all", F.lit(2), F.size("all"))
    merged = gathered.select("part", F.aggregate(others, F.get("all", F.lit(0)), _added).alias("steps"))
    at = F.expr(f"array{sum(every, ())}")
    total = F.transform(
        F.array(*[F.lit(i) for i in range(size)]),
        lambda f: F.aggregate(
            F.zip_with("steps", at, lambda s, place: F.when(place == f, s["removed"]).otherwise(F.lit(0).cast("long"))),
            F.lit(0).cast("long"),
            lambda a, b: a + b,
        ),
    )
    rows = merged.withColumn("totals", total).select("part", "totals", F.posexplode("steps").alias("pos", "made"))
    names = F.expr(f"array{tuple(''.join(FILTERS[i] for i in order) for order in every)}")
    return rows.select(
        "part",
        F.get(names, (F.col("pos") / size).cast("int")).alias("filter_order"),
        (F.col("pos") % size + 1).cast("int").alias("step"),
        *[F.col("made")[name].alias(name) for name in COUNTS],
        F.get("totals", F.get(at, F.col("pos"))).alias("shapley"),
    )


_LETTERS = ", ".join(f"('{letter}')" for letter in FILTERS)

ORACLE_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '{WORD_BREAK}'), lambda w: w <> '') AS ws
  FROM documents),
failing AS (
  SELECT doc_id, part, len(ws) < {MIN_WORDS} AS a,
         100 * len(list_distinct(ws)) < {MIN_DISTINCT_PERCENT} * len(ws) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MAX_CAPITAL_PERCENT} * length(t) AS c,
         regexp_matches(t, '{SYMBOLS}') AS d,
         coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS e
  FROM texts),
marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
cells AS (
  SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) ||
         (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END) ||
         (CASE WHEN e THEN 'E' ELSE '' END) AS fails,
         count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM failing LEFT JOIN marks ON marks.doc_id = failing.doc_id GROUP BY ALL),
letters(l) AS (VALUES {_LETTERS}),
orders AS (
  SELECT v.l || w.l || x.l || y.l || z.l AS filter_order
  FROM letters v, letters w, letters x, letters y, letters z
  WHERE len(list_distinct([v.l, w.l, x.l, y.l, z.l])) = 5),
steps AS (
  SELECT filter_order, step::INT AS step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, range(1, 6) r(step)),
judged AS (
  SELECT part, filter_order, step, f, n, good, toxic, fails, contains(fails, f) AS failing,
         translate(fails, earlier, '') <> fails AS gone
  FROM cells, steps),
counted AS (
  SELECT part, filter_order, step, f,
         coalesce(sum(n) FILTER (WHERE NOT failing AND NOT gone), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE failing AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE failing AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE fails = f), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE failing AND NOT gone), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE failing AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM counted"""
