"""Distances between vectors, as SQL expressions.

A vector is a list with one entry per dimension. An entry is a number or the
SQL text of a DOUBLE expression, most often a column name. The sums are written
out term by term, so that they stay inside one span of generated code; as text
they reach the planner in one call rather than in one call per operator.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Entry = str | float

# Below these a spread or a divisor counts as zero.
MIN_STD = 1e-12
EPS = 1e-6

METRICS = ("euclidean", "book")

# Beyond this many products per row (centers x dimensions) the written-out form
# leaves the size the JIT compiles, and a fold over arrays takes over.
MAX_INLINE_TERMS = 200


def quoted(name: str) -> str:
    """A column name as SQL text, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def unused(df: DataFrame, stem: str) -> str:
    """``stem`` with so many underscores behind it that no column begins with it."""
    names = [name.lower() for name in df.columns]
    while any(name.startswith(stem) for name in names):
        stem += "_"
    return stem


def entries(array: str, dimension: int) -> list[str]:
    """The entries of an array column."""
    return [f"CAST(get({quoted(array)}, {i}) AS DOUBLE)" for i in range(dimension)]


def _sql(entry: Entry) -> str:
    return f"({entry})" if isinstance(entry, str) else f"({float(entry)!r}D)"


def _sum(terms: Sequence[str]) -> str:
    return " + ".join(terms)


def _dot(p: Sequence[Entry], q: Sequence[Entry]) -> str:
    return _sum([f"{_sql(a)} * {_sql(b)}" for a, b in zip(p, q, strict=True)])


def z_scores(
    point: Sequence[Column], mean: Sequence[float], std: Sequence[float]
) -> list[Column]:
    """(value - mean) / std per dimension; a spread of about zero divides by 1."""
    return [
        (value - float(m)) / (float(s) if s > MIN_STD else 1.0)
        for value, m, s in zip(point, mean, std, strict=True)
    ]


def squared_distance(p: Sequence[Entry], q: Sequence[Entry]) -> str:
    """Squared Euclidean distance."""
    gaps = [f"{_sql(a)} - {_sql(b)}" for a, b in zip(p, q, strict=True)]
    return _dot(gaps, gaps)


def euclidean(p: Sequence[Entry], q: Sequence[Entry]) -> str:
    """Euclidean distance."""
    return f"sqrt({squared_distance(p, q)})"


def relative_deviation(point: Sequence[Entry], center: Sequence[Entry]) -> list[str]:
    """value / center - 1 per dimension; a center entry near zero divides by EPS."""
    result = []
    for value, middle in zip(point, center, strict=True):
        if isinstance(middle, str):
            divisor = f"CASE WHEN abs({middle}) > {EPS!r}D THEN {middle} ELSE {EPS!r}D END"
        else:
            divisor = float(middle) if abs(middle) > EPS else EPS
        result.append(f"{_sql(value)} / {_sql(divisor)} - 1.0D")
    return result


def norm(vector: Sequence[Entry]) -> str:
    """Euclidean length."""
    return f"sqrt({_dot(vector, vector)})"


def with_distance(
    df: DataFrame,
    point: Sequence[Entry],
    seed: Sequence[Entry],
    center: Sequence[Entry],
    metric: str = "euclidean",
    name: str = "distance",
) -> DataFrame:
    """Add the distance between ``point`` and ``seed`` under the chosen measure.

    ``euclidean`` is the plain distance. ``book`` works on the deviations of
    both from ``center``: the root of their squared cosine plus the squared
    difference of their lengths, or that difference alone where a length is
    about zero. Items that deviate in the same direction thus count as far
    apart; that is part of the measure.
    """
    if metric == "euclidean":
        return df.withColumn(name, F.expr(euclidean(point, seed)))
    if metric != "book":
        raise ValueError(f"unknown metric {metric!r}; use one of {', '.join(METRICS)}")
    places, own = range(len(point)), unused(df, "_m")
    of_point = [f"{e} AS {own}d{i}" for i, e in enumerate(relative_deviation(point, center))]
    of_seed = [f"{e} AS {own}c{i}" for i, e in enumerate(relative_deviation(seed, center))]
    c, d = [f"{own}c{i}" for i in places], [f"{own}d{i}" for i in places]
    cn, dn, cd = (f"{own}_{kind}" for kind in ("cn", "dn", "cd"))
    lengths = [f"{norm(c)} AS {cn}", f"{norm(d)} AS {dn}", f"{_dot(c, d)} AS {cd}"]
    measured = df.selectExpr("*", *of_point, *of_seed).selectExpr(
        *[quoted(column) for column in df.columns], *lengths
    )
    cosine, gap = f"({cd} / {cn} / {dn})", f"({cn} - {dn})"
    distance = F.expr(
        f"CASE WHEN {cn} < {EPS!r}D OR {dn} < {EPS!r}D THEN abs{gap} "
        f"ELSE sqrt({cosine} * {cosine} + {gap} * {gap}) END"
    )
    return measured.withColumn(name, distance).drop(cn, dn, cd)


def center_bound(point: Sequence[Entry], center: Sequence[Entry], metric: str = "euclidean") -> str:
    """A number per item such that two items are at least as far apart as their numbers.

    For ``euclidean`` the distance from the center (triangle inequality), for
    ``book`` the length of the deviation, whose difference is a part of the distance.
    """
    if metric == "euclidean":
        return euclidean(point, center)
    if metric != "book":
        raise ValueError(f"unknown metric {metric!r}; use one of {', '.join(METRICS)}")
    return norm(relative_deviation(point, center))


def nearest_center(point: Sequence[str] | str, centers: Sequence[Sequence[float]]) -> Column:
    """STRUCT<cost DOUBLE, cluster INT> of the nearest center.

    Equally near centers give the lowest index. ``point`` is a list of entries
    or the name of an ARRAY<DOUBLE> column. Centers are parameters (k x d
    numbers), never data; many of them are one array in the plan, over which the
    vector is folded: a sum of squares per center, of which the least is taken.

    A vector that is NULL, has another number of entries than the centers, or an
    entry that is NULL or NaN, has no nearest center: the result is NULL.
    """
    if not centers:
        raise ValueError("no centers")
    dimension = len(centers[0])
    if len(centers) * dimension > MAX_INLINE_TERMS:
        return _nearest_by_fold(quoted(point) if isinstance(point, str) else f"array({', '.join(point)})", centers)
    places = entries(point, dimension) if isinstance(point, str) else point
    if len(places) != dimension:
        raise ValueError("the point and the centers differ in dimension")
    options = [
        f"struct({squared_distance(places, center)} AS cost, {i} AS cluster)"
        for i, center in enumerate(centers)
    ]
    whole = [f"{place} IS NOT NULL AND NOT isnan({place})" for place in map(_sql, places)]
    if isinstance(point, str):
        whole.insert(0, f"size({quoted(point)}) = {dimension}")
    best = options[0] if len(options) == 1 else f"least({', '.join(options)})"
    return F.expr(f"CASE WHEN {' AND '.join(whole)} THEN {best} END")


def _nearest_by_fold(packed: str, centers: Sequence[Sequence[float]]) -> Column:
    """The wide form for an expression that is an array; the array is worked out once."""
    dimension = len(centers[0])
    options = F.from_json(F.lit(json.dumps([list(map(float, c)) for c in centers])), "array<array<double>>")

    def best(vector: Column) -> Column:
        def option(center: Column, i: Column) -> Column:
            gaps = F.zip_with(vector, center, lambda a, b: a - b)
            return F.struct(F.aggregate(gaps, F.lit(0.0), lambda s, d: s + d * d).alias("cost"), i.alias("cluster"))

        whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x))
        return F.when((F.size(vector) == dimension) & whole, F.array_min(F.transform(options, option)))

    return F.get(F.transform(F.array(F.expr(packed).cast("array<double>")), best), F.lit(0))
