"""Similar items: the nearest items of the seed's own cluster."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nearkin.functions import casts, vectors
from nearkin.functions.once import computed_once
from nearkin.operators.clusters import ClusterModel, centers_table
from nearkin.operators.features import feature_vector, valid_items, with_point, z_names
from nearkin.operators.seeds import first_per_id
from nearkin.schema import DEFAULT_TOP, SONGS, ItemColumns
from nearkin.sources.scratch import kept


def _present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [name for name in names if name in df.columns]


def describe(df: DataFrame, columns: ItemColumns = SONGS, keep: Sequence[str] = ()) -> DataFrame:
    """The display columns of an item, numbers cast and rounded.

    ``keep`` names further columns to carry along unchanged.
    """
    c = columns
    shown = [F.col(name) for name in _present(df, (c.id, c.name, c.maker_name, c.maker_id))]
    if c.year in df.columns:
        shown.append(casts.whole_number(df, c.year).alias(c.year))
    for name, digits in c.extra:
        if name in df.columns:
            shown.append(F.round(casts.number(df, name), digits).alias(name))
    return df.select(*shown, *[F.col(name) for name in keep])


def _ties(df: DataFrame, columns: ItemColumns) -> list[str]:
    """The display columns that order rows of equal distance and id."""
    c = columns
    return _present(df, (c.name, c.maker_name, c.maker_id, c.year, *[name for name, _ in c.extra]))


def seed_row(seeds: DataFrame, model: ClusterModel, columns: ItemColumns = SONGS) -> Row:
    """The seed as a row with its scaled features ``_z0``, ``_z1``, ...

    Raises LookupError if the seed does not exist or its features are invalid.
    """
    valid = valid_items(seeds, model.features)
    shown = _present(valid, (columns.id, columns.name, columns.maker_name, columns.maker_id))
    names = [*shown, *_present(valid, (columns.year, columns.cluster))]
    point = z_names(model.stats)
    found = with_point(valid, model.stats).select(*names, *point).limit(1).collect()
    if not found:
        raise LookupError("the seed item was not found")
    return found[0]


def candidates(
    assigned: DataFrame, seed: Row, model: ClusterModel, columns: ItemColumns = SONGS
) -> DataFrame:
    """The valid items of the seed's cluster, without rows that have its id.

    The cluster is a literal, so a table partitioned by cluster is read only
    where the seed's cluster lies.
    """
    rows = assigned.filter(F.col(columns.cluster) == seed[columns.cluster])
    rows = rows.filter(~F.col(columns.id).eqNullSafe(F.lit(seed[columns.id])))
    return valid_items(rows, model.features)


def candidate_counts(
    assigned: DataFrame, seed: Row, model: ClusterModel, columns: ItemColumns = SONGS
) -> DataFrame:
    """``n_candidates`` and ``n_total`` in one pass over the table."""
    valid = [casts.is_finite(value) for value in feature_vector(assigned, model.features)]
    wanted = (F.col(columns.cluster) == seed[columns.cluster]) & ~F.col(columns.id).eqNullSafe(
        F.lit(seed[columns.id])
    )
    for condition in valid:
        wanted = wanted & condition
    return assigned.agg(
        F.count_if(wanted).alias("n_candidates"), F.count(F.lit(1)).alias("n_total")
    )


def with_seed_distance(
    rows: DataFrame,
    seed: Row,
    model: ClusterModel,
    metric: str = "euclidean",
    name: str = "distance",
    columns: ItemColumns = SONGS,
) -> DataFrame:
    """Add the distance of each row from the seed, in the seed's cluster."""
    point = z_names(model.stats)
    start, center = [seed[z] for z in point], model.centers[seed[columns.cluster]]
    placed = with_point(rows, model.stats)
    return vectors.with_distance(placed, point, start, center, metric, name).drop(*point)


def recommend(
    assigned: DataFrame,
    model: ClusterModel,
    seed: Row,
    n: int = DEFAULT_TOP,
    metric: str = "euclidean",
    columns: ItemColumns = SONGS,
) -> DataFrame:
    """The ``n`` candidates nearest to the seed: rank, display columns, distance.

    Every task keeps its own ``n`` best rows; only those meet, and only those are
    rounded for display. Equal distances are ordered by id, then by what is shown.
    A row whose distance is no number does not count.
    """
    rows = candidates(assigned, seed, model, columns)
    scored = with_seed_distance(rows, seed, model, metric, columns=columns)
    scored = scored.filter(F.col("distance").isNotNull() & ~F.isnan("distance"))
    order = ["distance", columns.id, *_ties(assigned, columns)]
    best = scored.orderBy(*order).limit(n)
    place = F.row_number().over(W.orderBy(*order))
    shown = describe(best.withColumn("rank", place), columns, keep=["rank", "distance"])
    return shown.withColumn("distance", F.round("distance", 6))


def recommend_document(
    assigned: DataFrame,
    model: ClusterModel,
    seed: Row,
    n: int = DEFAULT_TOP,
    metric: str = "euclidean",
    columns: ItemColumns = SONGS,
) -> DataFrame:
    """One row: the seed, the cluster, the measure, the date and ``similar``."""
    c = columns
    best = recommend(assigned, model, seed, n, metric, columns)
    entry = F.struct(*[F.col(name) for name in best.columns if name != "rank"])
    ordered = F.sort_array(F.collect_list(F.struct(F.col("rank"), entry.alias("entry"))))

    def of_seed(name: str) -> Column:
        if name not in seed:
            return F.lit(None).cast("string")
        return F.lit(seed[name]).cast(assigned.schema[name].dataType)

    return best.agg(F.transform(ordered, lambda e: e["entry"]).alias("similar")).select(
        of_seed(c.name).alias("name"),
        of_seed(c.maker_name).alias("artist"),
        of_seed(c.id).alias("song_id"),
        of_seed(c.year).alias("year"),
        F.lit(seed[c.cluster]).alias("cluster"),
        F.lit(metric).alias("metric"),
        F.date_format(
            F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss"
        ).alias("date"),
        "similar",
    )


def nearest_in_group(
    rows: DataFrame,
    seeds: DataFrame,
    group: str,
    distance: Callable[[DataFrame], DataFrame],
    item_id: str,
    n: int = DEFAULT_TOP,
    ties: Sequence[str] = (),
) -> DataFrame:
    """For every seed the ``n`` nearest rows of its own group, with ``rank``.

    ``seeds`` has a unique ``seed_id``, the group column and whatever else
    ``distance`` needs, which adds a column of that name to the joined rows.
    Equal distances are ordered by the item's id, then by the columns ``ties``.
    A pair whose distance is NULL or NaN does not count; neither does a row with
    the seed's own id.

    The rows of a group are cut into slices by their input partition, and the
    seeds are repeated per slice, so that a group with a third of all rows is
    spread over all tasks. Every slice keeps its own ``n`` best per seed, and
    only those meet. How the join runs is left to the planner.
    """
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = vectors.unused(seeds, vectors.unused(rows, "_slice"))
    sliced = rows.withColumn(part, F.pmod(F.spark_partition_id(), F.lit(slices)))
    repeated = seeds.withColumn(part, F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    pairs = sliced.join(repeated, [group, part])
    others = pairs.filter(~F.col(item_id).eqNullSafe(F.col("seed_id")))
    scored = computed_once(distance(others), "distance")
    scored = scored.filter(F.col("distance").isNotNull() & ~F.isnan("distance"))
    order = ["distance", item_id, *ties]
    local = W.partitionBy(group, part, "seed_id").orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(local)).filter(F.col("rank") <= n)
    overall = W.partitionBy("seed_id").orderBy(*order)
    ranked = best.drop(part).withColumn("rank", F.row_number().over(overall))
    return ranked.filter(F.col("rank") <= n)


# A cell of the pruned join holds about so many rows; a level cuts a cell into so many at most.
CELL_ROWS = 32
QUANTILES = 64
LEVELS = 3, 4
# A cell's number has so many bits per level.
BITS = 8
# Relative slack of a bound, far above the rounding of the sums behind it.
SLACK = 1e-9


def _first_of_copies(
    rows: DataFrame, group: str, point: Sequence[str], item_id: str, n: int, ties: Sequence[str]
) -> DataFrame:
    """The rows that can be among the ``n`` nearest of any seed, as far as copies go.

    Of the rows of a group with one point and one id the first ``n`` by ``ties``, and
    of all ids with that point the first ``n + 1``: a seed leaves out one id.
    """
    place = vectors.unused(rows, "_copy")
    same = [group, *point]
    by_id = W.partitionBy(*same, item_id).orderBy(*(ties or [item_id]))
    few = rows.withColumn(place, F.row_number().over(by_id)).filter(F.col(place) <= n).drop(place)
    ids = W.partitionBy(*same).orderBy(item_id)
    return few.withColumn(place, F.dense_rank().over(ids)).filter(F.col(place) <= n + 1).drop(place)


def _cuts(rows: DataFrame, group: str, value: str, cell_rows: int, left: int) -> DataFrame:
    """The inner edges of every cell (``_of``, ``_within``) by quantiles of a number, ``_edges``, such
    that ``left`` levels of this kind lead to cells of about ``cell_rows`` rows."""
    fractions = ", ".join(str(i / QUANTILES) for i in range(1, QUANTILES))
    cuts = F.expr(f"percentile_approx({vectors.quoted(value)}, array({fractions}), 1000)")
    sizes = rows.groupBy(F.col(group).alias("_of"), F.col("_cell").alias("_within"))
    sizes = sizes.agg(cuts.alias("_cuts"), F.count(F.lit(1)).alias("_n"))
    wanted = F.ceil(F.pow(F.greatest(F.col("_n") / cell_rows, F.lit(1.0)), 1.0 / left) - 1e-6)
    sizes = sizes.withColumn("_wanted", F.least(F.lit(QUANTILES), wanted).cast("int")).filter("_wanted > 1")
    at = F.transform(
        F.sequence(F.lit(1), F.col("_wanted") - 1),
        lambda i: F.get("_cuts", (i * QUANTILES / F.col("_wanted")).cast("int") - 1),
    )
    return sizes.select("_of", "_within", F.array_distinct(at).alias("_edges"))


def _slice_of(value: Column) -> Column:
    """The slice a number falls into: how many edges are not above it; none where nothing is cut."""
    return F.coalesce(F.size(F.filter("_edges", lambda e: e <= value)), F.lit(0))


def _below(df: DataFrame, edges: DataFrame, group: str, cell: Column) -> DataFrame:
    """The cells (``_cell``) one level below those of ``df``, by an expression over ``_edges``."""
    # Fewer numbers than one for each CELL_ROWS rows.
    found = df.join(F.broadcast(edges), (F.col(group) == F.col("_of")) & (F.col("_cell") == F.col("_within")), "left")
    found = found.withColumn("_slice", cell)
    return found.withColumn("_cell", F.col("_cell") * (1 << BITS) + F.col("_slice")).drop("_of", "_within", "_edges", "_slice")


def _above(cell: str, bits: str) -> Column:
    return F.expr(f"shiftright({cell}, {bits})")


def _first_in_batches(found: DataFrame, n: int) -> DataFrame:
    """The pairs (seed_id, distance, _nth) without those that ``n`` of their own batch precede.

    Pairs leave the join seed by seed, so that few are left to be sorted and sent.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seed = batch.column("seed_id").dictionary_encode().indices.to_numpy(zero_copy_only=False)
            distance, nth = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("distance", "_nth"))
            order = np.lexsort((nth, distance, seed))
            start = np.flatnonzero(np.diff(seed[order], prepend=-1) != 0)
            place = np.arange(len(order)) - np.repeat(start, np.diff(start, append=len(order)))
            yield batch.take(pa.array(order[place < n]))

    return found.mapInArrow(run, found.schema)


def nearest_by_bound(
    rows: DataFrame,
    seeds: DataFrame,
    group: str,
    distance: Callable[[DataFrame], DataFrame],
    item_id: str,
    point: Sequence[str],
    bounds: Sequence[tuple[str, str]],
    n: int = DEFAULT_TOP,
    ties: Sequence[str] = (),
) -> DataFrame:
    """:func:`nearest_in_group` for many seeds, without all pairs of a group.

    ``bounds`` are pairs of columns, of the rows and of the seeds, such that ``distance``
    is never below the difference of a pair (see ``vectors.center_bound``). The rows of
    a group are cut into cells, by quantiles of one bound within the slices of another
    (the first only where it is the only one). A seed first meets its own cell; its n-th
    distance there limits which cells can hold anything nearer, and it meets those in the
    last step. Where the first is the only bound, a cell says little of the distance:
    then a seed meets a wider one, of the order of the root of the group, before that, and
    the last step goes by such cells. A seed that finds fewer than ``n`` meets a wider
    cell and then the group. A pair is measured once, and only if all bounds allow. The
    result is exact.

    ``point`` are the columns that the distance depends on: of many rows with one point
    only the first can be near, and the others go before any pair is made. What is
    left is numbered in the order of id and ``ties``; a pair carries that number, and
    the other columns join the winners. ``group`` has few values (the clusters of a
    model). The seeds go out once per cell they meet; where very many meet one cell,
    the adaptive planner splits the join. Pairs are never sorted as a whole: of each
    batch only what can be among the first goes on.
    """
    own = list(dict.fromkeys([item_id, group, *point, *[of_row for of_row, _ in bounds]]))
    few = _first_of_copies(rows, group, point, item_id, n, ties).orderBy(item_id, *ties)
    few = few.withColumns({"_nth": F.monotonically_increasing_id(), "_cell": F.lit(0).cast("long")})
    cut = list(bounds[1:] or bounds)[: LEVELS[1]]
    cut = (cut * LEVELS[0])[: max(LEVELS[0], len(cut))]
    last, cell_rows = len(cut), max(CELL_ROWS, 2 * n)
    targets = [cell_rows] * last
    placed = kept(few)
    if len(bounds) == 1:  # the last level leads from the wide cells to the small ones
        last -= 1
        most = placed.groupBy(group).count().agg(F.max("count")).first()[0] or 0
        targets[:last] = [max(cell_rows, int((2 * n * most) ** 0.5))] * last
    home, levels = seeds.withColumn("_cell", F.lit(0).cast("long")), []
    for level, ((of_row, of_seed), target) in enumerate(zip(cut, targets, strict=True)):
        left = last - level if level < last else 1
        levels.append(kept(_cuts(placed, group, of_row, target, left)))
        placed = _below(placed, levels[-1], group, _slice_of(F.col(of_row)))
        home = _below(home, levels[-1], group, _slice_of(F.col(of_seed)))
    placed, home = kept(placed), kept(home.withColumns({"_limit": F.lit(float("inf")), "_met": F.lit(0)}))
    met = placed.select("_nth", "_cell", *own)

    def measured(asking: DataFrame, bits: int, new: bool = True) -> DataFrame:
        """The pairs of seeds and the rows of the cell ``_at``, ``bits`` above the smallest."""
        there = met.withColumn("_at", _above("_cell", str(bits)))
        on = (F.col("l._at") == F.col("r._at")) & (F.col(f"l.{group}") == F.col(f"r.{group}"))
        on = on & ~F.col(f"r.{item_id}").eqNullSafe(F.col("l.seed_id"))
        if new:  # a cell that the seed has met is left out
            on = on & (_above("r._cell", "l._met") != _above("l._cell", "l._met"))
        limit = F.col("l._limit")
        for of_row, of_seed in bounds:
            gap = F.abs(F.col(f"r.{of_row}") - F.col(f"l.{of_seed}"))
            on = on & ((limit == float("inf")) | F.isnan(gap) | (gap <= limit))
        columns = [F.col(f"r.{c}") for c in ("_nth", *point)]
        asked = [c for c in asking.columns if c not in ("_at", "_cell", "_met")]
        pairs = asking.alias("l").join(there.alias("r"), on).select(*columns, *[F.col(f"l.{c}") for c in asked])
        found = computed_once(distance(pairs), "distance")
        found = found.filter(F.col("distance").isNotNull() & ~F.isnan("distance") & (F.col("distance") <= F.col("_limit")))
        return _first_in_batches(found.select("seed_id", "distance", "_nth"), n)

    def ranked(found: DataFrame) -> DataFrame:
        overall = W.partitionBy("seed_id").orderBy("distance", "_nth")
        return found.withColumn("rank", F.row_number().over(overall)).filter(F.col("rank") <= n)

    def limited(asking: DataFrame, best: DataFrame) -> DataFrame:
        limits = best.filter(F.col("rank") == n).select("seed_id", F.col("distance").alias("_far"))
        limit = F.coalesce("_far", F.lit(float("inf")))
        slack = (limit + F.abs(bounds[0][1]) + 1.0) * SLACK
        return asking.join(limits, "seed_id", "left").withColumn("_limit", limit + slack).drop("_far")

    best = kept(ranked(measured(home.withColumn("_at", F.col("_cell")), 0, new=False)))
    home = kept(limited(home, best))
    no_limit = F.col("_limit") == float("inf")
    for depth in (len(cut) - 1, 0):
        bits = BITS * (len(cut) - depth)
        wider = F.lit(True) if depth == last else no_limit
        asking = home.filter(wider)
        if asking.isEmpty():
            continue
        found = measured(asking.withColumn("_at", _above("_cell", str(bits))), bits)
        best = kept(ranked(best.drop("rank").unionByName(found)))
        home = kept(limited(home.withColumn("_met", F.when(wider, F.lit(bits)).otherwise(F.col("_met"))), best))

    # Who still has no limit has met the whole group.
    asked = home.filter(~no_limit).withColumnsRenamed({"_cell": "_own"}).withColumn("_cell", F.lit(0).cast("long"))
    for (_, of_seed), edges in zip(cut[:last], levels, strict=False):
        ends = (_slice_of(F.col(of_seed) - F.col("_limit")), _slice_of(F.col(of_seed) + F.col("_limit")))
        asked = _below(asked, edges, group, F.explode(F.sequence(*ends)))
    asked = asked.withColumnsRenamed({"_cell": "_at", "_own": "_cell"})
    bits = BITS * (len(cut) - last)
    # A seed's wider cell may cover several of these.
    asked = asked.filter((F.col("_met") < bits) | (F.expr(f"shiftright(_at, greatest(_met - {bits}, 0))") != _above("_cell", "_met")))
    best = ranked(best.drop("rank").unionByName(measured(asked, bits)))
    return best.join(placed.select("_nth", *rows.columns), "_nth").drop("_nth")


def recommend_batch(
    assigned: DataFrame,
    model: ClusterModel,
    seeds: DataFrame,
    n: int = DEFAULT_TOP,
    metric: str = "euclidean",
    columns: ItemColumns = SONGS,
) -> DataFrame:
    """:func:`recommend` for many seeds at once: seed_id, rank, columns, distance.

    ``seeds`` are rows of the assigned table; of several rows with one id the
    one counts that ``find_by_id`` finds. A seed with invalid features has no
    result, and a row without id is no seed.
    """
    c = columns
    point = z_names(model.stats)
    start = z_names(model.stats, "_seed")
    middle = z_names(model.stats, "_center")
    rows = with_point(valid_items(assigned, model.features), model.stats)
    shown = describe(rows, c).columns
    own = first_per_id(seeds, c)
    valid = with_point(valid_items(own, model.features), model.stats, "_seed")
    centers = centers_table(assigned.sparkSession, model).select(
        F.col("cluster").alias(c.cluster),
        *[F.get("center", F.lit(i)).alias(name) for i, name in enumerate(middle)],
    )
    of_row, of_seed = (F.expr(vectors.center_bound(p, middle, metric)) for p in (point, start))
    bounds = [("_bound", "_seed_bound")]
    if metric == "euclidean":  # no two points are nearer than in one dimension
        bounds += list(zip(point, start, strict=True))
    # The centers are a model: k rows.
    near = rows.select(*shown, c.cluster, *point).join(F.broadcast(centers), c.cluster)
    needed = near.withColumn("_bound", of_row).drop(*middle)
    chosen = valid.select(F.col(c.id).alias("seed_id"), F.col(c.cluster), *start)
    chosen = chosen.join(F.broadcast(centers), c.cluster).withColumn("_seed_bound", of_seed)
    if metric == "euclidean":  # which the centers are no part of
        chosen = chosen.drop(*middle)

    def distance(pairs: DataFrame) -> DataFrame:
        return vectors.with_distance(pairs, point, start, middle, metric)

    ties = _ties(rows, c)
    best = nearest_by_bound(needed, chosen, c.cluster, distance, c.id, point, bounds, n, ties)
    result = describe(best, c, keep=["seed_id", "rank", "distance"])
    return result.withColumn("distance", F.round("distance", 6))
