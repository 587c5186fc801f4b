"""Nearest neighbours by largest inner product, found through a k-means tree.

A tree of k-means centers is fitted on a bounded sample (``TRAIN_ROWS`` rows) and
every row is routed to a leaf. A query walks the tree best bin first: a priority
queue holds the nodes seen so far by their distance, the nearest is opened, and
leaves are visited in the order in which they come out of the queue. How many a
query visits is calibrated: for a bounded sample of the queries the true
neighbours are found among all rows, and visits are widened until the share of
them that lies in the visited leaves reaches ``TARGET``. Where that takes all
leaves, the search is exact.

Inner products are searched as distances: with M the largest length, a row x is
lifted to (x, sqrt(M^2 - |x|^2)) and a query scaled to length M, so that the
nearest lifted row is the one with the largest product. Results carry the product
of the original vectors, added up in the order of the components in double
precision, so that equal vectors have equal scores.

Rows and visiting queries meet per leaf, slice of its rows and slice of the
queries. A leaf with a third of all rows, or one that every query visits, is so
many slices; no task holds more than ``CELL_ROWS`` rows and ``CELL_QUERIES``
queries, about. Of every cell a query keeps its n best; those are ranked by a window.

Handling of odd rows: a vector that is NULL, empty or all zeros, or that has a NULL,
NaN or infinite component, takes no part; nor does one whose length is not the
commonest (of equally common ones the shortest). A row without id is never a query, but
it can be found (last among equals). Rows that repeat an id are queries and candidates
of their own; only the query's own row is no candidate. Queries with fewer
candidates get all of them. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nearkin.llm.common import kept

NEIGHBOURS = 20
TRAIN_ROWS = 20_000
CALIBRATION_QUERIES = 256
TARGET = 0.95
BRANCH = 8
LEAF_ROWS = 4096
MIN_LEVELS, MAX_LEVELS = 2, 4
ROUNDS = 8
SEED = 11
CELL_ROWS = 4096
CELL_QUERIES = 1024

RESULT = "query_id long, rank int, vec_id long, score double"


@dataclass(frozen=True)
class Tree:
    """Nodes in the order in which they were made; node 0 is the root.

    At most 1 + BRANCH + ... + BRANCH ** MAX_LEVELS centers, whatever the data.
    """

    centers: np.ndarray
    children: tuple[tuple[int, ...], ...]
    scale: float
    length: float

    @property
    def leaves(self) -> list[int]:
        return [node for node, below in enumerate(self.children) if not below]

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Rows as points on the sphere."""
        small = vectors / self.scale
        rest = np.sqrt(np.maximum(self.length**2 - np.einsum("ij,ij->i", small, small), 0.0))
        return np.hstack([small, rest[:, None]])

    def routed(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every row: from the root always to the nearest child."""
        points = self.lifted(vectors)
        at = np.zeros(len(points), np.int32)
        for node, below in enumerate(self.children):  # parents come before their children
            here = np.flatnonzero(at == node)
            if below and len(here):
                at[here] = np.asarray(below, np.int32)[nearest(points[here], self.centers[list(below)])]
        return at

    def visits(self, queries: np.ndarray, most: int) -> Iterator[list[int]]:
        """For every query its first ``most`` leaves, best bin first."""
        small = queries / self.scale
        small *= (self.length / np.sqrt(np.einsum("ij,ij->i", small, small)))[:, None]
        points = np.hstack([small, np.zeros((len(small), 1))])
        for gaps in squared(points, self.centers).tolist():
            queue, found = [(0.0, 0)], []
            while queue and len(found) < most:
                _, node = heapq.heappop(queue)
                if self.children[node]:
                    for child in self.children[node]:
                        heapq.heappush(queue, (gaps[child], child))
                else:
                    found.append(node)
            yield found


def squared(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, without the part that is the same for all centers of a point."""
    return np.einsum("ij,ij->i", centers, centers) - 2.0 * (points @ centers.T)


def nearest(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return squared(points, centers).argmin(axis=1)


def _k_means(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Up to ``k`` centers; fewer where there are not so many different points."""
    centers = points[rng.integers(len(points))][None, :]
    gap = np.einsum("ij,ij->i", points - centers[0], points - centers[0])
    while len(centers) < k and gap.max() > 0.0:
        new = points[rng.choice(len(points), p=gap / gap.sum())]
        centers = np.vstack([centers, new])
        gap = np.minimum(gap, np.einsum("ij,ij->i", points - new, points - new))
    for _ in range(ROUNDS):
        own = nearest(points, centers)
        centers = np.stack([points[own == i].mean(axis=0) for i in range(len(centers)) if (own == i).any()])
    return centers


def fit_tree(sample: np.ndarray, levels: int, scale: float, length: float) -> Tree:
    """Centers of centers: every node's share of the sample is clustered anew."""
    start = Tree(np.zeros((1, sample.shape[1] + 1)), ((),), scale, length)
    points, rng = start.lifted(sample), np.random.default_rng(SEED)
    centers, children = [points.mean(axis=0)], [()]
    open_nodes = [(0, points, 0)]
    for node, own, level in open_nodes:  # grows while it is read
        if level == levels or len(own) < 2:
            continue
        below = _k_means(own, BRANCH, rng)
        if len(below) < 2:
            continue
        nearby = nearest(own, below)
        children[node] = tuple(range(len(centers), len(centers) + len(below)))
        for i, center in enumerate(below):
            centers.append(center)
            children.append(())
            open_nodes.append((children[node][i], own[nearby == i], level + 1))
    return Tree(np.stack(centers), tuple(children), scale, length)


def _matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, dimension)


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, v: rows whose vectors are finite and not all zeros."""
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    return rows.filter(F.col("v").isNotNull() & whole & F.exists("v", lambda x: x != 0))


def _measured(rows: DataFrame) -> dict | None:
    """Of the commonest dimension: dimension, number of rows and queries, largest component and length."""
    most = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    sizes = rows.select("v", F.size("v").alias("dimension"), most.alias("most"))
    scaled = sizes.withColumn(
        "root", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / F.col("most")) * (x / F.col("most"))))
    )
    measured = scaled.groupBy("dimension").agg(
        F.count(F.lit(1)).alias("n"), F.max("most").alias("scale"), F.max(F.col("most") * F.col("root")).alias("length")
    )
    found = measured.orderBy(F.desc("n"), "dimension").limit(1).collect()
    return found[0].asDict() if found else None


def _chosen(rows: DataFrame, n: int, most: int) -> DataFrame:
    """About ``most`` of ``n`` rows, never more, chosen by a hash of their number."""
    steps = 1 << 30
    share = min(steps, math.ceil(steps * 1.2 * most / max(n, 1)))
    return rows.filter(F.pmod(F.xxhash64("row"), F.lit(steps)) < share).limit(most)


def grown(rows: DataFrame, found: dict) -> Tree:
    """The tree of a sample of the rows; one task fits it."""
    dimension, scale = found["dimension"], found["scale"]
    length = max(found["length"] / scale, 1e-300)
    levels = MIN_LEVELS
    while levels < MAX_LEVELS and BRANCH**levels * LEAF_ROWS < found["n"]:
        levels += 1

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = [_matrix(batch.column(0), dimension) for batch in batches if len(batch)]
        if matrices:
            tree = fit_tree(np.vstack(matrices), levels, scale, length)
            columns = [tree.centers.tolist(), [list(below) for below in tree.children]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(columns[0])), pa.int32()), pa.array(columns[0], pa.list_(pa.float64())),
                 pa.array(columns[1], pa.list_(pa.int32()))], names=["node", "center", "below"]
            )

    sample = _chosen(rows, found["n"], TRAIN_ROWS).select("v").coalesce(1)
    nodes = sample.mapInArrow(fit, "node int, center array<double>, below array<int>").orderBy("node").collect()
    if not nodes:  # no row happened to be chosen
        return Tree(np.zeros((1, dimension + 1)), ((),), scale, length)
    return Tree(np.array([r["center"] for r in nodes]), tuple(tuple(r["below"]) for r in nodes), scale, length)


def routed(rows: DataFrame, tree: Tree, dimension: int) -> DataFrame:
    """The rows with their leaf."""
    kind = rows.schema["v"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.routed(_matrix(batch.column(2), dimension))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=[*batch.schema.names, "leaf"])

    return rows.mapInArrow(run, f"row long, vec_id long, v {kind}, leaf int")


def _exact(row: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Products, added up in the order of the components."""
    return np.add.accumulate(others * row, axis=1)[:, -1]


def best_of(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, numbers: np.ndarray, ids: np.ndarray, known: np.ndarray, n: int):
    """Per query: the places of its n best rows and their scores, best first.

    ``own`` and ``numbers`` are the row numbers of queries and rows; ``known``
    says which rows have an id. A matrix product finds who may be among the best;
    those within its rounding error of the n-th are scored exactly.
    """
    rough = queries @ rows.T
    longest = np.sqrt(np.einsum("ij,ij->i", rows, rows).max())
    slack = 8.0 * rows.shape[1] * np.finfo("float64").eps * longest * np.sqrt(np.einsum("ij,ij->i", queries, queries))
    take = n + 1  # one of them may be the query itself
    for i, scores in enumerate(rough):
        if len(scores) > take:
            limit = np.partition(scores, len(scores) - take)[len(scores) - take] - slack[i]
            near = np.flatnonzero(~(scores < limit))
        else:
            near = np.arange(len(scores))
        near = near[numbers[near] != own[i]]
        exact = _exact(queries[i], rows[near])
        order = np.lexsort((ids[near], ~known[near], -exact))[:n]
        yield near[order], exact[order]


def _ids(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    known = column.is_valid().to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.is_valid().to_numpy()
    return column.fill_null(0).to_numpy(), known


def _ranked(found: DataFrame, n: int) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def true_neighbours(rows: DataFrame, queries: Sequence[tuple[int, Sequence[float]]], n: int) -> DataFrame:
    """query, vec_id, score, leaf, rank for a bounded list of queries, against all rows."""
    own, matrix = np.array([q[0] for q in queries]), np.array([q[1] for q in queries], "float64")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in own]
        for batch in batches:
            if not len(batch):
                continue
            vectors, leaves = _matrix(batch.column(2), matrix.shape[1]), batch.column(3).to_pylist()
            ids, known = _ids(batch.column(1))
            every = best_of(matrix, own, vectors, batch.column(0).to_numpy(), ids, known, n)
            for i, (places, scores) in enumerate(every):
                new = [(-s, not known[p], int(ids[p]), leaves[p]) for p, s in zip(places, scores.tolist(), strict=True)]
                best[i] = heapq.nsmallest(n, best[i] + new)
        flat = [(int(own[i]), None if b[1] else b[2], -b[0], b[3]) for i, found in enumerate(best) for b in found]
        if flat:
            columns = zip(*flat, strict=True)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32())
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["query", "vec_id", "score", "leaf"])

    found = rows.select("row", "vec_id", "v", "leaf").mapInArrow(run, "query long, vec_id long, score double, leaf int")
    return _ranked(found, n)


def calibrated(rows: DataFrame, queries: DataFrame, n_queries: int, tree: Tree, n: int, target: float) -> int:
    """The fewest leaf visits that find the target share of the sample's neighbours."""
    sample = [(r["row"], r["v"]) for r in _chosen(queries, n_queries, CALIBRATION_QUERIES).collect()]
    every = len(tree.leaves)
    if not sample:
        return every
    orders = tree.visits(np.array([v for _, v in sample], "float64"), every)
    place = {q: {leaf: i for i, leaf in enumerate(order)} for (q, _), order in zip(sample, orders, strict=True)}
    needed = sorted(place[r["query"]][r["leaf"]] + 1 for r in true_neighbours(rows, sample, n).collect())
    return needed[min(len(needed), math.ceil(target * len(needed))) - 1] if needed else every


def _visiting(queries: DataFrame, tree: Tree, dimension: int, most: int) -> DataFrame:
    """query, query_id, q, leaf: a row per query and leaf it visits."""
    kind = queries.schema["v"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.slice(start, 512)
                found = list(tree.visits(_matrix(part.column(2), dimension), most))
                at = pa.array(np.repeat(np.arange(len(part)), [len(f) for f in found]))
                leaf = pa.array([leaf for f in found for leaf in f], pa.int32())
                columns = [part.column(i).take(at) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*columns, leaf], names=["query", "query_id", "q", "leaf"])

    return queries.select("row", "vec_id", "v").mapInArrow(run, f"query long, query_id long, q {kind}, leaf int")


def _searched(rows: DataFrame, visits: DataFrame, n_queries: int, dimension: int, n: int) -> DataFrame:
    """query, query_id, vec_id, score: the n best of every cell for each query there."""
    parts = max(1, math.ceil(n_queries / CELL_QUERIES))
    # One row per leaf, and leaves are bounded by the tree.
    leaves = F.broadcast(rows.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("slices")))
    every_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    dealt = rows.join(leaves, "leaf").select(
        "leaf", F.pmod("row", "slices").cast("int").alias("slice"), every_part, "row", "vec_id", "v"
    )
    every_slice = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
    asked = visits.join(leaves, "leaf").select(
        "leaf", every_slice, F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int").alias("part"), "query", "query_id", "q"
    )
    names = ["query", "query_id", "vec_id", "score"]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table([pa.array([], pa.int64())] * 3 + [pa.array([], pa.float64())], names=names)
        ids, known = _ids(left.column("vec_id"))
        own = right.column("query").to_numpy()
        found = list(best_of(
            _matrix(right.column("q"), dimension), own, _matrix(left.column("v"), dimension),
            left.column("row").to_numpy(), ids, known, n,
        ))
        at = np.repeat(np.arange(len(found)), [len(places) for places, _ in found])
        places = np.concatenate([places for places, _ in found])
        scores = np.concatenate([scores for _, scores in found])
        asking = [right.column(name).take(pa.array(at)).combine_chunks() for name in names[:2]]
        hits = left.column("vec_id").take(pa.array(places)).combine_chunks()
        return pa.table([*asking, hits, pa.array(scores)], names=names)

    cell = ("leaf", "slice", "part")
    schema = "query long, query_id long, vec_id long, score double"
    return dealt.groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInArrow(meet, schema)


def search(
    df: DataFrame, every: int, n: int = NEIGHBOURS, vec_id: str = "vec_id", vector: str = "embedding", target: float = TARGET
) -> DataFrame:
    """query_id, rank, vec_id, score for every row whose id is divisible by ``every``."""
    numbered = usable(df, vec_id, vector)
    found = _measured(numbered)
    if found is None:
        return df.sparkSession.createDataFrame([], RESULT)
    alike = numbered.filter(F.size("v") == found["dimension"])
    rows = alike.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v")
    tree = grown(rows, found)
    placed = kept(routed(rows, tree, found["dimension"]))
    queries = placed.filter(F.col("vec_id") % every == 0)
    n_queries = queries.count()
    most = calibrated(placed, queries, n_queries, tree, n, target)
    visits = _visiting(queries, tree, found["dimension"], most)
    best = _ranked(_searched(placed, visits, n_queries, found["dimension"], n), n)
    return best.select("query_id", "rank", "vec_id", "score")
