"""Operator 10: documents linked by the Jaccard similarity of their word n-grams.

Universe-partition pigeonhole. Sets are banded by size. Within a band the hash
space of shingles is cut into m segments, and a set falls into its subsets per
segment. A set of l shingles and a smaller one that reach the threshold t differ
in at most H = 2 l (1 - t) / (1 + t) shingles, so among any H + 1 segments they
agree on one. Every set is indexed with all its segment subsets (in its own band,
and in the band below where partners of that size exist); it probes with H + 1
of them. Which ones is decided by cost: the frequencies of all subsets are
counted over the corpus first, and the rarest are taken; a subset that nobody
else has costs nothing, and empty ones are never used. Where a set has too few
segments that are not empty, the lowest K segments of the band are indexed with
their one-deletion neighbourhoods as well, which finds them up to one difference
and so counts twice; K is the least number that serves every set of the band.
Bands of small sets, and a band where even that fails for some set, have one
segment per shingle.

Candidates are verified on the whole sets. Sets that are equal are one class from
the start. Where a subset is shared by few sets, they are paired; where by many,
each with the first of them, and the members are kept aside: as long as such a
group still lies in several components, sets of different components are compared
by their distance in the order of size, in steps that grow. So a large group of
near copies costs about one pair each, and no link between components is lost.
What is compared first are sketches, a bit string per set as long as the set, of
which every shingle flips one bit: two sets differ in at least as many shingles as
their sketches in bits, so that unlike sets are told apart there for certain, and
only what is left becomes a pair. In the first step every set is paired with the
likest of the smaller ones alone, which makes one tree of near copies. A large group meets in blocks of ``TOGETHER``
members, a block of it with itself or with another.

Texts are dealt into groups by document id; subsets cross the cluster as packed,
sorted keys, distinct per group, to buckets of the key space.

Defined results: a NULL or empty text has no shingles and its own component; a
text with fewer words than a shingle is one shingle; rows with one id share a
component, that of the one with the least set; a NULL id takes part in no link
and has a NULL component; an empty table gives an empty result; other columns are
ignored. Shingles are compared by 64-bit hashes of their words' hashes, which for
long words include a second one modulo two primes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nearkin.llm import textarrays as ta
from nearkin.llm.common import held, kept, shuffles, slices, utf8
from nearkin.llm.repeats import edges

WORDS, PERCENT = 5, 75
GROUP_BYTES = 8 << 20
SLICE_BYTES = 2 << 20
KEYS_PER_BUCKET = 2_000_000
SPREAD = 2
SMALL_BAND = 5
BANDS = 48
IMPOSSIBLE = 2**31 - 1
SMALL_GROUP = 4
FURTHER = 64
TOGETHER = 10_000
PACKED_MEMBERS = 4096
JUDGED_AT_ONCE = 500_000
GATHERED_WORDS = 2_000_000

_SEEDS = np.random.default_rng(77).integers(1, 2**63, BANDS + 1, np.uint64)
_ELEMENT, _SEGMENT, _DELETED, _SKETCH = (
    np.uint64(x) for x in (0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x632BE59BD9B4E019, 0x2545F4914F6CDD1D)
)


# --- sets -------------------------------------------------------------------


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, and their n + 1 offsets."""
    data = ta.lowered(data)
    starts, ends, bounds = ta.words(data, offsets)
    rolling = ta.Rolling(ta.safe_word_hashes(data, starts, ends))
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), np.maximum(sizes - n + 1, 0))
    counts = np.maximum(sizes - n + 1, 0)
    places = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[owner]
    short = np.flatnonzero((sizes > 0) & (sizes < n))
    owner = np.concatenate([owner, short])
    found = np.concatenate(
        [rolling.windows(places, places + n), rolling.windows(bounds[short], bounds[short + 1])]
    )
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    new = np.ones(len(found), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
    owner, found = owner[new], found[new]
    return found, np.searchsorted(owner, np.arange(len(sizes) + 1))


def signatures(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers per set that do not depend on an order."""
    sums = np.zeros((2, len(sets) + 1), np.uint64)
    np.cumsum(ta.mixed(sets * _ELEMENT), out=sums[0, 1:])
    np.cumsum(ta.mixed(sets ^ _SEGMENT), out=sums[1, 1:])
    a, b = sums[:, bounds[1:]] - sums[:, bounds[:-1]]
    return a.view(np.int64), b.view(np.int64)


def sketches(sets: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Per set a string of bits, more than it has shingles and 64 at least: whether an odd number of them falls on each."""
    sizes = np.diff(bounds)
    bits = np.int64(1) << np.maximum(np.frexp(sizes.astype(np.float64))[1], 6).astype(np.int64)
    ends = np.cumsum(bits)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = (ta.mixed(sets ^ _SKETCH) & (bits - 1).astype(np.uint64)[owner]).astype(np.int64) + (ends - bits)[owner]
    odd = np.bincount(place, minlength=int(bits.sum())) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [packed[(e - b) >> 3 : e >> 3] for e, b in zip(ends.tolist(), bits.tolist(), strict=True)]


class Sketches:
    """The sketches of some nodes, by place among them; longer ones fold to the length of shorter ones."""

    def __init__(self, nodes: np.ndarray, known: pa.Table):
        packed = dict(zip(known["known"].to_pylist(), known["sketch"].to_pylist(), strict=True))
        held = [packed[node] for node in nodes.tolist()]
        self.length = np.fromiter(map(len, held), np.int64, len(held)) >> 3
        self.row = np.zeros(len(held), np.int64)
        self.words = {}
        for length in np.unique(self.length).tolist():
            own = np.flatnonzero(self.length == length)
            self.row[own] = np.arange(len(own))
            joined = b"".join(held[at] for at in own.tolist())
            self.words[length] = np.frombuffer(joined, "<u8").reshape(len(own), length)

    def _folded(self, places: np.ndarray, own: int, length: int) -> np.ndarray:
        found = self.words[own][self.row[places]]
        while found.shape[1] > length:
            half = found.shape[1] // 2
            found = found[:, :half] ^ found[:, half:]
        return found

    def differences(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The number of bits in which the sketches of each pair of places differ."""
        found = np.zeros(len(x), np.int64)
        lengths = np.stack([self.length[x], self.length[y]])
        for a, b in np.unique(lengths, axis=1).T.tolist():
            pairs = np.flatnonzero((lengths[0] == a) & (lengths[1] == b))
            at_once = max(1, GATHERED_WORDS // max(a, b))
            for start in range(0, len(pairs), at_once):
                some = pairs[start : start + at_once]
                unlike = self._folded(x[some], a, min(a, b)) ^ self._folded(y[some], b, min(a, b))
                found[some] = np.bitwise_count(unlike).sum(axis=1, dtype=np.int64)
        return found


# --- segments ---------------------------------------------------------------


def allowed(size: np.ndarray, percent: int) -> np.ndarray:
    """The most shingles by which a set of this size and a smaller partner differ."""
    return 2 * size * (100 - percent) // (100 + percent)


def memberships(sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(set, band): the band of its size, and the one below if partners lie there."""
    band = np.zeros(len(sizes), np.int64)
    some = sizes > 0
    band[some] = np.frexp(sizes[some].astype(np.float64))[1] - 1
    own = np.flatnonzero(some)
    low = np.flatnonzero(some & (band > 0) & (sizes * percent <= 100 * ((1 << band) - 1)))
    sets, bands = np.concatenate([own, low]), np.concatenate([band[own], band[low] - 1])
    order = np.argsort(sets, kind="stable")
    return sets[order], bands[order]


@dataclass(frozen=True)
class Plan:
    """Per band the number of segments (0: one per shingle) and of those with neighbourhoods."""

    percent: int
    segments: tuple[int, ...]
    deleted: tuple[int, ...]

    @staticmethod
    def first(percent: int) -> Plan:
        most = [int(allowed(np.array([2 << b]), percent)[0]) + 1 for b in range(BANDS)]
        segments = tuple(0 if b < SMALL_BAND else min(SPREAD * most[b], 1 << 31) for b in range(BANDS))
        return Plan(percent, segments, (0,) * BANDS)

    def served(self, needs: dict[int, int]) -> Plan:
        """With what the bands were found to need."""
        segments = tuple(0 if needs.get(b, 0) == IMPOSSIBLE else m for b, m in enumerate(self.segments))
        deleted = tuple(needs.get(b, 0) if m else 0 for b, m in enumerate(segments))
        return Plan(self.percent, segments, deleted)


@dataclass
class Parts:
    """The segment subsets of a slice of sets, ordered by membership and segment."""

    sets: np.ndarray  # of a membership
    bands: np.ndarray
    member: np.ndarray  # of a subset: its membership
    segment: np.ndarray
    size: np.ndarray
    key: np.ndarray
    deleted_of: np.ndarray  # of a neighbour: its subset
    deleted_key: np.ndarray


def parts(found: np.ndarray, bounds: np.ndarray, plan: Plan) -> Parts:
    sizes = np.diff(bounds)
    sets, bands = memberships(sizes, plan.percent)
    n = sizes[sets]
    member = np.repeat(np.arange(len(sets)), n)
    nth = np.arange(len(member)) - np.repeat(np.cumsum(n) - n, n)
    element = found[bounds[sets][member] + nth]
    band = bands[member]
    m = np.array(plan.segments, np.uint64)[band]
    spread = ta.mixed(element ^ _SEEDS[band])
    segment = np.where(m > 0, ((spread >> np.uint64(32)) * m) >> np.uint64(32), nth.astype(np.uint64))
    order = np.argsort((member.astype(np.uint64) << np.uint64(32)) | segment, kind="stable")
    member, segment, element = member[order], segment[order], ta.mixed(element[order] + _ELEMENT)
    new = np.ones(len(member), bool)
    new[1:] = (member[1:] != member[:-1]) | (segment[1:] != segment[:-1])
    first = np.flatnonzero(new)
    size = np.diff(first, append=len(member))
    total = np.add.reduceat(element, first) if len(first) else element
    own, segment_of = member[first], segment[first]
    # A shingle that is its own segment is known by itself, not by its place.
    named = np.where(m[order][first] > 0, segment_of, np.uint64(0)) if len(first) else segment_of
    place = ta.mixed(named * _SEGMENT + bands[own].astype(np.uint64) + np.uint64(1))
    near = segment_of < np.array(plan.deleted, np.uint64)[bands[own]]
    subset = np.repeat(np.arange(len(first)), size)
    single = np.flatnonzero(near[subset] & (size[subset] > 1))
    whole = np.flatnonzero(near)
    deleted_of = np.concatenate([whole, subset[single]])
    rest = np.concatenate([total[whole], total[subset[single]] - element[single]])
    return Parts(
        sets, bands, own, segment_of, size, ta.mixed(total ^ place),
        deleted_of, ta.mixed(rest ^ place[deleted_of] ^ _DELETED),
    )


def needed_neighbourhoods(p: Parts, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Per membership the number of low segments that must have neighbourhoods."""
    needs = allowed(sizes[p.sets], percent) + 1
    have = np.bincount(p.member, minlength=len(p.sets))
    result = np.zeros(len(p.sets), np.int64)
    for member in np.flatnonzero(have < needs).tolist():
        usable = p.segment[(p.member == member) & (p.size > 1)]
        lack = int(needs[member] - have[member])
        result[member] = int(usable[lack - 1]) + 1 if len(usable) >= lack else IMPOSSIBLE
    return result


def chosen(p: Parts, sizes: np.ndarray, percent: int, cost: np.ndarray, deleted_cost: np.ndarray):
    """Which subsets and which neighbourhoods each set probes with: the cheapest H + 1."""
    around = np.zeros(len(p.key), np.int64)
    np.add.at(around, p.deleted_of, np.left_shift(1, deleted_cost))
    extra = np.zeros(len(p.key), bool)
    extra[p.deleted_of] = True
    extra = np.flatnonzero(extra & (p.size > 1))
    member = np.concatenate([p.member, p.member[extra]])
    price = np.concatenate([np.left_shift(1, cost), around[extra]])
    order = np.lexsort((price, member))
    counts = np.bincount(member, minlength=len(p.sets))
    rank = np.arange(len(member)) - np.repeat(np.cumsum(counts) - counts, counts)
    taken = np.zeros(len(member), bool)
    taken[order] = rank < (allowed(sizes[p.sets], percent) + 1)[member[order]]
    around_taken = np.zeros(len(p.key), bool)
    around_taken[extra] = taken[len(p.key) :]
    return taken[: len(p.key)], around_taken[p.deleted_of]


# --- groups of texts --------------------------------------------------------


def _sliced(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop, data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


def group_sets(docs: pa.Table, wanted: np.ndarray, words: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, sets, bounds) of the wanted documents of a group, slice by slice.

    Of rows with one id the one with the least (size, signature) stands for it.
    """
    ids = docs["doc_id"].to_numpy()
    rows = np.flatnonzero(np.isin(ids, wanted))
    rows = rows[np.argsort(ids[rows], kind="stable")]
    own = ids[rows]
    if len(np.unique(own)) < len(own):
        found, bounds = shingle_sets(*utf8(docs["text"].combine_chunks().take(pa.array(rows))), words)
        a, b = signatures(found, bounds)
        order = np.lexsort((b, a, np.diff(bounds), own))
        first = order[np.diff(own[order], prepend=own[order[0]] - 1) != 0]
        rows, own = rows[first], own[first]
    data, offsets = utf8(docs["text"].combine_chunks().take(pa.array(rows)))
    for start, stop, part, at in _sliced(data, offsets):
        yield own[start:stop], *shingle_sets(part, at, words)


def _cells(keys: np.ndarray, n_buckets: int) -> list[tuple[int, int, int]]:
    cuts = np.searchsorted(keys, edges(n_buckets, 64))
    cuts[-1] = len(keys)
    return [(b, int(x), int(y)) for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if y > x]


def _distinct(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    first = np.flatnonzero(np.diff(every, prepend=~every[:1]) != 0)
    return every[first], np.diff(first, append=len(every))


def _count_buckets(cells: pa.Table) -> pa.Table:
    """Per key of each group the binary logarithm of its frequency in the corpus, 0 if it is alone."""
    keys = [ta.unpack_sorted(k) for k in cells["keys"].to_pylist()]
    every = np.concatenate(keys)
    counts = np.concatenate([np.frombuffer(c, np.uint8) for c in cells["counts"].to_pylist()]).astype(np.int64)
    order = np.argsort(every, kind="stable")
    first = np.flatnonzero(np.diff(every[order], prepend=~every[order[:1]]) != 0)
    total = np.add.reduceat(counts[order], first)
    level = np.ceil(np.log2(total)).astype(np.uint8)
    levels = np.empty(len(every), np.uint8)
    levels[order] = np.repeat(level, np.diff(first, append=len(every)))
    ends = np.cumsum([len(k) for k in keys])
    return pa.table(
        {
            "g": cells["g"],
            "bucket": cells["bucket"],
            "levels": pa.array([levels[e - len(k) : e].tobytes() for e, k in zip(ends, keys, strict=True)], pa.binary()),
        }
    )


_PAIRS = "x long, y long, name binary, first long, members binary"


def _packed_group(nodes: np.ndarray, sizes: np.ndarray, flags: np.ndarray) -> Iterator[tuple[bytes, int, bytes]]:
    """(name, place of the first, members) of slices of a group; equal groups have equal names."""
    name = hashlib.blake2b(nodes.tobytes() + flags.tobytes(), digest_size=16).digest()
    for first in range(0, len(nodes), PACKED_MEMBERS):
        some = slice(first, first + PACKED_MEMBERS)
        yield name, first, nodes[some].tobytes() + sizes[some].tobytes() + flags[some].tobytes()


def _pair_table(x: np.ndarray, y: np.ndarray, groups: list[tuple[bytes, int, bytes]]) -> pa.Table:
    n, k = len(x), len(groups)
    names, firsts, members = zip(*groups, strict=True) if groups else ((), (), ())
    return pa.table(
        {
            "x": pa.concat_arrays([pa.array(x, pa.int64()), pa.nulls(k, pa.int64())]),
            "y": pa.concat_arrays([pa.array(y, pa.int64()), pa.nulls(k, pa.int64())]),
            "name": pa.array([None] * n + list(names), pa.binary()),
            "first": pa.array([None] * n + list(firsts), pa.int64()),
            "members": pa.array([None] * n + list(members), pa.binary()),
        }
    )


def _fits(size_x, size_y, probe_x, probe_y, percent: int) -> np.ndarray:
    """Sizes that allow a link, and the larger of the two probed."""
    small, large = np.minimum(size_x, size_y), np.maximum(size_x, size_y)
    probed = ((size_x >= size_y) & probe_x) | ((size_y >= size_x) & probe_y)
    return (small * 100 >= large * percent) & probed


def _match_buckets(cells: pa.Table, percent: int) -> pa.Table:
    """Candidate pairs of the sets that share a subset, and larger groups as a whole."""
    key, doc, size, probe = [], [], [], []
    for row in cells.select(["keys", "refs", "ids", "sizes"]).to_pylist():
        refs = np.frombuffer(row["refs"], np.uint32)
        at = refs >> 1
        key.append(ta.unpack_sorted(row["keys"]))
        doc.append(np.frombuffer(row["ids"], np.int64)[at])
        size.append(np.frombuffer(row["sizes"], np.int64)[at])
        probe.append((refs & 1).astype(bool))
    key, doc, size, probe = (np.concatenate(v) for v in (key, doc, size, probe))
    order = np.lexsort((doc, key))
    key, doc, size, probe = key[order], doc[order], size[order], probe[order]
    # A set may have a key twice (as itself and as a neighbour): it probes if either does.
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] == key[:-1]) & (doc[1:] == doc[:-1])
    first = np.flatnonzero(~same)
    probe = np.logical_or.reduceat(probe, first) if len(first) else probe
    key, doc, size = key[first], doc[first], size[first]
    start = np.flatnonzero(np.diff(key, prepend=~key[:1]) != 0)
    count = np.diff(start, append=len(key))
    # Everyone with the first of the group; in a small group everyone with everyone.
    head = np.repeat(start, count)
    some = np.flatnonzero((head != np.arange(len(key))) & _fits(size[head], size, probe[head], probe, percent))
    xs, ys = [doc[head[some]]], [doc[some]]
    few = np.repeat(count, count) <= SMALL_GROUP
    for step in range(1, SMALL_GROUP - 1):
        x, y = slice(None, -step), slice(step, None)
        wanted = few[x] & (key[x] == key[y]) & _fits(size[x], size[y], probe[x], probe[y], percent)
        xs.append(doc[x][wanted])
        ys.append(doc[y][wanted])
    x, y = np.concatenate(xs), np.concatenate(ys)
    pairs = np.unique(np.stack([x, y]), axis=1) if len(x) else np.zeros((2, 0), np.int64)
    groups: dict[bytes, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    probing = np.logical_or.reduceat(probe, start) if len(start) else np.zeros(0, bool)
    for at in np.flatnonzero((count > SMALL_GROUP) & probing).tolist():
        members = slice(start[at], start[at] + count[at])
        by_size = np.lexsort((doc[members], size[members]))
        nodes, flags = doc[members][by_size], probe[members][by_size]
        same = groups.get(nodes.tobytes())
        groups[nodes.tobytes()] = nodes, size[members][by_size], flags if same is None else flags | same[2]
    return _pair_table(pairs[0], pairs[1], [row for group in groups.values() for row in _packed_group(*group)])


def _verify(rows: pa.Table, percent: int) -> pa.Table:
    """The pairs of a bucket whose sets reach the threshold. A row without ``y`` is the set of x."""
    own, pairs = {}, []
    for x, y, packed in zip(*(rows[n].to_pylist() for n in ("x", "y", "packed")), strict=True):
        if y is None:
            own[x] = ta.unpack_sorted(packed)
        else:
            pairs.append((x, y, packed))
    found = []
    for x, y, packed in pairs:
        one, other = own[x], ta.unpack_sorted(packed)
        common = len(np.intersect1d(one, other, assume_unique=True))
        if 100 * common >= percent * (len(one) + len(other) - common):
            found.append((x, y))
    return pa.table(
        {"x": pa.array([x for x, _ in found], pa.int64()), "y": pa.array([y for _, y in found], pa.int64())}
    )


# --- components -------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """node, component (its least node) of every node of the links (x, y).

    Alternating large and small stars: each round hangs neighbours on the least
    one, until all edges are stars around it.
    """
    oriented = links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
    edges_now = kept(oriented.filter("u <> v").distinct())
    while not _are_stars(edges_now):
        both = edges_now.unionByName(edges_now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges_now = kept(small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
    return edges_now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _are_stars(edges_now: DataFrame) -> bool:
    """True if every node is a center or hangs on exactly one center."""
    ends = edges_now.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges_now.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    )
    roles = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return roles.filter("hangs > 1 OR (hangs = 1 AND holds = 1)").isEmpty()


def joined_components(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, component) after further links: only components are joined."""
    x = found.select(F.col("node").alias("x"), F.col("component").alias("cx"))
    y = found.select(F.col("node").alias("y"), F.col("component").alias("cy"))
    between = links.join(x, "x", "left").join(y, "y", "left")
    between = between.select(F.coalesce("cx", "x").alias("x"), F.coalesce("cy", "y").alias("y"))
    moved = components(between)
    new = moved.select(F.col("node").alias("component"), F.col("component").alias("under"))
    renamed = found.join(new, "component", "left").select("node", F.coalesce("under", "component").alias("component"))
    return kept(renamed.unionByName(moved))


# --- the join ---------------------------------------------------------------


def _text_sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n, a, b, n_bytes, and what its bands need, of every text."""
    plan = Plan.first(percent)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("sets", lambda: None)
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            found, bounds = shingle_sets(data, offsets, words)
            sizes = np.diff(bounds)
            a, b = signatures(found, bounds)
            p = parts(found, bounds, plan)
            needs = needed_neighbourhoods(p, sizes, percent)
            per_text = [[] for _ in range(len(batch))]
            for at in np.flatnonzero(needs).tolist():
                per_text[p.sets[at]].append({"band": int(p.bands[at]), "k": int(needs[at])})
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(a), pa.array(b),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(per_text, pa.list_(pa.struct([("band", pa.int32()), ("k", pa.int64())]))),
                ],
                names=["doc_id", "n", "a", "b", "n_bytes", "needs"],
            )

    schema = "doc_id long, n long, a long, b long, n_bytes long, needs array<struct<band: int, k: long>>"
    return docs.mapInArrow(run, schema)


def linked(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = kept(_text_sets(rows, words, percent))
    total = sets.agg(F.sum("n_bytes")).first()[0] or 0
    n_groups = max(shuffles(spark), -(-total // GROUP_BYTES))
    n_buckets = max(min(n_groups, shuffles(spark)), int(total * 0.12) // KEYS_PER_BUCKET)
    needs = sets.select(F.inline("needs")).groupBy("band").agg(F.max("k").alias("k"))
    plan = Plan.first(percent).served({r["band"]: r["k"] for r in needs.collect()})

    nodes = sets.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct("n", "a", "b")).alias("own"))
    nodes = nodes.select("doc_id", "own.*")
    classes = nodes.filter("n > 0").groupBy("n", "a", "b").agg(F.min("doc_id").alias("rep"))
    members = kept(nodes.join(classes, ["n", "a", "b"], "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep"), "n"))

    g = F.pmod(F.xxhash64("doc_id"), F.lit(n_groups)).cast("int").alias("g")
    grouped = rows.filter("doc_id IS NOT NULL").select(g, "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    wanted = members.filter("doc_id = rep AND n > 0").select(g, "doc_id")
    ids = kept(wanted.groupBy("g").applyInArrow(_pack_ids, "g int, bucket int, levels binary"))

    def with_replies(replies: DataFrame, work, schema: str) -> DataFrame:
        return grouped.groupBy("g").cogroup(replies.groupBy("g")).applyInArrow(work, schema)

    def send_keys(docs: pa.Table, replies: pa.Table) -> pa.Table:
        own = _own_ids(replies)
        keys = []
        if len(docs) and len(own):
            for _, found, bounds in group_sets(docs, own, words):
                p = parts(found, bounds, plan)
                keys += [p.key, p.deleted_key]
        every, counts = _distinct(keys)
        cells = _cells(every, n_buckets)
        return pa.table(
            {
                "bucket": pa.array([b for b, _, _ in cells], pa.int32()),
                "g": pa.array([docs["g"][0].as_py()] * len(cells) if len(docs) else [], pa.int32()),
                "keys": pa.array([ta.pack_sorted(every[x:y]) for _, x, y in cells], pa.binary()),
                "counts": pa.array(
                    [np.minimum(counts[x:y], 255).astype(np.uint8).tobytes() for _, x, y in cells], pa.binary()
                ),
            }
        )

    def send_sets(docs: pa.Table, replies: pa.Table) -> pa.Table:
        own = _own_ids(replies)
        held, keys = [], []
        if len(docs) and len(own):
            for doc_ids, found, bounds in group_sets(docs, own, words):
                p = parts(found, bounds, plan)
                held.append((doc_ids, np.diff(bounds), p))
                keys += [p.key, p.deleted_key]
        every, _ = _distinct(keys)
        levels = np.zeros(len(every), np.uint8)
        known = {r["bucket"]: r["levels"] for r in replies.to_pylist() if r["bucket"] >= 0}
        for b, x, y in _cells(every, n_buckets):
            levels[x:y] = np.frombuffer(known[b], np.uint8)
        key, ref, doc, size, base = [], [], [], [], 0
        for doc_ids, sizes, p in held:
            cost = levels[np.searchsorted(every, p.key)].astype(np.int64)
            around = levels[np.searchsorted(every, p.deleted_key)].astype(np.int64)
            probe, probe_around = chosen(p, sizes, percent, cost, around)
            for k, level, flag, member in (
                (p.key, cost, probe, p.member),
                (p.deleted_key, around, probe_around, p.member[p.deleted_of]),
            ):
                shared = level > 0
                key.append(k[shared])
                ref.append(((p.sets[member[shared]] + base) << 1) | flag[shared])
            doc.append(doc_ids)
            size.append(sizes)
            base += len(doc_ids)
        if not key:
            return pa.table({n: pa.array([], t) for n, t in _SETS_TYPES})
        key, ref, doc, size = (np.concatenate(v) for v in (key, ref, doc, size))
        order = np.argsort(key, kind="stable")
        key, ref = key[order], ref[order]
        out = {n: [] for n, _ in _SETS_TYPES}
        for b, x, y in _cells(key, n_buckets):
            used, at = np.unique(ref[x:y] >> 1, return_inverse=True)
            out["bucket"].append(b)
            out["keys"].append(ta.pack_sorted(key[x:y]))
            out["refs"].append(((at << 1) | (ref[x:y] & 1)).astype("<u4").tobytes())
            out["ids"].append(doc[used].astype("<i8").tobytes())
            out["sizes"].append(size[used].astype("<i8").tobytes())
        return pa.table({n: pa.array(out[n], t) for n, t in _SETS_TYPES})

    sent = with_replies(ids, send_keys, "bucket int, g int, keys binary, counts binary")
    levels = kept(sent.groupBy("bucket").applyInArrow(_count_buckets, "g int, bucket int, levels binary"))
    sent = with_replies(ids.unionByName(levels), send_sets, "bucket int, keys binary, refs binary, ids binary, sizes binary")
    matched = kept(sent.groupBy("bucket").applyInArrow(lambda t: _match_buckets(t, percent), _PAIRS))

    pairs = matched.filter("x IS NOT NULL").select("x", "y").distinct()
    groups = kept(_unpacked_groups(matched.filter("members IS NOT NULL").select("name", "first", "members").distinct()))

    def pack_sets(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        ids, packed, sketched = [], [], []
        if len(docs) and len(wanted):
            for doc_ids, found, bounds in group_sets(docs, wanted["doc_id"].to_numpy(), words):
                ids += doc_ids.tolist()
                packed += [ta.pack_sorted(found[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                sketched += sketches(found, bounds)
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "packed": pa.array(packed, pa.binary()),
                "sketch": pa.array(sketched, pa.binary()),
            }
        )

    # The sets of all documents that share a subset with another, written once.
    involved = pairs.select(F.explode(F.array("x", "y")).alias("doc_id")).unionByName(
        groups.select(F.col("node").alias("doc_id"))
    )
    involved = involved.distinct().select(g, "doc_id")
    found_sets = grouped.groupBy("g").cogroup(involved.groupBy("g"))
    packed_sets = kept(found_sets.applyInArrow(pack_sets, "doc_id long, packed binary, sketch binary"))

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs (x, y) that are links; the sets travel, x's once per bucket of pairs."""
        dealt = pairs.withColumn("bucket", F.pmod(F.xxhash64("y"), F.lit(4 * n_buckets)))
        asked = dealt.select(F.col("x").alias("doc_id"), "x", F.lit(None).cast("long").alias("y"), "bucket").distinct()
        asked = asked.unionByName(dealt.select(F.col("y").alias("doc_id"), "x", "y", "bucket"))
        bucketed = packed_sets.join(asked, "doc_id").select("bucket", "x", "y", "packed")
        return bucketed.groupBy("bucket").applyInArrow(lambda t: _verify(t, percent), "x long, y long")

    found = components(verified(pairs))
    groups = _merged(groups, found)
    sketched = packed_sets.select(F.col("doc_id").alias("node"), "sketch")
    step, every = 1, False
    while True:
        groups = _opened(groups, found, step)
        if groups.isEmpty():
            break
        pairs = kept(_further_pairs(groups, sketched, step, percent, every))
        step, every = (step * FURTHER if every else step), True
        if not pairs.isEmpty():
            found = joined_components(found, verified(pairs))

    placed = members.join(found, members["rep"] == found["node"], "left")
    placed = placed.select("doc_id", F.coalesce("component", "rep").alias("component_id"))
    return sets.select("doc_id", F.col("n").alias("n_shingles")).join(placed, "doc_id", "left")


_SETS_TYPES = (
    ("bucket", pa.int32()), ("keys", pa.binary()), ("refs", pa.binary()), ("ids", pa.binary()), ("sizes", pa.binary())
)


def _pack_ids(rows: pa.Table) -> pa.Table:
    ids = rows["doc_id"].to_numpy().astype("<i8").tobytes()
    return pa.table(
        {
            "g": pa.array([rows["g"][0].as_py()], pa.int32()),
            "bucket": pa.array([-1], pa.int32()),
            "levels": pa.array([ids], pa.binary()),
        }
    )


def _own_ids(replies: pa.Table) -> np.ndarray:
    for row in replies.to_pylist():
        if row["bucket"] == -1:
            return np.frombuffer(row["levels"], np.int64)
    return np.zeros(0, np.int64)


_MEMBER = ("name", "at", "node", "size", "probe")


def _opened(groups: DataFrame, found: DataFrame, step: int) -> DataFrame:
    """The groups that lie in several components and reach further than ``step``; to every member
    its component, the group's least (``a``) and largest (``main``), its number of members, and
    into how many cells more than one the groups around that least component are dealt."""
    placed = groups.select(*_MEMBER).join(found, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    counted = placed.groupBy("name", "component").agg(F.count("*").alias("m"))
    spread = counted.groupBy("name").agg(
        F.min("component").alias("a"),
        F.max("component").alias("b"),
        F.sum("m").alias("n"),
        F.max_by("component", F.struct("m", "component")).alias("main"),
    )
    several = spread.filter(f"a <> b AND n > {step}").drop("b")
    more = several.groupBy("a").agg((F.sum("n") / TOGETHER).cast("long").alias("more"))
    return kept(placed.join(several.join(more, "a"), "name"))


def _merged(groups: DataFrame, found: DataFrame) -> DataFrame:
    """The groups that lie in several components, those around one component as a single one
    where that has no more pairs than they have: as they share members, each would make
    the same pairs. What share no subset and so meet in vain is told apart by sketches."""
    opened = _opened(groups, found, 1)
    apart = opened.select("a", "name", F.col("n").cast("double").alias("n")).distinct()
    apart = apart.groupBy("a").agg(F.sum(F.col("n") * F.col("n")).alias("pairs"), F.count("*").alias("names"))
    together = opened.select("a", "node").distinct().groupBy("a").agg(F.count("*").cast("double").alias("m"))
    alike = kept(apart.join(together, "a").filter("names > 1 AND m * m <= pairs").select("a"))
    members = opened.join(alike, "a").groupBy("a", "node").agg(F.max("size").alias("size"), F.max("probe").alias("probe"))
    at = F.row_number().over(W.partitionBy("a").orderBy("size", "node")) - 1
    # Longer than the digests that the other groups have as names.
    name = F.encode(F.concat(F.lit("all around component "), F.col("a").cast("string")), "UTF-8")
    one = members.select(name.alias("name"), at.cast("long").alias("at"), "node", "size", "probe")
    return kept(opened.join(alike, "a", "left_anti").select(*_MEMBER).unionByName(one))


def _further_pairs(groups: DataFrame, sketched: DataFrame, step: int, percent: int, every: bool) -> DataFrame:
    """The pairs (x, y) of different components that are ``step`` to ``FURTHER * step - 1`` places
    apart in a group, and whose sketches do not rule out a link; unless ``every`` is wanted, of
    every member's pairs with earlier ones (by size, then id) only that with the likest sketch.

    Groups around one component have most of their members in common: they meet in a
    cell, or in several if they are many, so that a pair is made once and not per group.
    A group larger than a cell is cut into blocks, and each pair of blocks is a cell.
    """
    block, last = (F.floor(x / TOGETHER) for x in (F.col("at"), F.col("n") - 1))
    far = FURTHER * step
    reach = (far - 2) // TOGETHER + 1
    blocks = F.sequence(F.greatest(block - reach, F.lit(0)), F.least(block + reach, last))
    name = F.xxhash64("name")
    part = F.when(F.col("n") > TOGETHER, name).otherwise(F.pmod(name, F.col("more") + 1))
    met = groups.select("a", part.alias("part"), *_MEMBER, "component", "main", F.explode(blocks).alias("other"))
    met = met.withColumns({"hi": F.greatest(block, "other"), "lo": F.least(block, "other")})
    met = met.filter((F.col("hi") - F.col("lo") + 1) * TOGETHER > step)
    cell = ["a", "part", "hi", "lo"]
    # Under names of their own, as both sides come from one table.
    theirs = [f"{c}_of" for c in cell]
    known = met.select(*(F.col(c).alias(t) for c, t in zip(cell, theirs, strict=True)), F.col("node").alias("known"))
    known = known.distinct().join(sketched.withColumnRenamed("node", "known"), "known")
    cells = met.select(*cell, *_MEMBER, "component", "main", block.alias("block"))

    def pair(rows: pa.Table, known: pa.Table) -> pa.Table:
        if len(rows) == 0:
            return pa.table({"x": pa.array([], pa.int64()), "y": pa.array([], pa.int64())})
        group = rows["name"].combine_chunks().dictionary_encode().indices.to_numpy()
        order = np.lexsort((rows["at"].to_numpy(), group))
        group = group[order]
        at, node, component, main, size, probe, block = (
            rows[n].to_numpy()[order] for n in ("at", "node", "component", "main", "size", "probe", "block")
        )
        nodes, place = np.unique(node, return_inverse=True)
        size_of = np.zeros(len(nodes), np.int64)
        size_of[place] = size
        sketch = Sketches(nodes, known)
        bounds = np.append(np.flatnonzero(np.diff(group, prepend=-1) != 0), len(group))
        made, like = [np.zeros(0, np.int64)], []
        least, likest = np.full(len(nodes), np.iinfo(np.int64).max), np.full(len(nodes), -1)

        def judge() -> None:
            pairs = np.unique(np.concatenate(made))
            x, y = pairs // len(nodes), pairs % len(nodes)
            differ = sketch.differences(x, y)
            some = differ * (100 + percent) <= (size_of[x] + size_of[y]) * (100 - percent)
            pairs, x, y, differ = pairs[some], x[some], y[some], differ[some]
            if not every and len(pairs):
                later = np.where((size_of[x] > size_of[y]) | ((size_of[x] == size_of[y]) & (x > y)), x, y)
                by_member = np.lexsort((differ, later))
                later = later[by_member]
                pairs, differ, later = (
                    v[np.diff(later, prepend=-1) != 0] for v in (pairs[by_member], differ[by_member], later)
                )
                better = differ < least[later]
                least[later[better]], likest[later[better]] = differ[better], pairs[better]
                pairs = pairs[:0]
            like.append(pairs)
            made[:] = [np.zeros(0, np.int64)]

        waiting = 0
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            of_group = (v[a:b] for v in (place, at, component, main, size, probe, block))
            for pairs in _apart(*of_group, step, far, percent, len(nodes)):
                made.append(pairs)
                waiting += len(pairs)
                if waiting > JUDGED_AT_ONCE:
                    judge()
                    waiting = 0
        judge()
        pairs = np.unique(np.concatenate([*like, likest[likest >= 0]]))
        return pa.table({"x": nodes[pairs // len(nodes)], "y": nodes[pairs % len(nodes)]})

    return cells.groupBy(*cell).cogroup(known.groupBy(*theirs)).applyInArrow(pair, "x long, y long").distinct()


def _apart(place, at, component, main, size, probe, block, step: int, far: int, percent: int, base: int) -> Iterator[np.ndarray]:
    """The pairs of a group (as low * base + high) of different components and ``step`` to
    ``far - 1`` places apart. One of a pair is not in the largest component, so
    only those are gone through. Of two blocks one member comes from each."""
    ours = np.flatnonzero(component != main)
    across = len(block) > 0 and block[0] != block[-1]
    # Members are in the order of size, so that the sizes that allow a link are a range.
    first = np.maximum(np.searchsorted(at, at[ours] - far + 1), np.searchsorted(size * 100, size[ours] * percent))
    before = np.searchsorted(at, at[ours] - step, side="right")
    after = np.searchsorted(at, at[ours] + step)
    end = np.minimum(
        np.searchsorted(at, at[ours] + far), np.searchsorted(size * percent, size[ours] * 100, side="right")
    )
    for i, a, b, c, d in zip(*(v.tolist() for v in (ours, first, before, after, end)), strict=True):
        others = np.concatenate([np.arange(a, b), np.arange(c, d)])
        wanted = (component[others] != component[i]) & _fits(size[i], size[others], probe[i], probe[others], percent)
        if across:
            wanted &= block[others] != block[i]
        far_places = place[others[wanted]]
        yield np.minimum(place[i], far_places) * base + np.maximum(place[i], far_places)


def _unpacked_groups(groups: DataFrame) -> DataFrame:
    return groups.mapInArrow(_unpacked, "name binary, at long, node long, size long, probe boolean")


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, first, members in zip(*(batch.column(n).to_pylist() for n in ("name", "first", "members")), strict=True):
            n = len(members) // 17
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * n, pa.binary()), pa.array(np.arange(first, first + n), pa.int64()),
                    pa.array(np.frombuffer(members, np.int64, n)), pa.array(np.frombuffer(members, np.int64, n, 8 * n)),
                    pa.array(np.frombuffer(members, bool, n, 16 * n)),
                ],
                names=["name", "at", "node", "size", "probe"],
            )
