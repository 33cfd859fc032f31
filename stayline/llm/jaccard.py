"""Near-duplicate classes by an exact join in Jaccard's metric space.

A document is the set of its word shingles; documents link where the distance
d = 1 - intersection / union is at most r. d is a metric, so with a pivot q

* the ball of q (d <= r) is one class: all its members link to q;
* a document that links to a member of the ball lies within 2 r of q. Those
  beyond the ball are its boundary window: they are copied into the region of q
  and compared with the ball there, unless they are in the same class already;
* a pair that no ball touches is left for the next level.

Level one takes documents as pivots: a bounded sample shows where the space is
crowded, and sampled documents that have others within 2 r become pivots. Their
regions hold the large groups of near copies, and no pair of a ball is made.

Level two joins what no ball holds. Those documents are at distance about 1 from
each other, so only pivots inside their sets part them: every shingle s is the
pivot {s}, nearest to the documents that own it. In a fixed order of shingles a
document enters the regions of its first shingles, as many as a linked document
may lack and SHARED more; two linked documents then share SHARED regions, and
pairs that share fewer are not compared. Shingles that are frequent in the sample
come last in the order.

A region of {s} with more than CROWDED documents is parted further: a few of its
members become document pivots, as on level one, and all members are measured
against them. A ball leaves the region, its window is compared with it, and the
rest is parted again. Removal is a matter of one region, so a pair that still
shares a region afterwards has lost none of those that it shares. So a group of
near copies that the sample missed makes a row per member and region, not its pairs.
A region whose balls hold next to nothing shares single shingles only, as texts with
a common passage do, and is paired as it is.

All levels end in exact set intersections, so every link is found whichever
documents are sampled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.arrow import pieces, small_batches
from stayline.llm.components import components
from stayline.llm.files import Shelf, key_files
from stayline.llm.names import aside, back
from stayline.llm.words import U64, chunks, flat, gram_hashes, mix, spans, word_hashes
from stayline.sources.staging import stage

#: Distinct sets looked at for pivots and frequent shingles, and shingles kept of them.
SAMPLE = 4096
SAMPLE_SHINGLES = 2_500_000
#: Times in the sample from which a shingle is frequent.
FREQUENT = 3
#: First shingles that two linked documents share at least, if they have as many.
SHARED = 5
#: Sets that one verification task compares.
BLOCK = 1024
#: Sets from which a region of one shingle is parted, and pivots per region in each step.
CROWDED = 256
STEPS = (1, 4, 16)
#: Pairs that are held before they are counted.
PAIRS = 2_000_000
#: Share of a region (one in so many) that its balls must take for a further step.
PROGRESS = 16
_LAST = (1 << 63) - 1


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each text's begin.

    A text with fewer than k words has one shingle, its whole word sequence; a
    text without words has none. A-Z count as a-z.
    """
    starts, ends, cuts = spans(data, offs)
    h = word_hashes(data, starts, ends, lower=True)
    n = np.diff(cuts)
    grams = gram_hashes(h, k)
    size = np.maximum(n - k + 1, 0)
    row = np.repeat(np.arange(len(n)), size)
    at = np.repeat(cuts[:-1] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    value = grams[at] if len(at) else np.zeros(0, U64)
    for length in range(1, k):
        short = np.flatnonzero(n == length)
        if len(short):
            whole = gram_hashes(h, length)[cuts[short]]
            row = np.concatenate([row, short])
            value = np.concatenate([value, mix(whole + U64(length))])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[new], value[new]
    return value, np.searchsorted(row, np.arange(len(n) + 1))


def set_names(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, equal for equal sets; 0 for the empty set."""
    n = np.diff(cuts)
    out = np.zeros(len(n), U64)
    full = np.flatnonzero(n)
    if len(full):
        total = np.add.reduceat(mix(values + U64(0x632BE59BD9B4E019)), cuts[:-1][full])
        out[full] = mix(total + n[full].astype(U64)) | U64(1)
    return out.view(np.int64)


def needed(size: np.ndarray, percent: int) -> np.ndarray:
    """Least intersection with a set of ``size`` that gives ``percent`` similarity."""
    return (percent * size + 99) // 100


def _similar(common, a, b, percent: int):
    return 100 * common >= percent * (a + b - common)


def _fronts(values: np.ndarray, cuts: np.ndarray, frequent: np.ndarray, percent: int, shared: int = 1):
    """First shingles of each set in the fixed order: (set, shingle, shingles from there on).

    Of the n shingles of a set at most n - needed(n) are missing from a similar
    one, so the first n - needed(n) + shared hold ``shared`` common ones.
    """
    n = np.diff(cuts)
    row = np.repeat(np.arange(len(n)), n)
    late = np.zeros(len(values), bool)
    if len(frequent):
        late = frequent[np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)] == values
    order = np.lexsort((values, late, row))
    rank = np.arange(len(values)) - cuts[:-1][row]
    inside = rank < (n - needed(n, percent) + shared)[row]
    return row[inside], values[order[inside]], (n[row] - rank)[inside]


@dataclass
class Pivots:
    """Pivot sets, an index of their first shingles, and the frequent shingles."""

    names: np.ndarray
    values: np.ndarray
    cuts: np.ndarray
    frequent: np.ndarray
    percent: int  # similarity at the edge of the boundary window

    def __post_init__(self) -> None:
        owner, shingle, _ = _fronts(self.values, self.cuts, self.frequent, self.percent)
        order = np.argsort(shingle, kind="stable")
        self.index, self.owner = shingle[order], owner[order]

    def near(self, values: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(set, pivot, intersection) of all sets inside a boundary window."""
        none = np.zeros(0, np.int64)
        if not len(self.names) or not len(values):
            return none, none, none
        row, shingle, _ = _fronts(values, cuts, self.frequent, self.percent)
        lo = np.searchsorted(self.index, shingle)
        hits = np.searchsorted(self.index, shingle, side="right") - lo
        found = np.repeat(row, hits)
        at = np.repeat(lo - (np.cumsum(hits) - hits), hits) + np.arange(hits.sum())
        pairs = np.unique(found * len(self.names) + self.owner[at])
        rows, pivots = np.divmod(pairs, len(self.names))
        sizes, own = np.diff(cuts), np.diff(self.cuts)
        common = np.zeros(len(rows), np.int64)
        for i, (r, q) in enumerate(zip(rows.tolist(), pivots.tolist(), strict=True)):
            common[i] = _common(values[cuts[r] : cuts[r + 1]], self.values[self.cuts[q] : self.cuts[q + 1]])
        good = _similar(common, sizes[rows], own[pivots], self.percent)
        return rows[good], pivots[good], common[good]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def choose_pivots(names: list[int], sets: list[np.ndarray], percent: int) -> Pivots:
    """Frequent shingles of a sample, and its documents that have others near by as pivots."""
    wide = 2 * percent - 100
    cuts = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    values = np.concatenate([np.zeros(0, U64), *sets])
    kinds, counts = np.unique(values, return_counts=True)
    frequent = kinds[counts >= FREQUENT]
    everyone = Pivots(np.array(names, np.int64), values, cuts, frequent, wide)
    # A member of a ball that is there already needs none of its own; lonely documents neither.
    chosen, covered = [], np.zeros(len(sets), bool)
    sizes = np.diff(cuts)
    for i in range(len(sets)):
        if covered[i]:
            continue
        one = np.array([0, sizes[i]])
        _, q, common = everyone.near(values[cuts[i] : cuts[i + 1]], one)
        if len(q) > 1:
            chosen.append(i)
            covered[q[_similar(common, sizes[i], sizes[q], percent)]] = True
    picked = [sets[i] for i in chosen]
    return Pivots(
        np.array([names[i] for i in chosen], np.int64),
        np.concatenate([np.zeros(0, U64), *picked]),
        np.concatenate([[0], np.cumsum([len(s) for s in picked])]).astype(np.int64),
        frequent,
        wide,
    )


def _each(batches: Iterator[pa.RecordBatch], k: int):
    """(batch, texts from, texts to, sets, cuts, names) in small parts."""
    for batch in pieces(batches, "text"):
        data, offs = flat(batch.column("text"))
        for a, b, part, cut in chunks(data, offs):
            values, cuts = shingle_sets(part, cut, k)
            yield batch, a, b, values, cuts, set_names(values, cuts)


def _only(values: np.ndarray, cuts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets of some rows."""
    size = np.diff(cuts)[rows]
    at = np.repeat(cuts[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return values[at], np.concatenate([[0], np.cumsum(size)])


def _unseen(names: np.ndarray, seen: set[int]) -> np.ndarray:
    """Rows with the first non-empty set of a name that the task meets."""
    rows = []
    for i, name in enumerate(names.tolist()):
        if name and name not in seen:
            seen.add(name)
            rows.append(i)
    return np.array(rows, np.int64)


def named_sets(docs: DataFrame, k: int, keep: list[str]) -> DataFrame:
    """Columns ``keep``, n_shingles and set_name of each document."""
    fields = [docs.schema[c] for c in keep]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "n_shingles long, set_name long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, b, _, cuts, names in _each(batches, k):
            rows = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in keep), pa.array(np.diff(cuts)), pa.array(names)],
                [*keep, "n_shingles", "set_name"],
            )

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def _sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """node and its set (packed hashes) for the nodes in ``wanted``; a task sends a set once.

    The names of the wanted sets lie in sorted files that workers map, so the texts
    of all other documents go nowhere.
    """
    files = docs.sparkSession.sparkContext.broadcast(key_files(wanted, "node"))  # a path per shuffle partition

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        shelf = Shelf()
        for _, _, _, values, cuts, names in _each(batches, k):
            rows = np.flatnonzero(files.value.held(names, shelf) & (names != 0))
            rows = rows[_unseen(names[rows], seen)]
            raw = [values[cuts[i] : cuts[i + 1]].tobytes() for i in rows.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(names[rows]), pa.array(raw, pa.binary())], ["node", "set"])

    return docs.select("text").mapInArrow(run, "node long, set binary")


def _id() -> Column:
    return F.coalesce("doc_id", F.lit(_LAST)).cast("long")


def _sample(docs: DataFrame, nodes: DataFrame, k: int) -> tuple[list[int], list[np.ndarray]]:
    """Up to SAMPLE sets with SAMPLE_SHINGLES shingles in all, by least hash of the name."""
    wanted = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).collect()
    room, chosen = SAMPLE_SHINGLES, []
    for row in wanted:
        room -= row["n_shingles"]
        if room < 0:
            break
        chosen.append(row["node"])
    if not chosen:
        return [], []
    table = docs.sparkSession.createDataFrame([(n,) for n in chosen], "node long")
    sets = _sets_of(docs, table, k).groupBy("node").agg(F.first("set").alias("set"))
    found = {r["node"]: np.frombuffer(r["set"], U64) for r in sets.collect()}
    return chosen, [found[n] for n in chosen]


def _region_rows(docs: DataFrame, pivots, k: int, percent: int) -> DataFrame:
    """node and pivot of every set in a ball (inside) or boundary window.

    ``link`` marks rows inside that connect something new in their task: enough to
    find the classes that the balls make.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        forest = _Forest()
        p = pivots.value
        own = np.diff(p.cuts)
        for _, _, _, values, cuts, names in _each(batches, k):
            rows = _unseen(names, seen)
            values, cuts = _only(values, cuts, rows)
            x, q, common = p.near(values, cuts)
            size = np.diff(cuts)[x]
            inside = _similar(common, size, own[q], percent)
            node, pivot = names[rows][x], p.names[q]
            link = [
                bool(i) and forest.join(a, b)
                for i, a, b in zip(inside, node.tolist(), pivot.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(pivot), pa.array(inside), pa.array(link, pa.bool_())],
                ["node", "pivot", "inside", "link"],
            )

    rows = docs.select("text").mapInArrow(run, "node long, pivot long, inside boolean, link boolean")
    return rows.groupBy("node", "pivot", "inside").agg(F.max("link").alias("link"))


def _front_rows(docs: DataFrame, pivots, k: int, percent: int, buckets: int) -> DataFrame:
    """First shingles of all sets in no ball, packed per bucket of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def send(parts: list) -> Iterator[pa.RecordBatch]:
            shingle, node, size, rest = (np.concatenate(c) for c in zip(*parts, strict=True))
            bucket = (shingle % U64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                at = order[edges[b] : edges[b + 1]]
                blobs = (shingle[at], node[at], size[at], rest[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in blobs)],
                    ["bucket", "shingles", "nodes", "sizes", "rests"],
                )

        seen: set[int] = set()
        p = pivots.value
        own = np.diff(p.cuts)
        parts, held = [], 0
        for _, _, _, values, cuts, names in _each(batches, k):
            rows = _unseen(names, seen)
            values, cuts = _only(values, cuts, rows)
            x, q, common = p.near(values, cuts)
            n = np.diff(cuts)
            free = np.ones(len(rows), bool)
            free[x[_similar(common, n[x], own[q], percent)]] = False
            values, cuts = _only(values, cuts, np.flatnonzero(free))
            nodes, n = names[rows][free], np.diff(cuts)
            row, shingle, rest = _fronts(values, cuts, p.frequent, percent, SHARED)
            if len(row):
                parts.append((shingle, nodes[row], n[row].astype(np.int32), rest.astype(np.int32)))
                held += len(row)
            if held >= 4_000_000:
                yield from send(parts)
                parts, held = [], 0
        if parts:
            yield from send(parts)

    return docs.select("text").mapInArrow(
        run, "bucket int, shingles binary, nodes binary, sizes binary, rests binary"
    )


def _region_pairs(
    shingle: np.ndarray, node: np.ndarray, size: np.ndarray, rest: np.ndarray, percent: int, side: np.ndarray | None = None
):
    """Pairs that may be similar, with the number of regions they share here and have to share in all.

    The entries are sorted by shingle. In the j-th region that two sets share, the
    shingles from there on bound their intersection but for the j - 1 before. So each
    of the first SHARED regions of a similar pair passes the test with SHARED - 1
    more; others need not be counted. With ``side`` only pairs of two sides are made.
    """
    _, starts, counts = np.unique(shingle, return_index=True, return_counts=True)
    last = np.repeat(starts + counts, counts)
    names, row = np.unique(node, return_inverse=True)
    sizes = np.zeros(len(names), np.int64)
    sizes[row] = size
    width = max(1, len(names))
    keys, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
    found: list[np.ndarray] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        more, n = np.unique(np.concatenate([np.zeros(0, np.int64), *found]), return_counts=True)
        every, at = np.unique(np.concatenate([keys, more]), return_inverse=True)
        return every, np.bincount(at, np.concatenate([times, n]), len(every)).astype(np.int64)

    step, at = 1, np.arange(len(node))
    # All pairs of neighbours 1, 2, 3, ... places apart in a region.
    while True:
        at = at[at + step < last[at]]
        if not len(at):
            break
        a, b = size[at], size[at + step]
        most = np.minimum(np.minimum(rest[at], rest[at + step]) + SHARED - 1, np.minimum(a, b))
        good = at[_similar(most, a, b, percent)]
        if side is not None:
            good = good[side[good] != side[good + step]]
        found.append(row[good] * width + row[good + step])
        if sum(map(len, found)) > PAIRS:
            (keys, times), found = merged(), []
        step += 1
    keys, times = merged()
    x, y = np.divmod(keys, width)
    wanted = np.minimum(SHARED, needed(np.maximum(sizes[x], sizes[y]), percent))
    return names[x], names[y], times, wanted


_MET = "a long, b long, times int, wanted int"


def _met(a: np.ndarray, b: np.ndarray, times: np.ndarray, wanted: np.ndarray) -> list[pa.Array]:
    return [pa.array(a), pa.array(b), pa.array(times.astype(np.int32)), pa.array(wanted.astype(np.int32))]


def _pairs_in_regions(percent: int):
    """Pairs of the regions of a bucket; of crowded regions the entries: shingle, node, size and rest."""

    def run(table: pa.Table) -> pa.Table:
        blob = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
        shingle, node = blob("shingles", U64), blob("nodes", np.int64)
        size, rest = blob("sizes", np.int32).astype(np.int64), blob("rests", np.int32).astype(np.int64)
        order = np.lexsort((node, shingle))
        shingle, node, size, rest = shingle[order], node[order], size[order], rest[order]
        new = np.ones(len(node), bool)  # one entry per set, however many tasks sent it
        new[1:] = (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])
        entries = [x[new] for x in (shingle, node, size, rest)]
        _, at, counts = np.unique(entries[0], return_inverse=True, return_counts=True)
        full = counts[at] > CROWDED
        pairs = _met(*_region_pairs(*(x[~full] for x in entries), percent))
        crowd = _met(entries[0][full].view(np.int64), *(x[full] for x in entries[1:]))
        mark = np.arange(len(pairs[0]) + len(crowd[0])) >= len(pairs[0])
        columns = [pa.concat_arrays(two) for two in zip(pairs, crowd, strict=True)]
        return pa.table([*columns, pa.array(mark)], ["a", "b", "times", "wanted", "crowded"])

    return run


def _pairs_left(percent: int):
    """Pairs of regions that have been parted: of one block, or between two blocks of a region."""

    def run(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_numpy() for c in ("shingle", "node", "size", "rest", "_mine")]
        order = np.lexsort((columns[1], columns[0]))
        shingle, node, size, rest, mine = (c[order].astype(np.int64) for c in columns)
        one = table.column("_p")[0].as_py() == table.column("_q")[0].as_py()
        found = _region_pairs(shingle, node, size, rest, percent, None if one else mine)
        return pa.table(_met(*found), ["a", "b", "times", "wanted"])

    return run


def _near_pivot(percent: int):
    """node and pivot of the pairs in a ball (inside) or boundary window, by their exact intersection."""
    wide = 2 * percent - 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("set"), batch.column("centre"), strict=True)
            sets = ([np.frombuffer(x.as_buffer(), U64) for x in pair] for pair in pairs)
            sizes = np.array([(_common(x, q), len(x), len(q)) for x, q in sets], np.int64).reshape(-1, 3).T
            near = pa.array(_similar(*sizes, wide))
            inside = pa.array(_similar(*sizes, percent))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("pivot"), inside, inside], ["node", "pivot", "inside", "link"]
            ).filter(near)

    return run


class _Forest:
    """Classes found so far in one task."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _verify_pairs(percent: int):
    """Links among the candidate pairs of a block, enough to connect its classes."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        sets = {
            n: np.frombuffer(s, U64)
            for n, s in zip(right.column("node").to_pylist(), right.column("set").to_pylist(), strict=True)
        }
        forest, links = _Forest(), []
        for a, b in zip(left.column("a").to_pylist(), left.column("b").to_pylist(), strict=True):
            if forest.root(a) != forest.root(b) and _similar(
                _common(sets[a], sets[b]), len(sets[a]), len(sets[b]), percent
            ):
                forest.join(a, b)
                links.append((a, b))
        return pa.table([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

    return run


def _verify_windows(percent: int):
    """Boundary documents of a pivot that link to a member of its ball, in one block of members."""

    def run(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        inside = table.column("inside").to_numpy()
        pivot = table.column("pivot")[0].as_py()
        sets = [np.frombuffer(s, U64) for s in table.column("set").to_pylist()]
        members = [sets[i] for i in np.flatnonzero(inside)]
        sizes = np.array([len(s) for s in members], np.int64)
        values = np.concatenate([np.zeros(0, U64), *members])
        owner = np.repeat(np.arange(len(members)), sizes)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        linked = []
        for i in np.flatnonzero(~inside).tolist():
            lo, hi = (np.searchsorted(values, sets[i], side=s) for s in ("left", "right"))
            hits = hi - lo
            at = np.repeat(lo - (np.cumsum(hits) - hits), hits) + np.arange(hits.sum())
            common = np.bincount(owner[at], minlength=len(members))
            if _similar(common, len(sets[i]), sizes, percent).any():
                linked.append(int(nodes[i]))
        return pa.table([pa.array(linked, pa.int64()), pa.array([pivot] * len(linked), pa.int64())], ["a", "b"])

    return run


def _window_links(
    docs: DataFrame, regions: DataFrame, k: int, percent: int, sets: DataFrame | None = None
) -> DataFrame:
    """Links from boundary windows into balls, between classes that no ball connects.

    ``sets`` holds the sets of all nodes in ``regions``; where it is None they are read from ``docs``.
    """
    spark = docs.sparkSession
    balls = regions.filter("link").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    label = components(balls)
    own = label.select("node", F.col("label").alias("_own"))
    centre = label.select(F.col("node").alias("pivot"), F.col("label").alias("_centre"))
    outside = (
        regions.filter("not inside").join(own, "node", "left").join(centre, "pivot", "left")
        .filter("_centre is not null and (_own is null or _own <> _centre)")
        .select("node", "pivot")
    )
    outside = stage(outside, "boundary")
    if outside.isEmpty():
        return spark.createDataFrame([], "a long, b long")
    crowded = outside.groupBy("pivot").agg(F.count("*").alias("_outside"))
    members = regions.filter("inside").select("node", "pivot").join(crowded, "pivot")
    sizes = members.groupBy("pivot", "_outside").agg(F.count("*").alias("_inside"))
    # Blocks of members x blocks of boundary documents; each side goes to the blocks of the other.
    sizes = sizes.select(
        "pivot",
        F.ceil(F.col("_inside") / BLOCK).cast("int").alias("_rows"),
        F.ceil(F.col("_outside") / BLOCK).cast("int").alias("_columns"),
    )
    spread = lambda side, count, other, inside: (
        side.join(sizes, "pivot").select(
            "node", "pivot", F.lit(inside).alias("inside"),
            F.pmod(F.xxhash64("node"), F.col(count)).cast("int").alias("_mine"),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("_other"),
        )
    )
    rows = spread(regions.filter("inside").select("node", "pivot").join(crowded.select("pivot"), "pivot"), "_rows", "_columns", True)
    columns = spread(outside, "_columns", "_rows", False)
    placed = rows.withColumnsRenamed({"_mine": "_row", "_other": "_column"}).unionByName(
        columns.withColumnsRenamed({"_mine": "_column", "_other": "_row"})
    )
    placed = stage(placed, "placed")
    full = placed.join(_sets_of(docs, placed.select("node"), k) if sets is None else sets, "node")
    return full.groupBy("pivot", "_row", "_column").applyInArrow(_verify_windows(percent), "a long, b long")


def _crowded_links(docs: DataFrame, entries: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links of the balls in crowded regions and of their windows, and the entries in no ball of their region."""
    links = docs.sparkSession.createDataFrame([], "a long, b long")
    sets = stuck = None
    for step, pivots in enumerate(STEPS):
        least = [F.min_by(F.struct("node", "size"), F.xxhash64("node", F.lit(step), F.lit(i))) for i in range(pivots)]
        full = (
            entries.groupBy("shingle")
            .agg(F.count("*").alias("_n"), F.array_distinct(F.array(*least)).alias("_pivots"))
            .filter(F.col("_n") > CROWDED)
        )
        full = stage(full if stuck is None else full.join(stuck, "shingle", "left_anti"), "crowded_regions")
        if full.isEmpty():
            break
        chosen = full.select("shingle", F.explode("_pivots").alias("_p")).select(
            "shingle", F.col("_p.node").alias("pivot"), F.col("_p.size").alias("_size")
        )
        # Sets of too different sizes cannot lie in each other's window.
        fits = 100 * F.least("size", "_size") >= (2 * percent - 100) * F.greatest("size", "_size")
        placed = entries.join(chosen, "shingle").filter(fits).select("shingle", "node", "pivot")
        pairs = placed.select("node", "pivot").distinct()
        if sets is None:
            wanted = entries.join(full.select("shingle"), "shingle", "left_semi").select("node")
            sets = stage(_sets_of(docs, wanted, k), "crowded_sets")
        centres = sets.join(chosen.select(F.col("pivot").alias("node")).distinct(), "node", "left_semi")
        centres = centres.dropDuplicates(["node"]).select(F.col("node").alias("pivot"), F.col("set").alias("centre"))
        # The few centres are stored first, so that Spark sends them to all tasks only where their size allows it.
        both = pairs.join(sets, "node").join(stage(centres, "centres"), "pivot")
        near = both.mapInArrow(_near_pivot(percent), "node long, pivot long, inside boolean, link boolean")
        near = stage(near.distinct(), "near_pivots")
        inside = near.filter("inside").select("node", "pivot")
        links = stage(
            links.unionByName(inside.select(F.col("node").alias("a"), F.col("pivot").alias("b")))
            .unionByName(_window_links(docs, near, k, percent, sets)),
            "crowded_links",
        )
        gone = stage(placed.join(inside, ["node", "pivot"]).select("shingle", "node").distinct(), "parted")
        entries = stage(entries.join(gone, ["shingle", "node"], "left_anti"), "crowded_entries")
        taken = gone.groupBy("shingle").agg(F.count("*").alias("_taken"))
        slow = full.join(taken, "shingle", "left").filter(PROGRESS * F.coalesce("_taken", F.lit(0)) < F.col("_n"))
        slow = slow.select("shingle")
        stuck = slow if stuck is None else stuck.unionByName(slow)
    return links, entries


def _sparse_links(docs: DataFrame, pivots, k: int, percent: int) -> DataFrame:
    """Links between sets that no ball of a sampled pivot holds."""
    buckets = 16 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fronts = _front_rows(docs, pivots, k, percent, buckets)
    met = fronts.groupBy("bucket").applyInArrow(_pairs_in_regions(percent), f"{_MET}, crowded boolean")
    met = stage(met, "met")
    entries = met.filter("crowded").select(
        F.col("a").alias("shingle"), F.col("b").alias("node"), F.col("times").alias("size"), F.col("wanted").alias("rest")
    )
    met = met.filter("not crowded").drop("crowded")
    links, entries = _crowded_links(docs, entries, k, percent)
    # Large regions are paired block by block, so that no task holds all pairs of a region.
    sizes = entries.groupBy("shingle").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    placed = entries.join(sizes, "shingle").withColumn("_mine", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    placed = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")).select(
        "shingle", "node", "size", "rest", "_mine",
        F.least("_mine", "_other").alias("_p"), F.greatest("_mine", "_other").alias("_q"),
    )
    bucket = F.when(F.col("_q") == 0, F.pmod("shingle", F.lit(buckets))).otherwise(F.col("shingle")).alias("_bucket")
    met = met.unionByName(placed.groupBy(bucket, "_p", "_q").applyInArrow(_pairs_left(percent), _MET))
    return links.unionByName(_pair_links(docs, met, k, percent))


def _pair_links(docs: DataFrame, met: DataFrame, k: int, percent: int) -> DataFrame:
    """Links among the pairs that share enough regions."""
    spark = docs.sparkSession
    enough = met.groupBy("a", "b", "wanted").agg(F.sum("times").alias("times")).filter("times >= wanted")
    pairs = stage(enough.select("a", "b"), "pairs")
    if pairs.isEmpty():
        return spark.createDataFrame([], "a long, b long")
    # Neighbours get a common label so that most pairs lie in one block; large labels are split.
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label"))
    counts = low.groupBy("label").agg(F.count("*").alias("_n"))
    block = F.xxhash64("label", F.pmod(F.xxhash64("node"), F.ceil(F.col("_n") / BLOCK).cast("long")))
    blocks = stage(low.join(counts, "label").select("node", block.alias("block")), "blocks")
    of = lambda side: blocks.select(F.col("node").alias(side), F.col("block").alias(f"_{side}"))
    home = pairs.join(of("a"), "a").join(of("b"), "b").select(
        "a", "b", F.least("_a", "_b").alias("_p"), F.greatest("_a", "_b").alias("_q")
    )
    home = stage(home, "pair_blocks")
    members = (
        home.select(F.col("a").alias("node"), "_p", "_q")
        .unionByName(home.select(F.col("b").alias("node"), "_p", "_q"))
        .distinct()
        .withColumnsRenamed({"_p": "_p2", "_q": "_q2"})
    )
    sets = members.join(_sets_of(docs, blocks.select("node"), k), "node")
    return (
        home.groupBy("_p", "_q")
        .cogroup(sets.groupBy("_p2", "_q2"))
        .applyInArrow(_verify_pairs(percent), "a long, b long")
    )


def _classes(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, n_shingles, set_name and id of every document; set_name, label and least id of every set."""
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    spark = docs.sparkSession
    small_batches(spark)
    named = named_sets(docs.select("doc_id", "text"), k, ["doc_id"])
    named = stage(named.withColumn("id", _id()), "named_sets")
    nodes = stage(
        named.filter("n_shingles > 0")
        .groupBy(F.col("set_name").alias("node"), "n_shingles")
        .agg(F.min("id").alias("id")),
        "nodes",
    )
    pivots = spark.sparkContext.broadcast(choose_pivots(*_sample(docs, nodes, k), percent))
    regions = stage(_region_rows(docs, pivots, k, percent), "regions")
    balls = regions.filter("link").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    links = stage(
        balls.unionByName(_window_links(docs, regions, k, percent)).unionByName(
            _sparse_links(docs, pivots, k, percent)
        ),
        "links",
    )
    label = components(links)
    grouped = nodes.join(label, "node", "left").select("node", "id", F.coalesce("label", "node").alias("label"))
    least = grouped.groupBy("label").agg(F.min("id").alias("least"))
    classes = grouped.join(least, "label").select(F.col("node").alias("set_name"), "label", "least")
    return named, stage(classes, "classes")


def _with_sets(docs: DataFrame, named: DataFrame, k: int, kept: list[str]) -> DataFrame:
    """``named`` with the columns ``kept`` of ``docs``."""
    if set(kept) <= {"doc_id"}:
        return named
    return named_sets(docs, k, list(dict.fromkeys(["doc_id", *kept]))).withColumn("id", _id())


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all where None), n_shingles and component_id of each document.

    Documents link where their sets of k-word shingles have a Jaccard similarity
    of at least ``percent`` in a hundred (51 to 100); component_id is the least
    doc_id that links reach. A null or empty text has no shingles and links with
    nothing. Rows may repeat; a null doc_id is left out of the least, and a class
    of nothing else has none. Columns called n_shingles or component_id are replaced.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("n_shingles", "component_id")]
    docs, names = aside(docs, kept, ["doc_id", "text"])
    named, classes = _classes(docs, k, percent)
    least = F.coalesce("least", "id")
    return _with_sets(docs, named, k, names).join(classes, "set_name", "left").select(
        *back(kept, names),
        "n_shingles",
        F.when(least != _LAST, least).alias("component_id"),
    )


def one_per_class(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one document of each class: that with the least doc_id.

    Documents without words stay. Where the least doc_id of a class is on several
    rows, or all its documents have none, one of these rows stays.
    """
    kept = docs.columns
    docs, names = aside(docs, kept, ["doc_id", "text"])
    named, classes = _classes(docs, k, percent)
    first = F.col("least").isNull() | (F.col("id") == F.col("least"))
    several = (
        named.join(classes, "set_name").filter(first).groupBy("label").count().filter("count > 1").select("label")
    )
    several = stage(several, "several_firsts")
    rows = _with_sets(docs, named, k, names)
    rows = rows.join(classes, "set_name", "left").filter(first)
    alone = rows.join(several, "label", "left_anti")
    if not several.isEmpty():
        alone = alone.unionByName(rows.join(several, "label", "left_semi").dropDuplicates(["label"]))
    return alone.select(*back(kept, names))
