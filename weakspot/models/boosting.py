"""Second-order boosted trees over gradient histograms, many fits in one scan.

Features are binned once at quantiles and written as blocks of rows to the
shared folder. A pass over the blocks adds up, for every tree node asked for,
gradients, hessians and rows by feature and bin; partial sums of a node meet in
one task, which finds the node's best split. Only splits reach the driver: a
few numbers a node, whatever the rows and bins. The driver keeps the queue of
leaves: level by level, or best first up to a number of leaves. Blocks that
fit one partition go to the tasks as they are: each fit grows in a task of its
own, by the same steps.

Gradients and hessians are whole numbers (multiples of 2^-30), so sums are
exact: neither partitions, their order nor a lost executor change a model.

Several fits share each pass: fits differ in their settings and in the column
of row weights (a fold leaves rows out by a weight of zero).

Rows with a NULL label or weight take no part. NaN goes to the last bin. A
table of one class, or none, gives trees of one leaf.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot.session import ensure_checkpoints, written_once

MOST_BINS = 256
ACCURACY = 10_000  # of the quantiles; exact up to as many rows
SKETCHES = 128  # features whose quantiles one scan sketches
BLOCK_CELLS = 1 << 20  # rows times features of a block
JOINED_BLOCKS = 4  # as many of them are added up at once
PART_CELLS = 1 << 23  # rows times features of a partition
PASS_BYTES = 64 << 20  # sums of one pass
ALONE_BYTES = 24 << 20  # blocks of a table whose fits grow in a task each
KEPT_BYTES = 16 << 20  # sums that a task keeps to find splits; beyond it more tasks share them
REFRESH = 5  # trees between two refreshes of the kept margins
SAVED = 10  # refreshes between two checkpoints of the margins
UNIT_BITS = 30


@dataclass(frozen=True)
class Growth:
    """How one fit grows. ``leaves`` grows best first, None level by level;
    ``prior`` starts at the log odds of the weighted classes instead of 0."""

    rounds: int = 100
    rate: float = 0.3
    depth: int | None = 6
    leaves: int | None = None
    l2: float = 1.0
    least_hessian: float = 1.0
    least_rows: int = 1
    least_gain: float = 1e-6
    subsample: float = 1.0
    prior: bool = False
    seed: int = 42


@dataclass
class Tree:
    """Nodes by heap number: the children of i are 2 i (up to the edge) and 2 i + 1."""

    splits: dict[int, tuple[int, int, float, float]] = field(default_factory=dict)  # feature, bin, edge, gain
    sums: dict[int, tuple[int, int, int]] = field(default_factory=dict)  # gradients, hessians, rows
    values: dict[int, float] = field(default_factory=dict)


class PackedTree:
    """A grown tree as arrays, read like a ``Tree``: 60 bytes a node."""

    def __init__(self, tree: Tree):
        ids = sorted(tree.sums)
        made = [tree.splits.get(i, (-1, 0, 0.0, 0.0)) for i in ids]
        self.ids = np.array(ids, dtype="int64")
        self.feature, self.cut, self.edge, self.gain = (
            np.array([s[k] for s in made], dtype=kind) for k, kind in enumerate(("int32", "int16", "float64", "float64")))
        self.own = np.array([tree.sums[i] for i in ids], dtype="int64").reshape(len(ids), -1)
        self.value = np.array([tree.values.get(i, 0.0) for i in ids])

    @property
    def splits(self) -> dict[int, tuple[int, int, float, float]]:
        at = np.flatnonzero(self.feature >= 0)
        return dict(zip(self.ids[at].tolist(), zip(*(c[at].tolist() for c in (self.feature, self.cut, self.edge, self.gain)))))

    @property
    def sums(self) -> dict[int, tuple]:
        return dict(zip(self.ids.tolist(), map(tuple, self.own.tolist())))

    @property
    def values(self) -> dict[int, float]:
        at = np.flatnonzero(self.feature < 0)
        return dict(zip(self.ids[at].tolist(), self.value[at].tolist()))


def packed(tree: Tree) -> Tree | PackedTree:
    return PackedTree(tree) if max(tree.sums) < 1 << 62 else tree


def routes(splits: dict[int, tuple], ends: dict[int, int]) -> tuple[np.ndarray, ...]:
    """(feature, bin, edge, left, right, end) arrays; ``ends`` numbers the nodes
    that rows are sent to, -1 elsewhere."""
    ids = sorted({1, *ends, *splits, *(c for i in splits for c in (2 * i, 2 * i + 1))})
    place = {i: k for k, i in enumerate(ids)}
    feature, cut, edge = np.full(len(ids), -1, "int32"), np.zeros(len(ids), "int16"), np.zeros(len(ids))
    left, right = np.arange(len(ids), dtype="int32"), np.arange(len(ids), dtype="int32")
    for i, (f, b, e, _) in splits.items():
        k = place[i]
        feature[k], cut[k], edge[k], left[k], right[k] = f, b, e, place[2 * i], place[2 * i + 1]
    return feature, cut, edge, left, right, np.array([ends.get(i, -1) for i in ids], dtype="int32")


def route(data: np.ndarray, table: tuple[np.ndarray, ...], by_edge: bool, stops: bool = False) -> np.ndarray:
    """Where each row of bins (or raw values) ends; with ``stops`` at the
    first numbered node on its way."""
    feature, cut, edge, left, right, end = table
    limit = edge if by_edge else cut
    at = np.zeros(len(data), dtype="int64")  # the root has the smallest number
    rows = np.arange(len(data))
    rows = rows[feature[at] >= 0]
    while len(rows):
        node = at[rows]
        if stops:
            rows = rows[end[node] < 0]
            node = at[rows]
        x = data[rows, feature[node]]
        at[rows] = np.where(x <= limit[node], left[node], right[node])
        rows = rows[feature[at[rows]] >= 0]
    return end[at]


class Grower:
    """The queue of leaves of one tree."""

    def __init__(self, how: Growth, layout: Layout):
        self.how, self.layout = how, layout
        self.tree = Tree()
        self.leaves = {1}
        self.best: dict[int, tuple | None] = {}  # measured nodes: (gain, feature, bin, sums of the left child)
        self.done = False

    def wanted(self) -> list[int]:
        """Nodes to sum in the next pass."""
        if 1 not in self.best:
            return [1]
        room = (self.how.leaves or math.inf) - len(self.leaves)
        open_ = [i for i in self.leaves if i in self.best and self.best[i]]
        open_.sort(key=lambda i: (-self.best[i][0], i))
        ahead = open_[:int(min(room, len(open_)))] if self.how.leaves else []
        parents = dict.fromkeys([*(i >> 1 for i in sorted(self.leaves) if i > 1 and i not in self.best), *ahead])
        return [c for parent in parents for c in (2 * parent, 2 * parent + 1) if c not in self.best]

    def splittable(self, node: int) -> bool:
        return self.how.depth is None or node.bit_length() - 1 < self.how.depth

    def hopeless(self, node: int) -> bool:
        """Too small or too deep for any split."""
        _, h, n = self.tree.sums[node]
        return not self.splittable(node) or n < 2 * self.how.least_rows or h * self.layout.unit < 2 * self.how.least_hessian

    def take(self, node: int, whole: tuple[int, int, int], found: tuple | None) -> None:
        """The node's sums and its best split from a pass."""
        if node == 1:
            self.tree.sums[1] = whole
        self.best[node] = found = None if self.hopeless(node) else found
        if found:
            self.tree.sums[2 * node] = found[3]
            self.tree.sums[2 * node + 1] = tuple(t - s for t, s in zip(self.tree.sums[node], found[3]))
            for child in (2 * node, 2 * node + 1):
                if self.hopeless(child):
                    self.best[child] = None

    def advance(self) -> None:
        """Split leaves while the next one to split is known."""
        while not self.done:
            if self.how.leaves and len(self.leaves) >= self.how.leaves:
                self.done = True
                break
            if self.how.leaves and any(i not in self.best for i in self.leaves):
                break
            open_ = [i for i in self.leaves if self.best.get(i)]
            if not open_:
                self.done = all(i in self.best for i in self.leaves)
                break
            for i in ([min(open_, key=lambda i: (-self.best[i][0], i))] if self.how.leaves else open_):
                gain, feature, cut, _ = self.best[i]
                self.tree.splits[i] = (feature, cut, float(self.layout.edges[feature][cut]), gain)
                self.leaves.remove(i)
                self.leaves |= {2 * i, 2 * i + 1}
        if self.done:
            unit, how = self.layout.unit, self.how
            for i in self.leaves:
                g, h, _ = self.tree.sums[i]
                below = h * unit + how.l2
                self.tree.values[i] = how.rate * (-(g * unit) / below) if below > 0 else 0.0
            self.tree.sums = {i: s for i, s in self.tree.sums.items() if i in self.leaves or i in self.tree.splits}

    def ahead(self) -> dict[int, tuple]:
        """All splits a row may take: those made and those that wait."""
        out = dict(self.tree.splits)
        for i, found in self.best.items():
            if found and i not in out:
                out[i] = (found[1], found[2], 0.0, found[0])
        return out


@dataclass
class Layout:
    """Bins of all features side by side, and the unit of the sums."""

    edges: list[np.ndarray]
    unit: float

    def __post_init__(self):
        self.offsets = np.concatenate([[0], np.cumsum([len(e) + 1 for e in self.edges])]).astype("int64")
        self.feature_of = np.repeat(np.arange(len(self.edges)), np.diff(self.offsets))
        self.last = np.zeros(self.total, dtype=bool)
        self.last[self.offsets[1:] - 1] = True

    @property
    def total(self) -> int:
        return int(self.offsets[-1])

    @property
    def node_bytes(self) -> int:
        return 24 * self.total

    @property
    def sizes(self) -> list[int]:
        return [len(e) + 1 for e in self.edges]


def best_split(sums: np.ndarray, whole: tuple[int, int, int], how: Growth, layout: Layout) -> tuple | None:
    """(gain, feature, bin, left sums) of the largest gain, at the first
    feature and bin among equals."""
    running = np.cumsum(sums, axis=1)
    before = running[:, layout.offsets[:-1]] - sums[:, layout.offsets[:-1]]
    left = running - before[:, layout.feature_of]
    right = np.asarray(whole)[:, None] - left
    gl, hl, gr, hr = (x * layout.unit for x in (left[0], left[1], right[0], right[1]))
    g, h = whole[0] * layout.unit, whole[1] * layout.unit
    ok = (~layout.last & (left[2] >= how.least_rows) & (right[2] >= how.least_rows) & (left[2] > 0) & (right[2] > 0)
          & (hl >= how.least_hessian) & (hr >= how.least_hessian))
    at = np.flatnonzero(ok)
    if not len(at):
        return None
    gain = gl[at] * gl[at] / (hl[at] + how.l2) + gr[at] * gr[at] / (hr[at] + how.l2) - g * g / (h + how.l2)
    top = int(np.argmax(gain))
    if not gain[top] > how.least_gain:
        return None
    k = int(at[top])
    feature = int(layout.feature_of[k])
    return float(gain[top]), feature, k - int(layout.offsets[feature]), tuple(int(s) for s in left[:, k])


def bin_edges(df: DataFrame, features: str, size: int, bins: int = MOST_BINS) -> list[np.ndarray]:
    """Distinct quantiles of every feature; a value up to edge b is in bin b or below."""
    shares = [i / bins for i in range(1, bins)]
    values = vector_to_array(features) if df.schema[features].dataType.typeName() != "array" else F.col(features)
    found: dict[int, list[float]] = {}
    for start in range(0, size, SKETCHES):
        # few keys, so that every task holds its sketches in memory
        part = df.select(F.posexplode(F.slice(values, start + 1, SKETCHES)).alias("pos", "x")).filter(~F.isnan("x"))
        for r in part.groupBy("pos").agg(F.percentile_approx("x", shares, ACCURACY).alias("q"), F.max("x").alias("most")).collect():
            found[start + r["pos"]] = sorted({q for q in r["q"] if q < r["most"]})
    return [np.asarray(found.get(i, []), dtype="float64") for i in range(size)]


def width_of(df: DataFrame, features: str) -> int:
    kind = df.schema[features].dataType.typeName()
    first = df.select(F.size(vector_to_array(features) if kind != "array" else F.col(features)).alias("n")).filter("n >= 0").first()
    return first["n"] if first else 0


def binned(df: DataFrame, edges: list[np.ndarray], features: str, label: str, weights: list[str], row_key: str | None) -> DataFrame:
    """Blocks of rows: bins, labels, weights and row numbers as bytes."""
    kind = df.schema[features].dataType.typeName()
    x = vector_to_array(features) if kind != "array" else F.col(features).cast("array<double>")
    key = F.xxhash64(row_key) if row_key else F.xxhash64(x)
    rows = df.select(x.alias("x"), F.col(label).cast("double").alias("y"), key.alias("key"),
                     F.array(*[F.col(w).cast("double") for w in weights]).alias("w")).filter(
        F.col("y").isNotNull() & ~F.exists("w", F.isnull))
    size = max(1, BLOCK_CELLS // max(1, len(edges)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                n = part.num_rows
                flat = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, len(edges))
                bins = np.empty((n, len(edges)), dtype="uint8")
                for j, edge in enumerate(edges):
                    bins[:, j] = np.searchsorted(edge, flat[:, j], side="left")
                w = part.column("w").flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_pydict({
                    "n": pa.array([n], pa.int32()), "bins": [bins.tobytes()], "y": [part.column("y").to_numpy().astype("float64").tobytes()],
                    "w": [np.asarray(w, dtype="float64").tobytes()], "keys": [part.column("key").to_numpy().astype("int64").tobytes()]})

    return rows.mapInArrow(pack, "n int, bins binary, y binary, w binary, keys binary")


@dataclass
class Block:
    bins: np.ndarray
    y: np.ndarray
    w: np.ndarray
    keys: np.ndarray
    margins: np.ndarray | None = None


def _unpack(row, width: int, weights: int) -> Block:
    n = row["n"]
    return Block(np.frombuffer(row["bins"], "uint8").reshape(n, width), np.frombuffer(row["y"]),
                 np.frombuffer(row["w"]).reshape(n, weights), np.frombuffer(row["keys"], "int64"))


def _joined(blocks: Iterator[Block], most: int) -> Iterator[Block]:
    """Blocks put together up to a number of rows: fewer and longer sums."""
    held, rows = [], 0
    for block in blocks:
        if held and rows + len(block.y) > most:
            yield Block(*(np.concatenate([getattr(b, c) for b in held]) for c in ("bins", "y", "w", "keys")))
            held, rows = [], 0
        held.append(block)
        rows += len(block.y)
    if held:
        yield Block(*(np.concatenate([getattr(b, c) for b in held]) for c in ("bins", "y", "w", "keys")))


def chosen_rows(keys: np.ndarray, share: float, seed: int, round_: int) -> np.ndarray:
    """Which rows a round of a subsampled fit sees, by a hash of their key."""
    x = keys.view("uint64") ^ np.uint64((seed * 0x9E3779B97F4A7C15 + round_ * 0xBF58476D1CE4E5B9) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(share * (2 ** 64 - 1)))


def tree_values(tree: Tree) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    order = sorted(tree.values)
    return routes(tree.splits, {i: k for k, i in enumerate(order)}), np.array([tree.values[i] for i in order])


def add_trees(margin: np.ndarray, data: np.ndarray, trees: list, by_edge: bool) -> np.ndarray:
    """The margins with the values of the trees, in their order."""
    for table, values in trees:
        margin = margin + values[route(data, table, by_edge)]
    return margin


def add_up(blocks: Iterator[Block], asked: list[tuple], jobs: list[tuple[Growth, int]], recent: dict[int, list], sizes: list[int],
           unit: float, round_: int) -> np.ndarray:
    """Gradients, hessians and rows by bin of the nodes asked for, (fit, routes, nodes) one after the other."""
    out = np.zeros((sum(n for _, _, n in asked), 3, sum(sizes)), dtype="int64")
    for block in blocks:
        base = 0
        for j, table, n in asked:
            how, at = jobs[j]
            w = block.w[:, at]
            used = w > 0
            if how.subsample < 1:
                used &= chosen_rows(block.keys, how.subsample, how.seed, round_)
            node = route(block.bins, table, False, stops=True)
            rows = np.flatnonzero(used & (node >= 0))
            if len(rows):
                bins, node = block.bins[rows], node[rows].astype("int64")
                p = 1.0 / (1.0 + np.exp(-add_trees(block.margins[rows, j], bins, recent[j], False)))
                g = np.rint((p - block.y[rows]) * w[rows] / unit)
                h = np.rint(p * (1.0 - p) * w[rows] / unit)
                first = 0
                for column, size in zip(np.ascontiguousarray(bins.T), sizes):
                    cells = node * size + column
                    for k, per_row in enumerate((g, h, None)):
                        added = np.bincount(cells, per_row, n * size)
                        out[base:base + n, k, first:first + size] += added.reshape(n, size).astype("int64")
                    first += size
            base += n
    return out


def split_of(sums: np.ndarray, how: Growth, layout: Layout) -> tuple:
    """(sums, best split) of a node."""
    whole = tuple(int(s) for s in sums[:, :layout.sizes[0]].sum(axis=1))
    return whole, best_split(sums, whole, how, layout)


class Fits:
    """Fits over the same blocks, pass by pass. The driver holds a model's
    trees as arrays, or none of them with ``keep`` off (a fold's model is only
    asked for the margins, which the blocks have)."""

    def __init__(self, blocks, layout: Layout, jobs: list[tuple[Growth, int]], starts: list[float], keep: bool = True):
        self.layout, self.jobs, self.starts, self.keep = layout, jobs, starts, keep
        self.trees: list[list[PackedTree]] = [[] for _ in jobs]
        self.tables: list[list] = [[] for _ in jobs]  # trees that the kept margins do not hold yet
        self.fresh, self.refreshed = 0, 0  # rounds that the kept margins hold, refreshes so far
        self.begin(blocks)

    def begin(self, blocks: RDD) -> None:
        starts = self.starts
        self.state = blocks.map(lambda b: Block(b.bins, b.y, b.w, b.keys, np.tile(np.asarray(starts), (len(b.y), 1)))).persist(
            StorageLevel.MEMORY_AND_DISK)
        self.last: RDD | None = None

    def added(self):
        """A function that adds the trees since the last time to a block's margins."""
        tables = self.tables

        def add(block: Block) -> Block:
            m = [add_trees(block.margins[:, j], block.bins, t, False) for j, t in enumerate(tables)]
            return Block(block.bins, block.y, block.w, block.keys, np.stack(m, axis=1))

        self.tables = [[] for _ in self.jobs]
        return add

    def refresh(self) -> None:
        """Add the trees since the last time to the kept margins. A lost block
        is made again from the one before; checkpoints bound that chain."""
        if self.last is not None:  # no job needs it any more
            self.last.unpersist()
        self.last, self.state = self.state, self.state.map(self.added()).persist(StorageLevel.MEMORY_AND_DISK)
        self.refreshed += 1
        if self.refreshed % SAVED == 0:
            self.state.checkpoint()

    def measure(self, round_: int, plans: list[tuple[int, dict, list[int]]]) -> list[tuple]:
        """(sums, best split) of the nodes of each plan (fit, splits, nodes), one after the other."""
        recent = {j: self.tables[j] for j, _, _ in plans}
        asked = [(j, routes(splits, {i: k for k, i in enumerate(nodes)}), len(nodes)) for j, splits, nodes in plans]
        jobs, sizes, unit = self.jobs, self.layout.sizes, self.layout.unit
        owners = [j for j, _, n in asked for _ in range(n)]
        many = len(owners)

        def split(parts: Iterator[tuple[int, np.ndarray]]) -> Iterator[tuple]:
            layout = Layout([np.empty(size - 1) for size in sizes], unit)
            for at, sums in parts:
                yield at, *split_of(sums, jobs[owners[at]][0], layout)

        sums = self.state.mapPartitions(lambda blocks: enumerate(add_up(blocks, asked, jobs, recent, sizes, unit, round_)))
        parts = sums.getNumPartitions()
        if parts > 1:
            sums = sums.reduceByKey(np.add, min(many, max(parts, many * self.layout.node_bytes // max(1, KEPT_BYTES))))
        return [found for _, *found in sorted(sums.mapPartitions(split).collect(), key=lambda r: r[0])]

    def grow(self, round_: int, active: list[int]) -> None:
        """One tree for every active fit."""
        growers = {j: Grower(self.jobs[j][0], self.layout) for j in active}
        most = max(1, PASS_BYTES // max(1, self.layout.node_bytes))
        while growers:
            todo = [(j, node) for j, grower in growers.items() for node in grower.wanted()]
            for start in range(0, len(todo), most):
                part = todo[start:start + most]
                plans = [(j, growers[j].ahead(), [n for k, n in part if k == j]) for j in dict.fromkeys(j for j, _ in part)]
                for (j, node), (whole, found) in zip(part, self.measure(round_, plans)):
                    growers[j].take(node, whole, found)
            for j, grower in list(growers.items()):
                grower.advance()
                if grower.done:
                    if self.keep:
                        self.trees[j].append(packed(grower.tree))
                    self.tables[j].append(tree_values(grower.tree))
                    del growers[j]

    def run(self) -> list[list[PackedTree]]:
        most = max((how.rounds for how, _ in self.jobs), default=0)
        for round_ in range(most):
            active = [j for j, (how, _) in enumerate(self.jobs) if round_ < how.rounds]
            self.grow(round_, active)
            if round_ + 1 - self.fresh >= REFRESH and round_ + 1 < most:
                self.refresh()
                self.fresh = round_ + 1
        return self.trees

    def hits(self, folds: list[int]) -> np.ndarray:
        """Of each fit's held-out rows (their fold is the last column of weights): true, predicted and all of class 1."""
        add = self.added()
        return self.state.map(lambda b: counted(add(b), folds)).treeReduce(np.add)

    def close(self) -> None:
        self.state.unpersist()
        if self.last is not None:
            self.last.unpersist()


def counted(block: Block, folds: list[int]) -> np.ndarray:
    held = block.w[:, -1:] == np.asarray(folds)[None, :]
    hit, one = held & (block.margins > 0), held & (block.y == 1)[:, None]
    return np.stack([(hit & one).sum(axis=0), hit.sum(axis=0), one.sum(axis=0)], axis=1)


class Alone(Fits):
    """The same in a task, over a list of blocks."""

    def begin(self, blocks: list[Block]) -> None:
        self.state = [Block(b.bins, b.y, b.w, b.keys, np.tile(np.asarray(self.starts), (len(b.y), 1))) for b in blocks]

    def refresh(self) -> None:
        self.state = list(map(self.added(), self.state))

    def measure(self, round_: int, plans: list[tuple[int, dict, list[int]]]) -> list[tuple]:
        out = []
        for j, splits, nodes in plans:
            asked = [(j, routes(splits, {i: k for k, i in enumerate(nodes)}), len(nodes))]
            sums = add_up(self.state, asked, self.jobs, {j: self.tables[j]}, self.layout.sizes, self.layout.unit, round_)
            out += [split_of(s, self.jobs[j][0], self.layout) for s in sums]
        return out

    def hits(self, folds: list[int]) -> np.ndarray:
        add = self.added()
        return sum((counted(add(b), folds) for b in self.state), np.zeros((len(folds), 3), dtype="int64"))


@dataclass
class BoostedModel:
    trees: list[Tree]
    start: float
    size: int
    features: str = "features"
    kind: str = "mean_gain"

    @property
    def featureImportances(self) -> np.ndarray:
        """Share of each feature: of the mean gain of its splits
        (``mean_gain``), of all gain (``gain``) or of all splits (``splits``)."""
        gain, count = np.zeros(self.size), np.zeros(self.size)
        for tree in self.trees:
            for f, _, _, g in tree.splits.values():
                gain[f] += g
                count[f] += 1
        out = {"splits": count, "gain": gain, "mean_gain": gain / np.maximum(count, 1)}[self.kind]
        return out / out.sum() if out.sum() > 0 else out

    def transform(self, df: DataFrame) -> DataFrame:
        """``margin``, ``probability`` and ``prediction`` by the edges of the trees."""
        p = 1.0 / (1.0 + F.exp(-F.col("margin")))
        return (with_margins(df, [self], self.features).withColumn("margin", F.get("margins", F.lit(0))).drop("margins").withColumn("probability", array_to_vector(F.array(1.0 - p, p)))
                .withColumn("prediction", (F.col("margin") > 0).cast("double")))

    def nodes(self, spark, unit: float = 2.0 ** -UNIT_BITS) -> DataFrame:
        """One row per node: (tree, node, feature, edge, gain, gradient,
        hessian, rows, value); a leaf has no feature, an inner node no value."""
        rows = []
        for t, tree in enumerate(self.trees):
            for i, (g, h, n) in sorted(tree.sums.items()):
                f, _, edge, gain = tree.splits.get(i, (None, None, None, None))
                rows.append((t, i, f, edge, gain, g * unit, h * unit, n, tree.values.get(i)))
        return spark.createDataFrame(rows, "tree int, node long, feature int, edge double, gain double, gradient double, hessian double, rows long, value double")


def with_margins(df: DataFrame, models: list[BoostedModel], features: str = "features") -> DataFrame:
    """``margins``: one for each model, all in one pass over the rows."""
    shared = df.sparkSession.sparkContext.broadcast([(m.start, [tree_values(t) for t in m.trees]) for m in models])
    kind = df.schema[features].dataType.typeName()
    x = vector_to_array(features) if kind != "array" else F.col(features).cast("array<double>")

    @F.pandas_udf("array<double>")
    def margins(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            data = np.nan_to_num(np.stack(batch.to_numpy()), nan=np.inf) if len(batch) else np.zeros((0, 1))
            made = [add_trees(np.full(len(batch), start), data, tables, True) for start, tables in shared.value]
            yield pd.Series(list(np.stack(made, axis=1)) if made else [[]] * len(batch))

    return df.withColumn("margins", margins(x))


def _run(df: DataFrame, jobs: list[tuple[Growth, str | None]], features: str, label: str, row_key: str | None, size: int,
         fold: str | None = None, folds: list[int] | None = None) -> tuple[list, list[float]]:
    """(trees of each fit, or with ``fold`` its counts on the fold held out; their starts)."""
    ensure_checkpoints(df.sparkSession)
    names = list(dict.fromkeys(w for _, w in jobs if w))
    held = df.select(*dict.fromkeys([*([row_key] if row_key else []), features, label, *names, *([fold] if fold else [])])).withColumn("__one", F.lit(1.0))
    columns = ["__one", *names]
    edges = bin_edges(held, features, size)
    ready = held
    if fold:  # a row without a label is scored but never fitted
        known = F.col(label).isNotNull()
        ready = held.withColumns({c: F.when(known, F.col(c)).otherwise(0.0) for c in columns}).withColumn(
            label, F.coalesce(F.col(label).cast("double"), F.lit(float("nan"))))
    blocks = written_once(binned(ready, edges, features, label, [*columns, *([fold] if fold else [])], row_key), "blocks")
    totals = held.filter(F.col(label).isNotNull()).agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.when(F.col(label) == y, F.col(c))).alias(f"{c}_{y}") for c in columns for y in (0, 1)]).first()
    both = {c: (totals[f"{c}_0"] or 0.0, totals[f"{c}_1"] or 0.0) for c in columns}
    # whole sums stay below 2^62
    bits = min(UNIT_BITS, 61 - math.ceil(math.log2(max(1.0, *map(sum, both.values())) + 1)))
    layout = Layout(edges, 2.0 ** -bits)
    starts = [math.log(both[w or "__one"][1] / both[w or "__one"][0]) if how.prior and min(both[w or "__one"]) > 0 else 0.0
              for how, w in jobs]
    width, weights = size, len(columns) + bool(fold)
    numbered = [(how, columns.index(w or "__one")) for how, w in jobs]
    rdd = blocks.rdd.map(lambda row: _unpack(row, width, weights))
    most = JOINED_BLOCKS * BLOCK_CELLS // max(1, size)
    rows = blocks.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-rows * max(1, size) // PART_CELLS))
    if parts == 1 and rows * (size + 8 * (2 + weights)) <= ALONE_BYTES:
        shared = df.sparkSession.sparkContext.broadcast(list(_joined(iter(rdd.collect()), most)))

        def alone(at: int):
            fits = Alone(shared.value, layout, [numbered[at]], [starts[at]], not fold)
            trees = fits.run()[0]
            return fits.hits([folds[at]])[0] if fold else trees

        try:
            return df.sparkSession.sparkContext.parallelize(range(len(jobs)), max(1, len(jobs))).map(alone).collect(), starts
        finally:
            shared.unpersist()
    fits = Fits(rdd.coalesce(parts).mapPartitions(lambda part: _joined(part, most)), layout, numbered, starts, not fold)
    try:
        trees = fits.run()
        return (list(fits.hits(folds)) if fold else trees), starts
    finally:
        fits.close()


def fit_many(df: DataFrame, jobs: list[tuple[Growth, str | None]], features: str = "features", label: str = "label",
             row_key: str | None = None, kind: str = "mean_gain") -> list[BoostedModel]:
    """A model for each (settings, weight column), all trained in the same passes."""
    size = width_of(df, features)
    if not size:  # no rows with features
        return [BoostedModel([], 0.0, 0, features, kind) for _ in jobs]
    return [BoostedModel(trees, start, size, features, kind) for trees, start in zip(*_run(df, jobs, features, label, row_key, size))]


def held_out(df: DataFrame, jobs: list[tuple[Growth, str | None]], fold: str, folds: list[int], features: str = "features",
             label: str = "label", row_key: str | None = None) -> list[tuple[int, int, int]]:
    """For each fit, on the rows of its fold: true positives, predicted
    positives, positives. No model is kept."""
    size = width_of(df, features)
    if not size:
        return [(0, 0, 0) for _ in jobs]
    return [tuple(int(x) for x in c) for c in _run(df, jobs, features, label, row_key, size, fold, folds)[0]]


@dataclass
class HistogramBoosting:
    """Estimator of one fit."""

    how: Growth
    features: str = "features"
    label: str = "label"
    weight: str | None = None
    kind: str = "mean_gain"
    row_key: str | None = None

    def fit(self, df: DataFrame) -> BoostedModel:
        return fit_many(df, [(self.how, self.weight)], self.features, self.label, self.row_key, self.kind)[0]


# settings of the two native boosting families
def second_order(rounds: int = 100, depth: int = 6, rate: float = 0.3, **more) -> Growth:
    """Level by level, leaf weights shrunk by l2 = 1."""
    return Growth(rounds=rounds, depth=depth, rate=rate, **more)


def leaf_wise(rounds: int = 100, leaves: int = 31, rate: float = 0.1, **more) -> Growth:
    """Best first, at least 20 rows in a leaf, starting at the prior."""
    return Growth(rounds=rounds, rate=rate, depth=None, leaves=leaves, l2=0.0, least_hessian=1e-3, least_rows=20, prior=True, **more)
