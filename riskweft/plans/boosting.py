"""Gradient-boosted trees with second-order gains, many models in one pass.

Every model grows its own trees, and all models of a call share each pass over
the data: variants, folds, samples, settings and feature sets. A pass adds up
gradients, hessians and rows by (model, node, feature, bin) in the tasks, adds
the tasks' sums by (model, node) in a shuffle, and picks the best split of each
node there; the driver receives one split per node and holds tree tables only.

Data stand in blocks of up to BLOCK_ROWS rows: bins of all columns, label, a
portable hash of the row's key, row weights, and each model's margin as of the
last refresh. Trees grown since then are applied in the pass; after REFRESH
trees the margins are brought up to date.

A table of up to TASK_BYTES needs no passes: a task reads its blocks once and
grows whole models on them, with the same sums, splits and order of additions,
so the trees are the same bit by bit. Models of one table are dealt out over
tasks, which run beside each other.

Gradients and hessians are rounded to 2^-24 and summed as integers, so sums do
not depend on the order of rows, tasks or retries. Ties go to the lower column,
then the lower border.

Growth. A split's gain is T(GL)^2/(HL+l2) + T(GR)^2/(HR+l2) - T(G)^2/(H+l2), with T
shrinking by l1, and must exceed min_gain; a leaf is -T(G)/(H+l2) times the
learning rate. Level-wise growth expands all nodes; best-first growth stops at
max_leaves. Its splits are asked for level by level and the order of expansion
is replayed on them, which gives the same tree, because a node's best split does
not depend on the order. Symmetric growth gives all nodes of a level the same
split, the one with the largest sum of gains.

Rows are drawn per tree by the hash of (seed, tree, key): equal keys are drawn
together. Missing values have a bin above all others.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import partial
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskweft.functions.rowmath import quoted
from riskweft.session import release, side_by_side, stage
from riskweft.sources.contract import SEED

#: Bins of a column; the borders are quantiles of its training values.
BINS = 64
BLOCK_ROWS = 1 << 16
REFRESH = 8
#: Columns whose quantiles are sketched at once.
SKETCHED = 24
#: A table whose blocks, with one model's margins and gradients, take up to so many bytes is grown in single tasks.
TASK_BYTES = 192 << 20
#: Gradients and hessians are multiples of 1 / SCALE.
SCALE = 1 << 24
#: A tree without a depth limit stops here; a path this long splits off one bin after the other.
DEEPEST = 64


@dataclass(frozen=True)
class Growth:
    """How one model grows its trees."""

    rounds: int
    learning_rate: float
    max_depth: int | None = None
    max_leaves: int | None = None
    min_hessian: float = 0.0
    min_rows: int = 1
    l2: float = 0.0
    l1: float = 0.0
    min_gain: float = 0.0
    row_share: float = 1.0
    column_share: float = 1.0
    symmetric: bool = False
    seed: int = SEED

    @property
    def depth(self) -> int:
        return DEEPEST if self.max_depth is None else self.max_depth

    def columns_of(self, tree: int, total: int) -> np.ndarray:
        """Columns that a tree may split on, drawn without replacement."""
        if self.column_share >= 1.0:
            return np.arange(total)
        wanted = max(1, int(self.column_share * total))
        return np.sort(np.random.default_rng([self.seed, tree]).permutation(total)[:wanted])


@dataclass(frozen=True)
class Split:
    gain: float
    column: int
    bin: int
    left: tuple[int, int, int]
    right: tuple[int, int, int]


@dataclass
class Tree:
    """Nodes in the order of their creation; a leaf has column -1. Sums are (gradient, hessian, rows) as integers."""

    column: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    sums: list[tuple[int, int, int]] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)

    def add(self, sums: tuple[int, int, int], depth: int) -> int:
        for values, value in ((self.column, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.gain, 0.0), (self.sums, sums), (self.depth, depth)):
            values.append(value)
        return len(self.column) - 1

    def split(self, node: int, by: Split) -> tuple[int, int]:
        self.column[node], self.bin[node], self.gain[node] = by.column, by.bin, by.gain
        self.left[node], self.right[node] = self.add(by.left, self.depth[node] + 1), self.add(by.right, self.depth[node] + 1)
        return self.left[node], self.right[node]


@dataclass(frozen=True)
class FlatTree:
    """A tree as arrays, for tasks."""

    column: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    levels: int

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node in which each row of a (columns, rows) matrix of bins ends."""
        at = np.zeros(bins.shape[1], np.int32)
        every = np.arange(bins.shape[1])
        for _ in range(self.levels):
            column = self.column[at]
            inner = column >= 0
            went = np.where(bins[np.where(inner, column, 0), every] <= self.bin[at], self.left[at], self.right[at])
            at = np.where(inner, went, at)
        return at


def shrunk(g: float, l1: float) -> float:
    return math.copysign(max(abs(g) - l1, 0.0), g)


def leaf_value(sums: tuple[int, int, int], growth: Growth) -> float:
    g, h = sums[0] / SCALE, sums[1] / SCALE
    return -growth.learning_rate * shrunk(g, growth.l1) / (h + growth.l2) if h + growth.l2 > 0 else 0.0


def flat(tree: Tree, growth: Growth) -> FlatTree:
    values = [leaf_value(s, growth) if c < 0 else 0.0 for c, s in zip(tree.column, tree.sums)]
    whole = [np.array(x, np.int32) for x in (tree.column, tree.bin, tree.left, tree.right)]
    return FlatTree(*whole, np.array(values), max(tree.depth, default=0))


# --- splits ------------------------------------------------------------------------------------------


def _gains(sums: np.ndarray, growth: Growth) -> np.ndarray:
    """Gain of every (column, border) of integer sums (3, columns, bins); -inf where a side is too small."""
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    whole = sums.sum(axis=2)[:, :, None]
    right = whole - left
    (gl, hl), (gr, hr), (g, h) = (x[:2] / SCALE for x in (left, right, whole))

    def score(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
        kept = np.maximum(np.abs(gradient) - growth.l1, 0.0)
        return np.divide(kept * kept, hessian + growth.l2, out=np.zeros_like(kept), where=hessian + growth.l2 > 0)

    found = score(gl, hl) + score(gr, hr) - score(g, h)
    least = max(growth.min_rows, 1)
    fits = (left[2] >= least) & (right[2] >= least) & (hl >= growth.min_hessian) & (hr >= growth.min_hessian)
    return np.where(fits, found, -np.inf)


def best_split(sums: np.ndarray, columns: np.ndarray, growth: Growth) -> tuple[tuple[int, int, int], Split | None]:
    """(sums of the node, its best split or None)."""
    whole = tuple(int(x) for x in sums[:, 0, :].sum(axis=1))
    gains = _gains(sums, growth)
    if not gains.size:
        return whole, None
    at = int(gains.argmax())
    column, border = divmod(at, gains.shape[1])
    gain = float(gains[column, border])
    if not gain > max(growth.min_gain, 0.0):
        return whole, None
    left = tuple(int(x) for x in sums[:, column, : border + 1].sum(axis=1))
    return whole, Split(gain, int(columns[column]), int(border), left, tuple(w - x for w, x in zip(whole, left)))


def best_level(nodes: dict[int, np.ndarray], columns: np.ndarray, growth: Growth) -> dict[int, tuple[tuple[int, int, int], Split | None]]:
    """One split for all nodes of a level: the largest sum of gains; a node that it leaves whole on one side stays a parent of an empty leaf."""
    free = replace(growth, min_rows=0, min_hessian=0.0)
    total = None
    for sums in nodes.values():
        left = np.cumsum(sums[2], axis=1)[:, :-1]
        inside = (left > 0) & (left < sums[2].sum(axis=1)[:, None])
        gains = np.where(inside, _gains(sums, free), 0.0)
        total = gains if total is None else total + gains
    at = int(total.argmax())
    column, border = divmod(at, total.shape[1])
    best = float(total[column, border])
    out = {}
    for node, sums in nodes.items():
        whole = tuple(int(x) for x in sums[:, 0, :].sum(axis=1))
        left = tuple(int(x) for x in sums[:, column, : border + 1].sum(axis=1))
        right = tuple(w - x for w, x in zip(whole, left))
        out[node] = (whole, Split(best, int(columns[column]), int(border), left, right) if best > max(growth.min_gain, 0.0) else None)
    return out


# --- growing -----------------------------------------------------------------------------------------


@dataclass
class _Grower:
    """One model between passes: finished trees and the one that grows."""

    growth: Growth
    n_columns: int
    trees: list[Tree] = field(default_factory=list)
    tree: Tree = field(default_factory=Tree)
    known: dict[int, Split | None] = field(default_factory=dict)
    asked: list[int] = field(default_factory=list)

    def __post_init__(self):
        self._start()

    def _start(self) -> None:
        self.tree, self.known = Tree(), {}
        self.tree.add((0, 0, 0), 0)
        self.asked = [0]

    @property
    def done(self) -> bool:
        return len(self.trees) >= self.growth.rounds

    @property
    def columns(self) -> np.ndarray:
        return self.growth.columns_of(len(self.trees), self.n_columns)

    def take(self, found: dict[int, tuple[tuple[int, int, int], Split | None]]) -> None:
        """Splits of the asked nodes; a node of which no task has seen a row has none."""
        for node in self.asked:
            sums, split = found.get(node, ((0, 0, 0), None))
            if node == 0:
                self.tree.sums[0] = sums
            self.known[node] = split
        for node in self.asked:
            if self.known[node] is not None:
                self.tree.split(node, self.known[node])
        self.asked = self._needed()
        if not self.asked:
            self.trees.append(self._final())
            self._start()

    def _open(self, node: int) -> bool:
        return node not in self.known and self.tree.depth[node] < self.growth.depth

    def _needed(self) -> list[int]:
        """Nodes whose split the final tree depends on, as far as is known; none if the tree is settled.

        Best-first growth is replayed on the known splits. A child whose split is
        not known yet may come before any later expansion, so it is needed unless
        it was made by the last one allowed.
        """
        most = self.growth.max_leaves
        if most is None:
            return [n for n in range(len(self.tree.column)) if self._open(n)]
        needed, leaves = [], 1
        open_ = [(-self.tree.gain[0], 0)] if self.known.get(0) is not None else []
        while open_ and leaves < most:
            _, node = heapq.heappop(open_)
            leaves += 1
            for child in (self.tree.left[node], self.tree.right[node]):
                if self.known.get(child) is not None:
                    heapq.heappush(open_, (-self.tree.gain[child], child))
                elif leaves < most and self._open(child):
                    needed.append(child)
        return sorted(needed)

    def _final(self) -> Tree:
        """The grown tree without expansions beyond max_leaves, its nodes in the order of expansion: best first, or level by level."""
        most = self.growth.max_leaves
        final = Tree()
        final.add(self.tree.sums[0], 0)

        def entry(node: int, place: int) -> tuple:
            return (-self.tree.gain[node] if most else 0.0, node, place)

        open_, leaves = [entry(0, 0)] if self.known.get(0) is not None else [], 1
        while open_ and leaves < (most or math.inf):
            _, node, at = heapq.heappop(open_)
            leaves += 1
            children = final.split(at, self.known[node])
            for child, place in zip((self.tree.left[node], self.tree.right[node]), children):
                if self.known.get(child) is not None:
                    heapq.heappush(open_, entry(child, place))
        return final


# --- blocks ------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Training:
    """One binned table that any number of models train on."""

    frame: DataFrame
    columns: tuple[str, ...]
    label: str
    weights: tuple[Column, ...]
    key: str | None = None
    #: Borders of the columns, instead of quantiles.
    borders: tuple[tuple[float, ...], ...] | None = None


BLOCK = "place int, n int, bins binary, label binary, key binary, weights binary, margins binary"


def borders_of(frame: DataFrame, columns: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Increasing borders of each column: its quantiles, all values but the largest where there are few.

    The built-in mergeable sketch, a pass for each SKETCHED columns, since a task
    holds a buffer for each column; borders are values of the table.
    """
    return [b for i in range(0, len(columns), SKETCHED) for b in _borders_of(frame, columns[i : i + SKETCHED], bins)]


def _borders_of(frame: DataFrame, columns: Sequence[str], bins: int) -> list[np.ndarray]:
    cells = [F.col(quoted(c)).cast("double") for c in columns]
    finite = [F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x) for x in cells]
    shares = F.expr("array(" + ", ".join(f"{i / bins!r}d" for i in range(1, bins)) + ")")
    row = frame.agg(*[F.percentile_approx(x, shares, 10_000).alias(f"b{i}") for i, x in enumerate(finite)], *[F.max(x).alias(f"m{i}") for i, x in enumerate(finite)]).first()
    found = []
    for i in range(len(columns)):
        values = np.unique(np.array(row[f"b{i}"] or [], np.float64))
        found.append(values[values < row[f"m{i}"]] if row[f"m{i}"] is not None else values)
    return found


def bins_of(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """0 up to the first border, 1 up to the second, ...; what is missing gets the bin above all borders' bins."""
    return np.where(np.isnan(values), len(borders) + 1, np.searchsorted(borders, values)).astype(np.uint8)


def _pack(place: int, borders: list[np.ndarray], n_weights: int, base: np.ndarray, most: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        size = 0

        def block(rows: pd.DataFrame) -> pa.RecordBatch:
            n, columns = len(rows), len(borders)
            bins = np.empty((columns, n), np.uint8)
            for i, b in enumerate(borders):
                bins[i] = bins_of(rows[f"c{i}"].to_numpy(np.float64), b)
            weights = rows[[f"w{i}" for i in range(n_weights)]].to_numpy(np.float64).T
            cells = [bins, rows["label"].to_numpy(np.uint8), rows["key"].to_numpy(np.int64), weights, np.repeat(base[:, None], n, axis=1)]
            return pa.RecordBatch.from_arrays(
                [pa.array([place], pa.int32()), pa.array([n], pa.int32()), *[pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in cells]],
                ["place", "n", "bins", "label", "key", "weights", "margins"],
            )

        for batch in batches:
            rows = batch.to_pandas()
            while len(rows):
                part, rows = rows.iloc[: most - size], rows.iloc[most - size :]
                held.append(part)
                size += len(part)
                if size == most:
                    yield block(pd.concat(held, ignore_index=True))
                    held, size = [], 0
        if size:
            yield block(pd.concat(held, ignore_index=True))

    return pack


@dataclass
class _Block:
    """The arrays of one block row."""

    place: int
    bins: np.ndarray
    label: np.ndarray
    key: np.ndarray
    weights: np.ndarray
    margins: np.ndarray

    @classmethod
    def of(cls, row: tuple) -> _Block:
        """From the columns of a block row, in their order."""
        place, n, *cells = row
        bins, label, key, weights, margins = (np.frombuffer(x, kind).reshape(-1, n) for x, kind in zip(cells, (np.uint8, np.uint8, np.int64, np.float64, np.float64)))
        return cls(place, bins, label[0], key[0], weights, margins)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def drawn(key: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Rows of a tree's sample."""
    salt = _mix(np.array([(seed << 20) + tree + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (_mix(key.view(np.uint64) ^ salt) >> np.uint64(11)) < np.uint64(int(share * (1 << 53)))


@dataclass(frozen=True)
class _Work:
    """What one model asks of a pass."""

    model: int
    place: int
    chunk: int
    slot: int
    weight: int
    growth: Growth
    tree: int
    columns: np.ndarray
    grown: tuple[FlatTree, ...]
    growing: FlatTree
    asked: tuple[int, ...]
    bins: int


def _sums(bins: np.ndarray, columns: np.ndarray, at: np.ndarray, nodes: int, width: int, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Integer sums (nodes, 3, columns, width) of rows that stand in nodes; bins: (all columns, rows).

    Gradients and hessians are whole numbers whose sums over a block of at most
    2^16 rows stay below 2^53, so the additions are exact.
    """
    out = np.empty((nodes, 3, len(columns), width), np.int64)
    start = at.astype(np.int64) * width
    for i, column in enumerate(columns):
        cell = start + bins[column]
        out[:, 0, i] = np.bincount(cell, g, nodes * width).reshape(nodes, width)
        out[:, 1, i] = np.bincount(cell, h, nodes * width).reshape(nodes, width)
        out[:, 2, i] = np.bincount(cell, minlength=nodes * width).reshape(nodes, width)
    return out


def _gradients(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of each row in units of 1 / SCALE."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint(weight * (p - label) * SCALE), np.rint(weight * p * (1.0 - p) * SCALE)


def _sampled(weight: np.ndarray, key: np.ndarray, growth: Growth, tree: int) -> np.ndarray:
    """Rows that a tree is grown on."""
    use = weight > 0
    if growth.row_share < 1.0:
        use = use & drawn(key, growth.seed, tree, growth.row_share)
    return use


def _node_sums(block: _Block, work: _Work) -> dict[int, np.ndarray]:
    """Integer sums (3, columns, bins) of each asked node over one block."""
    weight = block.weights[work.weight]
    slots = np.full(len(work.growing.column), -1, np.int32)
    slots[list(work.asked)] = np.arange(len(work.asked))
    at = slots[work.growing.place(block.bins)]
    rows = np.flatnonzero(_sampled(weight, block.key, work.growth, work.tree) & (at >= 0))
    if not len(rows):
        return {}
    margin = block.margins[work.slot][rows]
    bins = block.bins[:, rows]
    for tree in work.grown:
        margin = margin + tree.value[tree.place(bins)]
    g, h = _gradients(margin, block.label[rows], weight[rows])
    whole = _sums(bins, work.columns, at[rows], len(work.asked), work.bins, g, h)
    return {node: whole[i] for i, node in enumerate(work.asked) if whole[i, 2].any()}


def _best(work: _Work, nodes: dict[int, np.ndarray]) -> dict[int, tuple[tuple[int, int, int], Split | None]]:
    if work.growth.symmetric:
        return best_level(nodes, work.columns, work.growth)
    return {node: best_split(sums, work.columns, work.growth) for node, sums in nodes.items()}


def _rows_of(work: list[_Work], blocks: Iterator[tuple[int, tuple]]) -> dict[tuple[int, int], dict[int, np.ndarray]]:
    """Sums of the asked nodes over some blocks: (model, unit) -> node -> sums. A unit is what one split is chosen for: a node, or a whole level."""
    totals: dict[tuple[int, int], dict[int, np.ndarray]] = {}
    for chunk, row in blocks:
        block = _Block.of(row)
        for w in work:
            if w.place != block.place or w.chunk != chunk:
                continue
            for node, sums in _node_sums(block, w).items():
                nodes = totals.setdefault((w.model, -1 if w.growth.symmetric else node), {})
                nodes[node] = nodes[node] + sums if node in nodes else sums
    return totals


def _merged(a: dict[int, np.ndarray], b: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    return {n: a[n] + b[n] if n in a and n in b else a[n] if n in a else b[n] for n in a.keys() | b.keys()}


@dataclass
class _Data:
    """Blocks in memory, spread over tasks; they come from a staged table, which a lost executor reads again.

    Thousands of passes over the same blocks are the one place where a plan for
    each pass costs more than the pass, so they run on a cached RDD of blocks:
    0.10 s a pass on one block, against 0.42 s for the same pass as a DataFrame.
    """

    rows: RDD
    whole: bool
    reducers: int

    @classmethod
    def of(cls, spark: SparkSession, blocks: DataFrame, sizes: list[int], chunks: int) -> _Data:
        """sizes: blocks of each table; chunks: copies of each block, each for a part of the models."""
        n, parallelism = sum(sizes), spark.sparkContext.defaultParallelism
        rows = blocks.rdd.map(tuple)
        if n * chunks <= 4 * parallelism:
            spread = rows.zipWithIndex().flatMap(lambda x: [(x[1] * chunks + c, (c, x[0])) for c in range(chunks)])
            rows = spread.partitionBy(max(1, n * chunks), lambda k: k).values()
        else:
            rows = rows.flatMap(lambda x: [(c, x) for c in range(chunks)])
        # Where no table has a second block, a task's sums are the whole sums.
        return cls(rows.persist(StorageLevel.MEMORY_AND_DISK), max(sizes) <= 1, min(max(1, n), parallelism))

    def best(self, work: list[_Work]) -> dict[int, dict[int, tuple[tuple[int, int, int], Split | None]]]:
        """One pass for all models: model -> node -> (sums, split). The driver receives one split for each asked node."""
        named = {w.model: w for w in work}

        def chosen(units):
            return [(model, _best(named[model], nodes)) for (model, _), nodes in units]

        if self.whole:
            found = self.rows.mapPartitions(lambda rows: chosen(_rows_of(work, rows).items())).collect()
        else:
            parts = self.rows.mapPartitions(lambda rows: list(_rows_of(work, rows).items()))
            found = parts.reduceByKey(_merged, self.reducers).mapPartitions(chosen).collect()
        out: dict[int, dict] = {}
        for model, nodes in found:
            out.setdefault(model, {}).update(nodes)
        return out

    def refreshed(self, grown: dict[int, list[tuple[int, tuple[FlatTree, ...]]]]) -> _Data:
        """The same blocks with margins that hold the given trees; grown: place -> (slot, trees)."""

        def applied(x: tuple[int, tuple]) -> tuple[int, tuple]:
            block = _Block.of(x[1])
            margins = block.margins.copy()
            for slot, trees in grown.get(block.place, ()):
                for tree in trees:
                    margins[slot] += tree.value[tree.place(block.bins)]
            return x[0], (*x[1][:-1], margins.tobytes())

        after = replace(self, rows=self.rows.map(applied).persist(StorageLevel.MEMORY_AND_DISK))
        after.rows.count()
        self.rows.unpersist()
        return after


# --- whole models in one task ------------------------------------------------------------------------


@dataclass(frozen=True)
class _Job:
    """One model that a task grows from its first tree to its last."""

    model: int
    weight: int
    base: float
    growth: Growth
    n_columns: int
    bins: int


class _Sample:
    """The rows of one block that one tree is grown on, and the node of the growing tree in which each stands."""

    def __init__(self, block: _Block, job: _Job, margin: np.ndarray, tree: int):
        weight = block.weights[job.weight]
        rows = np.flatnonzero(_sampled(weight, block.key, job.growth, tree))
        self.bins = block.bins if len(rows) == len(weight) else np.take(block.bins, rows, axis=1)
        self.g, self.h = _gradients(margin[rows], block.label[rows], weight[rows])
        self.at = np.zeros(len(rows), np.int32)

    def move(self, tree: Tree, split: list[int]) -> None:
        """Rows of nodes that have just been split go to their children."""
        moves = np.zeros(len(tree.column), bool)
        moves[split] = True
        rows = np.flatnonzero(moves[self.at])
        column, border, left, right = (np.array(x, np.int32) for x in (tree.column, tree.bin, tree.left, tree.right))
        at = self.at[rows]
        self.at[rows] = np.where(self.bins[column[at], rows] <= border[at], left[at], right[at])

    def sums(self, nodes: list[int], total: int, columns: np.ndarray, width: int) -> np.ndarray:
        slots = np.full(total, -1, np.int32)
        slots[nodes] = np.arange(len(nodes))
        at = slots[self.at]
        rows = np.flatnonzero(at >= 0)
        if len(rows) == len(at):
            return _sums(self.bins, columns, at, len(nodes), width, self.g, self.h)
        picked = np.take(self.bins[columns], rows, axis=1)
        return _sums(picked, np.arange(len(columns)), at[rows], len(nodes), width, self.g[rows], self.h[rows])


def _grown_whole(blocks: list[_Block], job: _Job) -> list[Tree]:
    """All trees of one model. Of two children only the one with fewer rows is summed; the other is what is left of the parent."""
    grower = _Grower(job.growth, job.n_columns)
    margins = [np.full(len(b.label), job.base) for b in blocks]
    while not grower.done:
        t, columns, tree = len(grower.trees), grower.columns, grower.tree
        samples = [_Sample(b, job, m, t) for b, m in zip(blocks, margins)]
        sums: dict[int, np.ndarray] = {}
        parent: dict[int, int] = {}
        while True:
            asked, among = list(grower.asked), set(grower.asked)
            # The smaller child of each parent, and nodes without one.
            derived = {}
            for node in asked:
                p = parent.get(node)
                if p in sums and tree.left[p] in among and tree.right[p] in among:
                    pair = (tree.left[p], tree.right[p])
                    if node == max(pair, key=lambda c: (tree.sums[c][2], c)):
                        derived[node] = (p, *[c for c in pair if c != node])
            summed = [n for n in asked if n not in derived]
            whole = sum(s.sums(summed, len(tree.column), columns, job.bins) for s in samples)
            sums |= {n: whole[i] for i, n in enumerate(summed)}
            for n, (p, other) in derived.items():
                sums[n] = sums.pop(p) - sums[other]
            nodes = {n: sums[n] for n in asked if sums[n][2].any()}
            found = {}
            if nodes and job.growth.symmetric:
                found = best_level(nodes, columns, job.growth)
            elif nodes:
                found = {n: best_split(x, columns, job.growth) for n, x in nodes.items()}
            grower.take(found)
            if len(grower.trees) > t:
                break
            split = [n for n in asked if grower.known[n] is not None]
            for n in split:
                parent[tree.left[n]] = parent[tree.right[n]] = n
            for s in samples:
                s.move(tree, split)
        last = flat(grower.trees[-1], job.growth)
        for block, margin in zip(blocks, margins):
            margin += last.value[last.place(block.bins)]
    return grower.trees


def _dealt(jobs: dict[int, list[_Job]], tasks: int) -> list[tuple[int, list[_Job]]]:
    """(place, jobs) of each task, the longest first: the jobs of a table go to as many tasks as its share of the work asks for."""
    def cost(job: _Job) -> int:
        return job.growth.rounds * min(job.growth.depth, 8)

    out = []
    for place, listed in jobs.items():
        hands: list[list[_Job]] = [[] for _ in range(min(len(listed), max(1, -(-tasks // len(jobs)))))]
        for job in sorted(listed, key=cost, reverse=True):
            min(hands, key=lambda hand: sum(map(cost, hand))).append(job)
        out += [(place, hand) for hand in hands]
    return sorted(out, key=lambda x: -sum(map(cost, x[1])))


def _grow_in_tasks(spark: SparkSession, blocks: DataFrame, jobs: dict[int, list[_Job]]) -> dict[int, list[Tree]]:
    """model -> trees. Each task receives the blocks of one table; the driver receives tree tables."""
    dealt = _dealt(jobs, 2 * spark.sparkContext.defaultParallelism)
    wanted: dict[int, list[int]] = {}
    for i, (place, _) in enumerate(dealt):
        wanted.setdefault(place, []).append(i)

    def grow(rows: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int, list[Tree]]]:
        held: dict[int, list[_Block]] = {}
        for task, row in rows:
            held.setdefault(task, []).append(_Block.of(row))
        for task, found in held.items():
            for job in dealt[task][1]:
                yield job.model, _grown_whole(found, job)

    copies = blocks.rdd.map(tuple).flatMap(lambda row: [(i, row) for i in wanted.get(row[0], ())])
    return dict(copies.partitionBy(len(dealt), lambda k: k).mapPartitions(grow).collect())


# --- models ------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class BoostedModel:
    """A fitted model: borders of its columns, base margin and trees."""

    columns: tuple[str, ...]
    borders: tuple[np.ndarray, ...]
    base: float
    growth: Growth
    trees: tuple[Tree, ...]

    def probability(self, columns: Sequence[Column]) -> Column:
        """Positive-class probability from the model's columns, in their order."""
        borders, base, trees = self.borders, self.base, [flat(t, self.growth) for t in self.trees]

        def score(values: pd.DataFrame) -> pd.Series:
            bins = np.empty((len(borders), len(values)), np.uint8)
            for i, b in enumerate(borders):
                bins[i] = bins_of(values.iloc[:, i].to_numpy(np.float64), b)
            margin = np.full(len(values), base)
            for tree in trees:
                margin += tree.value[tree.place(bins)]
            return pd.Series(1.0 / (1.0 + np.exp(-margin)))

        cells = F.struct(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
        return F.pandas_udf(score, "double")(cells)

    def importances(self) -> np.ndarray:
        """Share of each column in the summed gains of all splits."""
        total = np.zeros(len(self.columns))
        for tree in self.trees:
            for column, gain in zip(tree.column, tree.gain):
                if column >= 0:
                    total[column] += gain
        return total / total.sum() if total.sum() > 0 else total

    def tree_rows(self) -> list[tuple]:
        """One row for every node, in the columns of TREE_TABLE."""
        rows = []
        for t, tree in enumerate(self.trees):
            paths = {0: ""}
            for node, column in enumerate(tree.column):
                g, h, n = tree.sums[node]
                inner = column >= 0
                border = None
                if inner:
                    paths[tree.left[node]], paths[tree.right[node]] = paths[node] + "l", paths[node] + "r"
                    if tree.bin[node] < len(self.borders[column]):
                        border = float(self.borders[column][tree.bin[node]])
                rows.append((
                    t, node, paths[node], self.columns[column] if inner else None, border, tree.left[node] if inner else None, tree.right[node] if inner else None,
                    float(tree.gain[node]) if inner else None, g / SCALE, h / SCALE, n, None if inner else leaf_value(tree.sums[node], self.growth),
                ))
        return rows


TREE_TABLE = (
    "tree int, node int, path string, feature string, threshold double, left_node int, right_node int, gain double, gradient double, hessian double, n_rows bigint, leaf double"
)


def tree_table(spark: SparkSession, models: dict[str, BoostedModel]) -> DataFrame:
    """The published form of fitted models: one row per node. A split without threshold parts what is present from what is missing."""
    rows = [(name, *row) for name, m in models.items() for row in m.tree_rows()]
    return spark.createDataFrame(rows, f"model string, {TREE_TABLE}")


@dataclass(frozen=True)
class Wanted:
    """One model to fit: its table, how it grows and which of the table's row weights it uses."""

    training: Training
    growth: Growth
    weight: int = 0


def _key(training: Training) -> Column:
    if training.key:
        return F.xxhash64(F.col(quoted(training.key)))
    return F.xxhash64(*[F.col(quoted(c)) for c in training.columns], F.col(quoted(training.label)))


def _blocks_of(place: int, t: Training, wanted: list[Wanted], bins: int, block_rows: int, task_bytes: int) -> tuple[DataFrame, list[np.ndarray], list[float], int]:
    """(blocks, borders, base margin of each model, number of blocks) of one table; 0 blocks: its models are grown in single tasks."""
    borders = [np.array(b, np.float64) for b in t.borders] if t.borders else borders_of(t.frame, t.columns, bins)
    label = F.col(quoted(t.label)).cast("double")
    sums = t.frame.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(w.cast("double") * label).alias(f"p{j}") for j, w in enumerate(t.weights)],
        *[F.sum(w.cast("double") * (1 - label)).alias(f"q{j}") for j, w in enumerate(t.weights)],
    ).first()
    base = []
    for w in wanted:
        positives, negatives = sums[f"p{w.weight}"], sums[f"q{w.weight}"]
        if not (positives or 0) > 0 or not (negatives or 0) > 0:
            raise ValueError("label must be binary 0/1 with both classes present")
        base.append(math.log(positives / negatives))
    cells = [F.col(quoted(c)).cast("double").alias(f"c{j}") for j, c in enumerate(t.columns)]
    rows = t.frame.select(*cells, label.cast("int").alias("label"), _key(t).alias("key"), *[w.cast("double").alias(f"w{j}") for j, w in enumerate(t.weights)])
    blocks = max(1, -(-sums["n"] // block_rows))
    # Per row: bins, and those of a tree's sample, label, key, weights; margin, gradient, hessian, node and what sums need for a moment.
    small = sums["n"] * (2 * len(t.columns) + 8 * len(t.weights) + 64) <= task_bytes
    # A task gathers the rows of one block at most, so no more tasks than blocks are needed.
    packed = rows.coalesce(blocks).mapInArrow(_pack(place, borders, len(t.weights), np.array([] if small else base), block_rows), BLOCK)
    return packed, borders, base, 0 if small else blocks


def fit_models(
    spark: SparkSession, wanted: dict[Any, Wanted], bins: int = BINS, block_rows: int = BLOCK_ROWS, task_bytes: int = TASK_BYTES,
) -> dict[Any, BoostedModel]:
    """Fit all models together: those of small tables whole in tasks, the others in passes that they share."""
    tables: list[Training] = []
    for w in wanted.values():
        if not any(w.training is t for t in tables):
            tables.append(w.training)
    place_of = {id(t): i for i, t in enumerate(tables)}
    by_place: dict[int, list[Any]] = {i: [] for i in range(len(tables))}
    for name, w in wanted.items():
        by_place[place_of[id(w.training)]].append(name)
    made = side_by_side(spark, [partial(_blocks_of, i, t, [wanted[n] for n in by_place[i]], bins, block_rows, task_bytes) for i, t in enumerate(tables)])
    borders, sizes = [m[1] for m in made], [m[3] for m in made]
    base = {n: b for i, m in enumerate(made) for n, b in zip(by_place[i], m[2])}
    trees: dict[Any, list[Tree]] = {}
    small, large = [i for i, n in enumerate(sizes) if not n], [i for i, n in enumerate(sizes) if n]
    if small:
        names = list(wanted)
        number = {n: i for i, n in enumerate(names)}
        blocks = _staged_blocks([made[i][0] for i in small])
        jobs = {
            i: [_Job(number[n], wanted[n].weight, base[n], wanted[n].growth, len(wanted[n].training.columns), _width(borders[i])) for n in by_place[i]] for i in small
        }
        trees |= {names[i]: t for i, t in _grow_in_tasks(spark, blocks, jobs).items()}
        release(blocks)
    if large:
        blocks = _staged_blocks([made[i][0] for i in large])
        trees |= _grow_in_passes(spark, blocks, {i: sizes[i] for i in large}, {i: {n: wanted[n] for n in by_place[i]} for i in large}, borders)
        release(blocks)
    return {
        n: BoostedModel(w.training.columns, tuple(borders[place_of[id(w.training)]]), base[n], w.growth, tuple(trees[n])) for n, w in wanted.items()
    }


def _staged_blocks(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return stage(whole, "boost-blocks")


def _width(borders: list[np.ndarray]) -> int:
    """Bins of a table's widest column, with the one of what is missing."""
    return max((len(b) for b in borders), default=0) + 2


def _grow_in_passes(spark: SparkSession, blocks: DataFrame, sizes: dict[int, int], by_place: dict[int, dict[Any, Wanted]], borders: list[list[np.ndarray]]) -> dict[Any, list[Tree]]:
    """All models of large tables, level by level; they share each pass, and a model that has its trees leaves."""
    # Few blocks are copied, so that their models are spread over the executors too.
    chunks = max(1, min(max(map(len, by_place.values())), spark.sparkContext.defaultParallelism // max(1, sum(sizes.values()))))
    data = _Data.of(spark, blocks, list(sizes.values()), chunks)

    wanted = {n: w for listed in by_place.values() for n, w in listed.items()}
    names = list(wanted)
    # (table, margins) of each model.
    at = {n: (place, slot) for place, listed in by_place.items() for slot, n in enumerate(listed)}
    growers = {n: _Grower(w.growth, len(w.training.columns)) for n, w in wanted.items()}
    applied = dict.fromkeys(names, 0)
    flats: dict[Any, list[FlatTree]] = {n: [] for n in names}
    while any(not g.done for g in growers.values()):
        work = []
        for i, n in enumerate(names):
            g = growers[n]
            if g.done:
                continue
            place, slot = at[n]
            work.append(_Work(
                i, place, slot % chunks, slot, wanted[n].weight, g.growth, len(g.trees), g.columns,
                tuple(flats[n][applied[n]:]), flat(g.tree, g.growth), tuple(g.asked), _width(borders[place]),
            ))
        found = data.best(work)
        for w in work:
            n = names[w.model]
            growers[n].take(found.get(w.model, {}))
            flats[n] += [flat(t, growers[n].growth) for t in growers[n].trees[len(flats[n]):]]
        going = [n for n in names if not growers[n].done]
        if going and max(len(flats[n]) - applied[n] for n in going) >= REFRESH:
            grown: dict[int, list] = {}
            for n in going:
                place, slot = at[n]
                grown.setdefault(place, []).append((slot, tuple(flats[n][applied[n]:])))
                applied[n] = len(flats[n])
            data = data.refreshed(grown)
    data.rows.unpersist()
    return {n: g.trees for n, g in growers.items()}
