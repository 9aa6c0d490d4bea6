"""Second-order boosted trees over binned features, all models grown together.

Rows are turned into small bin numbers once, by edges learned from all training rows. A tree grows
level by level for all models at once: every task adds up gradient and hessian per (model, node,
feature, bin) over its rows, the sums of tasks are added, and the driver picks the best split of
each node from them. The sums' size is fixed by models, nodes and bins, whatever the number of rows.

While no target has more than `Growth.rows_alone` training rows, the rows are dealt to one task a model,
and each task grows its trees without waiting for others, all in one job. It keeps the rows in the order of
their nodes and adds up only the smaller child of a split; the other child is what remains of its parent.
Columns are added up together, by the joint bin of as many as leave the sums in the cache. A lost task costs
its model. The limit bounds a task's memory.

With a target above it, each level of each tree is one job, 1500 for 300 trees of depth 5, so a job's own
cost counts. The rows stand as blocks of arrays in a persisted RDD that starts from a written table: a job
over it costs a fraction of the same sums through a DataFrame plan. A tree's leaf values are moved into the
blocks once, with the first job of the next tree; every ANEW_EVERY trees the blocks are made anew from the
first ones, with the margins of all trees so far, which are broadcast: some 2 MB for ten models of 300 trees.
So a lost block is a few steps from the table, and a job late in training costs what an early one costs.

Gradients and hessians are rounded to a power of two so fine that a double holds every sum of them
exactly. So sums are the same in any order, and a difference is what adding up would have given.

A split sends a row right if its bin is above the split's (numbers) or is the split's (one value of
a categorical column, as a 0/1 column per value would). Gain, leaf value and the least hessian of a
child are those of the usual second-order learner with squared penalty `l2`.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# functions below run in Python workers, which need no import path to this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fewer tasks than this send their sums to the driver directly; more are added up in a tree.
DIRECT_TASKS = 32
#: Marks of rows and trees that are united at once, so that they stay in the processor's cache.
MARKS_AT_ONCE = 131_072
#: Bits of a mark.
WORD = 32
#: Rows whose gradients are made, and added up, at once, for the same reason.
ROWS_ADDED = 65_536
#: Most joint bins of columns that are added up together; so many sums stay in the cache.
JOINT_CELLS = 16_384
#: Rows that a cell of joint sums must save others to repay its own cost.
ROWS_PER_CELL = 8
#: Trees after which blocks are made anew from the first ones.
ANEW_EVERY = 50
#: Bits of a sum of gradients or hessians; a double holds 53.
SUM_BITS = 51
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Growth:
    trees: int
    depth: int
    step: float
    l2: float = 1.0
    least_hessian: float = 1.0
    #: trees after which margins are moved into the blocks
    settle_every: int = 1
    #: training rows of a target up to which a task grows a model by itself, in some 80 bytes a row
    rows_alone: int = 8_000_000


@dataclass
class Encoding:
    """How one target's columns become bin numbers. Numbers come before categorical columns."""

    medians: dict[str, float]
    edges: dict[str, list[float]]
    values: dict[str, list[str]]

    def widths(self) -> list[int]:
        # a value not met in training has a number of its own, behind the others
        return [len(e) + 1 for e in self.edges.values()] + [len(v) + 1 for v in self.values.values()]

    def names(self) -> list[list[str]]:
        """Per column the name of the feature that a split at each bin asks for."""
        numbers = [[c] * (len(e) + 1) for c, e in self.edges.items()]
        return numbers + [[f"{c}_{v}" for v in [*vs, ""]] for c, vs in self.values.items()]

    def bins(self, batch: pa.RecordBatch) -> np.ndarray:
        """Bin numbers, a row per row of the batch, which holds the columns by name."""
        out = np.empty((batch.num_rows, len(self.edges) + len(self.values)), np.uint16)
        for j, (c, edges) in enumerate(self.edges.items()):
            x = batch.column(c).to_numpy(zero_copy_only=False).astype(float)
            out[:, j] = np.searchsorted(edges, np.where(np.isnan(x), self.medians[c], x), "left")
        for j, (c, values) in enumerate(self.values.items(), len(self.edges)):
            known = pa.array(values, batch.column(c).type)
            out[:, j] = pc.fill_null(pc.index_in(batch.column(c), known), len(values)).to_numpy(zero_copy_only=False)
        return out


@dataclass
class Forest:
    """Trees of one model as arrays (tree, node) in heap order; column -1 marks a leaf."""

    column: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    numeric: int

    def margins(self, bins: np.ndarray) -> np.ndarray:
        """The sum of the leaf values that each row reaches, added up tree by tree.

        All places of a tree's lowest level are bits of one number. A node that sends a row right rules out
        the places below its left child, so a row ends in the lowest place that no node rules out. Per column
        and bin the places that are left stand in one line for all trees, and a row's lines are united by AND.
        Below a leaf all nodes send left, so its value stands in the first place below it.
        """
        trees, nodes = self.value.shape
        inner, value, width = nodes // 2, self.value.copy(), nodes - nodes // 2
        for node in range(inner):
            leaf = self.column[:, node] < 0
            value[leaf, 2 * node + 1] = value[leaf, node]
        value = np.ascontiguousarray(value[:, inner:]).ravel()
        words = -(-width // WORD)
        lines = [(j, self._left(int(j), words)) for j in np.unique(self.column[self.column >= 0])]
        first, at_once = np.arange(trees) * width, max(1, MARKS_AT_ONCE // max(trees * words, 1))
        out = np.zeros(len(bins))
        for i in range(0, len(bins) if trees else 0, at_once):
            part = bins[i : i + at_once]
            left = np.full((len(part), words, trees), 2**WORD - 1, np.uint32)
            more = np.empty_like(left)
            for j, line in lines:
                np.take(line, part[:, j], axis=0, out=more, mode="clip")
                left &= more
            place = _lowest(left[:, 0])
            for word in range(1, words):
                place = np.where(left[:, :word].any(axis=1), place, WORD * word + _lowest(left[:, word]))
            out[i : i + at_once] = np.cumsum(value.take(place + first), axis=1)[:, -1]
        return out

    def _left(self, j: int, words: int) -> np.ndarray:
        """The places that the splits on a column leave, (bin, word, tree); the last bin stands for all above."""
        inner = self.column.shape[1] // 2
        tree, node = np.nonzero(self.column[:, :inner] == j)
        at = self.bin[tree, node].astype(np.int64)
        line = np.full((int(at.max()) + 2, words, self.column.shape[0]), 2**WORD - 1, np.uint32)
        x = np.arange(len(line))
        for t, v, b in zip(tree.tolist(), node.tolist(), at.tolist()):
            level = (v + 1).bit_length() - 1
            below = (inner + 1) >> level
            start, gone = (v + 1 - (1 << level)) * below, (1 << below // 2) - 1
            right = x > b if j < self.numeric else x == b
            for word in range(words):
                bits = (gone << start >> WORD * word) & (2**WORD - 1)
                if bits:
                    line[right, word, t] &= np.uint32(2**WORD - 1 - bits)
        return line

    def probabilities(self, bins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margins(bins)))


def _lowest(marks: np.ndarray) -> np.ndarray:
    """The number of the lowest bit of each number; a power of two is exact as a float, which holds its exponent."""
    return ((marks & -marks).astype(np.float32).view(np.int32) >> 23) - 127


def _walk(bins, numeric: int, column, at, model) -> np.ndarray:
    """The node that each row reaches in its model's tree."""
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(int(np.log2(column.shape[1] + 1))):
        j = column[model, node]
        inner = j >= 0
        if not inner.any():
            break
        x, split = bins[rows, j], at[model, node]
        right = np.where(j < numeric, x > split, x == split)
        node = np.where(inner, 2 * node + 1 + right, node)
    return node


#: Column, bin and value of the nodes of one tree of every model of a feature set.
Settled = tuple[np.ndarray, np.ndarray, np.ndarray]


@dataclass
class _Tree:
    """One tree of every model of a feature set while it grows."""

    column: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    totals: np.ndarray = field(repr=False)

    def settled(self) -> Settled:
        """What a row's walk needs. Plain arrays: a broadcast is read without this module."""
        return self.column, self.bin.astype(np.uint16), self.value

    @staticmethod
    def new(models: int, depth: int) -> _Tree:
        nodes = (models, 2 ** (depth + 1) - 1)
        return _Tree(
            np.full(nodes, -1, np.int16), np.zeros(nodes, np.int32), np.zeros(nodes), np.zeros(nodes), np.zeros((2, *nodes))
        )


@dataclass(frozen=True)
class _Shape:
    """Columns and where each one's bins stand among the cells of a node."""

    numeric: int
    widths: tuple[int, ...]
    #: per feature set the columns that its models may split on
    sets: tuple[tuple[int, ...], ...]
    models: int
    #: gradients and hessians are multiples of one over this; 0: as they are
    parts: float = 0.0

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.widths)])


Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _exact_parts(weight: float) -> float:
    """The largest power of two by which sums of rows of this weight in all are exact."""
    return 2.0 ** (SUM_BITS - int(np.ceil(np.log2(max(weight, 1.0)))))


def _slopes(shape: _Shape, label, weight, margins) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of each row."""
    p = 1.0 / (1.0 + np.exp(-margins))
    found = weight * (p - label), weight * p * (1.0 - p)
    return tuple(np.rint(x * shape.parts) / shape.parts for x in found) if shape.parts else found


def _level_sums(shape: _Shape, blocks, settled: list[list[Settled]], growing: list[_Tree], level: int, asked):
    """Sums (feature set, gradient or hessian, model and pair of nodes of the level, cell) over some blocks.

    Of each pair only one node is added up: `asked` tells per feature set, model and node which.
    """
    first, pairs, starts = 2**level - 1, max(2**level // 2, 1), shape.starts
    places = shape.models * pairs
    out = np.zeros((len(shape.sets), 2, places, int(starts[-1])))
    for block in blocks:
        model, bins, label, weight, margins = _settle(shape, block, settled)
        for s, tree in enumerate(growing):
            at = _walk(bins, shape.numeric, tree.column, tree.bin, model) - first
            open_ = np.flatnonzero((at >= 0) & asked[s][model, np.maximum(at, 0)])
            rows = bins[open_]
            parts = _slopes(shape, label[open_], weight[open_], margins[s, open_])
            place = model[open_] * pairs + (at[open_] >> 1)
            for j in shape.sets[s]:
                width = shape.widths[j]
                key = place * width + rows[:, j]
                for k, part in enumerate(parts):
                    found = np.bincount(key, part, places * width).reshape(places, width)
                    out[s, k, :, starts[j] : starts[j + 1]] += found
    return out


def _settle(shape: _Shape, block: Block, trees: list[list[Settled]]) -> Block:
    """The block with the leaf values of some trees added to its margins."""
    model, bins, label, weight, margins = block
    if not trees:
        return block
    margins = margins.copy()
    for growing in trees:
        for s, (column, at, value) in enumerate(growing):
            margins[s] += value[model, _walk(bins, shape.numeric, column, at, model)]
    return model, bins, label, weight, margins


def _anew(shape: _Shape, block: Block, done: Grown) -> Block:
    """The block with the margins of all trees so far."""
    model, bins, label, weight, margins = block
    margins, forests = np.zeros_like(margins), _forests(shape, done)
    for m in np.unique(model).tolist():
        mine = np.flatnonzero(model == m)
        for s, row in enumerate(forests):
            margins[s, mine] = row[m].margins(bins[mine])
    return model, bins, label, weight, margins


def best_splits(sums: np.ndarray, shape: _Shape, columns: Sequence[int], growth: Growth):
    """Per node: gain, column, bin and the two children's sums of the best split; gain 0 for none.

    `sums` is (gradient or hessian, node, cell). Ties go to the first column, then the first bin.
    """
    starts = shape.starts
    total = sums[:, :, starts[columns[0]] : starts[columns[0] + 1]].sum(axis=2)

    def worth(g, h):
        return g * g / (h + growth.l2)

    nodes = np.arange(total.shape[1])
    best = np.full(len(nodes), LEAST_GAIN)
    column, at = np.full(len(nodes), -1), np.zeros(len(nodes), np.int64)
    right = np.zeros_like(total)
    for j in columns:
        cells = sums[:, :, starts[j] : starts[j + 1]]
        # right of a number's bin are all bins above it; right of a value is the value alone
        gone = total[:, :, None] - np.cumsum(cells, axis=2) if j < shape.numeric else cells
        left = total[:, :, None] - gone
        gain = worth(*left) + worth(*gone) - worth(*total)[:, None]
        gain[(left[1] < growth.least_hessian) | (gone[1] < growth.least_hessian)] = 0.0
        b = gain.argmax(axis=1)
        better = gain[nodes, b] > best
        best[better], column[better], at[better] = gain[nodes, b][better], j, b[better]
        right[:, better] = gone[:, nodes, b][:, better]
    return np.where(column >= 0, best, 0.0), column, at, total - right, right


def _extend(tree: _Tree, sums: np.ndarray, shape: _Shape, columns: Sequence[int], level: int, growth: Growth) -> bool:
    """Splits the nodes of a level, or ends them as leaves; whether any was split."""
    first, nodes = 2**level - 1, 2**level
    gain, column, at, left, right = best_splits(sums, shape, columns, growth)
    here = slice(first, first + nodes)
    tree.column[:, here], tree.bin[:, here] = column.reshape(-1, nodes), at.reshape(-1, nodes)
    tree.gain[:, here] = gain.reshape(-1, nodes)
    if level == 0:
        starts = shape.starts
        tree.totals[:, :, 0] = sums[:, :, starts[columns[0]] : starts[columns[0] + 1]].sum(axis=2)
    model, node = np.nonzero(tree.column[:, here] >= 0)
    k = model * nodes + node
    for side, part in enumerate((left, right), 1):
        tree.totals[:, model, 2 * (first + node) + side] = part[:, k]
    return bool(len(model))


def _end(tree: _Tree, growth: Growth) -> None:
    g, h = tree.totals
    tree.value = np.where(tree.column < 0, -growth.step * g / (h + growth.l2), 0.0)


def _grow_trees(shape: _Shape, growth: Growth, sums: Callable[[list[_Tree], int, list], np.ndarray]) -> list[_Tree]:
    """One tree per feature set for all models; `sums` adds up a level of the trees as they are.

    Of the children of a split the lighter one is added up; the other is what remains of the parent.
    """
    growing = [_Tree.new(shape.models, growth.depth) for _ in shape.sets]
    found = None
    for level in range(growth.depth):
        first, nodes = 2**level - 1, 2**level
        if level == 0:
            found = sums(growing, 0, [np.ones((shape.models, 1), bool) for _ in growing])
        else:
            split = [tree.column[:, first // 2 : first] >= 0 for tree in growing]
            left, right = ([t.totals[1, :, first + k : first + nodes : 2] for t in growing] for k in (0, 1))
            light = [r <= l for l, r in zip(left, right)]
            asked = [np.stack([x & ~r, x & r], 2).reshape(shape.models, nodes) for x, r in zip(split, light)]
            mine = sums(growing, level, asked)
            # (feature set, gradient or hessian, model and parent, side, cell)
            there = np.array(split).reshape(len(growing), 1, -1, 1)
            rest = np.where(there, found - mine, 0.0)
            goes = np.array(light).reshape(len(growing), 1, -1, 1)
            found = np.stack([np.where(goes, rest, mine), np.where(goes, mine, rest)], 3)
            found = found.reshape(*rest.shape[:2], -1, rest.shape[-1])
        more = [_extend(t, found[s], shape, shape.sets[s], level, growth) for s, t in enumerate(growing)]
        if not any(more):
            break
    for tree in growing:
        _end(tree, growth)
    return growing


#: Per tree and feature set the arrays of the models' nodes: column, bin, value, gain.
Grown = list[list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]


def _plain(growing: list[_Tree]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    return [(t.column, t.bin, t.value, t.gain) for t in growing]


class _Joint:
    """The bins of some columns as one number a row, their joint bin, and the way back to each column."""

    def __init__(self, shape: _Shape, columns: Sequence[int]):
        self.columns, self.dims = tuple(columns), tuple(shape.widths[j] for j in columns)
        self.cells = int(np.prod(self.dims))
        places = np.unravel_index(np.arange(self.cells), self.dims)
        #: per column the bin that each joint bin holds
        self.bins = {j: place.astype(np.uint16) for j, place in zip(self.columns, places)}

    @staticmethod
    def groups(shape: _Shape, columns: Sequence[int], rows: int) -> list[_Joint]:
        """All columns, the widest first, each in the first group whose joint bins stay few beside the rows."""
        most = min(JOINT_CELLS, rows // ROWS_PER_CELL)
        found: list[list[int]] = []
        for j in sorted(columns, key=lambda j: -shape.widths[j]):
            cells = [int(np.prod([shape.widths[k] for k in [*group, j]])) for group in found]
            place = next((i for i, n in enumerate(cells) if n <= most), None)
            found.append([j]) if place is None else found[place].append(j)
        # narrow columns first: sums over them then run along whole rows of cells
        return [_Joint(shape, group[::-1]) for group in found]

    def keys(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bins), np.intp)
        for j, width in zip(self.columns, self.dims):
            out = out * width + bins[:, j]
        return out.astype(np.uint16)


def _grow_alone(shape: _Shape, growth: Growth, groups: Sequence[_Joint], keys: Sequence[np.ndarray], label, weight):
    """The trees of one model, whose rows are all here; `keys` holds the joint bins of each group of columns."""
    columns, starts = shape.sets[0], shape.starts
    margins, slopes = np.zeros(len(label)), (np.empty(len(label)), np.empty(len(label)))
    cells, joint_cells = int(starts[-1]), sum(group.cells for group in groups if len(group.columns) > 1)
    of = {j: i for i, group in enumerate(groups) for j in group.columns}

    def cut(rows) -> list:
        """Some rows, None for all, in parts whose values stay in the cache."""
        n = len(label) if rows is None else len(rows)
        parts = [slice(i, min(i + ROWS_ADDED, n)) for i in range(0, n, ROWS_ADDED)]
        return parts if rows is None else [rows[part].astype(np.intp) for part in parts]

    def at_rows(x, here):
        return x[here] if isinstance(here, slice) else x.take(here)

    def added(rows) -> np.ndarray:
        """Sums (gradient or hessian, cell) over some rows, None for all."""
        out = np.zeros((2, cells))
        # a joint histogram costs its cells, which few rows don't repay
        joint = rows is None or len(rows) * ROWS_PER_CELL >= joint_cells
        sums = [np.zeros((2, group.cells)) for group in groups] if joint else []
        for here in cut(rows):
            given = [at_rows(x, here) for x in slopes]
            for i, group in enumerate(groups):
                key = at_rows(keys[i], here).astype(np.intp)
                if joint:
                    for k, x in enumerate(given):
                        sums[i][k] += np.bincount(key, x, group.cells)
                    continue
                for j in group.columns:
                    x = key if len(group.columns) == 1 else group.bins[j].take(key)
                    for k, values in enumerate(given):
                        out[k, starts[j] : starts[j + 1]] += np.bincount(x, values, shape.widths[j])
        for group, found in zip(groups, sums):
            for j, width in zip(group.columns, group.dims):
                found = found.reshape(2, width, -1)
                out[:, starts[j] : starts[j + 1]] = found.sum(axis=2)
                found = found.sum(axis=1)
        return out

    def sides(rows, goes: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
        """The rows whose joint bin goes left, and those whose goes right."""
        found = []
        for here in cut(rows):
            right = goes.take(at_rows(key, here))
            if isinstance(here, slice):
                found.append([(np.flatnonzero(x) + here.start).astype(np.int32) for x in (~right, right)])
            else:
                found.append([here.compress(x).astype(np.int32) for x in (~right, right)])
        return [np.concatenate(x) for x in zip(*found)]

    for _ in range(growth.trees):
        for here in cut(None):
            for whole, x in zip(slopes, _slopes(shape, label[here], weight[here], margins[here])):
                whole[here] = x
        tree = _Tree.new(1, growth.depth)
        # rows and sums of the nodes of a level that may still be split
        open_ = {0: (None, added(None))}
        # rows of nodes that end, and of nodes that are split in the last level
        leaves, last = [], []
        for level in range(growth.depth):
            first, nodes = 2**level - 1, 2**level
            sums = np.zeros((2, nodes, cells))
            for node, (_, found) in open_.items():
                sums[:, node - first] = found
            more = _extend(tree, sums, shape, columns, level, growth)
            below = {}
            for node, (rows, found) in open_.items():
                j = tree.column[0, node]
                if j < 0:
                    leaves.append((node, rows))
                    continue
                key, at, bins = keys[of[j]], tree.bin[0, node], groups[of[j]].bins[j]
                # looked up by joint bin
                goes = bins > at if j < shape.numeric else bins == at
                if level == growth.depth - 1:
                    last.append((node, rows, goes, key))
                    continue
                parts = sides(rows, goes, key)
                less = int(len(parts[1]) < len(parts[0]))
                mine = added(parts[less])
                both = (found - mine, mine) if less else (mine, found - mine)
                below |= {2 * node + 1 + side: (parts[side], both[side]) for side in (0, 1)}
            open_ = below
            if not more:
                break
        _end(tree, growth)
        for node, rows in leaves:
            for here in cut(rows):
                margins[here] += tree.value[0, node]
        for node, rows, goes, key in last:
            value = np.where(goes, tree.value[0, 2 * node + 2], tree.value[0, 2 * node + 1])
            for here in cut(rows):
                margins[here] += value.take(at_rows(key, here))
        yield _plain([tree])[0]


def _grow_by_models(base: RDD, shape: _Shape, growth: Growth) -> Grown:
    """A task per feature set and target holds its rows and grows all trees of its model."""
    sets = len(shape.sets)

    def dealt(number, part):
        for turn, (model, bins, label, weight, _) in enumerate(part):
            for m in np.unique(model).tolist():
                mine = model == m
                for s in range(sets):
                    yield m * sets + s, ((number, turn), bins[mine], label[mine], weight[mine])

    def grown(number, part):
        # in the order of the table, so that sums of doubles are the same in every run
        found = sorted((piece for _, piece in part), key=lambda piece: piece[0])
        if not found:
            return
        alone = replace(shape, sets=(shape.sets[number % sets],), models=1)
        groups = _Joint.groups(alone, alone.sets[0], sum(len(piece[2]) for piece in found))
        keys = [np.concatenate([group.keys(piece[1]) for piece in found]) for group in groups]
        label, weight = (np.concatenate([piece[k] for piece in found]) for k in (2, 3))
        del found
        for tree in _grow_alone(alone, growth, groups, keys, label, weight):
            yield number, tree

    models = base.mapPartitionsWithIndex(dealt).partitionBy(shape.models * sets, lambda number: number)
    trees: dict[int, list] = {}
    for number, tree in models.mapPartitionsWithIndex(grown).collect():
        trees.setdefault(number, []).append(tree)

    def together(t: int, s: int):
        return tuple(np.concatenate([trees[m * sets + s][t][k] for m in range(shape.models)]) for k in range(4))

    return [[together(t, s) for s in range(sets)] for t in range(growth.trees)]


def _grow_by_levels(base: RDD, shape: _Shape, growth: Growth) -> Grown:
    """A job per level of a tree adds up the sums of all tasks."""
    state, pending, done, shared = base, [], [], []
    direct = base.getNumPartitions() <= DIRECT_TASKS
    for _ in range(growth.trees):
        def added(now, level, asked):
            def sums(part, trees=pending):
                yield _level_sums(shape, part, trees, now, level, asked)

            job = state.mapPartitions(sums)
            return sum(job.collect()) if direct else job.treeReduce(np.add)

        growing = _grow_trees(shape, growth, added)
        # the blocks before these are needed no more: the job has stored these
        for old in shared[:-1]:
            old.unpersist()
        shared = shared[-1:]
        done.append(growing)
        pending = [*pending, [tree.settled() for tree in growing]]
        if len(pending) >= growth.settle_every:
            anew = len(done) // ANEW_EVERY > (len(done) - len(pending)) // ANEW_EVERY
            if anew:
                # all trees so far on the first blocks, so that a lost block is a few steps from the table
                # plain arrays: a broadcast is read without this module
                so_far = base.context.broadcast([_plain(trees) for trees in done])
                state = base.map(lambda block, trees=so_far: _anew(shape, block, trees.value)).persist()
            else:
                state = state.map(lambda block, trees=pending: _settle(shape, block, trees)).persist()
            shared.append(state)
            pending = []
    for old in shared:
        old.unpersist()
    return [_plain(trees) for trees in done]


def _forests(shape: _Shape, done: Grown) -> list[list[Forest]]:
    def forest(s: int, m: int) -> Forest:
        return Forest(*(np.array([trees[s][k][m] for trees in done]) for k in range(4)), shape.numeric)

    return [[forest(s, m) for m in range(shape.models)] for s in range(len(shape.sets))]


def grow(blocks: RDD, shape: _Shape, growth: Growth) -> list[list[Forest]]:
    """The forests of each feature set and model. `blocks` are rebuilt from storage when lost."""
    base = blocks.persist()
    def sizes(block):
        return np.array([np.bincount(block[0], part, shape.models) for part in (None, block[3])])

    rows, weights = base.map(sizes).treeReduce(np.add)
    shape = replace(shape, parts=_exact_parts(weights.max()))
    alone = rows.max() <= growth.rows_alone
    done = (_grow_by_models if alone else _grow_by_levels)(base, shape, growth)
    base.unpersist()
    return _forests(shape, done)


# --- from and to tables -------------------------------------------------------------------
BLOCKS = "n int, model binary, bins binary, label binary"


def encoded(rows: DataFrame, encodings: Mapping[str, Encoding]) -> DataFrame:
    """Training rows (TARGET_NAME, LABEL and features) as blocks of bin numbers, one per batch."""
    order = {target: i for i, target in enumerate(encodings)}

    def run(batches):
        for batch in batches:
            targets = np.array([order[t] for t in batch.column("TARGET_NAME").to_pylist()], np.int16)
            label = batch.column("LABEL").to_numpy().astype(np.int8)
            bins = np.zeros((batch.num_rows, len(next(iter(encodings.values())).widths())), np.uint16)
            for target, i in order.items():
                mine = np.flatnonzero(targets == i)
                if mine.size:
                    bins[mine] = encodings[target].bins(batch.take(pa.array(mine)))
            columns = [[len(targets)], [targets.tobytes()], [bins.tobytes()], [label.tobytes()]]
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["n", "model", "bins", "label"]
            )

    columns = next(iter(encodings.values()))
    return rows.select("TARGET_NAME", "LABEL", *columns.edges, *columns.values).mapInArrow(run, BLOCKS)


def fit(
    blocks: DataFrame,
    encodings: Mapping[str, Encoding],
    weights: Mapping[str, float],
    sets: Sequence[Sequence[str]],
    growth: Growth,
) -> list[dict[str, Forest]]:
    """Per feature set the forest of each target. `blocks` must be a written table of encoded rows."""
    some = next(iter(encodings.values()))
    columns = [*some.edges, *some.values]
    widths = tuple(int(w) for w in np.max([e.widths() for e in encodings.values()], axis=0))
    chosen = tuple(tuple(columns.index(c) for c in names) for names in sets)
    shape = _Shape(len(some.edges), widths, chosen, len(encodings))
    positive = np.array([weights[t] for t in encodings])

    def opened(row) -> Block:
        model = np.frombuffer(row["model"], np.int16).astype(np.int64)
        bins = np.frombuffer(row["bins"], np.uint16).reshape(row["n"], -1)
        bins = bins.astype(np.uint8) if max(widths) <= 256 else bins
        label = np.frombuffer(row["label"], np.int8)
        weight = np.where(label == 1, positive[model], 1.0)
        return model, bins, label, weight, np.zeros((len(chosen), row["n"]))

    forests = grow(blocks.rdd.map(opened), shape, growth)
    return [dict(zip(encodings, row)) for row in forests]


def probabilities(df: DataFrame, models: Mapping[str, tuple[Encoding, Forest]]) -> DataFrame:
    """df with PROBABILITIES, an array of every model's probability in the order of `models`."""
    columns, chosen = df.columns, list(models.values())
    schema = df.select("*", F.array().cast("array<double>").alias("PROBABILITIES")).schema

    def run(batches):
        for batch in batches:
            scores = [f.probabilities(e.bins(batch)) for e, f in chosen]
            flat = pa.array(np.array(scores).T.ravel() if scores else np.zeros(0))
            steps = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(chosen))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(steps, flat)], [*columns, "PROBABILITIES"]
            )

    return df.mapInArrow(run, schema)


def probability_by_target(df: DataFrame, models: Mapping[str, tuple[Encoding, Forest]]) -> DataFrame:
    """df with PROBABILITY by the model of the row's TARGET_NAME, null where there is none."""
    columns = df.columns
    schema = df.select("*", F.lit(None).cast("double").alias("PROBABILITY")).schema
    models = dict(models)

    def run(batches):
        for batch in batches:
            targets, out = np.array(batch.column("TARGET_NAME").to_pylist(), object), np.full(batch.num_rows, np.nan)
            for target, (encoding, forest) in models.items():
                mine = np.flatnonzero(targets == target)
                if mine.size:
                    out[mine] = forest.probabilities(encoding.bins(batch.take(pa.array(mine))))
            found = pa.array(out, mask=np.isnan(out))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*columns, "PROBABILITY"])

    return df.mapInArrow(run, schema)
