"""Trees over sparse vectors, from histograms that tasks sum in numpy: what boosting, trees and forests share.

Every value is one cell: a feature with one value besides zero has one, other features one per bin between their cuts. Rows
are packed once into blocks, a batch of rows each as a few arrays, and written; a pass over the table moves whole arrays, not
rows. Zeros are never stored or summed: what they add up to is a node's total less its entries.

A level of one or more trees is one pass. A task sends its rows down the trees, sums ``g`` and ``h`` by open node and cell,
and gives one row per cell it has seen. The best split of a node is the one with the largest
``GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)``. With ``g`` the negative target and ``h`` the weight that is the
loss of variance, and for targets 0 and 1 half the loss of Gini impurity, times the weight; with derivatives of the logistic
loss it is the gain of boosting by second derivatives. Cells are summed and searched by position on executors, which give one
row per partition and open node; histograms of at most so many cells as the caller says go to the driver instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickcast.operators.encode import vector_arrays

# A gain below this is rounding.
LEAST_GAIN = 1e-6
# Cells that a task sums in two arrays of 8 bytes each; beyond that it sorts the cells of each block.
TASK_CELLS = 4_000_000
# Rows go down a tree by a table of their cells at the positions it splits on, if these are no more than this.
TABLE_POSITIONS = 256

BLOCK = {"row": np.int64, "y": np.float64, "ends": np.int32, "cells": np.int32, "state": np.float64}
BLOCK_KIND = ", ".join(f"{c} binary" for c in BLOCK)
# Cells are stored as the first of these, by bytes, that holds all of the layout.
CELL_KINDS = {2: np.uint16, 4: np.int32}
SUMS = pa.schema([("slot", pa.int32()), ("position", pa.int32()), ("bin", pa.int32()), ("g", pa.float64()), ("h", pa.float64())])
SUMS_KIND = "slot int, position int, bin int, g double, h double"


@dataclass
class Tree:
    """A complete binary tree, node n's children being 2n + 1 and 2n + 2: a leaf has position -1."""

    depth: int
    position: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def __post_init__(self):
        n = 2 ** (self.depth + 1) - 1
        self.position, self.cut = self.position or [-1] * n, self.cut or [0] * n
        self.threshold, self.value = self.threshold or [0.0] * n, self.value or [0.0] * n


@dataclass(frozen=True)
class Layout:
    """Where the cells of each position are: at the position itself, or behind all of them by bin."""

    width: int
    cuts: dict[int, list[float]]

    @cached_property
    def several(self) -> np.ndarray:
        return np.array(sorted(self.cuts), np.int64)

    @cached_property
    def bins(self) -> int:
        return max(map(len, self.cuts.values()), default=0) + 1

    @property
    def size(self) -> int:
        return self.width + len(self.several) * self.bins

    def start(self, position: int) -> int:
        return self.width + int(np.searchsorted(self.several, position)) * self.bins

    def span(self, position: int, cut: int) -> tuple[int, int]:
        """The cells that are right of a cut."""
        if position not in self.cuts:
            return position, position + 1
        return self.start(position) + cut, self.start(position) + self.bins

    def cells(self, places: np.ndarray, values: np.ndarray) -> np.ndarray:
        found = places.astype(np.int32)
        for position, cuts in self.cuts.items():
            at = np.flatnonzero(places == position)
            found[at] = self.start(position) + np.searchsorted(cuts, values[at], side="right")
        return found

    def places(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position and bin of cells."""
        position, cut = cells.copy(), np.ones_like(cells)
        at = np.flatnonzero(cells >= self.width)
        position[at] = self.several[(cells[at] - self.width) // self.bins]
        cut[at] = (cells[at] - self.width) % self.bins
        return position, cut


@dataclass
class Block:
    row: np.ndarray
    y: np.ndarray
    ends: np.ndarray
    cells: np.ndarray
    state: np.ndarray

    @cached_property
    def counts(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)

    @cached_property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.y), dtype=np.int32), self.counts)


def _packed(*blocks: Block) -> pa.RecordBatch:
    kind_of = lambda b, c: b.cells.dtype if c == "cells" else BLOCK[c]
    columns = [[np.ascontiguousarray(getattr(b, c), kind_of(b, c)).tobytes() for b in blocks] for c in BLOCK]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=list(BLOCK))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        columns = [batch.column(c) for c in BLOCK]
        for i in range(batch.num_rows):
            found = {c: column[i].as_buffer() for c, column in zip(BLOCK, columns, strict=True)}
            ends = np.frombuffer(found["ends"], BLOCK["ends"])
            entries = int(ends[-1]) if len(ends) else 0
            kinds = BLOCK | {"cells": CELL_KINDS[found["cells"].size // entries]} if entries else BLOCK
            yield Block(*(np.frombuffer(found[c], kind) for c, kind in kinds.items()))


def pack(df: DataFrame, features: str, label: str, layout: Layout, state: float) -> DataFrame:
    """The rows of ``df`` as blocks, each row with the number ``state``; a null label is NaN."""
    v = vector_arrays(df, features)
    places = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    rows = df.select(
        F.monotonically_increasing_id().alias("row"), (F.col(label) > 0.5).cast("double").alias("y"),
        F.when(F.size(v["values"]) > 0, places).otherwise(F.array().cast("array<int>")).alias("places"),
        v["values"].alias("values"),
    )
    return rows.mapInArrow(partial(_pack, layout, state), BLOCK_KIND)


def _pack(layout: Layout, state: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, y, places, values = (batch.column(c) for c in ("row", "y", "places", "values"))
        place, value = (np.asarray(c.flatten()) for c in (places, values))
        owner = np.repeat(np.arange(len(row)), np.asarray(places.value_lengths()))
        used = np.flatnonzero(value != 0)
        ends = np.cumsum(np.bincount(owner[used], minlength=len(row)))
        cells = layout.cells(place[used], value[used])
        if layout.size <= np.iinfo(CELL_KINDS[2]).max:
            cells = cells.astype(CELL_KINDS[2])
        y = np.asarray(y.fill_null(np.nan))
        yield _packed(Block(np.asarray(row), y, ends, cells, np.full(len(y), state)))


# Spark's ``xxhash64``, so that a row's draw is the same here and there.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(x, by: int):
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _mixed(x):
    x = (x ^ (x >> np.uint64(33))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    return x ^ (x >> np.uint64(32))


def drawn(seed: int, turn: int, row: np.ndarray) -> np.ndarray:
    """A draw in [0, 1) per row: ``pmod(xxhash64(seed, turn, row), 2^30) / 2^30`` with ``seed`` and ``turn`` of 32 bits."""
    found = np.array([42], np.uint64)
    for number in (seed, turn):
        found = found + _P5 + np.uint64(4)
        found = found ^ (np.array([number & 0xFFFFFFFF], np.uint64) * _P1)
        found = _mixed(_turned(found, 23) * _P2 + _P3)
    found = (found + _P5 + np.uint64(8)) ^ (_turned(row.astype(np.uint64) * _P2, 31) * _P1)
    found = _mixed(_turned(found, 27) * _P1 + _P4)
    return (found & np.uint64((1 << 30) - 1)).astype(np.float64) / float(1 << 30)


def drawn_feature(seed: int, turn: int, of: str, position: int) -> float:
    """A feature's draw in [0, 1) for a tree or a level of it."""
    return int(hashlib.md5(f"{seed}:{turn}:{of}:{position}".encode()).hexdigest()[:8], 16) / 2**32


@dataclass(frozen=True)
class Pass:
    """What the tasks of one level need. ``slots`` are the open nodes, each the number of its tree and its own.

    ``target(tree, block)`` gives ``g``, ``h`` and which rows count, None for all. ``features`` is how many positions, drawn
    with ``seed``, each node may split on; None for all.
    """

    layout: Layout
    trees: dict[int, Tree]
    slots: list[tuple[int, int]]
    target: Callable
    features: int | None = None
    seed: int = 0

    def spans(self, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
        pairs = [self.layout.span(p, c) if p >= 0 else (0, 0) for p, c in zip(tree.position, tree.cut, strict=True)]
        return tuple(np.array(side, np.int64) for side in zip(*pairs, strict=True))

    def allowed(self) -> np.ndarray | None:
        """Whether a node may split on a cell, by slot and cell."""
        if self.features is None:
            return None
        found = np.zeros((len(self.slots), self.layout.size), bool)
        for i, (tree, node) in enumerate(self.slots):
            chosen = np.random.default_rng([self.seed & 0xFFFFFFFF, tree, node]).permutation(self.layout.width)[: self.features]
            found[i, chosen] = True
            for p in set(chosen.tolist()) & set(self.layout.cuts):
                found[i, self.layout.start(p) : self.layout.start(p) + self.layout.bins] = True
        return found.ravel()


class _Router:
    """Sends rows down a tree."""

    def __init__(self, work: Pass, tree: Tree):
        self.low, self.high = work.spans(tree)
        inner = np.flatnonzero(self.high > 0)
        self.levels = int(inner[-1] + 1).bit_length() if len(inner) else 0
        self.used = np.zeros(work.layout.size, bool)
        for n in inner.tolist():
            self.used[self.low[n] : self.high[n]] = True
        # The column of each node and, from one on, of each used cell.
        positions, column = np.unique(np.array([tree.position[n] for n in inner.tolist()], np.int64), return_inverse=True)
        self.columns = len(positions)
        self.column, self.column_of = np.zeros(len(self.high), np.int64), None
        self.column[inner] = column
        if 0 < self.columns <= TABLE_POSITIONS:
            self.column_of = np.zeros(work.layout.size, np.int16)
            for n, c in zip(inner.tolist(), column.tolist(), strict=True):
                self.column_of[self.low[n] : self.high[n]] = c + 1

    def nodes(self, block: Block) -> np.ndarray:
        node = np.zeros(len(block.y), np.int64)
        if not self.levels:
            return node
        if self.column_of is not None:
            return self._by_table(block, node)
        at = np.flatnonzero(self.used[block.cells])
        cells, owner = block.cells[at], block.owner[at]
        for _ in range(self.levels):
            on = node[owner]
            right = np.zeros(len(node), np.int64)
            right[owner[(cells >= self.low[on]) & (cells < self.high[on])]] = 1
            node = np.where(self.high[node] > 0, 2 * node + 1 + right, node)
        return node

    def _by_table(self, block: Block, node: np.ndarray) -> np.ndarray:
        """The same from a table of cells by row and column, -1 where a row has none that is used."""
        column = self.column_of.take(block.cells)
        at = np.flatnonzero(column > 0)
        table = np.full(len(node) * self.columns, -1, np.int32)
        first = np.arange(len(node)) * self.columns
        table[first.take(block.owner.take(at)) + column.take(at) - 1] = block.cells.take(at)
        for _ in range(self.levels):
            cell, high = table.take(first + self.column.take(node)), self.high.take(node)
            node = np.where(high > 0, 2 * node + 1 + ((cell >= self.low.take(node)) & (cell < high)), node)
        return node


def _reduced(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Keys in order, each once, with the sums of what belongs to it."""
    key, *sums = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], *(np.add.reduceat(s[order], first) if len(key) else s for s in sums)


class _Sums:
    """Sums of ``g`` and ``h`` by key: in arrays over all keys, or in order of key."""

    def __init__(self, keys: int):
        self.keys, self.parts, self.held = keys, [], 0
        self.g, self.h = (np.zeros(keys), np.zeros(keys)) if keys <= TASK_CELLS else (None, None)

    def add(self, key: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
        if self.g is None:
            self.parts.append(_reduced([(key, g, h)]))
            self.held += len(self.parts[-1][0])
            if self.held > TASK_CELLS:
                self.parts = [_reduced(self.parts)]
                self.held = 2 * len(self.parts[0][0]) if len(self.parts[0][0]) < TASK_CELLS else 0
        elif self.keys <= 4 * len(key):
            self.g += np.bincount(key, g, self.keys)
            self.h += np.bincount(key, h, self.keys)
        else:
            np.add.at(self.g, key, g)
            np.add.at(self.h, key, h)

    def found(self) -> tuple[np.ndarray, ...]:
        if self.g is None:
            none = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
            return _reduced(self.parts or [none])
        key = np.flatnonzero((self.g != 0) | (self.h != 0))
        return key, self.g[key], self.h[key]


def _level(work: Pass, only_totals: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of one task; a node's totals have the position -1, its sum of ``g^2 / h`` the position -2."""
    size, count = work.layout.size, len(work.slots)
    allowed = None if only_totals else work.allowed()
    sums = _Sums(0 if only_totals else count * size)
    whole = np.zeros((3, count))
    routers = {}
    for t in {t for t, _ in work.slots}:
        slot = np.full(len(work.trees[t].position), -1, np.int64)
        for i, (own, n) in enumerate(work.slots):
            if own == t:
                slot[n] = i
        routers[t] = _Router(work, work.trees[t]), slot
    for block in _blocks(batches):
        for t, (router, slot_of) in routers.items():
            g, h, kept = work.target(t, block)
            slot = slot_of[router.nodes(block)]
            slot = slot if kept is None else np.where(kept, slot, -1)
            on = np.flatnonzero(slot >= 0)
            squares = np.divide(g[on] ** 2, h[on], out=np.zeros(len(on)), where=h[on] > 0)
            for k, part in enumerate((g[on], h[on], squares)):
                whole[k] += np.bincount(slot[on], part, count)
            if only_totals:
                continue
            cells, counts = block.cells, block.counts
            if len(on) < len(slot):
                cells, counts = cells[np.repeat(slot >= 0, counts)], counts[on]
            key = np.repeat(slot[on] * size, counts) + cells
            g, h = np.repeat(g[on], counts), np.repeat(h[on], counts)
            if allowed is not None:
                chosen = allowed[key]
                key, g, h = key[chosen], g[chosen], h[chosen]
            sums.add(key, g, h)
    slots = np.arange(count, dtype=np.int32)
    none = np.zeros(count, np.int32)
    for position, g, h in ((-1, whole[0], whole[1]), (-2, whole[2], whole[1])):
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (slots, none + np.int32(position), none, g, h)], schema=SUMS)
    key, g, h = sums.found() if not only_totals else (np.zeros(0, np.int64),) * 3
    for i in range(0, len(key), 100_000):
        part = slice(i, i + 100_000)
        position, cut = work.layout.places(key[part] % size)
        columns = (key[part] // size, position, cut)
        arrays = [*(pa.array(c.astype(np.int32)) for c in columns), pa.array(g[part]), pa.array(h[part])]
        yield pa.RecordBatch.from_arrays(arrays, schema=SUMS)


@dataclass(frozen=True)
class Rule:
    """Which split is best. ``shares`` are the shares of positions that a whole tree and a level may split on, by name."""

    l2: float = 0.0
    least: float = 1.0
    shares: dict[str, float] = field(default_factory=dict)
    seed: int = 0
    turn: int = 0

    def splits(self, cells: pa.Table, open_: np.ndarray) -> dict[int, tuple[float, int, int, float, float]]:
        """Per slot gain, position, bin and the sums on the right; of equal gains the lowest position and bin.

        ``open_`` has the totals ``g, h`` of each slot.
        """
        slot, position, cut, g, h = (cells.column(c).to_numpy() for c in ("slot", "position", "bin", "g", "h"))
        kept = np.flatnonzero((position >= 0) & (cut > 0))
        if self.shares and len(kept):
            places, at = np.unique(position[kept], return_inverse=True)
            inside = lambda p: all(drawn_feature(self.seed, self.turn, of, p) < s for of, s in self.shares.items())
            kept = kept[np.array([inside(p) for p in places.tolist()], bool)[at]]
        if not len(kept):
            return {}
        slot, position, cut, g, h = (x[kept] for x in (slot, position, cut, g, h))
        order = np.lexsort((-cut, position, slot))
        slot, position, cut, g, h = (x[order] for x in (slot, position, cut, g, h))
        # A cell that several tasks have seen is one.
        first = np.flatnonzero(
            np.concatenate([[True], (slot[1:] != slot[:-1]) | (position[1:] != position[:-1]) | (cut[1:] != cut[:-1])])
        )
        g, h = np.add.reduceat(g, first), np.add.reduceat(h, first)
        slot, position, cut = (x[first] for x in (slot, position, cut))
        starts = np.concatenate([[True], (slot[1:] != slot[:-1]) | (position[1:] != position[:-1])])
        begin = np.maximum.accumulate(np.where(starts, np.arange(len(slot)), 0))
        # A feature's sums start anew, so that those of others leave no rounding in them.
        rg, rh = g.copy(), h.copy()
        step = np.arange(len(slot)) - begin
        later = np.flatnonzero(step)
        later = later[np.argsort(step[later], kind="stable")]
        for at in np.split(later, np.flatnonzero(np.diff(step[later])) + 1):
            rg[at] += rg[at - 1]
            rh[at] += rh[at - 1]
        sg, sh = open_[slot, 0], open_[slot, 1]
        counts = np.flatnonzero((rh >= self.least) & (sh - rh >= self.least))
        slot, position, cut, rg, rh, sg, sh = (x[counts] for x in (slot, position, cut, rg, rh, sg, sh))
        # To nine digits, so that equal splits are equal whatever the order of the sums.
        part = lambda a, b: a**2 / (b + self.l2)
        gain = np.round(part(sg - rg, sh - rh) + part(rg, rh) - part(sg, sh), 9)
        found: dict[int, tuple[float, int, int, float, float]] = {}
        counts = np.flatnonzero(gain > LEAST_GAIN)
        counts = counts[np.lexsort((cut[counts], position[counts], -gain[counts], slot[counts]))]
        counts = counts[np.unique(slot[counts], return_index=True)[1]]
        for i in counts.tolist():
            found[int(slot[i])] = float(gain[i]), int(position[i]), int(cut[i]), float(rg[i]), float(rh[i])
        return found


def _searched(rule: Rule, open_: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = rule.splits(pa.Table.from_batches(batches, SUMS), open_)
    rows = [(slot, p, c, g, h, gain) for slot, (gain, p, c, g, h) in found.items()]
    columns = list(zip(*rows, strict=True)) or [()] * 6
    kinds = [*SUMS.types, pa.float64()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*SUMS.names, "gain"]
    )


def totals(blocks: DataFrame, work: Pass) -> np.ndarray:
    """``g``, ``h`` and the sum of ``g^2 / h`` of each slot."""
    found = np.zeros((len(work.slots), 3))
    rows = blocks.mapInArrow(partial(_level, work, True), SUMS_KIND).groupBy("slot", "position").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    for r in rows.collect():
        if r["position"] == -1:
            found[r["slot"], :2] = r["g"], r["h"]
        else:
            found[r["slot"], 2] = r["g"]
    return found


def level_splits(blocks: DataFrame, work: Pass, rule: Rule, open_: np.ndarray | None, on_driver: bool):
    """The best splits of the open nodes by slot (see ``Rule.splits``), and the nodes' totals; looked for if not given."""
    if open_ is None and not on_driver:
        open_ = totals(blocks, work)
    sums = blocks.mapInArrow(partial(_level, work, False), SUMS_KIND)
    if on_driver:
        cells = sums.groupBy("slot", "position", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
        if open_ is None:
            open_ = np.zeros((len(work.slots), 3))
            slot, position, g, h = (cells.column(c).to_numpy() for c in ("slot", "position", "g", "h"))
            whole, squares = np.flatnonzero(position == -1), np.flatnonzero(position == -2)
            open_[slot[whole], 0], open_[slot[whole], 1], open_[slot[squares], 2] = g[whole], h[whole], g[squares]
        return rule.splits(cells, open_), open_
    kind = f"{SUMS_KIND}, gain double"
    found: dict[int, tuple[float, int, int, float, float]] = {}
    for r in sums.repartition("position").mapInArrow(partial(_searched, rule, open_), kind).collect():
        here = (r["gain"], r["position"], r["bin"], r["g"], r["h"])
        best = found.get(r["slot"])
        if best is None or (-here[0], here[1], here[2]) < (-best[0], best[1], best[2]):
            found[r["slot"]] = here
    return found, open_


def _moved(work: Pass, tree: int, step: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    router, value = _Router(work, work.trees[tree]), np.array(work.trees[tree].value)
    for block in _blocks(batches):
        block.state = block.state + step * value[router.nodes(block)]
        yield _packed(block)


def moved(blocks: DataFrame, layout: Layout, tree: Tree, step: float = 1.0) -> DataFrame:
    """The blocks with what the tree gives each row, times ``step``, added to its number."""
    return blocks.mapInArrow(partial(_moved, Pass(layout, {0: tree}, [], None), 0, step), BLOCK_KIND)
