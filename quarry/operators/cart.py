"""Classification trees for a 0/1 target, grown breadth-first on binned inputs (trees and forests alike).

Inputs become one byte each: a number is the count of cut points below it (at most 254 quantiles of
the training rows), a nominal value the position of its level.

While a node has more than `local_rows` (bootstrap) rows, its split is searched by Spark: every task finds the
node of its rows in the splits made so far, adds up counts by (tree, node, input, bin, class), and the partial
counts of a node meet. Rows stay where they are: bootstrap counts and nodes are found anew in every pass, from
the row's hash and a broadcast of the large nodes (one per `local_rows` bootstrap rows). A node with fewer
rows gets them as compressed parts in one shuffle and is finished by one task, which grows the whole subtree
level by level in numpy. Both use the same split search on the same counts, so `local_rows` changes where
work is done, not the trees: it is larger for forests, whose trees keep all cores busy. Trees are grown in batches of about `BATCH_ROWS` bagged rows, whose shuffle files go
before the next batch, so the disk in use follows neither rows nor trees. Trees are kept as compressed
pieces of about two bytes a node.

Splits lower the weighted Gini impurity most (ties: first input, lowest cut). Nominal inputs are split
into two sets of levels: for two classes the best of all subsets is among the cuts of the levels
ordered by event share. Levels that a node's rows lack, and unknown ones, go to the larger side; missing
numbers count as larger than all others. Growth has no depth limit unless one is given.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import named
from quarry.session import cut_lineage, ensure_checkpoint_dir, right_size, shuffles_dropped

MAX_CUTS = 254
MAX_LEVELS = 255
UNKNOWN = 255
LOCAL_ROWS = 1 << 19
WALKED_ROWS = 1 << 14                      # rows that go down a tree together
COUNTED_ROWS = 1 << 13                     # nodes of more rows are split one by one from counts by class and bin
GROWN_ROWS = 1 << 17                       # rows of smaller nodes that are split together
BLOCK_ROWS = 1 << 20                       # rows that a task bags at a time
FOREST_LOCAL_ROWS = 1 << 23                # the same as LOCAL_ROWS, where every core has trees of its own
BATCH_ROWS = 1 << 27                       # bagged rows of the trees grown together, about 0.6 GB shuffled
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every bit of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Inputs:
    """Cut points of numeric and levels of nominal inputs, learned from training rows."""

    cuts: dict[str, list[float]]
    levels: dict[str, list[str]]

    @classmethod
    def fit(cls, df: DataFrame, numeric: Sequence[str], nominal: Sequence[str] = (),
            max_cuts: int = MAX_CUTS) -> "Inputs":
        """One aggregate for all cut points, one bounded distinct per nominal input."""
        cuts, levels = {}, {}
        if numeric:
            shares = F.array(*[F.lit((i + 1) / (max_cuts + 1)) for i in range(max_cuts)])
            row = df.agg(*[F.percentile_approx(F.when(~F.isnan(named(c).cast("double")), named(c).cast("double")),
                                               shares, 20_000).alias(f"q{i}") for i, c in enumerate(numeric)]).first()
            cuts = {c: sorted(set(row[f"q{i}"] or [])) for i, c in enumerate(numeric)}
        for c in nominal:
            found = df.select(named(c).cast("string").alias("v")).filter("v IS NOT NULL").distinct().limit(MAX_LEVELS + 1)
            levels[c] = sorted(r["v"] for r in found.collect())
            if len(levels[c]) > MAX_LEVELS:
                raise ValueError(f"{c} has more than {MAX_LEVELS} levels")
        return cls(cuts, levels)

    @property
    def names(self) -> list[str]:
        return [*self.cuts, *self.levels]

    def columns(self, prefix: str = "") -> list[Column]:
        return ([named(prefix + c).cast("double") for c in self.cuts]
                + [named(prefix + c).cast("string") for c in self.levels])

    def bins(self, columns: Sequence[pa.Array]) -> np.ndarray:
        """One byte per row and input, from the arrays of `columns`."""
        out = np.empty((len(columns[0]) if columns else 0, len(self.names)), np.uint8)
        for i, c in enumerate(self.cuts):
            values = columns[i].cast(pa.float64()).to_numpy(zero_copy_only=False)
            out[:, i] = np.searchsorted(np.array(self.cuts[c], float), values, "left")
        for i, c in enumerate(self.levels, len(self.cuts)):
            at = pc.index_in(columns[i].cast(pa.string()), pa.array(self.levels[c], pa.string()))
            out[:, i] = at.fill_null(UNKNOWN).to_numpy(zero_copy_only=False)
        return out


@dataclass(frozen=True)
class Rules:
    """When nodes are split: counts are of (bootstrap) rows, risk is weighted misclassification."""

    min_split: int = 2
    min_bucket: int = 1
    max_depth: int | None = None
    min_risk: float = 0.0                      # a node whose risk is not above this stays a leaf
    weights: tuple[float, float] = (1.0, 1.0)  # of a row of class 0 and of class 1
    seed: int = 1


# ---------------------------------------------------------------- split search
def _impurity(n: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Gini impurity times weight: 2 k (n - k) / n."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out = 2.0 * k * (n - k) / n
    out[n <= 0] = 0.0
    return out


def _starts(values: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.append(0, 1 + np.flatnonzero(values[1:] != values[:-1]))


def input_splits(node: np.ndarray, bins: np.ndarray, c0: np.ndarray, c1: np.ndarray, nominal: bool,
                 rules: Rules) -> tuple:
    """Best split of every node on one input, from cells (node, bin) sorted by both with class counts.

    (node numbers, gains, cut bins, class counts of the left side, left sides by bin for nominal inputs, 64 bins a
    word); gain -1 where none is allowed.
    """
    w0, w1 = rules.weights
    if nominal:
        share = c1 * w1 / (c0 * w0 + c1 * w1)
        order = np.lexsort((share, node))       # stable, so equal shares stay in the order of their bins
        node, bins, c0, c1 = node[order], bins[order], c0[order], c1[order]
    first = _starts(node)
    last = np.append(first[1:], len(node)) - 1
    rank = np.repeat(np.arange(len(first)), last - first + 1)
    s0, s1 = np.cumsum(c0), np.cumsum(c1)
    l0, l1 = s0 - (s0[first] - c0[first])[rank], s1 - (s1[first] - c1[first])[rank]
    t0, t1 = l0[last], l1[last]
    top, at = _best_cuts(l0, l1, t0, t1, rank, first, last, rules)
    words = None
    if nominal:
        bigger_left = (l0 + l1)[at] * 2 >= t0 + t1
        words = np.repeat(np.where(bigger_left, ~np.uint64(0), np.uint64(0)), 4)
        other = np.flatnonzero((np.arange(len(node)) <= at[rank]) != bigger_left[rank])
        bit = np.uint64(1) << (bins[other] & 63).astype(np.uint64)
        np.bitwise_xor.at(words, rank[other] * 4 + (bins[other] >> 6), bit)
        words = words.reshape(-1, 4)
    return node[first], top, bins[at].astype(np.int32), l0[at], l1[at], words


def _best_cuts(l0: np.ndarray, l1: np.ndarray, t0: np.ndarray, t1: np.ndarray, rank: np.ndarray, first: np.ndarray,
               last: np.ndarray, rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """Highest gain of every node and its first cell, from the class counts up to each cell and those of the nodes."""
    w0, w1 = rules.weights
    k, lk = (t1, l1) if w1 == 1.0 else (t1 * w1, l1 * w1)
    n, ln = (t0 + k, l0 + lk) if w0 == 1.0 else (t0 * w0 + k, l0 * w0 + lk)
    gain = _impurity(n, k)[rank] - _impurity(ln, lk) - _impurity(n[rank] - ln, k[rank] - lk)
    if rules.min_bucket > 1:
        left = l0 + l1
        gain[(left < rules.min_bucket) | ((t0 + t1)[rank] - left < rules.min_bucket)] = -1.0
    gain[last] = -1.0
    top = np.maximum.reduceat(gain, first)
    hit = np.flatnonzero(gain == top[rank])
    return top, hit[_starts(rank[hit])]


def splittable(t0: np.ndarray, t1: np.ndarray, depth: np.ndarray | int, rules: Rules) -> np.ndarray:
    """Whether the rules let nodes with these class counts be split."""
    risk = np.minimum(t0 * rules.weights[0], t1 * rules.weights[1])
    out = (t0 + t1 >= rules.min_split) & (t0 > 0) & (t1 > 0) & (risk > rules.min_risk)
    return out if rules.max_depth is None else out & (np.asarray(depth) < rules.max_depth)


def bits(words: np.ndarray) -> np.ndarray:
    """Sets of bins given as words of 64, one bool a bin."""
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8).reshape(-1, 32), axis=1, bitorder="little").astype(bool)


def tried_inputs(hashes: np.ndarray, mtry: int | None, n_inputs: int) -> np.ndarray:
    """Which inputs are tried in the nodes of these hashes."""
    tried = np.ones((len(hashes), n_inputs), bool)
    if mtry is not None and mtry < n_inputs:
        draw = mix(hashes[:, None] ^ mix(np.arange(1, n_inputs + 1, dtype=np.uint64))[None, :])
        tried[:] = False
        np.put_along_axis(tried, np.argsort(draw, axis=1)[:, :mtry], True, axis=1)
    return tried


class Level:
    """Best splits of nodes, filled input by input."""

    def __init__(self, size: int):
        self.gain, self.input = np.zeros(size), np.full(size, -1, np.int16)
        self.cut, self.words = np.zeros(size, np.int32), np.zeros((size, 4), np.uint64)
        self.l0, self.l1 = np.zeros((2, size))

    def add(self, i: np.ndarray | int, node: np.ndarray, gain: np.ndarray, cut: np.ndarray, l0: np.ndarray,
            l1: np.ndarray, words: np.ndarray | None) -> None:
        """What `input_splits` found on input `i`, one for all nodes or one each."""
        better = np.flatnonzero(gain > self.gain[node] + 1e-12)
        at = node[better]
        self.input[at] = i[at] if isinstance(i, np.ndarray) else i
        self.gain[at], self.cut[at], self.l0[at], self.l1[at] = gain[better], cut[better], l0[better], l1[better]
        if words is not None:
            self.words[at] = words[better]

    def left(self, nominal_from: int) -> np.ndarray:
        """Left or right by bin, for the first node."""
        return bits(self.words[:1])[0] if self.input[0] >= nominal_from else np.arange(256) <= self.cut[0]


def _one_node(counted: dict[int, np.ndarray], t0: float, t1: float, nominal_from: int, rules: Rules) -> Level:
    """Best split of a single node from its counts by (class, bin) for each input tried."""
    level = Level(1)
    for i, cells in counted.items():
        bins = np.flatnonzero(cells.sum(axis=0))
        level.add(i, *input_splits(np.zeros(len(bins), np.int64), bins, cells[0, bins], cells[1, bins],
                                   i >= nominal_from, rules))
    return level


def root_hash(tree: int, path: str, seed: int) -> np.ndarray:
    at = mix(np.array([tree + 1], np.uint64) ^ mix(np.array([seed], np.uint64)))
    for step in path:
        at = mix(at * np.uint64(2) + np.uint64(1 + (step == "R")))
    return at


@dataclass
class TreeArrays:
    """Nodes of a tree; a split's children are `child` and `child + 1`, a leaf has input -1."""

    input: np.ndarray       # int16
    cut: np.ndarray         # int32: bin of a number, row of `sides` for a nominal input
    child: np.ndarray       # int32
    n0: np.ndarray          # int64: (bootstrap) rows of class 0
    n1: np.ndarray
    gain: np.ndarray        # float64: impurity removed
    sides: np.ndarray       # bool, 256 a row: left by bin
    nominal_from: int = 1 << 15    # first nominal input (pieces only)
    steps: tuple | None = field(default=None, repr=False, compare=False)    # made by the first walk

    def leaves(self, bins: np.ndarray, nominal_from: int) -> np.ndarray:
        """Leaf of every row of bins; inputs from `nominal_from` on are nominal."""
        if self.steps is None:
            self.steps = self._steps(nominal_from)
        step, right, by, by_input, by_row, row_mask = self.steps
        out, width = np.zeros(len(bins), np.int32), bins.shape[1]
        for start in range(0, len(bins), WALKED_ROWS):
            part = bins[start:start + WALKED_ROWS]
            flat, rows = np.ascontiguousarray(part).ravel(), np.arange(start, start + len(part))
            node, first = np.zeros(len(part), np.int64), np.arange(len(part)) * width
            while len(rows):
                for _ in range(3):
                    here, word = node, step.take(node)
                    value = flat.take(first + (word & by_input))
                    node = (word >> by_row) + right.take((word >> by & row_mask) + value)
                going = node != here
                ends = np.flatnonzero(~going)
                if len(ends):
                    out[rows[ends]] = node[ends]
                    rows, node, first = rows[going], node[going], first[going]
        return out

    def _steps(self, nominal_from: int) -> tuple:
        """A node as one number: child, row of a table of sides times 256, and input, with the places of the three.
        A number's cut is the row of its number, a set comes after these. Leaves lead to themselves, so that finished rows
        need not be taken out at every step."""
        right = np.concatenate([np.arange(256)[None, :] > np.arange(256)[:, None], ~self.sides]).ravel().astype(np.int8)
        leaf = self.input < 0
        row = np.where(leaf, 255, self.cut.astype(np.int64) + np.where(self.input >= nominal_from, 256, 0)) << 8
        by = max(int(self.input.max()), 1).bit_length()
        by_row = by + len(right).bit_length()
        step = np.where(leaf, np.arange(len(leaf)), self.child).astype(np.int64) << by_row
        step |= row << by | np.where(leaf, 0, self.input)
        return step, right, by, (1 << by) - 1, by_row, (1 << by_row - by) - 1

    def order(self, bins: np.ndarray, nominal_from: int) -> np.ndarray:
        """Rows of bins from the leftmost leaf to the rightmost: neighbours go similar ways in similar trees, whose
        nodes then stay in the processor's cache."""
        place, width, at = np.zeros(len(self.input)), np.ones(len(self.input)), np.zeros(1, np.int64)
        while len(at := at[self.child[at] >= 0]):
            left = self.child[at].astype(np.int64)
            width[left] = width[left + 1] = width[at] / 2
            place[left], place[left + 1] = place[at], place[at] + width[left]
            at = np.concatenate([left, left + 1])
        return np.argsort(place[self.leaves(bins, nominal_from)])

    def events(self, weights: tuple[float, float] = (1.0, 1.0)) -> np.ndarray:
        """1 for nodes whose weighted majority is class 1 (ties: 0)."""
        return (self.n1 * weights[1] > self.n0 * weights[0]).astype(np.int8)


def grow_arrays(bins: np.ndarray, y: np.ndarray, count: np.ndarray, tree: int, path: str, mtry: int | None,
                nominal_from: int, rules: Rules) -> TreeArrays:
    """The whole subtree of one node's rows.

    Nodes of more than `COUNTED_ROWS` rows are split one by one from counts by class and bin, their rows parted in
    place; smaller ones go on together, level by level, in blocks of up to `GROWN_ROWS` rows, which stay in the
    processor's cache.
    """
    n, p = bins.shape
    table = np.zeros((n, -(-(p + 2) // 8) * 8), np.uint8)          # inputs, class and count of a row side by side
    table[:, :p], table[:, p], table[:, p + 1] = bins, y > 0, count
    whole = table.view(np.uint64)
    event, counts = table[:, p].astype(bool), table[:, p + 1]
    t0, t1 = int(counts[~event].sum(dtype=np.int64)), int(counts[event].sum(dtype=np.int64))
    made, blocks, small, held = _Made(), [], [], 0
    stack = [(0, n, made.add(t0, t1), root_hash(tree, path, rules.seed), len(path))]
    while stack:
        start, stop, node, hashes, depth = stack.pop()
        if stop - start <= COUNTED_ROWS:
            if held + stop - start > GROWN_ROWS:
                blocks.append(_grow_block(table, small, made, mtry, p, nominal_from, rules))
                small, held = [], 0
            small.append((start, stop, node, hashes, depth))
            held += stop - start
            continue
        t0, t1 = made.n0[node], made.n1[node]
        if not splittable(np.array([t0]), np.array([t1]), depth, rules)[0]:
            continue
        tried = np.flatnonzero(tried_inputs(hashes, mtry, p)[0]).tolist()
        level = _one_node(_counted(table, start, stop, tried, p), t0, t1, nominal_from, rules)
        if level.input[0] < 0:
            continue
        left = level.left(nominal_from)
        goes_left = left[table[start:stop, level.input[0]]]
        parts = [whole[start:stop].take(np.flatnonzero(side), axis=0) for side in (goes_left, ~goes_left)]
        middle = start + len(parts[0])
        whole[start:middle], whole[middle:stop] = parts
        child = made.split(node, level)
        both = hashes * np.uint64(2)
        stack += [(middle, stop, child + 1, mix(both + np.uint64(2)), depth + 1),
                  (start, middle, child, mix(both + np.uint64(1)), depth + 1)]
    if small:
        blocks.append(_grow_block(table, small, made, mtry, p, nominal_from, rules))
    return made.joined(blocks, nominal_from)


def _counted(table: np.ndarray, start: int, stop: int, tried: Sequence[int], p: int) -> dict[int, np.ndarray]:
    """Counts by (class, bin) of a stretch of rows, for each input tried."""
    out = {i: np.zeros(512) for i in tried}
    for a in range(start, stop, WALKED_ROWS):
        part = table[a:min(a + WALKED_ROWS, stop)]
        event, count = part[:, p].astype(np.int64) << 8, part[:, p + 1].astype(float)
        for i in tried:
            out[i] += np.bincount(event + part[:, i], count, 512)
    return {i: cells.reshape(2, 256) for i, cells in out.items()}


class _Made:
    """Nodes that were split one by one, in the order they were made, and the small ones below them."""

    def __init__(self):
        self.input, self.cut, self.child, self.gain = [], [], [], []
        self.n0, self.n1, self.words = [], [], []

    def add(self, n0: int, n1: int) -> int:
        for values, value in ((self.input, -1), (self.cut, 0), (self.child, -1), (self.gain, 0.0), (self.n0, n0),
                              (self.n1, n1), (self.words, np.zeros(4, np.uint64))):
            values.append(value)
        return len(self.input) - 1

    def split(self, node: int, level: Level) -> int:
        l0, l1 = int(level.l0[0]), int(level.l1[0])
        child = self.add(l0, l1)
        self.add(self.n0[node] - l0, self.n1[node] - l1)
        self.input[node], self.cut[node], self.gain[node] = int(level.input[0]), int(level.cut[0]), float(level.gain[0])
        self.words[node], self.child[node] = level.words[0], child
        return child

    def joined(self, blocks: list[dict[str, np.ndarray]], nominal_from: int) -> TreeArrays:
        """One tree in the order of its levels; equal sets of levels are kept once."""
        kinds = {"input": np.int16, "cut": np.int32, "child": np.int32, "gain": float, "n0": np.int64, "n1": np.int64,
                 "words": np.uint64}
        size, parts = len(self.input), {name: [np.array(getattr(self, name), kind)] for name, kind in kinds.items()}
        for block in blocks:
            roots = block["roots"]
            block["child"] = np.where(block["child"] >= 0, block["child"] + (size - len(roots)), -1).astype(np.int32)
            size += len(block["child"]) - len(roots)
            for name, pieces in parts.items():
                pieces[0][roots] = block[name][:len(roots)]
                pieces.append(block[name][len(roots):])
        all_ = {name: np.concatenate(pieces) for name, pieces in parts.items()}
        child, order = all_["child"], [np.zeros(1, np.int64)]
        while len(at := order[-1][child[order[-1]] >= 0]):
            order.append(np.stack([child[at], child[at] + 1], axis=1).ravel().astype(np.int64))
        order = np.concatenate(order)
        out = {name: values[order] for name, values in all_.items()}
        split = out["input"] >= 0
        out["child"][split] = 1 + 2 * np.arange(split.sum())
        by_set = out["input"] >= nominal_from
        sides, which = np.unique(out.pop("words")[by_set], axis=0, return_inverse=True)
        out["cut"][by_set] = which.ravel()
        return TreeArrays(sides=bits(sides).reshape(-1, 256), **out)


def _grow_block(table: np.ndarray, nodes: list[tuple], made: _Made, mtry: int | None, p: int, nominal_from: int,
                rules: Rules) -> dict[str, np.ndarray]:
    """The subtrees of some nodes, level by level; their roots come first."""
    # A row and input is one number: node, bin, class and count in 9 bits and more, 8, 1 and 8. Sorted, the numbers
    # bring the rows of a cell together and still hold what is added up.
    flat, width = table.ravel(), table.shape[1]
    rows = np.concatenate([np.arange(a, b) for a, b, *_ in nodes])
    at = np.repeat(np.arange(len(nodes)), [b - a for a, b, *_ in nodes])
    own = table[rows, p].astype(np.uint32) << 8 | table[rows, p + 1]
    rows *= width
    roots, hashes = np.array([x[2] for x in nodes]), np.concatenate([x[3] for x in nodes])
    depth = np.array([x[4] for x in nodes])
    t0, t1 = (np.array([x[i] for i in roots.tolist()], np.int64) for x in (made.n0, made.n1))
    opened = splittable(t0, t1, depth, rules)
    use = np.flatnonzero(opened[at])
    rows, own, at = rows[use], own[use], (np.cumsum(opened) - 1)[at[use]]
    parts, size = {name: [] for name in ("input", "cut", "child", "gain", "n0", "n1", "words")}, 0
    while len(t0):
        size += len(t0)
        who = np.flatnonzero(opened)
        found = (np.full(len(t0), -1, np.int16), np.zeros(len(t0), np.int32), np.full(len(t0), -1, np.int32),
                 np.zeros(len(t0)), t0, t1, np.zeros((len(t0), 4), np.uint64))
        for name, values in zip(parts, found):
            parts[name].append(values)
        if not len(who):
            break
        level = Level(len(who))
        tried = tried_inputs(hashes[who], mtry, p)
        tried = np.nonzero(tried)[1].reshape(len(who), -1)
        _search(level, flat, rows, at, own, tried, t0[who].astype(float), t1[who].astype(float), nominal_from, rules)
        split = np.flatnonzero(level.input >= 0)
        where = who[split]
        which, cut, child, gain, _, _, words = found
        which[who], gain[who], cut[who], words[where] = level.input, level.gain, level.cut, level.words[split]
        child[where] = size + 2 * np.arange(len(split))
        l0, l1 = level.l0[split].astype(np.int64), level.l1[split].astype(np.int64)
        t0, t1 = (np.stack([x, t[where] - x], axis=1).ravel() for x, t in ((l0, t0), (l1, t1)))
        both = hashes[where] * np.uint64(2)
        hashes = mix(np.stack([both + np.uint64(1), both + np.uint64(2)], axis=1).ravel())
        depth = np.repeat(depth[where] + 1, 2)
        opened = splittable(t0, t1, depth, rules)
        if opened.any():
            chosen = level.input.astype(np.int64)
            value = flat.take(rows + chosen.take(at))
            right = value > level.cut.take(at)
            if (chosen >= nominal_from).any():
                by_set = np.flatnonzero((chosen >= nominal_from).take(at))
                in_set = value[by_set]
                right[by_set] = level.words[at[by_set], in_set >> 6] >> (in_set & 63).astype(np.uint64) & np.uint64(1) == 0
            next_ = np.full(len(who), 2 * len(split))       # rows of nodes without a split go where nothing is open
            next_[split] = 2 * np.arange(len(split))
            at = next_.take(at) + right
            use = np.flatnonzero(np.append(opened, [False, False]).take(at))
            rows, own, at = rows[use], own[use], (np.cumsum(opened) - 1).take(at[use])
    return {name: np.concatenate(values) for name, values in parts.items()} | {"roots": roots}


#: Count, and count of the events in the upper half, of the last 9 bits of a packed row.
_OWN = np.arange(256, dtype=np.uint64)
_OWN = np.concatenate([_OWN, _OWN | _OWN << np.uint64(32)])


def _search(level: Level, flat: np.ndarray, rows: np.ndarray, at: np.ndarray, own: np.ndarray, tried: np.ndarray,
            t0: np.ndarray, t1: np.ndarray, nominal_from: int, rules: Rules) -> None:
    """Best splits of nodes that all have rows; `tried` are each node's inputs in rising order."""
    kind = np.uint32 if len(t0) <= 1 << 15 else np.uint64
    packed = at.astype(kind) << kind(17) | own
    for which in np.ascontiguousarray(tried.T):
        keys = flat.take(rows + which.take(at)).astype(kind) << kind(9) | packed
        keys.sort()
        cells = keys >> kind(9)
        ends = np.append(np.flatnonzero(cells[1:] != cells[:-1]), len(cells) - 1)
        upto = _OWN.take(keys & kind(511)).cumsum().take(ends)
        cells = cells.take(ends).astype(np.int64)
        node, bins = cells >> 8, cells & 255
        nominal = which >= nominal_from
        if nominal.any():
            sets = nominal.take(node)
            size = np.diff(upto, prepend=np.uint64(0))[sets]
            c1 = (size >> np.uint64(32)).astype(float)
            level.add(which, *input_splits(node[sets], bins[sets], (size & np.uint64(0xFFFFFFFF)).astype(float) - c1, c1,
                                           True, rules))
        last = np.append(np.flatnonzero(node[1:] != node[:-1]), len(node) - 1)
        upto -= np.append(np.uint64(0), upto[last[:-1]]).take(node)
        if nominal.any():
            numbers = np.flatnonzero(~sets)
            if not len(numbers):
                continue
            node, bins, upto = node[numbers], bins[numbers], upto[numbers]
            last = np.append(np.flatnonzero(node[1:] != node[:-1]), len(node) - 1)
        first = np.append(0, last[:-1] + 1)
        l1 = (upto >> np.uint64(32)).astype(float)
        l0 = (upto & np.uint64(0xFFFFFFFF)).astype(float) - l1
        of = node[first]
        rank = node if len(of) == len(t0) else np.repeat(np.arange(len(of)), last - first + 1)
        top, best = _best_cuts(l0, l1, t0[of], t1[of], rank, first, last, rules)
        level.add(which, of, top, bins[best].astype(np.int32), l0[best], l1[best], None)


# ---------------------------------------------------------------- growth on Spark
PIECE = "tree int, node string, nodes long, packed binary"
_PIECE_ARROW = pa.schema([("tree", pa.int32()), ("node", pa.string()), ("nodes", pa.int64()), ("packed", pa.binary())])
PART = "tree int, node string, n long, rows binary"
LEAF, OPEN, LOCAL = 0, 1, 2


def _shrunk(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest type that holds them."""
    low, high = (int(values.min()), int(values.max())) if len(values) else (0, 0)
    return values.astype(np.promote_types(np.min_scalar_type(low), np.min_scalar_type(high)))


def _squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _expand(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def pack(t: TreeArrays, nominal_from: int, weights: tuple[float, float]) -> bytes:
    """A piece without what follows from the rest: children come in the order of their splits, gains from the
    counts; equal sets of levels are kept once."""
    split = t.input >= 0
    cut, sides = t.cut.astype(np.int64), np.packbits(t.sides, axis=1)
    if len(sides):
        by_set = t.input >= nominal_from
        sides, which = np.unique(sides, axis=0, return_inverse=True)
        cut[by_set] = which.ravel()[cut[by_set]]
    out = [np.array([nominal_from, *weights, t.gain[0], t.child[0]], float).tobytes()]
    for values in (t.input, cut[split], t.n0, t.n1, sides):
        values = _shrunk(values)
        out += [values.dtype.char.encode(), values.size.to_bytes(4, "little"), values.tobytes()]
    return _squeeze(b"".join(out))


def unpack(packed: bytes, gains: bool = True) -> TreeArrays:
    data = _expand(packed)
    head, at, parts = np.frombuffer(data, float, 5), 40, []
    for _ in range(5):
        kind, size = np.dtype(data[at:at + 1].decode()), int.from_bytes(data[at + 1:at + 5], "little")
        parts.append(np.frombuffer(data, kind, size, at + 5))
        at += 5 + size * kind.itemsize
    which, cuts, n0, n1, sides = parts
    split = which >= 0
    at = np.flatnonzero(split)
    child, cut, gain = np.full(len(which), -1, np.int32), np.zeros(len(which), np.int32), np.zeros(len(which))
    cut[at] = cuts
    n0, n1 = n0.astype(np.int64), n1.astype(np.int64)
    if head[4] >= 0:
        child[at] = 1 + 2 * np.arange(len(at))
    if head[4] >= 0 and gains:
        w0, w1 = head[1], head[2]
        left = child[at]
        n, k, ln, lk = n0[at] * w0 + n1[at] * w1, n1[at] * w1, n0[left] * w0 + n1[left] * w1, n1[left] * w1
        gain[at] = _impurity(n, k) - _impurity(ln, lk) - _impurity(n - ln, k - lk)
    gain[0] = head[3]
    return TreeArrays(which.astype(np.int16), cut, child, n0, n1, gain,
                      np.unpackbits(sides).astype(bool).reshape(-1, 256), int(head[0]))


def _piece_row(tree: int, node: str, t: TreeArrays, nominal_from: int, weights: tuple[float, float]) -> dict:
    return {"tree": tree, "node": node, "nodes": len(t.input), "packed": pack(t, nominal_from, weights)}


def assemble(pieces: dict[str, TreeArrays]) -> TreeArrays:
    """One tree from its pieces by path: a piece whose root is a split without children here continues in
    the pieces of its two paths."""
    sides: list[np.ndarray] = []
    values: dict[str, list[np.ndarray]] = {n: [] for n in ("input", "cut", "child", "n0", "n1", "gain")}
    slots: list[np.ndarray] = []
    waiting, size = [("", 0)], 1
    while waiting:
        path, slot = waiting.pop()
        piece = pieces[path]
        shift = size - 1                       # node i > 0 of the piece gets place size - 1 + i
        cut, child = piece.cut.copy(), np.where(piece.child >= 0, piece.child + shift, -1).astype(np.int32)
        if len(piece.sides):
            cut[piece.input >= piece.nominal_from] += len(sides)
            sides.extend(piece.sides)
        size += len(piece.input) - 1
        if piece.input[0] >= 0 and piece.child[0] < 0:
            child[0] = size
            waiting += [(path + "R", size + 1), (path + "L", size)]
            size += 2
        slots.append(np.append(slot, shift + np.arange(1, len(piece.input))))
        for name, value in (("input", piece.input), ("cut", cut), ("child", child), ("n0", piece.n0),
                            ("n1", piece.n1), ("gain", piece.gain)):
            values[name].append(value)
    order = np.argsort(np.concatenate(slots))
    return TreeArrays(sides=np.array(sides, bool).reshape(-1, 256),
                      **{n: np.concatenate(v)[order] for n, v in values.items()})


def encode_rows(rows: DataFrame, inputs: Inputs, target: str, key: str) -> DataFrame:
    """(n0, n1, packed) of blocks of training rows with a target: rows by class, and for each row the hash of its key,
    its class and one byte per input, column by column. Written once, as many blocks for every core (files of few row
    groups are read by few tasks), for every pass over single rows would take longer to read than to count."""
    source = rows.select(F.xxhash64(named(key)).alias("h"), named(target).cast("int").alias("y"), *[
        c.alias(f"x{i}") for i, c in enumerate(inputs.columns())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(1)))
            if batch.num_rows:
                bins, y = inputs.bins(batch.columns[2:]), batch.column(1).to_numpy()
                packed = b"".join(x.tobytes() for x in (batch.column(0).to_numpy(), y.astype(np.uint8), bins.T))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int((y == 0).sum())]), pa.array([int((y == 1).sum())]), pa.array([packed], pa.binary())],
                    ["n0", "n1", "packed"])

    cores = rows.sparkSession.sparkContext.defaultParallelism
    return cut_lineage(source.mapInArrow(encode, "n0 long, n1 long, packed binary").repartition(cores))


def class_counts(encoded: DataFrame) -> tuple[int, int]:
    """Rows of class 0 and of class 1 among `encode_rows`."""
    row = encoded.agg(F.sum("n0"), F.sum("n1")).first()
    return row[0] or 0, row[1] or 0


def _unpacked(column: pa.Array, n_inputs: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hashes, classes and columns of bins of each packed block."""
    for block in column:
        data = np.frombuffer(block.as_buffer(), np.uint8)
        n = len(data) // (9 + n_inputs)
        yield data[:8 * n].view(np.int64), data[8 * n:9 * n], data[9 * n:].reshape(n_inputs, n)


def poisson_counts(h: np.ndarray, y: np.ndarray, tree: int, rates: tuple[float, float], seed: int) -> np.ndarray:
    """Bootstrap count of every row in one tree: Poisson by class, from a hash of row and tree.

    The same for ever: training and out-of-bag passes see the same counts, on any partitioning.
    """
    mixed = mix(h.astype(np.uint64) ^ root_hash(tree, "", seed + 7919)[0])
    out, known = np.zeros(len(h), np.int64), {}
    for cls, rate in enumerate(rates):
        if rate not in known:
            known[rate] = _counts_at(mixed, _steps(rate))
        mine = (y > 0) == bool(cls)
        np.copyto(out, known[rate], where=mine)
    return out


def _steps(rate: float) -> np.ndarray:
    """Cumulated Poisson probabilities."""
    steps, term, k = [], np.exp(-rate), 0
    total = term
    while total < 1 - 1e-12 and k < 255:
        steps.append(total)
        k += 1
        term *= rate / k
        total += term
    return np.array(steps)


def _counts_at(mixed: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Number of steps not above the fraction that a hash stands for. Its first 12 bits tell, except in the few
    of 4096 intervals that hold a step."""
    edges = np.arange(4097) / 4096
    low, high = np.searchsorted(steps, edges[:-1], "right"), np.searchsorted(steps, edges[1:], "left")
    place = (mixed >> np.uint64(52)).astype(np.int64)
    out = low[place]
    open_ = np.flatnonzero((high > low)[place])
    out[open_] = np.searchsorted(steps, (mixed[open_] >> np.uint64(11)).astype(float) * 2.0 ** -53, "right")
    return out


@dataclass
class Top:
    """The large nodes of a tree and the smaller ones right below them; a split's children are `child` and `child + 1`."""

    path: list[str]
    state: np.ndarray       # int8: LEAF (or split), OPEN (to be split by Spark), LOCAL (finished by one task)
    input: np.ndarray       # int16, -1 where not split
    child: np.ndarray       # int32
    left: np.ndarray        # bool, 256 a node: left by bin
    hashes: np.ndarray

    @classmethod
    def root(cls, tree: int, state: int, seed: int) -> "Top":
        return cls([""], np.array([state], np.int8), np.full(1, -1, np.int16), np.zeros(1, np.int32),
                   np.zeros((1, 256), bool), root_hash(tree, "", seed))

    def place(self, columns: np.ndarray, use: np.ndarray) -> np.ndarray:
        """Node of each of the rows `use` of columns of bins."""
        at = np.zeros(len(use), np.int32)
        rows = np.arange(len(use)) if self.input[0] >= 0 else np.arange(0)
        while len(rows):
            node = at[rows]
            at[rows] = node = self.child[node] + ~self.left[node, columns[self.input[node], use[rows]]]
            rows = rows[self.input[node] >= 0]
        return at

    def grown(self, tree: int, splits: list[dict], local_rows: int, seed: int) -> "Top":
        """With the results of this level's open nodes; those without rows are leaves."""
        number = {self.path[i]: i for i in np.flatnonzero(self.state == OPEN).tolist()}
        path, new = list(self.path), [r for r in splits if r["chosen"] >= 0]
        state, which, child = (np.append(v, np.full(2 * len(new), f, v.dtype)) for v, f in (
            (np.where(self.state == OPEN, LEAF, self.state).astype(np.int8), LEAF), (self.input, -1), (self.child, 0)))
        left = np.concatenate([self.left, np.zeros((2 * len(new), 256), bool)])
        for r in splits:
            if r["chosen"] == -2:
                state[number[r["node"]]] = LOCAL
        for r in new:
            i, at = number[r["node"]], len(path)
            which[i], child[i] = r["chosen"], at
            left[i] = np.unpackbits(np.frombuffer(r["left"], np.uint8)).astype(bool)
            for side, n in (("L", r["n_left"]), ("R", r["n_right"])):
                state[len(path)] = OPEN if n > local_rows else LOCAL
                path.append(r["node"] + side)
        hashes = np.concatenate([self.hashes, *[root_hash(tree, x, seed) for x in path[len(self.path):]]])
        return Top(path, state, which, child, left, hashes)


def _bagged(batches: Iterator[pa.RecordBatch], p: int, tops: dict[int, Top], rates: tuple[float, float] | None,
            seed: int, state: int) -> Iterator[tuple]:
    """(tree, top, rows, counts, node, y, columns of bins) of the rows that lie in nodes of one state, tree by tree,
    for up to `BLOCK_ROWS` rows of a task at a time; `rows` are places in the last two."""

    def block(held):
        h, y = (np.concatenate(x) for x in list(zip(*held))[:2])
        columns = np.concatenate([x[2] for x in held], axis=1)
        for tree, top in tops.items():
            if not (top.state == state).any():
                continue
            count = np.ones(len(h), np.int64) if rates is None else poisson_counts(h, y, tree, rates, seed)
            use = np.flatnonzero(count)
            at = top.place(columns, use)
            here = top.state[at] == state
            if not here.all():
                use, at = use[here], at[here]
            if len(use):
                yield tree, top, use, count[use], at, y, columns

    held, rows = [], 0
    for batch in batches:
        for part in _unpacked(batch.column(2), p):
            held.append(part)
            rows += len(part[0])
            if rows >= BLOCK_ROWS:
                yield from block(held)
                held, rows = [], 0
    if held:
        yield from block(held)


def grow_trees(encoded: DataFrame, inputs: Inputs, n_trees: int = 1, mtry: int | Sequence[int] | None = None,
               rates: tuple[float, float] | None = None, rules: Rules = Rules(), local_rows: int | None = None) -> str:
    """Grow trees on `encode_rows` and write their pieces (PIECE) as Parquet; returns the folder.

    `rates`: expected bootstrap count of a row by class (None: every row once). `mtry`: inputs tried a split,
    one number or one a tree. Rows whose target is NULL take no part.
    """
    spark = encoded.sparkSession
    p, nominal_from, seed = len(inputs.names), len(inputs.cuts), rules.seed
    tries = list(mtry) if isinstance(mtry, Sequence) else [mtry] * n_trees
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/trees-{uuid.uuid4().hex}"
    spark.createDataFrame([], PIECE).write.parquet(path)
    with shuffles_dropped(spark):
        n_rows, cores = sum(class_counts(encoded)), spark.sparkContext.defaultParallelism
    if local_rows is None:
        local_rows = FOREST_LOCAL_ROWS if n_trees >= cores else LOCAL_ROWS
    rows = right_size(encoded, n_rows, BLOCK_ROWS)
    if n_rows > local_rows and rows.rdd.getNumPartitions() < cores:
        rows = encoded.repartition(cores)
    with shuffles_dropped(spark):
        for batch in tree_batches(n_trees, n_rows, rates, cores):
            tops = {t: Top.root(t, OPEN if n_rows > local_rows else LOCAL, seed) for t in batch}
            while any((top.state == OPEN).any() for top in tops.values()):
                splits = _split_large(rows, tops, path, p, nominal_from, tries, rates, rules, local_rows)
                tops = {t: top.grown(t, splits.get(t, []), local_rows, seed) for t, top in tops.items()}
            _finish_small(rows, tops, path, p, nominal_from, tries, rates, rules,
                          max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * cores))
    return path


def tree_batches(n_trees: int, n_rows: int, rates: tuple[float, float] | None, cores: int = 1) -> list[range]:
    """Trees to grow together: at most `BATCH_ROWS` bagged rows, or one tree; batches of about equal size, in which
    every core has as many trees."""
    bagged = n_rows * min(max(rates), 1.0) if rates else n_rows
    most = max(1, int(BATCH_ROWS / max(bagged, 1)))
    size = max(1, -(-n_trees // -(-n_trees // most)))
    if size < n_trees and most >= cores:
        size = min(-(-size // cores) * cores, most // cores * cores)
    return [range(first, min(first + size, n_trees)) for first in range(0, n_trees, size)]


def _finish_small(rows: DataFrame, tops: dict[int, Top], path: str, p: int, nominal_from: int, tries: list,
                  rates: tuple[float, float] | None, rules: Rules, most_tasks: int) -> None:
    """Deal the rows of all small nodes to their tasks, grow their subtrees and write the pieces."""
    # Nodes are dealt in turn: hashes of few nodes would leave some tasks with several and others with none.
    small = np.cumsum([0, *[(top.state == LOCAL).sum() for top in tops.values()]])
    turn = {t: first + np.cumsum(top.state == LOCAL) - 1 for (t, top), first in zip(tops.items(), small)}
    tasks = int(min(max(small[-1], 1), most_tasks))
    shared = rows.sparkSession.sparkContext.broadcast((tops, turn))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        tops, turn = shared.value
        for tree, top, use, count, at, y, bins in _bagged(batches, p, tops, rates, rules.seed, LOCAL):
            if len(top.path) > 1:
                order = np.argsort(at.astype(np.uint16) if len(top.path) < 1 << 16 else at, kind="stable")
                use, count, at = use[order], count[order], at[order]
            columns = np.stack([y[use], count.astype(np.uint8), *(column[use] for column in bins)])
            first = _starts(at)
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(at)]):
                out.append((tree, top.path[at[a]], int(turn[tree][at[a]]), _squeeze(columns[:, a:b].tobytes())))
                size += len(out[-1][3])
            if size > 16 << 20:
                yield _parts(out)
                out, size = [], 0
        if out:
            yield _parts(out)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, node), parts in _by_node(batches):
            columns = np.concatenate([np.frombuffer(_expand(x), np.uint8).reshape(2 + p, -1) for x in parts], axis=1)
            parts.clear()
            grown = grow_arrays(columns[2:].T, columns[0], columns[1], tree, node, tries[tree], nominal_from, rules)
            yield pa.RecordBatch.from_pylist([_piece_row(tree, node, grown, nominal_from, rules.weights)], _PIECE_ARROW)

    (rows.mapInArrow(deal, PART).repartitionById(tasks, F.col("n").cast("int")).sortWithinPartitions("tree", "node")
     .mapInArrow(finish, PIECE).write.mode("append").parquet(path))


def _by_node(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, str], list[bytes]]]:
    """Parts of rows of one (tree, node) after the other, from parts in this order."""
    at, held = None, []
    for batch in batches:
        for row in range(batch.num_rows):
            key = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
            if key != at and held:
                yield at, held
                held = []
            at = key
            held.append(batch.column(3)[row].as_py())
    if held:
        yield at, held


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
        pa.int32(), pa.string(), pa.int64(), pa.binary()))], ["tree", "node", "n", "rows"])


def _split_large(rows: DataFrame, tops: dict[int, Top], path: str, p: int, nominal_from: int, tries: list,
                 rates: tuple[float, float] | None, rules: Rules, local_rows: int) -> dict[int, list[dict]]:
    """Search the splits of all open nodes in one pass, write their pieces; (node, chosen input, left side by bin,
    rows of either side) by tree. Chosen is -1 for leaves and -2 for nodes left to one task."""
    shared = rows.sparkSession.sparkContext.broadcast(tops)

    def count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for tree, top, rows, count, at, y, bins in _bagged(batches, p, shared.value, rates, rules.seed, OPEN):
            nodes = np.flatnonzero(top.state == OPEN)
            slot = np.zeros(len(top.path), np.int64)
            slot[nodes] = np.arange(len(nodes))
            where, tried = slot[at], tried_inputs(top.hashes[nodes], tries[tree], p)
            have = np.bincount(where, minlength=len(nodes))
            key, cells = (where * 2 + y[rows]) << 8, {}
            for i in range(p):
                use = slice(None) if tried[:, i].all() else np.flatnonzero(tried[where, i])
                cells[i] = np.bincount(key[use] | bins[i][rows[use]], count[use], len(nodes) * 512).astype(
                    np.uint32).reshape(len(nodes), 2, 256)
            for j in np.flatnonzero(have).tolist():
                counted = np.stack([cells[i][j] for i in np.flatnonzero(tried[j]).tolist()])
                out.append((tree, top.path[nodes[j]], int(have[j]), _squeeze(counted.tobytes())))
                size += len(out[-1][3])
            if size > 16 << 20:
                yield _parts(out)
                out, size = [], 0
        if out:
            yield _parts(out)

    def best_split(key: tuple, table: pa.Table) -> pa.Table:
        tree, node = key[0].as_py(), key[1].as_py()
        counted = sum(np.frombuffer(_expand(c), np.uint32).reshape(-1, 2, 256).astype(np.int64)
                      for c in table.column("rows").to_pylist())
        t0, t1 = counted[0].sum(axis=1)
        row = {"tree": tree, "node": node, "nodes": 0, "packed": None, "chosen": -2, "left": None, "n_left": 0, "n_right": 0}
        if t0 + t1 > local_rows:
            level = Level(1)
            tried = np.flatnonzero(tried_inputs(root_hash(tree, node, rules.seed), tries[tree], p)[0]).tolist()
            if splittable(np.array([t0]), np.array([t1]), len(node), rules)[0]:
                level = _one_node(dict(zip(tried, counted)), t0, t1, nominal_from, rules)
            by_set = level.input[0] >= nominal_from
            sides, cut = bits(level.words[:int(by_set)]), np.zeros(1, np.int32) if by_set else level.cut
            row |= _piece_row(tree, node, TreeArrays(level.input, cut, np.array([-1]), np.array([t0]), np.array([t1]),
                                                     level.gain, sides), nominal_from, rules.weights)
            row["chosen"] = int(level.input[0])
            if row["chosen"] >= 0:
                left = level.left(nominal_from)
                cells = counted[tried.index(row["chosen"])].sum(axis=0)
                row["left"], row["n_left"] = np.packbits(left).tobytes(), int(cells[left].sum())
                row["n_right"] = int(t0 + t1) - row["n_left"]
        return pa.Table.from_pylist([row], pa.schema([*_PIECE_ARROW, ("chosen", pa.int32()), ("left", pa.binary()),
                                                      ("n_left", pa.int64()), ("n_right", pa.int64())]))

    splits = cut_lineage(rows.mapInArrow(count_cells, PART).groupBy("tree", "node").applyInArrow(
        best_split, PIECE + ", chosen int, left binary, n_left long, n_right long"))
    splits.filter("chosen > -2").select("tree", "node", "nodes", "packed").write.mode("append").parquet(path)
    found: dict[int, list[dict]] = {}
    for r in splits.select("tree", "node", "chosen", "left", "n_left", "n_right").toArrow().to_pylist():
        found.setdefault(r["tree"], []).append(r)
    return found


def packed_trees(spark, path: str, first: int = 0, last: int | None = None) -> dict[int, dict[str, bytes]]:
    """Packed pieces by path of trees first..last (inclusive) of a folder, on the driver."""
    pieces = spark.read.schema(PIECE).parquet(path).filter(F.col("tree") >= first)
    if last is not None:
        pieces = pieces.filter(F.col("tree") <= last)
    found: dict[int, dict[str, bytes]] = {}
    for row in pieces.select("tree", "node", "packed").toArrow().to_pylist():
        found.setdefault(row["tree"], {})[row["node"]] = row["packed"]
    return dict(sorted(found.items()))


def unpack_tree(pieces: dict[str, bytes], gains: bool = True) -> TreeArrays:
    found = {node: unpack(x, gains) for node, x in pieces.items()}
    return found[""] if set(found) == {""} else assemble(found)


def load_trees(spark, path: str, first: int = 0, last: int | None = None) -> dict[int, TreeArrays]:
    """Trees first..last (inclusive) of a folder of pieces, assembled on the driver."""
    return {t: unpack_tree(pieces) for t, pieces in packed_trees(spark, path, first, last).items()}
