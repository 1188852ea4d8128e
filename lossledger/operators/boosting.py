"""Gradient-boosted trees over vectors of bytes, grown leaf by leaf from histograms.

Every feature is cut once into at most 63 bins; a row is one byte a feature, byte 63 says missing.
A tree grows by splitting the leaf of greatest gain until it has ``num_leaves``. A split round sums
the gradients by (leaf, feature, bin); the best split of a leaf follows from the sums alone.

Gradients are rounded to whole multiples of a fixed unit, so sums are exact, whatever the order in
which rows arrive. Trees therefore depend neither on the partitioning nor on lost executors, and
both ways to fit give the same ones:

* ``fit_by_rounds``: rows stay where they are. A round is one Spark job: tasks sum their rows'
  histograms, these are added up, and the driver finds the splits. A round also measures the children
  of all leaves that may still be split, so a tree takes about as many rounds as it is deep, not as
  it has leaves.
* ``fit_in_tasks``: many models over training sets of a proven size (``ROWS_IN_TASK``) side by side,
  one task each, as for folds and trials. Where there are more cores than models, a task's rows are
  dealt to helping processes, which are asked for sums as tasks are in a round, without a job.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossledger.operators.helpers import Helpers
from lossledger.session import stage

# Levels of a byte: 63 bins, and one for missing values.
BINS = 64
MISSING = BINS - 1
# Rows of a training set that one task may hold: some 260 bytes each, as vectors by row and by
# feature, pairs of features, gradients and places. Up to about so many a task alone needs less
# time a tree than the jobs of its rounds.
ROWS_IN_TASK = 6_000_000
ROWS_PER_BLOCK = 65_536
# Leaves of more rows are counted by pairs of features. Where they are fewer than one in so many,
# their vectors are fetched whole, since each lies in one place.
ROWS_FOR_PAIRS, SPARSE = 3_000, 16
# Leaves whose children are measured together with those of the leaf to be split: they are almost
# always split soon, and one call for several costs little more than one for one.
TURNS_AHEAD = 7
# Rows that a task of a fit by rounds works on at once, trees between two staged states of it, and
# tasks whose sums are added up in one step.
ROWS_PER_STATE, TREES_PER_STAGE, TASKS_ADDED_AT_ONCE = 500_000, 50, 32
# Whole numbers up to this size are exact in double precision.
EXACT = float(1 << 53)
# Least sum of second derivatives in a leaf, and what steadies the order of categories.
LEAST_HESSIAN, SMOOTH = 1e-3, 10.0


@dataclass(frozen=True)
class Settings:
    """Parameters of a fit. Row sampling needs an interval that the usual parameter sets leave out,
    so ``subsample`` is accepted and has no effect, as there."""

    n_estimators: int = 100
    learning_rate: float = 0.1
    num_leaves: int = 31
    min_child_samples: int = 20
    colsample_bytree: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 0.0
    subsample: float = 1.0
    seed: int = 42
    binary: bool = True

    @staticmethod
    def of(params: dict, binary: bool) -> Settings:
        whole = {"n_estimators", "num_leaves", "min_child_samples", "seed"}
        return Settings(binary=binary, **{k: int(v) if k in whole else float(v)
                                          for k, v in params.items()})


@dataclass
class Tree:
    """Nodes in the order in which they were made, the root first. ``left`` is -1 in leaves."""

    feature: list[int] = field(default_factory=list)
    goes_left: list[bytes] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)

    def add(self, value: float, rows: int) -> int:
        for column, blank in ((self.feature, -1), (self.goes_left, b""), (self.left, -1),
                              (self.right, -1), (self.value, value), (self.rows, rows)):
            column.append(blank)
        return len(self.left) - 1

    def mask(self, node: int) -> np.ndarray:
        """For each byte, whether it goes left."""
        return np.unpackbits(np.frombuffer(self.goes_left[node], np.uint8)).astype(bool)

    def leaves(self) -> list[int]:
        return [i for i, child in enumerate(self.left) if child < 0]


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    goes_left: bytes
    left: tuple[float, float, int]
    right: tuple[float, float, int]


# -- what both ways share --------------------------------------------------------------------


def gradients(margin: np.ndarray, label: np.ndarray, unit: float,
              binary: bool) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss, in whole multiples of ``unit``."""
    if binary:
        p = 1.0 / (1.0 + np.exp(-margin))
        return np.rint((p - label) / unit), np.rint(p * (1.0 - p) / unit)
    return np.rint((margin - label) / unit), np.full(len(label), np.rint(1.0 / unit))


def histogram(x: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """(3, features, bins): sums of g and h and the number of rows, by byte."""
    n, width = x.shape
    out = np.zeros((3, width * BINS))
    base = np.arange(width) * BINS
    for i in range(0, n, ROWS_PER_BLOCK):
        at = (x[i:i + ROWS_PER_BLOCK] + base).ravel()
        for k, weight in enumerate((g, h)):
            out[k] += np.bincount(at, np.repeat(weight[i:i + ROWS_PER_BLOCK], width), width * BINS)
        out[2] += np.bincount(at, minlength=width * BINS)
    return out.reshape(3, width, BINS)


def pairs_of(columns: np.ndarray, features: np.ndarray) -> list[np.ndarray]:
    """Both bytes of a pair of features in one number; the last feature may stand alone.
    ``columns`` has a row per feature."""
    return [(columns[f].astype(np.uint16) << 6) | (columns[more[0]] if len(more) else 0)
            for f, more in ((features[j], features[j + 1:j + 2])
                            for j in range(0, len(features), 2))]


def paired_histogram(pairs: list[np.ndarray], width: int, rows: np.ndarray | slice, g: np.ndarray,
                     h: np.ndarray, binary: bool, counts: np.ndarray | None = None) -> np.ndarray:
    """The ``histogram`` of ``rows``: a count by both bytes of a pair holds those by either, for one
    pass over the rows. Two sums are one of complex numbers, whose parts add up apart: both
    derivatives, or, where second ones are all alike and follow from it, the first one and the
    number of rows. Where ``counts`` are known, rows are not counted."""
    out = np.empty((3, width, BINS))
    both = _both(g[rows], h[rows], binary)
    sums = np.empty(BINS * BINS, complex)
    for k, pair in enumerate(pairs):
        at = pair[rows].astype(np.intp)
        sums.fill(0.0)
        np.add.at(sums, at, both)
        cells = [sums.reshape(BINS, BINS)]
        if binary and counts is None:
            cells.append(np.bincount(at, minlength=BINS * BINS).reshape(BINS, BINS))
        for i, axis in ((2 * k, 1), (2 * k + 1, 0))[:width - 2 * k]:
            both_sums = cells[0].sum(axis=axis)
            out[0, i], out[1 if binary else 2, i] = both_sums.real, both_sums.imag
            if len(cells) > 1:
                out[2, i] = cells[1].sum(axis=axis)
    if not binary:
        out[1] = out[2] * (h[0] if len(h) else 0.0)
    elif counts is not None:
        out[2] = counts
    return out


def _both(g: np.ndarray, h: np.ndarray, binary: bool) -> np.ndarray:
    """What is added up together, as complex numbers."""
    both = np.empty(len(g), complex)
    both.real, both.imag = g, h if binary else 1.0
    return both


def small_histogram(x: np.ndarray, g: np.ndarray, h: np.ndarray, binary: bool) -> np.ndarray:
    """The ``histogram`` of few rows, all sums at once where they fit: above the sum of the second
    derivatives a double has bits left for the number of rows."""
    n, width = x.shape
    at = np.add(x, np.arange(width) * BINS, dtype=np.intp).ravel()
    both = _both(g, h, binary)
    above = 2.0 ** math.ceil(math.log2(h.max() * n + 1.0)) if binary and n else 1.0
    counted = binary and above * (n + 1) <= EXACT
    if counted:
        both.imag += above
    sums = np.zeros(width * BINS, complex)
    np.add.at(sums, at, np.repeat(both, width))
    out = np.empty((3, width * BINS))
    out[0], out[1 if binary else 2] = sums.real, sums.imag
    if counted:
        np.floor(out[1] / above, out=out[2])
        out[1] -= out[2] * above
    elif binary:
        out[2] = np.bincount(at, minlength=width * BINS)
    else:
        out[1] = out[2] * (h[0] if n else 0.0)
    return out.reshape(3, width, BINS)


def _score(g, h, s: Settings, more=0.0):
    shrunk = np.maximum(np.abs(g) - s.reg_alpha, 0.0) if s.reg_alpha else g
    return shrunk * shrunk / (h + s.reg_lambda + more)


def leaf_value(g: float, h: float, s: Settings) -> float:
    size = max(abs(g) - s.reg_alpha, 0.0) / (h + s.reg_lambda) if h + s.reg_lambda > 0 else 0.0
    return -math.copysign(size, g) * s.learning_rate


def best_split(sums: np.ndarray, features: np.ndarray, categorical: np.ndarray, unit: float,
               s: Settings) -> Split | None:
    """The best split of one leaf, from its histogram."""
    return best_splits(sums[:, None], features, categorical, unit, s)[0]


def best_splits(sums: np.ndarray, features: np.ndarray, categorical: np.ndarray, unit: float,
                s: Settings) -> list[Split | None]:
    """Per leaf the split of greatest gain, the first of equal ones; None if none gains.

    ``sums`` is (3, leaves, features, bins), with a row per feature of ``features``. Numbers are cut
    between two bytes, and missing ones go to the side that gains more. Categories are cut in the
    order of their mean gradient, which holds the best of all divisions into two; missing ones go
    right.
    """
    leaves, width = sums.shape[1:3]
    g_all, h_all, n_all = sums[:, :, 0].sum(axis=2) * np.array([[unit], [unit], [1.0]])
    least = max(s.min_child_samples, 1)
    rows = sums.reshape(3, leaves * width, BINS)
    known, gap = rows[:, :, :MISSING], rows[:, :, MISSING]
    kinds = np.tile(categorical, leaves)
    groups = np.flatnonzero(kinds)
    if len(groups):
        g, h, n = known[:, groups]
        order = np.argsort(np.where(n > 0, g / (h + SMOOTH / unit), np.inf), axis=1, kind="stable")
        known = known.copy()
        known[:, groups] = known[:, groups[:, None], order]
    below = np.cumsum(known, axis=2)
    some = known[2] > 0
    most = np.repeat(n_all - least, width)[:, None]
    found: list[tuple | None] = [None] * leaves
    whole = _score(g_all, np.maximum(h_all, LEAST_HESSIAN), s)
    gappy = np.flatnonzero(~kinds & (gap[2] > 0))
    # Missing values on the right of all features, then on the left of those that have any.
    for gap_left in (False, True):
        if gap_left:
            if not len(gappy):
                break
            left = below[:, gappy] + gap[:, gappy, None]
            ok = (left[2] >= least) & (left[2] <= most[gappy]) & some[gappy]
            first = np.searchsorted(gappy, np.arange(leaves + 1) * width)
        else:
            left, ok = below, (below[2] >= least) & (below[2] <= most) & some
            first = np.arange(leaves + 1) * width
        at = np.flatnonzero(ok)
        if not len(at):
            continue
        cuts = np.searchsorted(at, first * MISSING)
        each = np.diff(cuts)
        gl, hl = left[0].take(at) * unit, left[1].take(at) * unit
        gr, hr = np.repeat(g_all, each) - gl, np.repeat(h_all, each) - hl
        more = 0.0
        if len(groups) and not gap_left:
            more = np.repeat(np.where(kinds, SMOOTH, 0.0), np.count_nonzero(ok, axis=1))
        gain = (_score(gl, np.maximum(hl, LEAST_HESSIAN), s, more)
                + _score(gr, np.maximum(hr, LEAST_HESSIAN), s, more))
        gain[(hl < LEAST_HESSIAN) | (hr < LEAST_HESSIAN)] = -np.inf
        for k in range(leaves):
            if cuts[k] == cuts[k + 1]:
                continue
            i = int(cuts[k] + gain[cuts[k]:cuts[k + 1]].argmax())
            more_gain = float(gain[i] - whole[k])
            if more_gain > 1e-12 and (found[k] is None or more_gain > found[k][0]):
                row, place = divmod(int(at[i]), MISSING)
                n = int(left[2, row, place])
                found[k] = (more_gain, int(gappy[row]) if gap_left else row, place, gap_left,
                            (float(gl[i]), float(hl[i]), n),
                            (float(gr[i]), float(hr[i]), int(n_all[k]) - n))
    out: list[Split | None] = []
    for one in found:
        if one is None:
            out.append(None)
            continue
        gain, row, place, gap_left, left, right = one
        goes = np.zeros(BINS, bool)
        if kinds[row]:
            goes[order[np.searchsorted(groups, row), :place + 1]] = True
        else:
            goes[:place + 1] = True
            goes[MISSING] = gap_left
        out.append(Split(gain, int(features[row % width]), np.packbits(goes).tobytes(), left,
                         right))
    return out


def grow(measure: Callable, s: Settings, ahead: bool,
         most: int | None = None) -> tuple[Tree, dict]:
    """One tree, best leaf first, and the path of every leaf (0 left, 1 right).

    ``measure(paths, splits)`` gives the sums and the best split of each leaf named by its path;
    ``splits`` holds the splits known so far. With ``ahead`` a call also measures the children of
    all leaves whose turn may come, or of the ``most`` first of them, so that there are few calls;
    the tree is the same.
    """
    known: dict[tuple, Split | None] = {}
    root = measure([()], known)[()]
    known[()] = root[1]
    tree = Tree()
    place = {(): tree.add(leaf_value(*root[0][:2], s), int(root[0][2]))}
    queue = [(-root[1].gain, 0, ())] if root[1] else []
    leaves, turn = 1, 0
    while queue and leaves < s.num_leaves:
        _, _, path = heapq.heappop(queue)
        split = known[path]
        node = place.pop(path)
        tree.feature[node], tree.goes_left[node] = split.feature, split.goes_left
        children = [(*path, 0), (*path, 1)]
        for child, sums in zip(children, (split.left, split.right)):
            place[child] = tree.add(leaf_value(*sums[:2], s), int(sums[2]))
        tree.left[node], tree.right[node] = place[children[0]], place[children[1]]
        leaves += 1
        if leaves >= s.num_leaves:
            break
        if children[0] not in known:
            turns = [path]
            if ahead:
                left = s.num_leaves - leaves
                turns += may_follow(queue, known, left if most is None else min(left, most))
            wanted = [(*p, side) for p in turns for side in (0, 1) if (*p, side) not in known]
            known.update({p: split for p, (_, split) in measure(wanted, known).items()})
        for child in children:
            turn += 1
            if known[child]:
                heapq.heappush(queue, (-known[child].gain, turn, child))
    return tree, place


def may_follow(queue: list, known: dict, turns: int) -> list[tuple]:
    """The leaves that may be among the next ``turns`` to be split and whose children are not known:
    those that are if children not yet known never come first."""
    ahead, out = list(queue), []
    while ahead and turns:
        _, _, path = heapq.heappop(ahead)
        turns -= 1
        if (*path, 0) not in known:
            out.append(path)
            continue
        for child in ((*path, 0), (*path, 1)):
            if known[child]:
                heapq.heappush(ahead, (-known[child].gain, 0, child))
    return out


def tree_features(s: Settings, number: int, width: int) -> np.ndarray:
    """The features that a tree may use."""
    few = max(1, min(width, round(width * s.colsample_bytree)))
    return np.sort(np.random.default_rng([s.seed, number]).permutation(width)[:few])


# -- one task, one model ---------------------------------------------------------------------


class _RowsHere:
    """Measures leaves over rows in memory; the larger child is its parent less the smaller.
    ``columns`` are the rows ``x`` once more, a row per feature. ``counts`` are all rows by feature
    and byte, if known."""

    def __init__(self, x, columns, g, h, features, categorical, unit, s, counts=None):
        self.x, self.columns = x, columns
        self.counts = None if counts is None else counts[features]
        self.pairs = pairs_of(columns, features) if len(x) > ROWS_FOR_PAIRS else []
        self.g, self.h, self.unit, self.s = g, h, unit, s
        self.features, self.categorical = features, categorical[features]
        self.rows: dict[tuple, np.ndarray] = {(): np.arange(len(x))}
        self.sums: dict[tuple, np.ndarray] = {}
        self.divided: set[tuple] = set()

    def add_to(self, margin: np.ndarray, values: dict[tuple, float]) -> None:
        """Adds the value of each leaf of the tree. Rows may have been divided further than it."""
        for path, rows in self.rows.items():
            while path not in values:
                path = path[:-1]
            margin[rows] += values[path]

    def divide(self, path: tuple, split: Split) -> None:
        self.divided.add(path)
        mask = np.unpackbits(np.frombuffer(split.goes_left, np.uint8)).astype(bool)
        rows = self.rows.pop(path)
        if path:
            left = mask.take(self.columns[split.feature].take(rows))
            self.rows[(*path, 0)], self.rows[(*path, 1)] = rows[left], rows[~left]
        else:
            left = mask.take(self.columns[split.feature])
            self.rows[(0,)], self.rows[(1,)] = np.flatnonzero(left), np.flatnonzero(~left)

    def _histogram(self, path: tuple) -> np.ndarray:
        rows = self.rows[path]
        if len(rows) > ROWS_FOR_PAIRS:
            width, binary = len(self.features), self.s.binary
            if len(rows) * SPARSE < len(self.x):
                few = pairs_of(np.ascontiguousarray(self.x.take(rows, axis=0).T), self.features)
                return paired_histogram(few, width, slice(None), self.g[rows], self.h[rows], binary)
            return paired_histogram(self.pairs, width, rows if path else slice(None), self.g,
                                    self.h, binary, None if path else self.counts)
        few = self.x.take(rows, axis=0).take(self.features, axis=1)
        return small_histogram(few, self.g[rows], self.h[rows], self.s.binary)

    def __call__(self, paths: list[tuple], splits: dict) -> dict:
        for path in paths:
            if path and path not in self.rows:
                self.divide(path[:-1], splits[path[:-1]])
        for path in paths:
            if not path:
                self.sums[path] = self._histogram(path)
            elif path not in self.sums:
                pair = [(*path[:-1], 0), (*path[:-1], 1)]
                small = min(pair, key=lambda p: len(self.rows[p]))
                other = pair[1 - pair.index(small)]
                self.sums[small] = self._histogram(small)
                self.sums[other] = self.sums.pop(path[:-1]) - self.sums[small]
        sums = np.stack([self.sums[p] for p in paths], axis=1)
        totals = sums[:, :, 0].sum(axis=2) * np.array([[self.unit], [self.unit], [1.0]])
        splits = best_splits(sums, self.features, self.categorical, self.unit, self.s)
        return {p: (tuple(t), split) for p, t, split in zip(paths, totals.T.tolist(), splits)}


def fit_rows(x: np.ndarray, y: np.ndarray, categorical: np.ndarray, base: float, unit: float,
             s: Settings) -> list[Tree]:
    """All trees over rows in memory."""
    margin = np.full(len(y), base)
    columns = np.ascontiguousarray(x.T)
    counts = np.stack([np.bincount(column, minlength=BINS) for column in columns])
    trees = []
    for number in range(s.n_estimators):
        g, h = gradients(margin, y, unit, s.binary)
        rows = _RowsHere(x, columns, g, h, tree_features(s, number, x.shape[1]), categorical, unit,
                         s, counts)
        tree, place = grow(rows, s, ahead=True, most=TURNS_AHEAD)
        for parent, split in _not_taken(tree, place, rows.divided).items():
            rows.divide(parent, split)
        rows.add_to(margin, {path: tree.value[node] for path, node in place.items()})
        trees.append(tree)
    return trees


def _not_taken(tree: Tree, place: dict, divided: set) -> dict[tuple, Split]:
    """The last turns of a tree, whose children were not measured."""
    return {p[:-1]: _split_of(tree, node) for p, node in place.items()
            if p and p[:-1] not in divided}


class _Share:
    """The rows of a task that one of its helpers holds."""

    def __init__(self, categorical: np.ndarray, base: float, unit: float, s: Settings):
        self.categorical, self.base, self.unit, self.s = categorical, base, unit, s
        self.parts: list[tuple[bytes, np.ndarray]] = []

    def add(self, x: bytes, y: np.ndarray) -> None:
        self.parts.append((x, y))

    def begin(self, number: int) -> None:
        """Turns to a tree."""
        if self.parts:
            self.y = np.concatenate([y for _, y in self.parts])
            x = np.frombuffer(b"".join(x for x, _ in self.parts), np.uint8)
            self.parts = []
            self.x = x.reshape(len(self.y), -1)
            self.columns = np.ascontiguousarray(self.x.T)
            self.counts = np.stack([np.bincount(c, minlength=BINS) for c in self.columns])
            self.margin = np.full(len(self.y), self.base)
        self.rows = None
        g, h = gradients(self.margin, self.y, self.unit, self.s.binary)
        self.rows = _RowsHere(self.x, self.columns, g, h,
                              tree_features(self.s, number, self.x.shape[1]), self.categorical,
                              self.unit, self.s, self.counts)

    def sums(self, out: np.ndarray, paths: list[tuple], splits: dict) -> None:
        """The sums of leaves; ``splits`` has those of their parents."""
        self.divide(splits)
        for sums, path in zip(out.reshape(len(paths), -1), paths):
            sums[:] = self.rows._histogram(path).ravel()

    def divide(self, splits: dict) -> None:
        for path, split in splits.items():
            self.rows.divide(path, split)

    def end(self, values: dict, splits: dict) -> None:
        """The value of each leaf, and the turns that are not taken yet."""
        self.divide(splits)
        self.rows.add_to(self.margin, values)


def fit_with_helpers(helpers: Helpers, categorical: np.ndarray, unit: float,
                     s: Settings) -> list[Tree]:
    """All trees over the rows that helpers hold: those of ``fit_rows``, since sums are exact."""
    trees = []
    for number in range(s.n_estimators):
        helpers.tell_all("begin", number)
        done: set[tuple] = set()

        def add_up(paths: list[tuple], splits: dict) -> np.ndarray:
            turns = {p[:-1]: splits[p[:-1]] for p in paths if p}
            done.update(turns)
            size = 3 * len(features) * BINS
            return helpers.add_up(len(paths) * size, "sums", paths, turns).reshape(
                len(paths), 3, -1, BINS)

        features = tree_features(s, number, len(categorical))
        tree, place = grow(_measure_of(add_up, features, categorical, unit, s), s, ahead=True,
                           most=TURNS_AHEAD)
        helpers.tell_all("end", {p: tree.value[node] for p, node in place.items()},
                         _not_taken(tree, place, done))
        trees.append(tree)
    return trees


def _split_of(tree: Tree, child: int) -> Split:
    parent = next(i for i in range(len(tree.left)) if child in (tree.left[i], tree.right[i]))
    return Split(0.0, tree.feature[parent], tree.goes_left[parent], (), ())


_TREE_SQL = ("model int, tree int, feature array<int>, goes_left array<binary>, left array<int>, "
             "right array<int>, value array<double>, rows array<long>")
_TREE = pa.schema([
    ("model", pa.int32()), ("tree", pa.int32()), ("feature", pa.list_(pa.int32())),
    ("goes_left", pa.list_(pa.binary())), ("left", pa.list_(pa.int32())),
    ("right", pa.list_(pa.int32())), ("value", pa.list_(pa.float64())),
    ("rows", pa.list_(pa.int64()))])


def _tree_rows(model: int, trees: list[Tree]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([
        {"model": model, "tree": i, "feature": t.feature, "goes_left": t.goes_left, "left": t.left,
         "right": t.right, "value": t.value, "rows": t.rows} for i, t in enumerate(trees)],
        schema=_TREE)


def tree_frame(spark: SparkSession, trees: list[Tree], model: int = 0) -> DataFrame:
    """One row per tree."""
    return spark.createDataFrame(pa.Table.from_batches([_tree_rows(model, trees)]), _TREE_SQL)


def trees_of(frame: DataFrame, model: int = 0) -> list[Tree]:
    """The trees of a frame: their number and size are set by the fit's parameters."""
    rows = frame.where(F.col("model") == model).orderBy("tree").collect()
    return [Tree(list(r["feature"]), [bytes(b) for b in r["goes_left"]], list(r["left"]),
                 list(r["right"]), list(r["value"]), list(r["rows"])) for r in rows]


class _Dealt:
    """The rows of one model in a task, and its fit, by the task itself or with helpers."""

    def __init__(self, categorical: np.ndarray, s: Settings, base: float, unit: float,
                 helpers: int = 1):
        self.categorical, self.s, self.base, self.unit = categorical, s, base, unit
        make = partial(_Share, categorical, base, unit, s)
        self.helpers = (Helpers(helpers, make, (TURNS_AHEAD + 1) * 3 * len(categorical) * BINS)
                        if helpers > 1 else None)
        self.parts: list[tuple[bytes, np.ndarray]] = []
        self.n = 0

    def add(self, x: bytes, y: np.ndarray) -> None:
        if self.helpers is None:
            self.parts.append((x, y))
            return
        vectors = np.frombuffer(x, np.uint8).reshape(len(y), -1)
        many = len(self.helpers.pipes)
        for i in range(many):
            at = (i - self.n) % many
            if at < len(y):
                self.helpers.tell(i, "add", vectors[at::many].tobytes(), y[at::many])
        self.n += len(y)

    def fit(self) -> list[Tree]:
        if self.helpers is not None:
            return fit_with_helpers(self.helpers, self.categorical, self.unit, self.s)
        y = np.concatenate([p[1] for p in self.parts])
        x = np.frombuffer(b"".join(p[0] for p in self.parts), np.uint8).reshape(len(y), -1)
        self.parts = []
        return fit_rows(x, y, self.categorical, self.base, self.unit, self.s)

    def close(self) -> None:
        if self.helpers is not None:
            self.helpers.close()


def fit_in_tasks(rows: DataFrame, models: dict[int, tuple],
                 categorical: np.ndarray) -> dict[int, list[Tree]]:
    """The trees of every model: ``rows`` is (model, x, y), of bounded size per model, and
    ``models`` gives each one's settings, base and unit, and the number of its helpers if there are
    any. A task fits one model."""
    # The longest fits begin first.
    order = sorted(models, key=lambda m: (*(-n for n in models[m][3:]), -models[m][0].n_estimators
                                          * models[m][0].num_leaves, m))
    places = {m: i for i, m in enumerate(order)}
    place = F.create_map(*(F.lit(v) for pair in places.items() for v in pair))[F.col("model")]

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Dealt] = {}
        try:
            for batch in batches:
                numbers = batch.column("model").to_numpy()
                for model in map(int, np.unique(numbers)):
                    mine = batch.filter(pa.array(numbers == model))
                    if model not in held:
                        held[model] = _Dealt(categorical, *models[model])
                    held[model].add(b"".join(mine.column("x").to_pylist()),
                                    mine.column("y").to_numpy())
            for model in held:
                yield _tree_rows(model, held[model].fit())
                held[model].close()
        finally:
            for one in held.values():
                one.close()

    # Partitions are named by number: two models never share a task, as a hash could have it.
    spread = rows.withColumn("_place", place).repartitionById(len(places), F.col("_place"))
    found = stage(spread.drop("_place").mapInArrow(fit, _TREE_SQL), "fitted")
    return {m: trees_of(found, m) for m in models}


# -- rounds over all tasks -------------------------------------------------------------------


def _blocks(batches) -> Iterator[pa.RecordBatch]:
    """Rows packed as bytes, up to ``ROWS_PER_STATE`` in a row: vectors (a row per feature), labels
    and margins."""
    held, n = [], 0
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS_PER_BLOCK):
            held.append(batch.slice(i, ROWS_PER_BLOCK))
            n += held[-1].num_rows
            if n >= ROWS_PER_STATE:
                yield _block(held)
                held, n = [], 0
    if n:
        yield _block(held)


def _block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    y, margin = (np.concatenate([part.column(c).to_numpy() for part in held])
                 for c in ("y", "margin"))
    x = np.frombuffer(b"".join(v for part in held for v in part.column("x").to_pylist()), np.uint8)
    return pa.RecordBatch.from_arrays(
        [pa.array([part.tobytes()], pa.binary())
         for part in (x.reshape(len(y), -1).T, y, margin)], names=["x", "y", "margin"])


def _unpacked(blocks) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for x, y, margin in blocks:
        y = np.frombuffer(y)
        yield np.frombuffer(x, np.uint8).reshape(-1, len(y)), y, np.frombuffer(margin)


def _reach(columns: np.ndarray, paths: list[tuple], splits: dict) -> dict[tuple, np.ndarray]:
    """The rows in each of the leaves; ``columns`` has a row per feature. Only turns that lead to
    one of them are taken."""
    wanted = {p[:i] for p in paths for i in range(1, len(p) + 1)}
    rows: dict[tuple, np.ndarray] = {}
    for parent in sorted({p[:-1] for p in wanted}, key=len):
        split = splits[parent]
        mask = np.unpackbits(np.frombuffer(split.goes_left, np.uint8)).astype(bool)
        here = rows.get(parent)
        values = columns[split.feature] if here is None else columns[split.feature].take(here)
        left = mask.take(values)
        for side, turn in ((0, left), (1, ~left)):
            if (*parent, side) in wanted:
                rows[(*parent, side)] = np.flatnonzero(turn) if here is None else here[turn]
    if () in paths:
        rows[()] = np.arange(columns.shape[1])
    return {p: rows[p] for p in paths}


def _leaf_histogram(columns: np.ndarray, features: np.ndarray, rows: np.ndarray, g: np.ndarray,
                    h: np.ndarray, binary: bool) -> np.ndarray:
    """The ``histogram`` of ``rows``, whose gradients are ``g`` and ``h``."""
    few = np.stack([columns[f][rows] for f in features])
    if len(rows) > ROWS_FOR_PAIRS:
        return paired_histogram(pairs_of(few, np.arange(len(few))), len(few), slice(None), g, h,
                                binary)
    return small_histogram(few.T, g, h, binary)


def _measure_by_job(state: RDD, features: np.ndarray, categorical: np.ndarray, unit: float,
                    s: Settings) -> Callable:
    """``measure`` of ``grow`` as one Spark job. Tasks sum the smaller child of each pair and the
    sums are added up."""
    binary = s.binary
    depth = 1 if state.getNumPartitions() <= TASKS_ADDED_AT_ONCE else 2

    def add_up(paths: list[tuple], needed: dict) -> np.ndarray:
        def summed(blocks):
            total = np.zeros((len(paths), 3, len(features), BINS), np.int64)
            for columns, y, margin in _unpacked(blocks):
                for k, rows in enumerate(_reach(columns, paths, needed).values()):
                    g, h = gradients(margin[rows], y[rows], unit, binary)
                    total[k] += _leaf_histogram(columns, features, rows, g, h, binary).astype(
                        np.int64)
            yield total

        return state.mapPartitions(summed).treeReduce(np.add, depth)

    return _measure_of(add_up, features, categorical, unit, s)


def _measure_of(add_up: Callable, features: np.ndarray, categorical: np.ndarray, unit: float,
                s: Settings) -> Callable:
    """``measure`` of ``grow`` from ``add_up(paths, splits)``, which sums leaves over all rows, given
    the splits on their paths. Only the smaller child of each pair is summed, the larger one is its
    parent less the smaller. The sums of a tree's leaves are set by its parameters, not by the rows,
    so one process holds them."""
    sums: dict[tuple, np.ndarray] = {}
    kinds = categorical[features]

    def measure(paths: list[tuple], splits: dict) -> dict:
        small = {p[:-1]: p if splits[p[:-1]].left[2] <= splits[p[:-1]].right[2]
                 else (*p[:-1], 1) for p in paths if p and p[-1] == 0}
        told = list(small.values()) or [()]
        needed = {p[:i]: splits[p[:i]] for p in told for i in range(len(p))}
        sums.update(zip(told, add_up(told, needed)))
        for parent, path in small.items():
            sums[(*parent, 1 - path[-1])] = sums.pop(parent) - sums[path]
        found = np.stack([sums[p] for p in paths], axis=1).astype(float)
        totals = found[:, :, 0].sum(axis=2) * np.array([[unit], [unit], [1.0]])
        best = best_splits(found, features, kinds, unit, s)
        return {p: (tuple(t), split) for p, t, split in zip(paths, totals.T.tolist(), best)}

    return measure


_STATE_SQL = "x binary, y binary, margin binary"


def _held(state: DataFrame) -> RDD:
    """A staged state for the rounds: a round as a job of the RDD needs no query plan of its own."""
    return state.rdd.map(lambda r: (bytes(r["x"]), bytes(r["y"]), bytes(r["margin"]))).persist(
        StorageLevel.MEMORY_AND_DISK_DESER)


def fit_by_rounds(rows: DataFrame, s: Settings, base: float, unit: float,
                  categorical: np.ndarray) -> list[Tree]:
    """All trees over rows (x, y) of any number, which stay in their partitions."""
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows.count() // ROWS_PER_STATE))
    packed = rows.select("x", F.col("y").cast("double").alias("y"), F.lit(base).alias("margin"))
    state = _held(stage(packed.repartition(tasks).mapInArrow(_blocks, _STATE_SQL), "boosting"))
    trees: list[Tree] = []
    before: RDD | None = None
    for number in range(s.n_estimators):
        features = tree_features(s, number, len(categorical))
        tree, _ = grow(_measure_by_job(state, features, categorical, unit, s), s, ahead=True)
        trees.append(tree)
        if before is not None:
            before.unpersist()
        # Kept for the tree's rounds, the first of which computes it; a lost share is computed
        # again from the state that was staged last.
        before, state = state, state.mapPartitions(_mover(tree)).persist(
            StorageLevel.MEMORY_AND_DISK_DESER)
        if (number + 1) % TREES_PER_STAGE == 0 and number + 1 < s.n_estimators:
            moved = state
            state = _held(stage(spark.createDataFrame(moved, _STATE_SQL, verifySchema=False),
                                "boosting"))
            moved.unpersist()
    for kept in (before, state):
        if kept is not None:
            kept.unpersist()
    return trees


def _mover(tree: Tree) -> Callable:
    def move(blocks):
        score = Scorer([tree])
        for columns, y, margin in _unpacked(blocks):
            yield columns.tobytes(), y.tobytes(), (margin + score(columns)).tobytes()

    return move


# -- scoring ---------------------------------------------------------------------------------


def leaf_order(tree: Tree) -> tuple[list[int], dict[int, int], list[tuple[int, int, int]]]:
    """Leaves from left to right; per inner node the interval of its leaves: (node, first, last),
    the first leaf of its right child in the map."""
    order: list[int] = []
    middle: dict[int, int] = {}
    spans: list[tuple[int, int, int]] = []

    def visit(node: int) -> None:
        if tree.left[node] < 0:
            order.append(node)
            return
        first = len(order)
        visit(tree.left[node])
        middle[node] = len(order)
        visit(tree.right[node])
        spans.append((node, first, len(order)))

    visit(0)
    return order, middle, spans


class Scorer:
    """Sums of leaf values. Per tree and feature, one table says for each byte which leaves it still
    allows, one bit a leaf; the tables' conjunction over the features leaves the leaf of a row."""

    def __init__(self, trees: list[Tree]):
        self.parts = []
        for tree in trees:
            order, middle, spans = leaf_order(tree)
            words = -(-len(order) // 64)
            tables: dict[int, np.ndarray] = {}
            for node, first, last in spans:
                allowed = np.ones((2, words * 64), np.uint8)
                allowed[0, first:middle[node]] = 0
                allowed[1, middle[node]:last] = 0
                bits = np.packbits(allowed, axis=1, bitorder="little").view(np.uint64)
                side = bits[tree.mask(node).astype(int)]
                feature = tree.feature[node]
                tables[feature] = tables[feature] & side if feature in tables else side
            self.parts.append((tables, words, np.array([tree.value[i] for i in order])))

    def leaves(self, x: np.ndarray, part: int) -> np.ndarray:
        """The place of each row's leaf, from left to right; ``x`` has a row per feature."""
        tables, words, values = self.parts[part]
        out = np.zeros(x.shape[1], np.int64)
        if len(values) == 1:
            return out
        for word in range(words):
            left = None
            for feature, table in tables.items():
                allowed = table[:, word][x[feature]]
                left = allowed if left is None else np.bitwise_and(left, allowed, out=left)
            # A trailing word allows the bits past the last leaf as well: only one is a leaf's.
            if word == words - 1 and len(values) % 64:
                left &= np.uint64((1 << (len(values) % 64)) - 1)
            some = left != 0
            out[some] = word * 64 + np.log2(left[some].astype(float)).astype(np.int64)
        return out

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(x.shape[1])
        for part, (_, _, values) in enumerate(self.parts):
            out += values[self.leaves(x, part)]
        return out
