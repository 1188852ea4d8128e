"""Periodic runs of words by an enhanced suffix array and the branching-tandem test.

A run is a longest stretch of words of one document that repeats with period q, the smallest of the
stretch, and is at least ``2 q`` and ``shortest`` words long.

1. Only words that can belong to a run are sorted. A run of 12 words has each of its words under a
   6-word gram that comes again in the document, so stretches without such grams are left out;
   what is left stands in one sequence per slice of texts, each stretch with an alphabet of its own,
   so that equal words of two stretches or documents do not match.
2. Prefix doubling gives the suffix array and its inverse (ISA); only suffixes that still tie are
   sorted again. The ranks of every doubling step are kept, from them come the common prefixes
   (LCP) of neighbours, exactly.
3. The nearest smaller LCP values on both sides bound each LCP interval, the values equal to the
   interval's own divide it into children. There is no tree and there are no nodes, only bounds.
4. Branching-tandem test: for every suffix i in all but the largest child of an interval of depth d,
   ISA[i + d] and ISA[i - d] in the interval but in another child say that a square of period d
   begins at i, or at i - d, and cannot be shifted right. Each suffix is tested O(log n) times.
5. A run has one such square for its period, at its right end; rotated left as far as it goes it is
   the run. Multiples of the period give the same stretch and merge into its smallest period.

Texts are worked on in slices of bounded size, or one by one if they are longer; nothing but rows of
the input is exchanged between tasks, so there is no shuffle. A text of n words takes about
4 (log2 n + 20) bytes a word where all of it is periodic.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.llm import arrays as a

SHORTEST = 12
RESULTS = {"n_words": "bigint", "runs": "array<struct<start:bigint,length:bigint,period:bigint>>",
           "collapsed_text": "string", "runs_sha256": "string", "collapsed_sha256": "string"}


def periodic_runs(docs: DataFrame, text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """``docs`` with the runs of each row's text and what is left of it without their repeats.

    Words are runs of bytes other than ASCII white space, numbered from 0. ``runs`` is ordered by
    start, then period. ``collapsed_text`` joins by one space the words that no run covers after
    its first period; runs_sha256 digests one line ``start,length,period`` per run. A null or empty
    text, and one of blanks only, has no words, no runs and an empty collapsed_text. Every row is
    for itself, so ids, ties and repeated rows do not matter; no rows give no rows. Other columns
    stay, except that the five result columns replace any of the same name.
    """
    if shortest < 4:
        raise ValueError("a run has at least four words")
    kept = [c for c in docs.columns if c not in RESULTS or c == text]
    rows = docs.select(F.struct(*kept).alias("row"), F.col(text).alias("text"))
    kinds = T.StructType([rows.schema["row"], *T._parse_datatype_string(
        ", ".join(f"{c} {kind}" for c, kind in RESULTS.items())).fields])
    out = rows.mapInArrow(lambda it: _batches(it, shortest), kinds)
    return out.select(*(F.col("row")[c].alias(c) for c in kept if c not in RESULTS), *RESULTS)


def longest(runs: str = "runs") -> Column:
    """The run of greatest length; ties by the smallest start, then period; null without runs."""
    first = F.array_sort(F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"),
        r["length"].alias("length"))))
    return F.get(first, F.lit(0))


# -- what tasks do ---------------------------------------------------------------------------


def _batches(batches, shortest: int) -> Iterator[pa.RecordBatch]:
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        sizes, texts, digests, lists, counts = [], [], [], [], [0]
        for _, data, offsets in a.text_slices(batch.column("text")):
            starts, ends, bounds, words = a.word_hashes(data, offsets)
            owner, first, length, period = find_runs(words, bounds, shortest)
            keep = _kept(len(words), bounds[owner] + first, length, period)
            lists.append(np.stack([first, length, period]))
            cuts = np.searchsorted(owner, np.arange(len(offsets)))
            for i in range(len(offsets) - 1):
                here = slice(bounds[i], bounds[i + 1])
                left = keep[here]
                told = a.joined(data, starts[here][left], ends[here][left])
                mine = slice(cuts[i], cuts[i + 1])
                lines = "".join(f"{s},{n},{q}\n" for s, n, q in zip(
                    first[mine].tolist(), length[mine].tolist(), period[mine].tolist()))
                sizes.append(len(left))
                counts.append(counts[-1] + cuts[i + 1] - cuts[i])
                texts.append(told)
                digests.append((hashlib.sha256(lines.encode()).hexdigest(),
                                hashlib.sha256(told).hexdigest()))
        flat = np.concatenate(lists, axis=1) if lists else np.zeros((3, 0), np.int64)
        runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in flat], fields=list(run))
        yield pa.RecordBatch.from_arrays([
            batch.column("row"), pa.array(sizes, pa.int64()),
            pa.ListArray.from_arrays(pa.array(counts, pa.int32()), runs),
            pa.array(texts, pa.binary()).cast(pa.string()),
            pa.array([x for x, _ in digests], pa.string()),
            pa.array([x for _, x in digests], pa.string())], names=["row", *RESULTS])


def _kept(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """True for the words that no run covers after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return np.cumsum(depth)[:-1] == 0


def find_runs(words: np.ndarray, bounds: np.ndarray, shortest: int = SHORTEST):
    """(owner, start, length, period) of the runs of several texts, by owner, start and period.

    ``words`` holds a hash per word, ``bounds`` the first word of each text and one past the last.
    """
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = _candidates(words, owner, shortest // 2)
    if not len(at):
        return (np.zeros(0, np.int64),) * 4
    stretch = np.cumsum((np.diff(at, prepend=at[0]) != 1) | (np.diff(owner[at], prepend=-1) != 0))
    letters = _letters(words[at], stretch)
    start, length, period = runs_of(letters, shortest)
    return _ordered(owner[at[start]], at[start] - bounds[owner[at[start]]], length, period)


def _ordered(owner, start, length, period):
    order = np.lexsort((period, start, owner))
    return owner[order], start[order], length[order], period[order]


def _candidates(words: np.ndarray, owner: np.ndarray, gram: int) -> np.ndarray:
    """The places of words under a gram that comes again in the same text.

    A run of ``2 gram`` words or more with period q repeats each of its grams q words further on
    or back, but for at most q - 1 in the middle of a short run, whose words the others cover.
    """
    grams = a.gram_hashes(words, gram)
    if not len(grams):
        return np.zeros(0, np.int64)
    inside = owner[:len(grams)] == owner[gram - 1:]
    key = grams ^ a.mix(owner[:len(grams)].astype(np.uint64) + np.uint64(1))
    place = np.flatnonzero(inside)
    key = key[place]
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    depth = np.zeros(len(words) + 1, np.int64)
    depth[place[again]] += 1
    depth[place[again] + gram] -= 1
    return np.flatnonzero(np.cumsum(depth)[:-1] > 0)


def _letters(words: np.ndarray, stretch: np.ndarray) -> np.ndarray:
    """A number for each distinct word of each stretch."""
    order = np.lexsort((words, stretch))
    new = a.changes(words[order], stretch[order])
    out = np.empty(len(words), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


# -- the enhanced suffix array ---------------------------------------------------------------


class SuffixArray:
    """``order`` (the suffixes sorted), ``rank`` (its inverse) and ``common`` (the length of the
    common prefix of each suffix in the order with the one before; 0 for the first)."""

    def __init__(self, letters: np.ndarray):
        n = len(letters)
        self.levels = [_dense(letters)]
        step = 1
        while True:
            rank = self.levels[-1]
            size = np.bincount(rank, minlength=n)
            tied = np.flatnonzero(size[rank] > 1)
            if not len(tied):
                break
            after = tied + step
            follow = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
            order = np.lexsort((follow, rank[tied]))
            group, follow = rank[tied][order], follow[order]
            heads = a.changes(group, follow)
            first = np.flatnonzero(a.changes(group))
            base = np.repeat(first, np.diff(np.append(first, len(group))))
            begin = np.maximum.accumulate(np.where(heads, np.arange(len(group)), 0))
            deeper = rank.copy()
            deeper[tied[order]] = group + (begin - base)
            self.levels.append(deeper)
            step *= 2
        self.rank = self.levels[-1]
        self.order = np.empty(n, np.int64)
        self.order[self.rank] = np.arange(n)
        self.common = np.zeros(n, np.int64)
        self.common[1:] = self.forward(self.order[:-1], self.order[1:])

    def forward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many letters the suffixes at x and at y, not the same ones, have in common."""
        n = len(self.rank)
        out = np.zeros(len(x), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            i, j = x + out, y + out
            ok = (i < n) & (j < n)
            ok[ok] = self.levels[k][i[ok]] == self.levels[k][j[ok]]
            out[ok] += 1 << k
        return out

    def backward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many letters before x and before y agree; x and y differ."""
        out = np.zeros(len(x), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            i, j = x - out - (1 << k), y - out - (1 << k)
            ok = (i >= 0) & (j >= 0)
            ok[ok] = self.levels[k][i[ok]] == self.levels[k][j[ok]]
            out[ok] += 1 << k
        return out


def _dense(letters: np.ndarray) -> np.ndarray:
    """The number of smaller letters in the sequence, for each place."""
    size = np.bincount(letters)
    return (np.cumsum(size) - size)[letters].astype(np.int64)


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """Where the next smaller value to the right is; the length if there is none. Every pointer
    jumps along the pointers of the places it passes, which are no smaller."""
    n = len(values)
    padded = np.append(values, np.iinfo(np.int64).min)
    to = np.append(np.arange(1, n + 1), n)
    going = np.flatnonzero(padded[to[:n]] >= values)
    while len(going):
        to[going] = to[to[going]]
        going = going[padded[to[going]] >= values[going]]
    return to[:n]


def runs_of(letters: np.ndarray, shortest: int = SHORTEST):
    """(start, length, period) of the runs of one sequence, in any order."""
    n = len(letters)
    array = SuffixArray(letters)
    # Boundaries between neighbours that share something; each lies in one LCP interval.
    low = n - 1 - nearest_smaller(array.common[::-1])[::-1]
    high = nearest_smaller(array.common) - 1
    edge = np.flatnonzero(array.common > 0)
    edge = edge[np.lexsort((edge, low[edge], array.common[edge]))]
    depth = array.common[edge]
    # The interval of a boundary is [low, high] in the order; equal boundaries of one follow.
    low, high = low[edge], high[edge]
    if not len(edge):
        return (np.zeros(0, np.int64),) * 3
    new = a.changes(depth, low)
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(edge)))
    # Children: from the interval's begin to its first boundary, between boundaries, to its end.
    children = count + 1
    total = int(children.sum())
    first = np.cumsum(children) - children
    begin = np.empty(total, np.int64)
    begin[first] = low[head]
    rest = np.ones(total, bool)
    rest[first] = False
    begin[rest] = edge
    end = np.empty(total, np.int64)
    end[:-1] = begin[1:] - 1
    end[first + children - 1] = high[head]
    size = end - begin + 1
    owner = np.repeat(np.arange(len(head)), children)
    # All but one largest child of each interval are tested.
    by_size = np.lexsort((-size, owner))
    small = np.ones(total, bool)
    small[by_size[first]] = False
    start, length, period = [], [], []
    tested = np.flatnonzero(small)
    for part in _parts(tested, size[tested]):
        found = _squares(array, begin[part], end[part], low[head][owner[part]],
                         high[head][owner[part]], depth[head][owner[part]])
        start.append(found[0])
        length.append(found[1])
        period.append(found[2])
    start, length, period = map(np.concatenate, (start, length, period))
    good = length >= shortest
    start, length, period = start[good], length[good], period[good]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    least = a.changes(start, length) if len(start) else np.zeros(0, bool)
    return start[least], length[least], period[least]


def _parts(index: np.ndarray, size: np.ndarray, limit: int = 1 << 20) -> list[np.ndarray]:
    """Consecutive children of about ``limit`` suffixes together."""
    cuts = np.flatnonzero(np.diff((np.cumsum(size) - 1) // limit)) + 1
    return np.split(index, cuts)


def _squares(array: SuffixArray, begin, end, low, high, depth):
    """The runs of the branching squares that the suffixes of these children are part of."""
    size = end - begin + 1
    at = array.order[a.ranges(begin, size)]
    begin, end, low, high, depth = (np.repeat(x, size) for x in (begin, end, low, high, depth))
    n = len(array.rank)
    squares = []
    for other, square in ((at + depth, at), (at - depth, at - depth)):
        ok = (other >= 0) & (other < n)
        place = array.rank[np.where(ok, other, 0)]
        ok &= (low <= place) & (place <= high) & ((place < begin) | (place > end))
        squares.append(np.stack([square[ok], depth[ok]]))
    square, q = np.concatenate(squares, axis=1)
    square, q = np.divmod(np.unique(square * (n + 1) + q), n + 1)
    turned = array.backward(square, square + q)
    return square - turned, turned + 2 * q, q
