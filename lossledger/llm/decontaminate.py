"""Benchmark decontamination by embedding edit distance into Hamming distance.

Words are runs of letters, digits and non-ASCII bytes, in lower case; in scripts without spaces
between words every character is a word. A passage of a document matches an item of n words if
their edit distance over words is at most int((1 - similarity) * n), at every length: an item of
fewer than five words matches its own words only at similarity 0.8.

1. Items are few and texts are many, so distinct item texts are sent to all tasks, in portions of
   bounded size; each portion is one pass over the documents.
2. Windows as long as an item are looked at only where they could match: each edit breaks at most
   two word pairs, so a match keeps at least n - 1 - 2k of the n - 1 pairs of an item of its
   length. This bound loses no match.
3. The CGK random walk reads a window: at each step it writes the current word, and a random bit
   that depends on step and word tells whether to move on. Few edits change few of the places. The
   first n steps are used: a walk cannot pass the end of a window in them, so no place is padding,
   on which all windows would agree. Each repetition samples ``PLACES`` places of one of ``WALKS``
   walks as the bucket key. Unrelated windows share a bucket in less than one case of a hundred; the
   number of repetitions follows from the target recall at the largest distance.
4. Windows and items that share a bucket are verified: exact edit distance of the item to the best
   part of the document around the window.
5. Items that allow no edit are looked up by the hash of all their words at every place.
"""

from __future__ import annotations

import math
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.llm import arrays as a
from lossledger.session import stage

SIMILARITY = 0.8
PLACES = 4
WALKS = 8
RECALL = 0.99
# Share of places on which window and item agree at the largest distance, as measured in tests.
AGREEMENT = 0.5
# Numbers that the walks of the windows of one step of a task take up at once.
STEP_VALUES = 1 << 22
# Text of items that a task holds at once.
PORTION = 16 << 20

_HITS = [("first_word", T.LongType()), ("n_words", T.LongType()), ("edits", T.LongType()),
         ("similarity", T.DoubleType())]
_PAD = np.uint64(0x5BD1E9955BD1E995)
_CLASSES = 64
# Matches that a task holds before it hands them on.
_ROWS = 100_000
_PROBE = 14

_GAPS = np.ones(256, bool)
_GAPS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

# First and last character of the blocks whose scripts put no spaces between words: Thai and Lao,
# Tibetan, Burmese, Khmer, Tai, Han and kana with their punctuation, Javanese, wide forms.
_UNSPACED = np.array([
    (0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF),
    (0x1A20, 0x1AAF), (0x2E80, 0x312F), (0x3190, 0x4DBF), (0x4E00, 0x9FFF), (0xA980, 0xA9FF),
    (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF00, 0xFF9F), (0x20000, 0x3FFFF)])


def repetitions(recall: float = RECALL, agreement: float = AGREEMENT, places: int = PLACES) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - agreement ** places)))


def words_of(data: np.ndarray, offsets: np.ndarray):
    """(bounds, hashes) of the words of several texts."""
    folded = a.LOWER[data]
    # Capital letters of Latin-1 are C3 80 to C3 9E, but for the multiplication sign.
    capital = np.zeros(len(folded), bool)
    capital[1:] = (folded[:-1] == 0xC3) & (folded[1:] >= 0x80) & (folded[1:] <= 0x9E) & (
        folded[1:] != 0x97)
    folded = np.where(capital, folded + 0x20, folded)
    starts, ends, bounds = a.split_words(folded, offsets, _GAPS)
    starts, ends, bounds = _characters(folded, starts, ends, bounds)
    return bounds, a.hash_spans(folded, starts, ends)


def _characters(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray):
    """The words, cut before and after every character of a script without spaces."""
    at = np.flatnonzero(data >= 0xE0)
    at = at[at + 3 <= len(data)]
    if not len(at):
        return starts, ends, bounds
    wide = data[at] >= 0xF0
    last = np.minimum(at + 3, len(data) - 1)
    code = (data[at] & 15).astype(np.int64)
    code = code << 6 | data[at + 1] & 63
    code = code << 6 | data[at + 2] & 63
    code = np.where(wide, code << 6 | data[last] & 63, code)
    block = np.searchsorted(_UNSPACED[:, 0], code, "right") - 1
    own = (block >= 0) & (code <= _UNSPACED[block, 1])
    cuts = np.unique(np.append(at[own], (at + 3 + wide)[own]))
    word = np.searchsorted(starts, cuts, "right") - 1
    inside = (word >= 0) & (cuts > starts[word]) & (cuts < ends[word])
    cuts, word = cuts[inside], word[inside]
    return (np.sort(np.append(starts, cuts)), np.sort(np.append(ends, cuts)),
            bounds + np.searchsorted(word, bounds))


class Walk:
    """CGK walks of windows of ``n`` words, and the keys of their sampled places.

    ``WALKS`` walks share the repetitions: each walk is sampled several times.
    """

    def __init__(self, n: int, count: int, places: int = PLACES):
        rng = np.random.default_rng(n)
        self.n, self.count = n, count
        self.walks = min(WALKS, count)
        places = min(places, n)
        self.sampled = np.array([rng.choice(n, places, replace=False) for _ in range(count)])
        self.seeds = rng.integers(0, 2 ** 64, (self.walks, n), dtype=np.uint64) | np.uint64(1)
        self.mixers = rng.integers(0, 2 ** 64, (count, places), dtype=np.uint64) | np.uint64(1)

    @property
    def at_once(self) -> int:
        """Windows that may walk together."""
        return max(1, STEP_VALUES // (2 * self.n + self.walks * min(self.n, self.sampled.size)
                                      + self.count))

    def embed(self, windows: np.ndarray) -> dict[int, np.ndarray]:
        """What each walk writes at the sampled steps: (windows, walks) per step."""
        rows = np.arange(len(windows))[:, None]
        at = np.zeros((len(windows), self.walks), np.int64)
        wanted = set(self.sampled.ravel().tolist())
        out = {}
        for step in range(max(wanted) + 1):
            word = windows[rows, at]
            if step in wanted:
                out[step] = word
            # Hashes of words are mixed already: the top bit of a product is a fair coin.
            at += ((word * self.seeds[:, step]) >> np.uint64(63)).astype(np.int64)
        return out

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """One bucket key per window and repetition."""
        written = self.embed(windows)
        key = np.empty((len(windows), self.count), np.uint64)
        for r, places in enumerate(self.sampled.tolist()):
            own = np.full(len(windows), np.uint64(r + 1))
            for place, odd in zip(places, self.mixers[r]):
                own += written[place][:, r % self.walks] * odd
            key[:, r] = a.mix(own)
        return key


def padded(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Windows of ``n`` words from each start, padded from its end on, and one more pad."""
    at = starts[:, None] + np.arange(n + 1)[None, :]
    inside = (at < ends[:, None]) & (np.arange(n + 1) < n)
    return np.where(inside, words[np.minimum(at, len(words) - 1)], _PAD)


def _densest(pairs: int, least: int) -> int:
    """Of ``pairs`` in a row with ``least`` hits, so many hits at least lie in some ``_PROBE``."""
    blocks, rest = divmod(pairs, _PROBE)
    return next(c for c in range(max(least, 0) + 1) if blocks * c + min(rest, c) >= least)


class Items:
    """A portion of the items, ready to be looked up."""

    def __init__(self, rows: list[tuple], similarity: float = SIMILARITY, shortest: int = 1,
                 recall: float = RECALL):
        texts = pa.array([t for _, t in rows], pa.string())
        self.ids, self.words = [], []
        brief = []
        at = 0
        for _, data, offsets in a.text_slices(texts):
            bounds, words = words_of(data, offsets)
            for x, y in zip(bounds, bounds[1:]):
                if y - x < max(shortest, 1):
                    pass
                elif int((1 - similarity) * (y - x) + 1e-9):
                    self.ids.append(rows[at][0])
                    self.words.append(words[x:y])
                else:
                    brief.append((rows[at][0], words[x:y]))
                at += 1
        self.edits = [int((1 - similarity) * len(w) + 1e-9) for w in self.words]
        self.lengths = sorted({len(w) for w in self.words})
        self.count = repetitions(recall)
        self.walks = {n: Walk(n, self.count) for n in self.lengths}
        self.least_pairs = {n: n - 1 - 2 * int((1 - similarity) * n + 1e-9) for n in self.lengths}
        self.probe = min((_densest(n - 1, m) for n, m in self.least_pairs.items()), default=1)
        self._pairs()
        self._buckets()
        self._short(brief)

    def _short(self, brief: list[tuple]) -> None:
        """Per length without edits: the sorted hashes of its items, and the items of each."""
        found: dict[int, dict[int, list[int]]] = {}
        for key, words in brief:
            whole = int(a.gram_hashes(words, len(words))[0])
            found.setdefault(len(words), {}).setdefault(whole, []).append(len(self.words))
            self.ids.append(key)
            self.words.append(words)
            self.edits.append(0)
        self.short = {n: (np.array(sorted(own), np.uint64), [own[h] for h in sorted(own)])
                      for n, own in sorted(found.items())}

    def _pairs(self) -> None:
        """Which word pairs occur in items, and in items of which lengths (as bits)."""
        self.bit = {n: np.uint64(1 << (i * _CLASSES // len(self.lengths)))
                    for i, n in enumerate(self.lengths)}
        pairs = [a.gram_hashes(w, 2) for w in self.words]
        self.item_pairs = [np.unique(p) for p in pairs]
        bits = [np.full(len(p), self.bit[len(p) + 1]) for p in pairs]
        pairs = np.concatenate(pairs) if pairs else np.zeros(0, np.uint64)
        bits = np.concatenate(bits) if bits else np.zeros(0, np.uint64)
        self.pairs, first = np.unique(pairs, return_inverse=True)
        self.bits = np.zeros(len(self.pairs), np.uint64)
        np.bitwise_or.at(self.bits, first, bits)
        size = max(16, int(4 * len(self.pairs)).bit_length())
        self.mask = np.uint64((1 << size) - 1)
        self.maybe = np.zeros(1 << size, bool)
        self.maybe[(self.pairs & self.mask).astype(np.int64)] = True

    def _buckets(self) -> None:
        """Per length: the bucket keys of its items, sorted, and the item of each."""
        self.buckets = {}
        for n in self.lengths:
            own = np.array([i for i, w in enumerate(self.words) if len(w) == n])
            flat = np.concatenate([self.words[i] for i in own])
            starts = np.arange(len(own)) * n
            windows = padded(flat, starts, starts + n, n)
            step = self.walks[n].at_once
            keys = np.concatenate([self.walks[n].keys(windows[i:i + step]).ravel()
                                   for i in range(0, len(windows), step)])
            order = np.argsort(keys, kind="stable")
            self.buckets[n] = keys[order], np.repeat(own, self.count)[order]

    def pair_bits(self, pairs: np.ndarray) -> np.ndarray:
        """For each word pair the lengths of the items that have it."""
        out = np.zeros(len(pairs), np.uint64)
        at = np.flatnonzero(self.maybe[(pairs & self.mask).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.pairs, pairs[at]), len(self.pairs) - 1)
        found = self.pairs[place] == pairs[at]
        out[at[found]] = self.bits[place[found]]
        return out

    def matches(self, bounds: np.ndarray, words: np.ndarray):
        """(text, item, first word, words, edits) of every match in several texts."""
        yield from self._exact(bounds, words)
        if len(words) < 2 or not self.lengths:
            return
        pairs = a.gram_hashes(words, 2)
        bits = self.pair_bits(pairs)
        inner = bounds[1:-1]
        inner = inner[(inner > 0) & (inner <= len(bits))]
        bits[inner - 1] = 0  # no pair goes from one text into the next
        hits: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for item, first, last in self._candidates(bounds, words, pairs, bits):
            text = int(np.searchsorted(bounds, first, "right")) - 1
            hits.setdefault((text, item), []).extend(
                (edits, first - int(bounds[text]) + start, size) for start, size, edits in
                every_part(self.words[item], words[first:last], self.edits[item]))
        for (text, item), own in sorted(hits.items()):
            for edits, start, size in apart(own):
                yield text, item, start, size, edits

    def _exact(self, bounds: np.ndarray, words: np.ndarray):
        """Matches of the items without edits. Of those of one item that overlap, the first counts."""
        for n, (hashes, items) in self.short.items():
            whole = a.gram_hashes(words, n)
            place = np.minimum(np.searchsorted(hashes, whole), len(hashes) - 1)
            at = np.flatnonzero(hashes[place] == whole)
            text = np.searchsorted(bounds, at, "right") - 1
            inside = at + n <= bounds[text + 1]
            free: dict[int, int] = {}
            for first, t, begin, h in zip(at[inside].tolist(), text[inside].tolist(),
                                          bounds[text[inside]].tolist(),
                                          place[at[inside]].tolist()):
                if first >= free.get(h, 0):
                    free[h] = first + n
                    for item in items[h]:
                        yield t, item, first - begin, n, 0

    def _candidates(self, bounds, words, pairs, bits):
        """(item, first word, one past the last) of the parts that share a bucket with an item;
        parts of one item that are near one another are one."""
        some = np.append(0, np.cumsum(bits != 0))
        ends = np.minimum(np.arange(len(bits)) + _PROBE, len(bits))
        near = np.flatnonzero(some[ends] - some[:-1] >= self.probe)
        if not len(near):
            return
        # Windows that hold such a stretch begin at most a window before it.
        wide = self.lengths[-1]
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, np.maximum(near - wide, 0), 1)
        np.add.at(depth, np.minimum(near + wide + _PROBE, len(words)), -1)
        at = np.flatnonzero(np.cumsum(depth)[:-1] > 0)
        own_bits = bits[np.minimum(at, len(bits) - 1)]
        own_bits[at >= len(bits)] = 0
        after = np.searchsorted(bounds, at, "right")
        begin, stop = bounds[after - 1], bounds[after]
        for n in self.lengths:
            total = np.append(0, np.cumsum((own_bits & self.bit[n]) != 0))
            until = np.minimum(np.arange(len(at)) + n - 1, len(at))
            chosen = np.flatnonzero(total[until] - total[:-1] >= self.least_pairs[n])
            step = self.walks[n].at_once
            for i in range(0, len(chosen), step):
                part = chosen[i:i + step]
                yield from self._length(n, at[part], begin[part], stop[part], words, pairs)

    def _length(self, n, starts, begins, stops, words, pairs):
        """Candidates among windows of one length."""
        keys, owner = self.buckets[n]
        own = self.walks[n].keys(padded(words, starts, stops, n))
        low = np.searchsorted(keys, own)
        high = np.searchsorted(keys, own, "right")
        row, turn = np.nonzero(high > low)
        low, high = low[row, turn], high[row, turn]
        found = np.divmod(np.unique(owner[a.ranges(low, high - low)] * len(starts)
                                    + np.repeat(row, high - low)), len(starts))
        # Of the pairs of its own words an item keeps enough, or the bucket was chance.
        place = starts[:, None] + np.arange(n - 1)[None, :]
        inside = place < (stops - 1)[:, None]
        window_pairs = pairs[np.minimum(place, len(pairs) - 1)]
        for item in np.unique(found[0]):
            rows = found[1][found[0] == item]
            kept = (np.isin(window_pairs[rows], self.item_pairs[item]) & inside[rows]).sum(axis=1)
            rows = rows[kept >= self.least_pairs[n]]
            if not len(rows):
                continue
            slack = self.edits[item]
            place_of = starts[rows]
            new = np.append(True, (np.diff(place_of) > n)
                            | (stops[rows][1:] != stops[rows][:-1]))
            heads = np.flatnonzero(new)
            tails = np.append(heads[1:], len(rows)) - 1
            for x, y in zip(heads, tails):
                yield (int(item), max(int(begins[rows[x]]), int(place_of[x]) - slack),
                       min(int(stops[rows[y]]), int(place_of[y]) + n + slack))


def apart(hits: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (edits, first word, words) those that do not overlap a nearer one, by place."""
    kept: list[tuple[int, int, int]] = []
    for edits, start, size in sorted(set(hits)):
        if all(start >= s + n or start + size <= s for _, s, n in kept):
            kept.append((edits, start, size))
    return sorted(kept, key=lambda h: h[1])


def _distances(item: np.ndarray, part: np.ndarray, free: bool) -> list[int]:
    """Edit distance of the item to the part up to each place; ``free``: from any place on.

    A column of the table of distances is two whole numbers, one bit a word of the item, that say
    where it rises and falls; a word of the part turns them by a few operations on whole numbers.
    """
    size = len(item)
    whole, top = (1 << size) - 1, 1 << (size - 1)
    places: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        places[word] = places.get(word, 0) | 1 << i
    rises, falls, last = whole, 0, size
    out = [last]
    for word in part.tolist():
        same = places.get(word, 0)
        level = (((same & rises) + rises) ^ rises) | same
        up, down = falls | (whole & ~(level | rises)), rises & level
        last += bool(up & top) - bool(down & top)
        out.append(last)
        up = (up << 1 | (not free)) & whole
        down = down << 1 & whole
        steep = same | falls
        rises, falls = down | (whole & ~(steep | up)), up & steep
    return out


def best_part(item: np.ndarray, part: np.ndarray, edits: int) -> tuple[int, int, int] | None:
    """(first word, words, edits) of the part's stretch nearest to the item, if near enough; the
    first of equal ones."""
    # A stretch that is the item itself needs no table.
    if len(part) >= len(item):
        windows = np.lib.stride_tricks.sliding_window_view(part, len(item))
        same = np.flatnonzero((windows == item).all(axis=1))
        if len(same):
            return int(same[0]), len(item), 0
    ends = _distances(item, part, True)
    end = ends.index(min(ends))
    if ends[end] > edits:
        return None
    back = _distances(item[::-1], part[:end][::-1], False)
    size = back.index(min(back))
    return end - size, size, ends[end]


def every_part(item: np.ndarray, part: np.ndarray, edits: int):
    """The matches of the item that do not overlap, the nearest first."""
    left = [(0, len(part))]
    own = np.isin(a.gram_hashes(part, 2), a.gram_hashes(item, 2))
    while left:
        x, y = left.pop()
        # Each edit breaks two pairs at most.
        if y - x < len(item) - edits or own[x:y - 1].sum() < len(item) - 1 - 2 * edits:
            continue
        hit = best_part(item, part[x:y], edits)
        if hit:
            start, size, near = hit
            yield x + start, size, near
            left += [(x, x + start), (x + start + max(size, 1), y)]


# -- Spark -----------------------------------------------------------------------------------


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
          item_key: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY,
          shortest: int = 1) -> DataFrame:
    """(key, item key, first_word, n_words, edits, similarity) per match of an item in a document.

    Places count the words that decontamination sees. Overlapping matches of one item are one row.
    An item of fewer than ``shortest`` words matches nothing; a document or an item without words or
    text never does. Rows with equal or null keys are searched one by one; items with equal texts
    are searched once and all reported. No documents or no items give no rows.
    """
    spark = docs.sparkSession
    told = items.select(F.col(item_key).alias("i"), F.col(item_text).alias("t")).where(
        "t is not null").withColumn("h", F.xxhash64("t"))
    texts = stage(told.groupBy("h").agg(F.min("t").alias("t")), "items")
    size = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    portions = max(1, -(-size // PORTION))
    out = T.StructType([T.StructField("key", docs.schema[key].dataType),
                        T.StructField("h", T.LongType())] + [T.StructField(*h) for h in _HITS])
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = None
    for n in range(portions):
        portion = texts.where(F.pmod(F.xxhash64("h"), F.lit(portions)) == n)
        shared = spark.sparkContext.broadcast(sorted(map(tuple, portion.collect())))
        part = stage(rows.mapInArrow(_searcher(shared, similarity, shortest), out), "hits")
        shared.unpersist()
        found = part if found is None else found.union(part)
    names = told.select(F.col("i"), F.col("h").alias("of"))
    return found.join(names, F.col("h") == F.col("of")).select(
        F.col("key").alias(key), F.col("i").alias(item_key), *(h for h, _ in _HITS))


def _searcher(shared, similarity, shortest):
    def found(items, batch):
        for row, data, offsets in a.text_slices(batch.column("text")):
            for t, *rest in items.matches(*words_of(data, offsets)):
                yield row + t, *rest

    def search(batches):
        items = Items(shared.value, similarity, shortest)
        for batch in batches:
            for hits in batched(found(items, batch), _ROWS):
                at, item, first, size, edits = zip(*hits)
                near = [1 - e / len(items.words[i]) for e, i in zip(edits, item)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("key").take(pa.array(at)),
                    pa.array([items.ids[i] for i in item], pa.int64()),
                    pa.array(first, pa.int64()), pa.array(size, pa.int64()),
                    pa.array(edits, pa.int64()), pa.array(near, pa.float64())],
                    names=["key", "h", *(h for h, _ in _HITS)])

    return search
