"""Substring deduplication by seeds and extension.

A passage is a run of ``length`` or more words that also starts earlier: in a document with a
smaller id, or earlier in the same one. Every word that such a passage covers is removed.

1. Seeds. Winnowing picks, in each window of ``length`` words, the ``anchor``-word gram with the
   smallest hash, so any two equal windows pick the same gram at the same place. Consecutive
   windows that pick the same gram form its run: the gram extended both ways as far as it rules.
2. Join on anchors. Occurrences meet by the hash of their anchor, never as pairs. If the extended
   texts are equal too, all but the first occurrence repeat as a whole. An anchor with different
   extended texts (where passages begin or end) leaves its windows open.
3. Extension. Only open windows are compared, each by its own 128 bits; all but the first of equal
   ones repeat.
4. Repeats that touch or overlap merge into maximal ones and are cut out.

Tasks combine what they have seen before anything is shuffled: an anchor or window comes at most
once from each flush of a task, however many documents hold it. Flushes are bounded in rows, and
reducers hold one partition of packed numbers. The number of partitions is the session's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.llm import arrays as a
from lossledger.llm.frames import ROW, partitions, unique_rows
from lossledger.session import stage

LENGTH = 20
ANCHOR = 8
# Occurrences that a task combines before it sends them.
FLUSH = 600_000

_SECOND_BASE = 0xD6E8FEB86659FD93
COVERED, OPEN, PACKED = 0, 1, 2
# A run of windows as one long: first window, number of windows.
_SHIFT = 20
_MOST = (1 << _SHIFT) - 1
_FOUND = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("doc", pa.int64()),
                    ("span", pa.int64()), ("blob", pa.binary())])
_FOUND_SQL = "kind int, part int, doc long, span long, blob binary"
_CUT_SQL = "at long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def cut_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text",
                length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with n_words, n_removed, kept_sha256 and kept_text per row.

    Words are runs of bytes other than ASCII white space, unchanged. ``kept_text`` joins the kept
    words by one space; kept_sha256 is its lower-case hex digest. A null or empty text, and one of
    blanks only, has no words, an empty kept_text and nothing removed; one of fewer than
    ``length`` words loses nothing. Rows that share a key, or have none, are separate documents in
    the order of key (nulls last) and text hash. No rows give no rows. Other columns stay, except
    that the four result columns replace any of the same name.
    """
    if not 1 <= anchor <= length:
        raise ValueError("an anchor is at least one word and at most a window")
    results = ["n_words", "n_removed", "kept_sha256", "kept_text"]
    kept = [c for c in docs.columns if c not in results or c in (key, text)]
    rows, _ = unique_rows(docs.select(F.struct(*kept).alias("row"), F.col(key).alias("key"),
                                      F.col(text).alias("text")), "key", "text")
    texts = rows.select(F.col(ROW).alias("doc"), "text")
    n = partitions(docs.sparkSession)

    seeds = texts.mapInArrow(lambda it: _seed_tasks(it, length, anchor, n), _FOUND_SQL)
    found = stage(_meet(seeds, n, _seed_merge), "seeds")
    opened = _by_doc(found.where(F.col("kind") == OPEN))
    windows = texts.join(opened, "doc").mapInArrow(
        lambda it: _window_tasks(it, length, n), _FOUND_SQL)
    extended = stage(_meet(windows, n, _window_merge), "windows")
    repeats = _by_doc(found.where(F.col("kind") == COVERED).union(extended))

    whole = rows.select("row", F.col(ROW).alias("doc")).join(repeats, "doc", "left")
    row_type = whole.schema["row"].dataType
    out = T.StructType([T.StructField("row", row_type)] + [
        T.StructField(c, T.StringType() if "kept" in c else T.LongType()) for c in results])
    return whole.select("row", F.col("row")[text].alias("text"), "spans").mapInArrow(
        lambda it: _cut(it, length), out).select(
            *(F.col("row")[c].alias(c) for c in kept), *results)


def _by_doc(found: DataFrame) -> DataFrame:
    """The runs of each document; as many as its words at most."""
    return found.groupBy("doc").agg(F.collect_list("span").alias("spans"))


def _meet(found: DataFrame, n: int, merge) -> DataFrame:
    """Packed rows meet by their part; rows that are settled already pass."""
    return found.repartition(n, "part").mapInArrow(
        lambda it: _reduce(it, merge), _FOUND_SQL).select("kind", "doc", "span")


# -- what tasks do ---------------------------------------------------------------------------


def _emit(kind, doc, first, count) -> Iterator[pa.RecordBatch]:
    """Runs of windows, in pieces short enough for one long."""
    while len(doc):
        take = np.minimum(count, _MOST)
        for i in range(0, len(doc), 100_000):
            j = slice(i, i + 100_000)
            size = len(doc[j])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.broadcast_to(np.int32(kind), size)),
                pa.array((doc[j] & 0x3FFFFFFF).astype(np.int32)), pa.array(doc[j]),
                pa.array(first[j] << _SHIFT | take[j]),
                pa.nulls(size, pa.binary())], schema=_FOUND)
        more = count > take
        doc, first, count = doc[more], (first + take)[more], (count - take)[more]


def _send(keys: np.ndarray, record: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    """Records in one packed row per part."""
    part = ((keys >> np.uint64(20)) % np.uint64(n)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    record, part = record[order], part[order]
    starts = np.flatnonzero(a.changes(part))
    ends = np.append(starts[1:], len(part))
    for i in range(0, len(starts), 64):
        s, e = starts[i:i + 64], ends[i:i + 64]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(s), PACKED, np.int32)), pa.array(part[s]),
            pa.nulls(len(s), pa.int64()), pa.nulls(len(s), pa.int64()),
            pa.array([record[x:y].tobytes() for x, y in zip(s, e)], pa.binary())], schema=_FOUND)


def _reduce(batches, merge) -> Iterator[pa.RecordBatch]:
    packed = []
    for batch in batches:
        kinds = batch.column("kind").to_numpy(zero_copy_only=False)
        packed += batch.column("blob").filter(pa.array(kinds == PACKED)).to_pylist()
        settled = batch.filter(pa.array(kinds != PACKED))
        if settled.num_rows:
            yield settled
    yield from merge(packed)


SEED = np.dtype([("anchor", "u8"), ("run", "u8"), ("doc", "i8"), ("first", "i4"),
                 ("count", "u1"), ("many", "u1")])


def _seed_tasks(batches, length: int, anchor: int, n: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        docs = batch.column("doc").to_numpy(zero_copy_only=False)
        for row, data, offsets in a.text_slices(batch.column("text")):
            _, _, bounds, words = a.word_hashes(data, offsets)
            held.append(_runs(docs[row:], bounds, words, length, anchor))
            size += len(held[-1])
            if size >= FLUSH:
                yield from _seed_flush(np.concatenate(held), n)
                held, size = [], 0
    if size:
        yield from _seed_flush(np.concatenate(held), n)


def _runs(docs, bounds, words, length, anchor) -> np.ndarray:
    """The runs of windows of several documents, each with its anchor's and its whole hash."""
    counts = np.diff(bounds)
    whole = np.flatnonzero(counts >= length)
    if not len(whole):
        return np.zeros(0, SEED)
    grams = a.gram_hashes(words, anchor)
    picked = a.sliding_argmin(grams, length - anchor + 1)
    windows = counts[whole] - length + 1
    starts = a.ranges(bounds[whole], windows)
    owner = np.repeat(whole, windows)
    at = picked[starts]
    heads = np.flatnonzero(a.changes(at, owner))
    tails = np.append(heads[1:], len(starts)) - 1
    first, last, at = starts[heads], starts[tails], at[heads]
    run = a.RangeHash(words)(first, last + length)
    out = np.empty(len(heads), SEED)
    out["anchor"] = grams[at]
    out["run"] = a.mix(run ^ ((at - first) * 64 + (last - first)).astype(np.uint64))
    out["doc"] = docs[owner[heads]]
    out["first"] = first - bounds[owner[heads]]
    out["count"] = last - first + 1
    out["many"] = 0
    return out


def _order(seeds: np.ndarray) -> np.ndarray:
    """Seeds whose anchor occurs more than once, by anchor, run and place; and the others."""
    order = np.argsort(seeds["anchor"], kind="stable")
    key = seeds["anchor"][order]
    same = key[1:] == key[:-1]
    many = np.zeros(len(key), bool)
    many[1:] |= same
    many[:-1] |= same
    shared = seeds[order[many]]
    rank = np.lexsort((shared["first"], shared["doc"], shared["run"], shared["anchor"]))
    return shared[rank], seeds[order[~many]]


def _groups(shared: np.ndarray):
    """For each shared seed: is it the first of its run; number of runs and most of ``many`` of
    its anchor."""
    new_anchor = a.changes(shared["anchor"])
    new_run = new_anchor | a.changes(shared["run"])
    group = np.cumsum(new_anchor) - 1
    runs = np.bincount(group, new_run)[group] if len(shared) else np.zeros(0)
    marked = np.zeros(len(shared), bool)
    if len(shared):
        marked = np.logical_or.reduceat(shared["many"] > 0, np.flatnonzero(new_anchor))[group]
    return new_anchor, new_run, runs, marked


def _seed_flush(seeds: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    """Settles what a task can settle alone; one seed of each anchor goes on."""
    shared, alone = _order(seeds)
    new_anchor, new_run, runs, _ = _groups(shared)
    repeated = shared[~new_run]
    yield from _merged(COVERED, repeated)
    opened = shared[new_run & (runs > 1)]
    yield from _merged(OPEN, opened)
    speakers = shared[new_anchor].copy()
    speakers["many"] = runs[new_anchor] > 1
    rest = np.concatenate([speakers, alone])
    rest = rest[np.lexsort((rest["first"], rest["doc"]))]
    yield from _send(rest["anchor"], rest, n)


def _seed_merge(packed: list[bytes]) -> Iterator[pa.RecordBatch]:
    if not packed:
        return
    shared, _ = _order(np.frombuffer(b"".join(packed), SEED))
    _, new_run, runs, marked = _groups(shared)
    yield from _merged(COVERED, shared[~new_run])
    yield from _merged(OPEN, shared[new_run & ((runs > 1) | marked) & (shared["many"] == 0)])


def _merged(kind: int, seeds: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Runs of a document that follow on one another, as one."""
    if not len(seeds):
        return
    seeds = seeds[np.lexsort((seeds["first"], seeds["doc"]))]
    first = seeds["first"].astype(np.int64)
    last = first + seeds["count"]
    heads = a.changes(seeds["doc"])
    heads[1:] |= first[1:] != last[:-1]
    starts = np.flatnonzero(heads)
    ends = np.append(starts[1:], len(seeds)) - 1
    yield from _emit(kind, seeds["doc"][starts], first[starts], last[ends] - first[starts])


WINDOW = np.dtype([("one", "u8"), ("two", "u8"), ("doc", "i8"), ("first", "i4")])


def _window_tasks(batches, length: int, n: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        docs = batch.column("doc").to_numpy(zero_copy_only=False)
        spans = batch.column("spans")
        for row, data, offsets in a.text_slices(batch.column("text")):
            _, _, bounds, words = a.word_hashes(data, offsets)
            one, two = a.RangeHash(words), a.RangeHash(words, _SECOND_BASE)
            for i in range(len(offsets) - 1):
                code = np.unique(spans[row + i].values.to_numpy())
                at = a.ranges(code >> _SHIFT, code & _MOST)
                start = at + bounds[i]
                got = np.empty(len(at), WINDOW)
                got["one"], got["two"] = one(start, start + length), two(start, start + length)
                got["doc"], got["first"] = docs[row + i], at
                held.append(got)
                size += len(got)
            if size >= FLUSH:
                yield from _window_flush(np.concatenate(held), n)
                held, size = [], 0
    if size:
        yield from _window_flush(np.concatenate(held), n)


def _later(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows that equal an earlier one, and the first of each."""
    windows = windows[np.lexsort((windows["first"], windows["doc"], windows["two"],
                                  windows["one"]))]
    new = a.changes(windows["one"], windows["two"])
    return windows[~new], windows[new]


def _window_runs(windows: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(windows):
        return
    windows = windows[np.lexsort((windows["first"], windows["doc"]))]
    first = windows["first"].astype(np.int64)
    heads = a.changes(windows["doc"])
    heads[1:] |= first[1:] != first[:-1] + 1
    starts = np.flatnonzero(heads)
    ends = np.append(starts[1:], len(windows)) - 1
    yield from _emit(COVERED, windows["doc"][starts], first[starts],
                     first[ends] - first[starts] + 1)


def _window_flush(windows: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    later, first = _later(windows)
    yield from _window_runs(later)
    yield from _send(first["one"], first, n)


def _window_merge(packed: list[bytes]) -> Iterator[pa.RecordBatch]:
    if packed:
        yield from _window_runs(_later(np.frombuffer(b"".join(packed), WINDOW))[0])


def _cut(batches, length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column("spans")
        n_words, n_removed, digests, kept_texts = [], [], [], []
        for row, data, offsets in a.text_slices(batch.column("text")):
            starts, ends, bounds = a.split_words(data, offsets)
            for i in range(len(offsets) - 1):
                words = slice(bounds[i], bounds[i + 1])
                n = bounds[i + 1] - bounds[i]
                keep = np.ones(n, bool)
                if spans[row + i].is_valid:
                    code = spans[row + i].values.to_numpy()
                    depth = np.zeros(n + 1, np.int32)
                    np.add.at(depth, code >> _SHIFT, 1)
                    np.add.at(depth, (code >> _SHIFT) + (code & _MOST) + length - 1, -1)
                    keep = np.cumsum(depth)[:-1] == 0
                left = _join(data, starts[words][keep], ends[words][keep])
                n_words.append(n)
                n_removed.append(n - int(keep.sum()))
                digests.append(hashlib.sha256(left).hexdigest())
                kept_texts.append(left)
        yield pa.RecordBatch.from_arrays([
            batch.column("row"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
            pa.array(digests, pa.string()),
            pa.array(kept_texts, pa.binary()).cast(pa.string())],
            names=["row", "n_words", "n_removed", "kept_sha256", "kept_text"])


def _join(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words joined by one space."""
    if not len(starts):
        return b""
    size = ends - starts
    out = np.full(int(size.sum()) + len(size) - 1, 32, np.uint8)
    at = np.cumsum(size + 1) - size - 1
    out[a.ranges(at, size)] = data[a.ranges(starts, size)]
    return out.tobytes()
