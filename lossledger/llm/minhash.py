"""Near-duplicate documents: one-permutation hashing, banded buckets, star-shaped candidates.

1. A document is the set of its distinct word shingles, as 64-bit hashes. Equal sets collapse to
   one class first, so thousands of copies cost one row from here on.
2. One-permutation hashing: the top bits of a shingle's hash name its bin, the smallest hash of a
   bin is its value. Empty bins borrow from a bin that a fixed random walk finds (optimal
   densification), so sets of any size get all values from a single pass.
3. Bands of values are bucket keys. A bucket proposes a star: its smallest class with each other
   member. Proposals of all buckets meet once, and lengths that cannot reach the threshold go.
4. A proposal holds if the full sets reach the threshold. Sets travel once per proposal; the set of
   a star's centre is sent once per ``FAN`` members, so a hot centre divides over tasks.
5. A star can miss a link between two of its outer members. In every bucket whose members lie in
   more than one component, the members outside its largest component are compared with all
   others: block by block inside tasks, so that no pair becomes a row and a bucket that holds a
   third of all classes divides over tasks. Two members that share several buckets are compared in
   the first only; members of one component, or of sizes too far apart, are not.

At 25 bands of 5 a pair at the threshold of 0.8 shares a bucket with probability 0.99995.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.llm import arrays as a
from lossledger.llm.components import connected
from lossledger.llm.frames import ROW, key_of_row, unique_rows
from lossledger.session import stage

WORDS = 5
PERCENT = 80
BIN_BITS = 7
BANDS, BAND = 25, 5
# Members that share one copy of their centre's set.
FAN = 64
# Members of a bucket that are compared with one another in one step: odd ones, and all.
ODD, BLOCK = 128, 512
_PROBES = 64

_SKETCH_SQL = "row long, n_shingles long, finger binary, bands array<long>"


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id, kept) per row of ``docs``.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A text of fewer than
    ``words`` words is one shingle; a null, empty or blank text has none and is linked with
    nothing. Two rows are linked if 100 * intersection >= percent * union of their sets.
    component_id is the smallest key that links reach, itself included; ``kept`` marks one row per
    component, the one with that key. Rows that share a key are separate; rows without one come
    last and may have a null component_id. No rows give no rows.
    """
    rows, again = unique_rows(docs.select(key, text), key, text)
    sketched = stage(rows.select(F.col(ROW).alias("row"), F.col(text).alias("text")).mapInArrow(
        lambda it: _sketch(it, words), _SKETCH_SQL), "sketches")
    classes = stage(sketched.where("n_shingles > 0").groupBy("finger").agg(
        F.min_by(F.struct("row", "n_shingles", "bands"), "row").alias("first")).select(
            "finger", F.col("first.row").alias("class"), "first.n_shingles", "first.bands"),
        "classes")
    buckets = stage(_buckets(classes), "buckets")
    texts = rows.select(F.col(ROW).alias("class"), F.col(text).alias("text"))
    sets = stage(texts.join(buckets.select("class").distinct(), "class").mapInArrow(
        lambda it: _sets(it, words), "class long, shingles binary"), "sets")

    links = stage(_stars(buckets, sets, percent), "stars")
    found = connected(links)
    more = stage(_rest(buckets, found, classes, sets, percent), "links")
    if not more.isEmpty():
        found = connected(links.union(more))

    member = sketched.join(classes.select("finger", "class"), "finger", "left").select(
        "row", "n_shingles", F.coalesce("class", "row").alias("class"))
    out = member.join(found, F.col("class") == F.col("node"), "left").select(
        "row", "n_shingles", F.coalesce("component", "class").alias("component_id"),
        (F.col("row") == F.coalesce("component", "class")).alias("kept"))
    ranks = rows.select(ROW, key) if again else None
    out = key_of_row(key_of_row(out, "component_id", key, ranks), "row", key, ranks)
    return out.select(F.col("row").alias(key), "n_shingles", "component_id", "kept")


# -- stars -----------------------------------------------------------------------------------


def _buckets(classes: DataFrame) -> DataFrame:
    """(band, class, n, centre) of buckets with more than one class: the centre is its smallest
    class, with its size."""
    rows = classes.select("class", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    many = rows.groupBy("band").agg(F.min(F.struct("class", "n")).alias("centre"),
                                    F.max("class").alias("last")).where("centre.class <> last")
    return rows.join(many.drop("last"), "band")


def _fits(n: Column, m: Column, percent: int) -> Column:
    """Sets of these sizes can reach the threshold."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _stars(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the centres and members whose full sets reach the threshold."""
    pairs = stage(buckets.where((F.col("class") != F.col("centre.class"))
                                & _fits(F.col("n"), F.col("centre.n"), percent))
                  .select(F.col("centre.class").alias("centre"), "class").distinct(), "proposals")
    sizes = pairs.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / FAN).alias("seats"))
    seat = F.pmod(F.xxhash64("class"), F.col("seats"))
    members = pairs.join(sizes, "centre").withColumn("seat", seat).join(sets, "class").select(
        "centre", "seat", "class", "shingles")
    heads = sizes.select("centre", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("seats") - 1)).alias("seat")).join(
            sets, F.col("centre") == F.col("class")).select(
                "centre", "seat", F.lit(None).cast("long").alias("class"), "shingles")
    dealt = heads.union(members).repartition("centre", "seat").sortWithinPartitions(
        "centre", "seat", F.col("class").asc_nulls_first())
    return dealt.mapInArrow(lambda it: _compare(it, percent), "a long, b long")


def _compare(batches, percent: int):
    """Each run of rows starts with its centre's set; the members follow."""
    head = None
    for batch in batches:
        left, right = [], []
        centres = batch.column("centre").to_pylist()
        classes = batch.column("class").to_pylist()
        for i, blob in enumerate(batch.column("shingles")):
            shingles = np.frombuffer(blob.as_buffer(), np.uint64)
            if classes[i] is None:
                head = shingles.copy()
                continue
            at = np.searchsorted(head, shingles)
            common = int((head[np.minimum(at, len(head) - 1)] == shingles).sum())
            if 100 * common >= percent * (len(head) + len(shingles) - common):
                left.append(centres[i])
                right.append(classes[i])
        yield pa.RecordBatch.from_pydict(
            {"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


# -- what stars leave out --------------------------------------------------------------------


def _rest(buckets: DataFrame, found: DataFrame, classes: DataFrame, sets: DataFrame,
          percent: int) -> DataFrame:
    """(a, b): links between members of a bucket that lie in different components."""
    placed = buckets.drop("centre").join(found, F.col("class") == F.col("node"), "left").select(
        "band", "class", "n", F.coalesce("component", "class").alias("component"))
    spans = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("size")).groupBy(
        "band").agg(F.max(F.struct("size", "component")).alias("main"),
                    F.sum("size").alias("members")).where(
                        # Of two members both are known: one is the centre.
                        "members > main.size and members > 2").select(
                            "band", F.col("main.component").alias("main"),
                            F.ceil((F.col("members") - F.col("main.size")) / ODD).alias("odds"),
                            F.ceil(F.col("members") / BLOCK).alias("blocks"))
    odd = F.col("component") != F.col("main")
    numbered = placed.join(spans, "band").withColumns({
        "odd": odd, "i": F.pmod(F.xxhash64("class", F.lit(1)), F.col("odds")),
        "j": F.pmod(F.xxhash64("class"), F.col("blocks"))})
    # Side 0: odd members, once per block. Side 1: all members, once per block of odd ones.
    numbered = numbered.withColumn("at", F.explode(F.expr("""concat(
        if(odd, transform(sequence(0L, blocks - 1), y -> struct(i AS i, y AS j, 0 AS side)),
           cast(array() AS array<struct<i:bigint,j:bigint,side:int>>)),
        transform(sequence(0L, odds - 1), x -> struct(x AS i, j AS j, 1 AS side)))""")))
    wanted = numbered.select("band", "at.i", "at.j", "at.side", "class", "component", "odd")
    full = sets.join(classes.select("class", "bands"), "class")
    key = ["band", "i", "j"]
    dealt = wanted.join(full, "class").repartition(*key).sortWithinPartitions(
        *key, "side", "class")
    return dealt.mapInArrow(lambda it: _compare_blocks(it, percent), "a long, b long")


def _compare_blocks(batches, percent: int):
    """Compares the two sides of each block pair; its rows follow on one another."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(k).to_numpy() for k in ("band", "i", "j")]
        head = a.changes(*keys)
        if held:
            head[0] = any(k[0] != held[-1].column(n)[-1].as_py()
                          for k, n in zip(keys, ("band", "i", "j")))
        cuts = [*np.flatnonzero(head), batch.num_rows]
        if cuts[0]:
            held.append(batch.slice(0, cuts[0]))
        for first, last in zip(cuts, cuts[1:]):
            if held:
                yield _block(pa.Table.from_batches(held), percent)
            held = [batch.slice(first, last - first)]
    if held:
        yield _block(pa.Table.from_batches(held), percent)


def _block(rows: pa.Table, percent: int) -> pa.RecordBatch:
    side, classes, component = (rows[c].to_numpy() for c in ("side", "class", "component"))
    odd = rows["odd"].to_numpy()
    band = rows["band"][0].as_py()
    bands = np.array(rows["bands"].to_pylist()).reshape(len(side), -1)
    before = np.arange(bands.shape[1]) < (bands == band).argmax(axis=1)[:, None]
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["shingles"].combine_chunks()]
    size = np.array([len(x) for x in sets])
    right = np.flatnonzero(side == 1)
    found: list[tuple[int, int]] = []
    for x in np.flatnonzero(side == 0):
        ok = (component[right] != component[x]) & ~(odd[right] & (classes[right] <= classes[x]))
        ok &= 100 * np.minimum(size[right], size[x]) >= percent * np.maximum(size[right], size[x])
        # Pairs that share an earlier bucket as well are compared there.
        ok &= ~((bands[right] == bands[x]) & before[x]).any(axis=1)
        others = right[ok]
        if not len(others):
            continue
        flat = np.concatenate([sets[y] for y in others])
        at = np.minimum(np.searchsorted(sets[x], flat), size[x] - 1)
        starts = np.cumsum(size[others]) - size[others]
        common = np.add.reduceat((sets[x][at] == flat).astype(np.int64), starts)
        linked = 100 * common >= percent * (size[x] + size[others] - common)
        found += [(classes[x], classes[y]) for y in others[linked]]
    left, right = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_pydict(
        {"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


# -- sets and sketches -----------------------------------------------------------------------


def _shingles(column: pa.Array, n: int):
    """The sorted distinct shingles of each text."""
    for _, data, offsets in a.text_slices(column):
        _, _, bounds, words = a.word_hashes(data, offsets, a.LOWER)
        grams = a.gram_hashes(words, n)
        for i in range(len(offsets) - 1):
            first, last = bounds[i], bounds[i + 1]
            if last - first >= n:
                found = np.sort(grams[first:last - n + 1])
                yield found[a.changes(found)]
            elif last > first:
                yield a.gram_hashes(words[first:last], last - first)
            else:
                yield words[:0]


def _sets(batches, n: int):
    for batch in batches:
        blobs = [s.tobytes() for s in _shingles(batch.column("text"), n)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("class"), pa.array(blobs, pa.binary())], names=["class", "shingles"])


_WALKS: dict[int, np.ndarray] = {}


def _walk(bins: int, probes: int) -> np.ndarray:
    """Where each empty bin looks for a value, in order; the same for every document."""
    if probes not in _WALKS:
        # A longer walk begins like a shorter one.
        seeds = (np.arange(bins)[:, None] + bins * np.arange(probes)[None, :]).astype(np.uint64)
        _WALKS[probes] = (a.mix(seeds + np.uint64(0x51ED2701)) % np.uint64(bins)).astype(np.int64)
    return _WALKS[probes]


def sketch(shingles: np.ndarray, bits: int = BIN_BITS) -> np.ndarray:
    """One value per bin of a sorted set that is not empty."""
    bins = 1 << bits
    place = (shingles >> np.uint64(64 - bits)).astype(np.int64)
    head = a.changes(place)
    values = np.zeros(bins, np.uint64)
    values[place[head]] = shingles[head]
    full = np.zeros(bins, bool)
    full[place[head]] = True
    empty = np.flatnonzero(~full)
    probes = _PROBES
    while len(empty):
        walk = _walk(bins, probes)[empty]
        hit = full[walk]
        first = hit.argmax(axis=1)
        found = hit[np.arange(len(empty)), first]
        values[empty[found]] = values[walk[np.arange(len(empty)), first][found]]
        empty = empty[~found]
        probes *= 8
    return values


def _bands(values: np.ndarray) -> np.ndarray:
    rows = values[:BANDS * BAND].reshape(BANDS, BAND)
    key = np.arange(BANDS, dtype=np.uint64)
    for j in range(BAND):
        key = a.mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return key


def _sketch(batches, n: int):
    for batch in batches:
        counts, fingers, bands = [], [], []
        for shingles in _shingles(batch.column("text"), n):
            counts.append(len(shingles))
            if not len(shingles):
                fingers.append(None)
                continue
            fingers.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
            bands.append(_bands(sketch(shingles)))
        flat = np.concatenate(bands) if bands else np.zeros(0, np.uint64)
        size = np.array([BANDS if c else 0 for c in counts], np.int64)
        yield pa.RecordBatch.from_arrays([
            batch.column("row"), pa.array(counts, pa.int64()), pa.array(fingers, pa.binary()),
            a.lists(flat.view(np.int64), np.append(0, np.cumsum(size)), pa.int64())],
            names=["row", "n_shingles", "finger", "bands"])
