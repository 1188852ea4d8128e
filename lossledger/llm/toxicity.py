"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct character n-grams of a text, hashed to a fixed number of columns; a
character is a code point of UTF-8, runs of white space count as one blank, A-Z are lower-cased. Each column gets the log ratio of its rates in
toxic and other texts; the columns that separate most enter a logistic regression whose inputs are
those ratios (0 where the n-gram is absent). The model is fitted on at most ``FIT`` labelled texts,
half of each class if there are enough, picked by a hash of the id among the documents that are
there; the intercept is then moved to the rate of the classes among all labelled documents, so that
scores mean the same at every size of the input.
It is fitted on whole texts and applied to whole texts. What reaches the driver is bounded by
``FIT``, ``COLUMNS`` and ``KEPT``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.llm import arrays as a
from lossledger.session import stage

SIZES = (5,)
COLUMNS = 1 << 20
KEPT = 1 << 14
FIT = 12_000
SMOOTHING = 1.0
LEAST_TEXTS = 3
RIDGE = 1.0
STEPS = 40
THRESHOLD = 0.7

_BASE = 0xA0761D6478BD642F


# -- features --------------------------------------------------------------------------------


def flattened(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes with one blank around and between words; bounds of each text."""
    starts, ends, first = a.split_words(data, offsets)
    size = ends - starts + 1
    texts = len(offsets) - 1
    words = np.diff(first)
    # Every word brings the blank after it; every text one more at its beginning.
    owner = np.repeat(np.arange(texts), words)
    at = np.cumsum(size) - size + owner + 1
    total = np.append(0, np.cumsum(size))[first] + np.arange(texts + 1)
    out = np.full(int(total[-1]), 32, np.uint8)
    out[a.ranges(at, size - 1)] = a.LOWER[data[a.ranges(starts, size - 1)]]
    return out, total


def characters(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number per character of UTF-8 text, its bytes in sequence, and bounds in characters."""
    begins = (data & 0xC0) != 0x80
    if begins.all():
        return data.astype(np.uint64), bounds
    starts = np.flatnonzero(begins)
    size = np.diff(np.append(starts, len(data)))
    out = data[starts].astype(np.uint64)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        out[more] |= data[starts[more] + k].astype(np.uint64) << np.uint64(8 * k)
    return out, np.searchsorted(starts, bounds)


def grams(letters: np.ndarray, n: int, columns: int) -> np.ndarray:
    """The column of the n-gram that begins at each character."""
    if len(letters) < n:
        return np.zeros(0, np.int64)
    up, _ = a.powers(_BASE, n)
    out = np.full(len(letters) - n + 1, np.uint64(n))
    for j in range(n):
        out += letters[j:len(letters) - n + 1 + j] * up[j]
    return (a.mix(out) >> np.uint64(64 - columns.bit_length() + 1)).astype(np.int64)


class Columns:
    """The distinct columns of each text of a slice."""

    def __init__(self, columns: int = COLUMNS, sizes: tuple[int, ...] = SIZES):
        self.columns, self.sizes = columns, sizes
        self.last = np.zeros(columns, np.int32)

    def __call__(self, column: pa.Array):
        for _, data, offsets in a.text_slices(column):
            flat, bounds = characters(*flattened(data, offsets))
            found = [grams(flat, n, self.columns) for n in self.sizes]
            for x, y in zip(bounds, bounds[1:]):
                own = np.concatenate([g[x:max(x, y - n + 1)]
                                      for g, n in zip(found, self.sizes)])
                at = np.arange(len(own), dtype=np.int32)
                self.last[own] = at
                yield own[self.last[own] == at]


# -- fitting ---------------------------------------------------------------------------------


@dataclass
class Model:
    """``weights`` of the columns ``kept``; all others count nothing. ``bias``: the intercept."""

    kept: np.ndarray
    weights: np.ndarray
    bias: float
    columns: int = COLUMNS
    sizes: tuple[int, ...] = SIZES

    def scorer(self):
        find = Columns(self.columns, self.sizes)
        dense = np.zeros(self.columns)
        dense[self.kept] = self.weights

        def scores(column: pa.Array) -> np.ndarray:
            total = np.array([dense[own].sum() for own in find(column)], float)
            return 1 / (1 + np.exp(-np.clip(total + self.bias, -700, 700)))

        return scores


def ratios(toxic: np.ndarray, other: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Naive Bayes log-count ratio of each column."""
    p, q = toxic + smoothing, other + smoothing
    return np.log(p / p.sum()) - np.log(q / q.sum())


def choose(toxic: np.ndarray, other: np.ndarray, ratio: np.ndarray, kept: int = KEPT):
    """Where the columns that separate most are: ratio times the root of the number of texts."""
    weight = np.abs(ratio) * np.sqrt(toxic + other)
    return np.sort(np.argsort(-weight, kind="stable")[:kept])


def logistic(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, label: np.ndarray,
             ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression, by limited-memory quasi-Newton steps.

    Entry ``i`` says that text ``rows[i]`` has the column ``columns[i]``, whose input is its ratio
    in ``values``.
    """
    size = len(values)
    sign = np.where(label > 0, 1.0, -1.0)

    def loss(x):
        w, b = x[:-1], x[-1]
        margin = np.bincount(rows, (w * values)[columns], len(label)) + b
        z = sign * margin
        cost = np.logaddexp(0, -z).sum() + 0.5 * ridge * w @ w
        pull = -sign / (1 + np.exp(np.clip(z, -700, 700)))
        grad = np.bincount(columns, pull[rows], size) * values + ridge * w
        return cost, np.append(grad, pull.sum())

    x = np.zeros(size + 1)
    cost, grad = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        step = -_two_loop(grad, past)
        slope = grad @ step
        if slope >= 0:
            step, slope, past = -grad, -(grad @ grad), []
        rate = 1.0 if past else min(1.0, 1 / (np.abs(grad).sum() + 1e-12))
        while True:
            new_cost, new_grad = loss(x + rate * step)
            if new_cost <= cost + 1e-4 * rate * slope or rate < 1e-12:
                break
            rate /= 2
        moved, turned = rate * step, new_grad - grad
        if moved @ turned > 1e-12:
            past = [*past[-9:], (moved, turned)]
        x, done = x + moved, abs(cost - new_cost) < 1e-8 * max(1.0, abs(cost))
        cost, grad = new_cost, new_grad
        if done:
            break
    return x[:-1] * values, float(x[-1])


def _two_loop(grad, past):
    q, scales = grad.copy(), []
    for s, y in reversed(past):
        scale = s @ q / (y @ s)
        scales.append(scale)
        q -= scale * y
    if past:
        s, y = past[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), scale in zip(past, reversed(scales)):
        q += s * (scale - y @ q / (y @ s))
    return q


def shift(counted: dict[int, int], most: int) -> float:
    """What to add to an intercept fitted on at most ``most`` of the ``counted`` texts of each
    class: the log-odds of class 1 among all of them less those among the fitted ones."""
    other, toxic = counted.get(0, 0), counted.get(1, 0)
    if not other or not toxic:
        return 0.0
    return float(np.log(toxic / other) - np.log(min(toxic, most) / min(other, most)))


# -- Spark -----------------------------------------------------------------------------------


def held_out(key: Column) -> Column:
    """Rows that a model must not learn from: a third, by the checksum of the id as text."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "toxic", fit: int = FIT) -> Model:
    """The model of the labelled texts that are not held out.

    Labels other than 0 and 1 and labels without a document are ignored; of several labels of a
    document the largest holds, and of several documents with one id the text of the smallest hash
    is learned. Classes are taken at different rates where one has more than half of ``fit``; the
    intercept makes up for it. With no texts of one class, or none at all, every score is the rate
    of class 1, one half at worst.
    """
    rated = (labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()
                          & ~held_out(F.col(key)))
             .groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("label")))
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"),
                        F.xxhash64(text).alias("hash"))
    # One row of three numbers per labelled document that is there: quota and rates go by these.
    present = texts.where(~held_out(F.col("key"))).groupBy("key").agg(F.min("hash").alias("hash"))
    usable = stage(rated.join(present, "key"), "usable")
    counted = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    moved = shift(counted, fit // 2)
    picked = [usable.where(F.col("label") == x).orderBy(F.xxhash64("key"), "key").limit(fit // 2)
              for x in (0, 1)]
    picked = stage(picked[0].union(picked[1]), "labels")
    # At most ``fit`` rows of three numbers; equal rows of a document collapse in the tasks.
    texts = stage(texts.join(F.broadcast(picked), ["key", "hash"]).groupBy("key", "label").agg(
        F.first("text").alias("text")), "labelled")
    counts = texts.select("text", "label").mapInArrow(
        _count, "column int, toxic long, other long").groupBy("column").agg(
            F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).where(
                F.col("toxic") + F.col("other") >= LEAST_TEXTS).orderBy("column").toArrow()
    column, toxic, other = (counts.column(i).to_numpy() for i in range(3))
    ratio = ratios(toxic, other)
    at = choose(toxic, other, ratio)
    kept, ratio = column[at], ratio[at]
    rows = texts.mapInArrow(lambda it: _kept(it, kept),
                            "key string, label int, places binary").collect()
    rows.sort(key=lambda r: (r["key"], r["places"]))
    target = np.array([r["label"] for r in rows], int)
    if not len(kept) or not 0 < target.sum() < len(target):
        rate = (target.sum() + 0.5) / (len(target) + 1)
        return Model(kept[:0], ratio[:0], float(np.log(rate / (1 - rate))) + moved)
    places = [np.frombuffer(r["places"], np.uint16) for r in rows]
    owner = np.repeat(np.arange(len(places)), [len(x) for x in places])
    weights, bias = logistic(owner, np.concatenate(places).astype(np.int64), ratio, target)
    return Model(kept, weights, bias + moved)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` in [0, 1], higher for likelier toxic.

    A null text scores like an empty one. A column called score is replaced. No rows give no rows.
    """
    rest = [c for c in docs.columns if c != "score"]
    rows = docs.select(F.struct(*rest).alias("row"), F.col(text).alias("text"))
    out = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(lambda it: _score(it, model), out).select("row.*", "score")


def _count(batches):
    find = Columns()
    total = np.zeros((2, COLUMNS), np.int64)
    for batch in batches:
        for label, own in zip(batch.column("label").to_pylist(), find(batch.column("text"))):
            total[label, own] += 1
    used = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(total[1, used]), pa.array(total[0, used])],
        names=["column", "toxic", "other"])


def _kept(batches, kept: np.ndarray):
    find = Columns()
    place = np.full(COLUMNS, -1, np.int64)
    place[kept] = np.arange(len(kept))
    for batch in batches:
        found = []
        for own in find(batch.column("text")):
            at = place[own]
            found.append(np.sort(at[at >= 0]).astype(np.uint16).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key").cast(pa.string()), batch.column("label"), pa.array(found)],
            names=["key", "label", "places"])


def _score(batches, model: Model):
    score = model.scorer()
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(score(batch.column("text")))], names=["row", "score"])
