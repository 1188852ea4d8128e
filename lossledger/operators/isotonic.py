"""Isotonic regression by pooling adjacent violators, in tasks.

The fit to all points is the fit to the pooled blocks of consecutive ranges of them, so lists of
blocks merge: every range of scores is pooled by a task of its own, then neighbouring lists are
pooled together, ``MERGED`` at a time, until one list is left. Blocks replace their points as soon
as they are pooled, so no task holds the points of more than one range.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.session import stage

MERGED = 16
_BLOCK_SQL = "part int, low double, high double, total double, weight double"


@dataclass(frozen=True)
class Isotonic:
    """Knots of a rising map, linear between them and constant outside."""

    x: tuple[float, ...]
    y: tuple[float, ...]

    def apply(self, score: Column) -> Column:
        x, y = np.array(self.x), np.array(self.y)

        @F.arrow_udf("double")
        def interpolated(values: pa.Array) -> pa.Array:
            told = values.to_numpy(zero_copy_only=False).astype(float)
            if not len(x):
                return pa.nulls(len(told), pa.float64())
            found = np.interp(told, x, y)
            return pa.array(found, mask=np.isnan(told))

        return interpolated(score.cast("double"))


def pool(low, high, total, weight) -> list[np.ndarray]:
    """The blocks of consecutive blocks: neighbours pool while the later mean is not greater."""
    out: list[list[float]] = []
    for a, b, t, w in zip(low.tolist(), high.tolist(), total.tolist(), weight.tolist()):
        while out and out[-1][2] * w >= t * out[-1][3]:
            first, _, t0, w0 = out.pop()
            a, t, w = first, t0 + t, w0 + w
        out.append([a, b, t, w])
    return [np.array(column) for column in zip(*out)] if out else [np.zeros(0)] * 4


def _pooled(batches) -> Iterator[pa.RecordBatch]:
    """A task's sorted points or blocks as one list; it pools as they come."""
    part, held = 0, [np.zeros(0)] * 4
    for batch in batches:
        if batch.num_rows:
            part = batch.column("part")[0].as_py()
            fresh = [batch.column(c).to_numpy() for c in ("low", "high", "total", "weight")]
            held = pool(*(np.append(a, b) for a, b in zip(held, fresh)))
    if len(held[0]):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(held[0]), part, np.int32)), *map(pa.array, held)],
            names=["part", "low", "high", "total", "weight"])


def fit_isotonic(points: DataFrame, score: str, label: str, ranges: int | None = None) -> Isotonic:
    """The rising map from ``score`` to ``label`` of least squared error.

    Rows collapse to one point per distinct score first, so a score that a third of them share is
    one point. Rows without a finite score or label take no part.
    """
    spark = points.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    value = F.col(score).cast("double")
    known = (points.where(value.isNotNull() & ~F.isnan(value) & F.col(label).isNotNull())
             .groupBy(value.alias("low"))
             .agg(F.sum(F.col(label).cast("double")).alias("total"),
                  F.count(F.lit(1)).cast("double").alias("weight")))
    blocks = stage(known.select("low", F.col("low").alias("high"), "total", "weight")
                   .repartitionByRange(ranges, "low").sortWithinPartitions("low")
                   .withColumn("part", F.spark_partition_id())
                   .select("part", "low", "high", "total", "weight")
                   .mapInArrow(_pooled, _BLOCK_SQL), "pooled")
    while ranges > 1:
        ranges = -(-ranges // MERGED)
        blocks = stage(blocks.withColumn("part", F.floor(F.col("part") / MERGED).cast("int"))
                       .repartitionById(ranges, F.col("part")).sortWithinPartitions("low")
                       .mapInArrow(_pooled, _BLOCK_SQL), "pooled")
    knots: dict[float, float] = {}
    for r in sorted(blocks.collect(), key=lambda r: r["low"]):
        knots[r["low"]] = knots[r["high"]] = r["total"] / r["weight"]
    return Isotonic(tuple(knots), tuple(knots.values()))
