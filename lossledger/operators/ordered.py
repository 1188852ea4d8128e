"""Order-dependent statistics without sorting everything in one task.

A window without partitions funnels all rows through one task. Here rows are first collapsed to
one per distinct order value, then cut into blocks of bounded size along that order; block totals
give each block its offset, and a window runs only inside a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossledger.session import stage

ROWS_PER_BLOCK = 500_000


def block_edges(distinct: DataFrame, order: Column, rows: int, rows_per_block: int) -> list:
    """Values that cut ``rows`` distinct rows into blocks of about ``rows_per_block``."""
    blocks = -(-rows // rows_per_block)
    if blocks < 2:
        return []
    shares = [i / blocks for i in range(1, blocks)]
    found = distinct.agg(
        F.percentile_approx(order, shares, max(10_000, 10 * blocks)).alias("edges")).first()
    return sorted(set(found["edges"] or []))


def running_totals(df: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = (),
                   rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Adds ``<s>_before`` and ``<s>_total`` for each column ``s`` of ``sums``.

    ``df`` holds one row per (``by``, ``order``). ``<s>_before`` is the total of ``s`` over the
    rows of the same ``by`` with a smaller ``order``; ``<s>_total`` that over all of them. Equal
    values share a row and so a block; the block of a value depends only on the value, not on the
    partitioning, so a retried task finds the same blocks.
    """
    distinct = stage(df, "distinct")
    as_double = F.col(order).cast("double")
    edges = block_edges(distinct, as_double, distinct.count(), rows_per_block)
    by = list(by)
    if not edges:
        every = Window.partitionBy(*(by or [F.lit(0)]))
        earlier = every.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return distinct.select(
            "*",
            *(F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{s}_before") for s in sums),
            *(F.sum(s).over(every).alias(f"{s}_total") for s in sums),
        )
    inf = float("inf")
    cutter = Bucketizer(splits=[-inf, *edges, inf], inputCol="__order", outputCol="__block",
                        handleInvalid="keep")
    blocked = cutter.transform(distinct.withColumn("__order", as_double)).drop("__order")
    every = Window.partitionBy(*(by or [F.lit(0)]))
    earlier = every.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocked.groupBy(*by, "__block").agg(*(F.sum(s).alias(s) for s in sums)).select(
        *(F.col(b).alias(f"__{b}") for b in by),
        F.col("__block").alias("__at"),
        *(F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{s}_offset") for s in sums),
        *(F.sum(s).over(every).alias(f"{s}_total") for s in sums),
    )
    match = F.col("__block") == F.col("__at")
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"__{b}"))
    inside = (Window.partitionBy(*by, "__block").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, -1))
    return blocked.join(offsets, match).select(
        *df.columns,
        *((F.col(f"{s}_offset") + F.coalesce(F.sum(s).over(inside), F.lit(0)))
          .alias(f"{s}_before") for s in sums),
        *(f"{s}_total" for s in sums),
    )


def exact_quantiles(df: DataFrame, value: str, shares: Sequence[float], by: Sequence[str] = (),
                    rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Linearly interpolated quantiles: columns ``by``, ``share_index``, ``quantile``.

    Exact at any size. The built-in ``percentile`` keeps every distinct value of a group in one
    task; here the two order statistics around each share are looked up in running counts.
    """
    by = list(by)
    counted = (df.where(F.col(value).isNotNull()).groupBy(*by, value)
               .agg(F.count(F.lit(1)).alias("n")))
    placed = running_totals(counted, value, ["n"], by, rows_per_block)
    ranks = ", ".join(f"struct({i} AS share_index, double(n_total - 1) * {float(share)!r}D AS rank)"
                      for i, share in enumerate(shares))
    low = _holds("floor(r.rank)")
    high = _holds("least(floor(r.rank) + 1, n_total - 1)")
    touched = F.expr(f"explode(filter(array({ranks}), r -> ({low}) OR ({high}))) AS r")
    rows = placed.select(*by, value, "n_before", "n", "n_total", touched)
    return (
        rows.groupBy(*by, F.col("r.share_index").alias("share_index"))
        .agg(F.expr(f"max({value}) FILTER (WHERE {low}) AS low"),
             F.expr(f"max({value}) FILTER (WHERE {high}) AS high"),
             F.expr("max(r.rank - floor(r.rank)) AS part"))
        .select(*by, "share_index", F.expr(
            "if(part < 0.5D, low + (high - low) * part, high - (high - low) * (1D - part))"
            " AS quantile"))
    )


def _holds(rank: str) -> str:
    """Whether the row's run of equal values covers a 0-based rank."""
    return f"{rank} >= n_before AND {rank} < n_before + n"
