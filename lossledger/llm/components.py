"""Connected components of a link table, distributed.

One level: tasks join what they can alone, flush by flush, and send each node with the smallest
node it reaches there. A node then meets the roots that tasks found for it, no more than there were
flushes; it follows the smallest, and the others become links to that one. Only such links enter
the next level, so the graph shrinks to a fraction each time. Many links at one node cost nothing
special: rows are grouped by the node that follows, never by the root that is followed. The levels'
answers are then joined from the last to the first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossledger.session import stage

# Links that a task joins at once.
FLUSH = 1_000_000
LEVELS = 100


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``, component the smallest node reached.

    Nulls and self-links are dropped; repeated and mirrored links count once. No links, no rows.
    """
    levels: list[DataFrame] = []
    edges = links.where("a is not null and b is not null and a <> b").select(
        F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    for _ in range(LEVELS):
        level = stage(edges.mapInArrow(_local_roots, "node long, root long").groupBy("node").agg(
            F.array_sort(F.collect_set("root")).alias("roots")), "components")
        levels.append(level)
        roots = level.select(F.explode("roots").alias("node")).distinct()
        both = level.join(roots, "node", "left_semi").select("node", F.col("roots")[0].alias("b"))
        several = level.where(F.size("roots") > 1).select(
            F.col("roots")[0].alias("a"), F.explode(F.slice("roots", 2, 2 ** 31 - 1)).alias("b"))
        edges = stage(both.withColumnRenamed("node", "a").union(several), "roots")
        if edges.isEmpty():
            break
    else:
        raise RuntimeError(f"links did not settle within {LEVELS} levels")
    found = None
    for level in reversed(levels):
        pure = level.select(F.explode("roots").alias("node")).distinct().join(
            level.select("node"), "node", "left_anti")
        moved = level.select("node", F.col("roots")[0].alias("root")).union(
            pure.select("node", "node"))
        if found is not None:
            # What became of a root in the later level, its followers become as well.
            later = found.select(F.col("node").alias("r"), "component")
            moved = moved.join(later, F.col("root") == F.col("r"), "left").select(
                "node", F.coalesce("component", "root").alias("root"))
            moved = stage(moved, "components")
        found = moved.withColumnRenamed("root", "component")
    return found


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it reaches) for the nodes that reach a smaller one."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[:len(a)], place[len(a):]
    label = np.arange(len(nodes))
    while True:
        before = label
        label = label.copy()
        least = np.minimum(label[x], label[y])
        # Hooks the roots, so that whole trees move, then halves all paths.
        np.minimum.at(label, before[x], least)
        np.minimum.at(label, before[y], least)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        if (label == before).all():
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _local_roots(batches):
    held, size = [], 0
    for batch in batches:
        held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        size += batch.num_rows
        if size >= FLUSH:
            yield from _rooted(held)
            held, size = [], 0
    if size:
        yield from _rooted(held)


def _rooted(held):
    node, root = local_roots(*(np.concatenate(x) for x in zip(*held)))
    for i in range(0, len(node), 100_000):
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[i:i + 100_000]), pa.array(root[i:i + 100_000])], names=["node", "root"])
