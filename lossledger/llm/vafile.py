"""Exact top-k search by inner product over vector-approximation files.

Components are scaled to whole numbers, so scores are exact and bounds hold exactly.

1. Equal vectors collapse to one class with the ``k + 1`` smallest of its rows, as many as any
   result can show: a vector that a third of all rows share costs one entry.
2. Classes are dealt into blocks by hash. A block has its own grid: each component's range in the
   block is cut into ``2 ** BITS`` equal cells, and the approximation file holds one byte a
   component. The classes of the query rows are packed into blocks of queries as well.
3. Scan. A unit of work is one block of queries with one block of cells; it reads no exact vector. A
   cell's middle gives the score up to a slack that is the same for the whole block. A unit sends,
   per query, its ``k + 1`` best lower bounds and its best upper bound. The lower bounds of all
   blocks give each query a floor that its results reach.
4. Read. Blocks whose best upper bound is below the floor are dropped for that query. In the others
   the cells are scanned again and exact vectors are read in the order of their bounds, until the
   kth result is certain: no bound left reaches the kth best score read, or the floor.
5. Per query the best rows of all units, its own row left out.

Rows travel packed in blocks of bounded size, units join by block numbers, and a unit sends
``k + 1`` rows a query at most, however many tie. Only counts reach the driver: joins of packed rows
are merges, since these rows compress so well that many fit under the size up to which a table would
be broadcast, and unpacked they would fill the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossledger.llm import arrays as a
from lossledger.llm.frames import ROW, key_of_row, partitions, spread_join, unique_rows
from lossledger.session import stage

K = 5
SCALE = 256
BITS = 8
# Numbers in a block of classes and in a block of queries, at most, and vectors in one, at least.
BLOCK_VALUES = 1 << 19
QUERY_VALUES = 1 << 17
LEAST = 512
# Candidates that a query reads at a time while its kth result is not certain.
STEP = 16
# Whole numbers up to this size are exact in double precision.
EXACT = float(1 << 53)

_CELLS = "low binary, width binary, cells binary"
_EXACT = "exact binary, members binary"
_SCAN_SQL = "dim int, qb long, block long, cls long, place int, bounds array<double>, best double"
_READ_SQL = "query long, row long, score long"


def top_k(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding",
          k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, ``key``, score): the ``k`` rows of greatest inner product per query row.

    A component x counts as floor(scale * x), x in double precision. Every row but the query's own
    is a candidate, also rows that share its vector or its key; there are fewer than ``k`` results
    if there are fewer candidates. Ties go to the smaller key, rows without a key come last. Vectors
    that are null or empty, or hold a component that is null, NaN or infinite, take no part; nor do
    vectors so long (2 ** 31 after scaling) that a score might not fit 64 bits. Vectors of different
    dimensions do not compare. No rows give no rows. Other columns do not matter.
    """
    if k < 1:
        raise ValueError("a search has at least one result")
    rows, again = unique_rows(vectors.select(key, vector, F.coalesce(is_query, F.lit(False))
                                             .alias("asks")), key, vector)
    scaled = F.transform(vector, lambda x: F.lit(float(scale)) * x.cast("double"))
    good = (F.size("x") > 0) & ~F.exists("x", lambda x: x.isNull() | F.isnan(x)
                                         | (F.abs(x) > float(1 << 31)))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    usable = stage(
        rows.select(F.col(ROW).alias("row"), "asks", scaled.alias("x")).where(good)
        .select("row", "asks", F.transform("x", lambda x: F.floor(x)).alias("v"))
        .where(squares < float(1 << 62)).withColumn("hash", F.xxhash64("v")), "usable")
    classes = stage(_classes(usable, k), "classes")
    asking = _asking(usable, classes)
    blocks, queries = _packed(classes, asking, partitions(vectors.sparkSession), k)

    cells, exact = blocks.drop("exact", "members"), blocks.drop("low", "width", "cells")
    numbers = blocks.groupBy("dim").agg(F.collect_list("block").alias("all"))
    units = queries.select("dim", "qb").join(numbers, "dim").select(
        "dim", "qb", F.explode("all").alias("block"))
    scan = stage(_merged(_merged(units, queries, "dim", "qb"), cells, "dim", "block").mapInArrow(
        lambda it: _scan(it, k), _SCAN_SQL), "scan")
    wanted = _merged(scan, _floors(scan, k), "cls").where(F.col("best") >= F.col("floor")).groupBy(
        "dim", "qb", "block").agg(F.collect_list("place").alias("places"),
                                  F.collect_list("floor").alias("floors"))
    read = _merged(_merged(_merged(wanted, queries, "dim", "qb"), cells, "dim", "block"),
                   exact.drop("n"), "dim", "block").mapInArrow(lambda it: _read(it, k), _READ_SQL)
    found = _results(read, asking, k)
    ranks = rows.select(ROW, key) if again else None
    found = key_of_row(key_of_row(found, "query_id", key, ranks), "row", key, ranks)
    return found.select("query_id", "rank", F.col("row").alias(key), "score")


def _merged(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """A join that never broadcasts either side."""
    return left.join(right.hint("merge"), list(keys))


def _classes(usable: DataFrame, k: int) -> DataFrame:
    """(cls, v, hash, members): each distinct vector, its smallest row and its k + 1 smallest.
    A task keeps no more than those of a vector before it shuffles them."""
    order = Window.partitionBy("hash", "v").orderBy("row")
    few = usable.select("hash", "v", "row").withColumn("nth", F.row_number().over(order)).where(
        F.col("nth") <= k + 1)
    return few.groupBy("hash", "v").agg(F.array_sort(F.collect_list("row")).alias("members")).select(
        F.col("members")[0].alias("cls"), "hash", "v", "members")


def _asking(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """(row, cls): the class of every query row. Distinct vectors with one hash, if there are any,
    stay apart by comparison."""
    by_hash = classes.groupBy("hash").agg(F.collect_list(F.struct("v", "cls")).alias("these"))
    asked = usable.where("asks").select("hash", "row", F.col("v").alias("own"))
    joined = spread_join(asked, by_hash.hint("merge"), "hash")
    same = F.filter("these", lambda c: c["v"] == F.col("own"))
    return stage(joined.select("row", same[0]["cls"].alias("cls")), "asking")


def _packed(classes: DataFrame, asking: DataFrame, tasks: int,
            k: int) -> tuple[DataFrame, DataFrame]:
    """The approximation file with exact vectors beside it, and the blocks of queries."""
    def dealt(rows: DataFrame, values: int, name: str) -> DataFrame:
        sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("count"))
        per = F.greatest(F.lit(1.0), F.least(F.lit(float(values)) / F.col("dim"), F.greatest(
            F.lit(float(LEAST)), F.col("count") / F.lit(2 * tasks))))
        number = F.pmod(F.xxhash64("cls"), F.ceil(F.col("count") / per).cast("long"))
        return (rows.withColumn("dim", F.size("v")).join(sizes, "dim").withColumn(name, number)
                .select("dim", name, "cls", "v", "members").repartition("dim", name)
                .sortWithinPartitions("dim", name, "cls"))

    blocks = dealt(classes, BLOCK_VALUES, "block").mapInArrow(
        lambda it: (_pack(*group, k) for group in _groups(it, "block")),
        f"dim int, block long, n int, {_CELLS}, {_EXACT}")
    asked = classes.join(asking.select("cls").distinct(), "cls", "left_semi")
    queries = dealt(asked, QUERY_VALUES, "qb").mapInArrow(
        lambda it: (_pack_queries(*group) for group in _groups(it, "qb")),
        "dim int, qb long, asked binary, q binary")
    return stage(blocks, "blocks"), stage(queries, "queries")


def _floors(scan: DataFrame, k: int) -> DataFrame:
    """(cls, floor): the (k + 1)th best lower bound of each query over all blocks."""
    bounds = F.sort_array(F.flatten(F.collect_list("bounds")), asc=False)
    return scan.groupBy("cls").agg(bounds.alias("all")).select(
        "cls", F.coalesce(F.get("all", F.lit(k)), F.lit(float("-inf"))).alias("floor"))


def _results(read: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query row: its class's k + 1 best, without its own row."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "row")
    best = (read.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
            .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("nth", "row", "score")))
                                  .alias("best")))
    own = asking.select(F.col("row").alias("query_id"), F.col("cls").alias("query"))
    others = F.slice(F.filter("best", lambda b: b["row"] != F.col("query_id")), 1, k)
    return spread_join(own, best, "query").select(
        "query_id", F.posexplode(others).alias("at", "one")).select(
            "query_id", (F.col("at") + 1).alias("rank"), "one.row", "one.score")


# -- what tasks do ---------------------------------------------------------------------------


def _groups(batches, name: str) -> Iterator[tuple]:
    """(dim, number, cls, v, members) of each block; its rows follow on one another."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        head = a.changes(batch.column("dim").to_numpy(), batch.column(name).to_numpy())
        if held:
            head[0] = any(batch.column(c)[0] != held[-1].column(c)[-1] for c in ("dim", name))
        cuts = [*np.flatnonzero(head), batch.num_rows]
        if cuts[0]:
            held.append(batch.slice(0, cuts[0]))
        for first, last in zip(cuts, cuts[1:]):
            if held:
                yield _group(held, name)
            held = [batch.slice(first, last - first)]
    if held:
        yield _group(held, name)


def _group(held: list[pa.RecordBatch], name: str) -> tuple:
    rows = pa.Table.from_batches(held).combine_chunks()
    dim = rows["dim"][0].as_py()
    flat = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return (dim, rows[name][0].as_py(), rows["cls"].to_numpy(), flat.reshape(-1, dim),
            rows["members"].combine_chunks())


def _row(values: dict) -> pa.RecordBatch:
    kinds = {"dim": pa.int32(), "n": pa.int32(), "block": pa.int64(), "qb": pa.int64()}
    return pa.RecordBatch.from_arrays(
        [pa.array([x], kinds.get(c, pa.binary())) for c, x in values.items()], names=list(values))


def _pack(dim: int, block: int, cls: np.ndarray, v: np.ndarray, members, k: int) -> pa.RecordBatch:
    low = v.min(axis=0)
    width = (v.max(axis=0) - low) // (1 << BITS) + 1
    cells = ((v - low) // width).astype(np.uint8)
    each = np.diff(members.offsets.to_numpy())
    few = np.full((len(cls), k + 1), -1, np.int64)
    few[np.repeat(np.arange(len(cls)), each), a.ranges(np.zeros_like(each), each)] = (
        members.flatten().to_numpy())
    return _row({"dim": dim, "block": block, "n": len(cls), "low": low.tobytes(),
                 "width": width.tobytes(), "cells": cells.tobytes(), "exact": v.tobytes(),
                 "members": few.tobytes()})


def _pack_queries(dim: int, qb: int, cls: np.ndarray, v: np.ndarray, members) -> pa.RecordBatch:
    return _row({"dim": dim, "qb": qb, "asked": cls.tobytes(), "q": v.tobytes()})


def _numbers(unit: dict, name: str, dim: int = 0, kind=np.int64) -> np.ndarray:
    flat = np.frombuffer(unit[name], kind)
    return flat.reshape(-1, dim) if dim else flat


def _bounds(unit: dict, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Twice the score at the middle of each cell vector, per query, and each query's slack: twice
    the exact score is at most that far away. Both are whole numbers, so nothing is rounded; where
    doubles could not hold them the slack is infinite and every vector is read."""
    dim = unit["dim"]
    low, width = _numbers(unit, "low").astype(float), _numbers(unit, "width").astype(float)
    cells = _numbers(unit, "cells", dim, np.uint8)
    most = np.abs(low) * 2 + (2 * width) * (1 << BITS)
    q = q.astype(float)
    if len(q) and (np.abs(q) @ most).max() >= EXACT:
        return np.zeros((len(q), len(cells))), np.full(len(q), np.inf)
    middle = (q * (2 * width)) @ cells.T.astype(float) + (q @ (2 * low + width - 1))[:, None]
    return middle, np.abs(q) @ (width - 1)


def _best(values: np.ndarray, k: int) -> np.ndarray:
    """The k greatest of each row, in any order."""
    if values.shape[1] <= k:
        return values
    return np.partition(values, values.shape[1] - k, axis=1)[:, -k:]


def _units(batches) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}


def _scan(batches, k: int) -> Iterator[pa.RecordBatch]:
    for unit in _units(batches):
        q = _numbers(unit, "q", unit["dim"])
        middle, slack = _bounds(unit, q)
        top = _best(middle, k + 1) - slack[:, None]
        size = len(q)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(size, unit["dim"], np.int32)), pa.array(np.full(size, unit["qb"])),
            pa.array(np.full(size, unit["block"])), pa.array(_numbers(unit, "asked")),
            pa.array(np.arange(size, dtype=np.int32)),
            a.lists(top.ravel(), np.arange(size + 1) * top.shape[1], pa.float64()),
            pa.array(middle.max(axis=1) + slack)],
            names=["dim", "qb", "block", "cls", "place", "bounds", "best"])


def _read(batches, k: int) -> Iterator[pa.RecordBatch]:
    for unit in _units(batches):
        places = np.array(unit["places"], np.int64)
        q, v = _numbers(unit, "q", unit["dim"])[places], _numbers(unit, "exact", unit["dim"])
        members, asked = _numbers(unit, "members", k + 1), _numbers(unit, "asked")[places]
        middle, slack = _bounds(unit, q)
        out = []
        for i in range(len(q)):
            at, scores = _nearest(q[i], v, middle[i], slack[i], unit["floors"][i], k)
            rows = members[at]
            real = rows >= 0
            rows, scores = rows[real], np.repeat(scores, real.sum(axis=1))
            few = np.lexsort((rows, -scores))[:k + 1]
            out.append(np.stack([np.full(len(few), asked[i]), rows[few], scores[few]]))
        query, row, score = np.concatenate(out, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(row), pa.array(score)],
                                         names=["query", "row", "score"])


def _nearest(q, v, middle, slack, floor, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors read and their scores: in the order of the upper bounds, until no bound left
    reaches the floor or the (k + 1)th best score so far."""
    near = np.flatnonzero(middle + slack >= floor)
    near = near[np.argsort(-middle[near], kind="stable")]
    scores = np.zeros(0, np.int64)
    step = STEP
    while len(scores) < len(near):
        if len(scores) > k:
            enough = 2.0 * np.partition(scores, len(scores) - k - 1)[-k - 1]
            if middle[near[len(scores)]] + slack < enough:
                break
        following = near[len(scores):len(scores) + step]
        scores = np.append(scores, v[following] @ q)
        step *= 2
    return near[:len(scores)], scores
