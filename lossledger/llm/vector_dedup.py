"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one kept per group.

1. Vectors that are equal within a group collapse to one with a count.
2. Spherical k-means runs on a bounded sample (``SAMPLE`` vectors, ``SAMPLE_VALUES`` numbers, the
   smallest by hash). A cell is to hold about one block, so the number of cells grows with that of
   the vectors, up to ``CELLS`` and a sixteenth of the sample. The index then holds every vector.
3. A vector lives in the cell of its nearest centroid and also visits each cell whose border is
   near. Two vectors with cosine >= c are at most sqrt(2 - 2c) apart; if they live in different
   cells, one of them is within half of that of the border between the two. So these visits miss no
   pair: the search is exact, and the cells only save work. Sending a vector to one more cell costs
   as much as some thousand products, which is why cells are as large as blocks.
4. Cells are cut into blocks of about ``BLOCK`` vectors and at most ``BLOCK_VALUES`` numbers. A task
   multiplies two blocks, so a cell that holds a third of all vectors divides over many tasks, and
   no task ever holds a whole cell.
5. A block pair sends, per vector, how many links it has and the smallest vector it reaches there:
   the number of rows does not grow with the number of links. Components come from those rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossledger.llm import arrays as a
from lossledger.llm.components import connected
from lossledger.llm.frames import ROW, key_of_row, unique_rows
from lossledger.session import stage

COSINE = 0.93
SAMPLE = 16_384
SAMPLE_VALUES = 4_000_000
CELLS = 4_096
FEWEST_CELLS = 4
BLOCK = 2_048
BLOCK_VALUES = 1 << 20
ROUNDS = 12
# Rows of one vector are dealt to this many join keys, whatever they hold of all rows.
SALTS = 16

_MEMBERS_SQL = ("vec long, copies long, grp int, dim int, home int, visits array<int>, "
                "v array<{kind}>")


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                 group: str = "label", cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept) per row of ``vectors``.

    Two rows link if their ``group`` is equal and not null, their vectors have as many components
    and a cosine of at least ``cosine`` in double precision. Vectors that are null, empty or zero,
    or hold a null, NaN or infinite component, link with nothing. Rows that share a key are
    separate; rows without one come last and may have a null component_id. ``kept`` marks the
    smallest row of each component. No rows give no rows. A group is an integer.
    """
    if not 0 < cosine <= 1:
        raise ValueError("the cosine is above 0 and at most 1")
    kind = "float" if vectors.schema[vector].dataType.elementType.typeName() == "float" else "double"
    keyed, again = unique_rows(vectors.select(key, vector, group), key, vector, group)
    rows = keyed.select(F.col(ROW).alias("row"), F.col(group).cast("int").alias("grp"),
                       F.col(vector).cast(f"array<{kind}>").alias("v")).withColumn(
                           "salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    good = (F.col("grp").isNotNull() & (F.size("v") > 0)
            & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists("v", lambda x: x != 0))
    classes = stage(rows.where(good).groupBy("grp", "v").agg(
        F.min("row").alias("vec"), F.count(F.lit(1)).alias("copies"),
        F.bit_or(F.expr("shiftleft(1, salt)")).alias("salts")), "vectors")
    centroids = _fit(classes)
    members = stage(classes.mapInArrow(lambda it: _assign(it, centroids, cosine),
                                       _MEMBERS_SQL.format(kind=kind)), "members")
    products = stage(_pairs(members).mapInArrow(
        lambda it: _multiply(it, cosine), "vec long, links long, least long"), "products")
    found = connected(products.select(F.col("vec").alias("a"), F.col("least").alias("b")))
    links = products.groupBy("vec").agg(F.sum("links").alias("links"))

    classes = classes.join(links, "vec", "left").join(
        found, F.col("vec") == F.col("node"), "left").select(
            "grp", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "vec").alias("component"),
            F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), s -> getbit(salts, s) = 1)"))
            .alias("salt"))
    out = rows.withColumn("v", F.when(good, F.col("v"))).join(
        classes, ["grp", "v", "salt"], "left").select(
            "row", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "row").alias("component_id"),
            (F.col("row") == F.coalesce("component", "row")).alias("kept"))
    ranks = keyed.select(ROW, key) if again else None
    out = key_of_row(key_of_row(out, "component_id", key, ranks), "row", key, ranks)
    return out.select(F.col("row").alias(key), "n_links", "component_id", "kept")


# -- cells -----------------------------------------------------------------------------------


def _fit(classes: DataFrame) -> dict[int, np.ndarray]:
    """Centroids for each number of components, from the bounded sample."""
    sizes = classes.groupBy(F.size("v").alias("dim")).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("grp").alias("groups"))
    out = {}
    # Vectors of rarer dimensions share one cell per dimension.
    for dim, n, groups in sizes.orderBy(F.desc("n"), "dim").limit(16).collect():
        size = max(1, min(SAMPLE, SAMPLE_VALUES // dim))
        share = n // max(groups, 1)
        cells = max(min(FEWEST_CELLS, math.isqrt(share)), share // BLOCK)
        cells = max(1, min(CELLS, cells, size // 16))
        if cells == 1:
            continue
        sample = classes.where(F.size("v") == dim).orderBy(F.xxhash64("vec"), "vec").limit(size)
        points = np.array([r["v"] for r in sample.select("v").collect()], float)
        out[dim] = spherical_kmeans(_unit(points), cells)
    return out


def _unit(points: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, large and tiny components alike."""
    points = points / np.abs(points).max(axis=1, keepdims=True)
    return points / np.sqrt((points * points).sum(axis=1, keepdims=True))


def spherical_kmeans(points: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids. Starts from evenly spaced points; an empty cell takes the worst-placed."""
    centroids = points[np.linspace(0, len(points) - 1, cells).astype(int)]
    for _ in range(rounds):
        near = points @ centroids.T
        home = near.argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, points)
        size = np.linalg.norm(sums, axis=1)
        lost = np.flatnonzero(size == 0)
        worst = np.argsort(near[np.arange(len(points)), home])[:len(lost)]
        sums[lost], size[lost] = points[worst], 1.0
        centroids = sums / size[:, None]
    return centroids


def _assign(batches, centroids: dict[int, np.ndarray], cosine: float):
    """The cell that each vector lives in, and all those that it is in or visits."""
    reach = math.sqrt(max(0.0, 2 - 2 * cosine)) / 2 + 1e-9
    for batch in batches:
        column = batch.column("v")
        lengths = np.diff(column.offsets.to_numpy())
        flat = column.flatten().to_numpy(zero_copy_only=False)
        begins = np.cumsum(lengths) - lengths
        for dim in np.unique(lengths):
            for at in _chunks(np.flatnonzero(lengths == dim)):
                points = _unit(flat[begins[at][:, None] + np.arange(dim)].astype(float))
                cells = centroids.get(int(dim))
                if cells is None:
                    near = np.zeros((len(at), 1))
                    wide = np.ones((1, 1))
                else:
                    near = points @ cells.T
                    wide = np.sqrt(np.maximum(2 - 2 * cells @ cells.T, 1e-30))
                home = near.argmax(axis=1)
                best = near[np.arange(len(at)), home][:, None]
                visit = (best - near) <= reach * wide[home]
                visit[np.arange(len(at)), home] = True
                _, cell = np.nonzero(visit)
                bounds = np.append(0, np.cumsum(visit.sum(axis=1)))
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).take(take) for c in ("vec", "copies", "grp")),
                    pa.array(np.full(len(at), dim, np.int32)), pa.array(home.astype(np.int32)),
                    a.lists(cell.astype(np.int32), bounds, pa.int32()), column.take(take)],
                    names=["vec", "copies", "grp", "dim", "home", "visits", "v"])


def _chunks(index: np.ndarray) -> list[np.ndarray]:
    return np.array_split(index, -(-len(index) // 256))


# -- blocks ----------------------------------------------------------------------------------


def _pairs(members: DataFrame) -> DataFrame:
    """Each vector once per block pair that it takes part in: residents with residents (i <= j),
    and visitors with residents (visitor block t is i = -1 - t). Side 0 is the left block."""
    cell = ["grp", "dim", "cell"]
    lives = F.col("cell") == F.col("home")
    size = F.least(F.lit(BLOCK), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_VALUES) / F.col("dim"))))
    blocks = lambda flag: F.ceil(F.count(F.when(flag, 1)) / size).cast("int")
    placed = members.withColumn("cell", F.explode("visits"))
    # Counted without the vectors; as files of known size these decide how the vectors join them.
    sizes = stage(placed.groupBy(*cell).agg(blocks(lives).alias("nh"), blocks(~lives).alias("nt"))
                  .where("nh > 0"), "cells")
    numbered = placed.join(sizes, cell).withColumn("lives", lives).withColumn(
        "b", F.pmod(F.xxhash64("vec"), F.when(lives, F.col("nh")).otherwise(F.col("nt")))
        .cast("int"))
    place = "array<struct<i:int,j:int,side:int>>"
    numbered = numbered.withColumn("at", F.explode(F.expr(f"""
        if(lives,
           concat(transform(sequence(b, nh - 1), j -> (b, j, 0)),
                  if(b = 0, array(), transform(sequence(0, b - 1), i -> (i, b, 1))),
                  if(nt = 0, array(), transform(sequence(0, nt - 1), t -> (-1 - t, b, 1)))),
           transform(sequence(0, nh - 1), j -> (-1 - b, j, 0)))""".replace(
               "array()", f"cast(array() as {place})").replace(
               "(b, j, 0)", "named_struct('i', b, 'j', j, 'side', 0)").replace(
               "(i, b, 1)", "named_struct('i', i, 'j', b, 'side', 1)").replace(
               "(-1 - t, b, 1)", "named_struct('i', -1 - t, 'j', b, 'side', 1)").replace(
               "(-1 - b, j, 0)", "named_struct('i', -1 - b, 'j', j, 'side', 0)"))))
    key = [*cell, "i", "j"]
    # Only residents that meet visitors are asked where they visit themselves.
    asked = F.when((F.col("at.i") < 0) & (F.col("at.side") == 1), F.col("visits"))
    return numbered.select(*cell, "at.i", "at.j", "at.side", "vec", "copies", "home",
                           asked.alias("visits"), "v").repartition(*key).sortWithinPartitions(
                               *key, "side", "vec")


_KEY = ["grp", "dim", "cell", "i", "j"]
_OUT = pa.schema([("vec", pa.int64()), ("links", pa.int64()), ("least", pa.int64())])


def _multiply(batches, cosine: float):
    """One product per block pair; a pair's rows follow on one another."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        head = a.changes(*(batch.column(k).to_numpy() for k in _KEY))
        if held:
            head[0] = any(batch.column(k)[0] != held[-1].column(k)[-1] for k in _KEY)
        cuts = [*np.flatnonzero(head), batch.num_rows]
        if cuts[0]:
            held.append(batch.slice(0, cuts[0]))
        for first, last in zip(cuts, cuts[1:]):
            if held:
                yield _product(pa.Table.from_batches(held), cosine)
            held = [batch.slice(first, last - first)]
    if held:
        yield _product(pa.Table.from_batches(held), cosine)


def _product(rows: pa.Table, cosine: float) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    side = rows["side"].to_numpy()
    i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
    dim = rows["dim"][0].as_py()
    points = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    points = _unit(points.astype(float).reshape(-1, dim))
    vec, copies = rows["vec"].to_numpy(), rows["copies"].to_numpy()
    left = np.flatnonzero(side == 0)
    right = left if i == j else np.flatnonzero(side == 1)
    hit = points[left] @ points[right].T >= cosine
    if i == j:
        np.fill_diagonal(hit, False)
    elif i < 0 and hit.any():
        hit &= ~_twice(rows, left, right, vec)
    links = np.zeros(len(vec), np.int64)
    links[left] = hit @ copies[right]
    if i != j:
        links[right] = copies[left] @ hit
    least = _least(hit, vec[left], vec[right], i == j)
    reached = vec.copy()
    reached[left] = least[0]
    if i != j:
        reached[right] = least[1]
    some = links > 0
    return pa.RecordBatch.from_arrays(
        [pa.array(vec[some]), pa.array(links[some]), pa.array(reached[some])], schema=_OUT)


def _twice(rows, left, right, vec) -> np.ndarray:
    """Pairs of a visitor and a resident that the other cell finds as well: the resident visits
    the visitor's home. They count where the visitor is the smaller."""
    home = rows["home"].to_numpy()
    visits = rows["visits"].combine_chunks()
    homes, own = np.unique(home[left], return_inverse=True)
    seen = np.zeros((len(home), len(homes)), bool)
    flat = visits.flatten().to_numpy(zero_copy_only=False)
    who = np.repeat(np.arange(len(home)), pc.fill_null(pc.list_value_length(visits), 0))
    at = np.minimum(np.searchsorted(homes, flat), len(homes) - 1)
    ok = homes[at] == flat
    seen[who[ok], at[ok]] = True
    return seen[right][:, own].T & (vec[left][:, None] > vec[right][None, :])


def _least(hit, left, right, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The smallest vector that each one reaches by links of this product."""
    none = np.iinfo(np.int64).max
    left, right = left.copy(), right.copy()
    rows, columns = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    part = hit[np.ix_(rows, columns)]
    while len(rows):
        before = left[rows].sum() + right[columns].sum()
        left[rows] = np.minimum(left[rows], np.where(part, right[columns], none).min(axis=1))
        if same:
            right = left
        right[columns] = np.minimum(
            right[columns], np.where(part, left[rows][:, None], none).min(axis=0))
        if same:
            left = right
        if left[rows].sum() + right[columns].sum() == before:
            break
    return left, right
