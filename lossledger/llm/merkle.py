"""Merkle manifest of a dataset: every row a leaf, every group of rows a tree, one root over all.

Nodes carry nested-interval labels: the interval of leaf ranks that they cover.

1. Leaves are ranked by group and key. ``fan`` consecutive nodes of a tree become one node, level by
   level, until one is left, the group's subroot; the subroots in the order of groups likewise
   become the root. A level is one grouping by (tree, interval of the level), so groups have ``fan``
   members at most, however large the tree.
2. Ancestors are attached from the root down, one join per level: a node's label falls into one
   bucket of the next level's intervals, and the ancestor there contains it. Each run of siblings
   is one row with the path above it, so the wide paths travel once per run, not once per leaf.
3. Of the nodes of its run, those whose intervals lie before and after a node's own are its
   siblings. They are its part of the proof on that level.

The number of levels is the logarithm of the largest tree; every level is staged, so nothing is
computed twice and a lost executor costs a retry. Only sizes and the root reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.llm.frames import ranked
from lossledger.session import stage

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts in sequence."""
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: Sequence[str | Column] = FIELDS) -> Column:
    """The digest of a row's fields: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the
    value. No two rows that differ in a field give the same bytes."""
    def told(field):
        value = (F.col(field) if isinstance(field, str) else field).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value),
                          F.lit("-"))

    return digest(*(told(f) for f in fields))


def proof_digest(path: str = "path") -> Column:
    """The digest of all siblings of a path, from the leaf's run up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""),
                  256)


def folded(start: Column, path: str = "path") -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda node, p: digest(p["left"], node, p["right"]))


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang",
             fields: Sequence[str] = FIELDS, carry: Sequence[str] = (), fan: int = FAN) -> DataFrame:
    """(carry..., leaf, subroot, root, path) per row of ``docs``.

    ``path`` holds, from the leaf's run up to the root, one (left, right) per level: the digests of
    the siblings before and after, in sequence. A run of one node, as the last of a level can be,
    has empty sides and is hashed all the same. A group of one row is its own subroot; a single
    subroot is the root.

    Groups are ordered by bytes, the null group first; the rows of a group by key, those without a
    key last. Rows that share a key are leaves of their own in the order of their digests; equal
    rows are interchangeable. A null field, an empty one and ``-`` differ. No rows give no rows.
    Columns that are neither fields nor carried do not matter, whatever their names.
    """
    if fan < 2:
        raise ValueError("a run has two nodes or more")
    slim = docs.select(F.struct(*carry).alias("payload") if carry else F.lit(None).cast("int")
                       .alias("payload"), F.col(group).alias("grp"), F.col(key).alias("key"),
                       leaf(fields).alias("digest"))
    # Staged first: dealing rows by ranges reads them twice, and digests are costly.
    rows = ranked(stage(slim, "leaves"), F.col("grp").asc_nulls_first(), F.col("key").asc_nulls_last(),
                  F.col("digest"), name="lo").drop("key")
    trees = stage(rows.groupBy("grp").agg(F.min("lo").alias("first"),
                                          F.count(F.lit(1)).alias("size")), "trees")
    leaves = rows.join(trees.withColumnRenamed("grp", "of"), F.col("grp").eqNullSafe(F.col("of"))
                       ).select("first", "size", "lo", F.col("lo").alias("hi"), "digest", "payload")

    levels, tops = _ascend(leaves, _largest(trees), fan)
    subroots = ranked(tops, F.col("first"), name="at").select(
        F.lit(0).cast("long").alias("first"), F.lit(tops.count()).cast("long").alias("size"),
        F.col("at").alias("lo"), F.col("at").alias("hi"), "digest",
        F.struct(F.col("first").alias("tree")).alias("payload"))
    subroots = stage(subroots, "subroots")
    upper, top = _ascend(subroots, _largest(subroots), fan)
    root = top.first()
    ends = _descend(subroots, upper, top.select(
        "first", F.col("digest").alias("subroot"), _empty().alias("path")), fan)
    above = stage(ends.select(F.col("payload.tree").alias("first"), F.col("digest").alias("subroot"),
                              "path"), "above")
    out = _descend(leaves, levels, above, fan)
    told = [F.col(f"payload.{c}").alias(c) for c in carry]
    return out.select(*told, F.col("digest").alias("leaf"), "subroot",
                      F.lit(root["digest"] if root else None).cast("string").alias("root"), "path")


def _largest(trees: DataFrame) -> int:
    return trees.agg(F.max("size")).first()[0] or 0


def _empty() -> Column:
    return F.expr("cast(array() AS array<struct<left:string,right:string>>)")


def _bucket(width: int) -> Column:
    """The interval of ``width`` leaves in which a node's label begins, counted from its tree's."""
    return F.floor((F.col("lo") - F.col("first")) / F.lit(width)).cast("long")


def _ascend(leaves: DataFrame, largest: int, fan: int) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level, each with the node above it, and the top node of every tree."""
    node = ["first", "size", "digest"]
    levels, tops = [], [leaves.where("size = 1").select(*node)]
    below, width = leaves, 1
    while width < largest:
        kid = ["lo", "hi", "digest", *(["payload"] if not levels else [])]
        runs = (below.where(F.col("size") > width).withColumn("bucket", _bucket(width * fan))
                .groupBy("first", "size", "bucket")
                .agg(F.array_sort(F.collect_list(F.struct(*kid))).alias("kids")))
        width *= fan
        runs = stage(runs.select(
            "first", "size", F.col("kids")[0]["lo"].alias("lo"),
            F.element_at("kids", -1)["hi"].alias("hi"),
            F.sha2(F.array_join(F.col("kids.digest"), ""), 256).alias("digest"), "kids"), "runs")
        levels.append(runs)
        below = runs
        tops.append(runs.where(F.col("size") <= width).select(*node))
    return levels, stage(reduce(DataFrame.union, tops), "tops")


def _sides(kids: str, lo: Column, hi: Column) -> Column:
    """The siblings before and after an interval: those of the run that it does not cover."""
    def told(outside):
        return F.array_join(F.transform(F.filter(kids, outside), lambda k: k["digest"]), "")

    return F.struct(told(lambda k: k["hi"] < lo).alias("left"),
                    told(lambda k: k["lo"] > hi).alias("right"))


def _descend(leaves: DataFrame, levels: list[DataFrame], above: DataFrame,
             fan: int) -> DataFrame:
    """Every leaf with its subroot and path. ``above`` is what each tree has over its top node:
    (first, subroot, path)."""
    placed, width = None, fan ** len(levels)
    for runs in reversed(levels):
        found = runs.where(F.col("size") <= width).join(above, "first")
        if placed is not None:
            # The label's bucket on the next level is the join key; containment confirms it.
            parents = placed.select(
                "first", _bucket(width * fan).alias("bucket"), F.col("lo").alias("low"),
                F.col("hi").alias("high"), F.col("kids").alias("siblings"), "subroot",
                F.col("path").alias("upper"))
            inner = (runs.where(F.col("size") > width)
                     .withColumn("bucket", _bucket(width * fan))
                     .join(parents, ["first", "bucket"])
                     .where((F.col("low") <= F.col("lo")) & (F.col("hi") <= F.col("high"))))
            inner = inner.withColumn("path", F.concat(F.array(
                _sides("siblings", F.col("lo"), F.col("hi"))), "upper"))
            found = found.unionByName(inner.select(*found.columns))
        placed = stage(found, "placed") if width > fan else found
        width //= fan
    out = ["digest", "payload", "subroot", "path"]
    lone = leaves.where("size = 1").join(above, "first").select(*out)
    if placed is None:
        return lone
    each = placed.select("subroot", F.col("path").alias("upper"), "kids",
                         F.explode("kids").alias("kid"))
    path = F.concat(F.array(_sides("kids", F.col("kid.lo"), F.col("kid.hi"))), F.col("upper"))
    return each.select("kid.digest", "kid.payload", "subroot", path.alias("path")).unionByName(lone)
