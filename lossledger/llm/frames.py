"""Helpers on DataFrames that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.session import stage, tune

ROW = "_row"
# Rows of two numbers that are broadcast.
SMALL = 100_000


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings of these operators: texts travel to Python in batches of bounded size."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, as the cluster sizes it to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, *order: Column, name: str = ROW) -> DataFrame:
    """``df`` with the 0-based rank of each row in the total order of ``order``.

    Rows are dealt by ranges of the order and sorted inside each; a two-level sum over the sizes
    of the ranges gives the offsets. No window spans all rows or all rows of one key, so a key
    that holds a third of all rows divides like any other. Ties rank in any order, but the result
    is staged, so that each row keeps its rank. Empty input gives an empty frame.
    """
    spark = df.sparkSession
    part, at = f"{name}_part", f"{name}_at"
    tie = f"{name}_tie"
    spread = (df.withColumn(tie, F.monotonically_increasing_id())
              .repartitionByRange(partitions(spark), *order, F.col(tie))
              .sortWithinPartitions(*order, tie)
              .withColumn(part, F.spark_partition_id())
              .withColumn(at, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    local = stage(spread.drop(tie), "ranked")
    return local.join(_offsets(local, part), part).withColumn(
        name, F.col(at) + F.col("_offset")).drop(part, at, "_offset")


def _offsets(local: DataFrame, part: str) -> DataFrame:
    """The number of rows before each range: a running sum over one row per range."""
    sizes = local.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    return running_total(sizes, part, "_n", "_offset")


def running_total(totals: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """The sum of ``value`` over smaller keys. One row per task or file, never per record: up to
    ``SMALL`` of them are marked to be broadcast, so that what joins them stays where it is."""
    schema = T.StructType([totals.schema[key], T.StructField(name, T.LongType())])
    rows = sorted((r[0], r[1]) for r in totals.select(key, value).collect())
    before, out = 0, []
    for k, n in rows:
        out.append((k, before))
        before += n
    found = totals.sparkSession.createDataFrame(out, schema)
    return F.broadcast(found) if len(out) <= SMALL else found


def unique_rows(df: DataFrame, key: str, *ties: str) -> tuple[DataFrame, bool]:
    """``df`` with ``_row``, a long that names each row and orders rows like ``key``.

    It is the key itself where keys are whole numbers, unique and present, which one narrow
    aggregation finds.
    Otherwise rows are ranked by key (nulls last), then by a hash of ``ties``; the flag says so.
    """
    if df.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return ranked(df, F.col(key).asc_nulls_last(), F.xxhash64(*ties)), True
    again = (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
             .where((F.col("n") > 1) | F.col(key).isNull()).limit(1))
    if again.isEmpty():
        return df.withColumn(ROW, F.col(key).cast("long")), False
    return ranked(df, F.col(key).asc_nulls_last(), F.xxhash64(*ties)), True


def key_of_row(rows: DataFrame, column: str, key: str, ranks: DataFrame | None) -> DataFrame:
    """``column`` holds ``_row`` values: put the keys of those rows in their place."""
    if ranks is None:
        return rows
    names = ranks.select(F.col(ROW).alias("_of"), F.col(key).alias("_key"))
    return (rows.join(names, F.col(column) == F.col("_of"), "left")
            .withColumn(column, F.col("_key")).drop("_of", "_key"))


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``left`` joined by the long ``key`` with ``right``, which has each key once.

    A key that holds more than a partition's share of ``left`` would be one task's work. Fewer keys
    than partitions can hold that much, so their list is bounded; their rows are dealt over as many
    salts as they have shares, and their one row of ``right`` is copied to each.
    """
    n = partitions(left.sparkSession)
    counts = stage(left.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "counts")
    share = (counts.agg(F.sum("n")).first()[0] or 0) // n + 1
    hot = {k: -(-c // share) for k, c in counts.where(
        (F.col("n") > share) & F.col(key).isNotNull()).collect()}
    if not hot:
        return left.join(right, key, how)
    salts = F.coalesce(F.create_map(*(F.lit(x) for pair in hot.items() for x in pair))[F.col(key)],
                       F.lit(1))
    dealt = left.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), salts))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                                salts.cast("long") - 1)))
    return dealt.join(copies, [key, "_salt"], how).drop("_salt")
