"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a table of prime size, from two hashes of its
name. Shards take turns; each claims the first free slot in its order of preference. Shares then
differ by one slot at most, and a shard that comes or goes moves few other slots. The table is a
constant array in the plan, so placing a row is one hash and one array access, without a shuffle.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lossledger.llm.frames import ROW, ranked

SLOTS = 65_537
SHARDS = 64
# A key with more than this many average shards' rows is spread over several shards.
HOT = 0.5


def names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """For each slot the number of its shard. The shards are taken in the given order."""
    if slots < 3 or any(slots % k == 0 for k in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("the number of slots is an odd prime")
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards have different names and are no more than the slots")
    at, skips = [], []
    for name in shards:
        digest = hashlib.blake2b(name.encode(), digest_size=16).digest()
        at.append(int.from_bytes(digest[:8], "little") % slots)
        skips.append(int.from_bytes(digest[8:], "little") % (slots - 1) + 1)
    table = [-1] * slots
    left = slots
    while True:
        for i, skip in enumerate(skips):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip) % slots
            table[at[i]] = i
            left -= 1
            if not left:
                return table


def _slot(slots: int, *keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def _lookup(table: list[int], slot: Column) -> Column:
    """The array is written as one literal, which the optimizer folds."""
    array = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")
    return F.element_at(array, slot + 1)


def placed(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS,
           hot: float = HOT) -> DataFrame:
    """``df`` with ``slot``, ``shard`` (its number) and ``piece``.

    Rows with equal keys share a shard, unless the key alone holds more than ``hot`` of an average
    shard: its rows, equal ones too, are then numbered and dealt to several shards in turn, ``piece``
    telling which. Only rows of such keys are shuffled. Null is a key like any other. Columns called
    slot, shard or piece are replaced. The hot keys are fewer than ``len(shards) / hot``, so they are
    sent to all tasks.
    """
    rows = df.drop("slot", "shard", "piece")
    counts = rows.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    share = max(1.0, total * hot / len(shards))
    many = {r["_key"]: min(len(shards), int(r["_n"] / share) + 1)
            for r in counts.where(F.col("_n") > share).where("_n > 1").collect()}
    table = lookup_table(shards, slots)
    if many:
        kind = df.schema[key]
        hot_keys = df.sparkSession.createDataFrame(
            list(many.items()), f"_key {kind.dataType.simpleString()}, _pieces int")
        told = rows.join(F.broadcast(hot_keys), F.col(key).eqNullSafe(F.col("_key")),
                         "left").drop("_key")
        own = ranked(told.where("_pieces is not null"), F.col(key).asc_nulls_last(),
                     F.xxhash64(*rows.columns))
        own = own.withColumn("piece", F.pmod(F.col(ROW), F.col("_pieces")).cast("int")).drop(ROW)
        rows = told.where("_pieces is null").withColumn("piece", F.lit(0)).unionByName(own).drop(
            "_pieces")
    else:
        rows = rows.withColumn("piece", F.lit(0))
    first = F.xxhash64(F.col(key))
    slot = F.when(F.col("piece") == 0, _slot(slots, first)).otherwise(
        _slot(slots, first, F.col("piece")))
    rows = rows.withColumn("slot", slot)
    return rows.withColumn("shard", _lookup(table, F.col("slot")))


def write_shards(rows: DataFrame, folder: str) -> None:
    """One folder per shard. Rows are rebalanced by shard: Spark cuts a shard into tasks of the
    advised partition size, however large it is, and puts small ones together."""
    rows.hint("rebalance", "shard").write.partitionBy("shard").parquet(folder)


def read_shards(spark: SparkSession, folder: str, kind: StructType) -> DataFrame:
    """The rows of all shards as they were written; ``kind`` is their schema."""
    return spark.read.schema(kind).parquet(folder).select(*kind.names)
