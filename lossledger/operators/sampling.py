"""A reproducible random sample of exactly n rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossledger.operators.chronology import digest_at

EXPLAIN_SAMPLE = 2_000
PLOT_SAMPLE = 5_000


def hash_sample(df: DataFrame, n: int, key: str = "id", seed: int = 42) -> DataFrame:
    """The min(n, rows) rows with the smallest digest of key and seed.

    The digest that bounds the sample is located first, so that taking the sample is a filter
    with a literal: no sort of the rows, and no task that gathers them. Where the bound falls among
    copies of one key, those with the smallest hash of all columns complete the sample.
    """
    if n <= 0:
        return df.limit(0)
    salted = df.withColumn("__salted", F.concat_ws("#", F.col(key).cast("string"), F.lit(seed)))
    end = digest_at(salted, n, "__salted")
    if end is None:
        return df
    digest, copies = end
    taken = salted.where(F.md5("__salted") < digest)
    if copies:
        taken = taken.union(salted.where(F.md5("__salted") == digest)
                            .orderBy(F.xxhash64(*df.columns)).limit(copies))
    return taken.drop("__salted")
