"""A fixed category vocabulary per column, taken from the full population."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossledger.operators.boosting import MISSING
from lossledger.session import stage
from lossledger.sources.columns import CATEGORICAL_FEATURES

# Categories that a hot list may hold per column: those with more than one row in this many.
HOT = 500


def _counted(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, category, n) of the categories present, all columns from one scan."""
    pairs = F.array(*(
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("category"))
        for f in features))
    return (df.select(F.inline(pairs)).where(F.col("category").isNotNull())
            .groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n")))


def vocabulary(df: DataFrame, features: Sequence[str] = tuple(CATEGORICAL_FEATURES)) -> DataFrame:
    """(feature, category, code): distinct values in text order, all columns from one scan."""
    order = Window.partitionBy("feature").orderBy("category")
    return _counted(df, features).withColumn("code", F.row_number().over(order) - 1).drop("n")


def frequent(df: DataFrame, features: Sequence[str] = tuple(CATEGORICAL_FEATURES),
             most: int = MISSING) -> dict[str, list[str]]:
    """The ``most`` frequent categories of each column, ties in text order: those that get a byte of
    their own in a vector. However many categories there are, no more reach the driver."""
    order = Window.partitionBy("feature").orderBy(F.desc("n"), "category")
    found = (_counted(df, features).withColumn("place", F.row_number().over(order))
             .where(F.col("place") <= most).collect())
    return {f: [r["category"] for r in sorted(found, key=lambda r: r["place"])
                if r["feature"] == f] for f in features}


def encoded(df: DataFrame, words: DataFrame,
            features: Sequence[str] = tuple(CATEGORICAL_FEATURES),
            suffix: str = "_code") -> DataFrame:
    """``df`` with the code of each of its categories, as ``words`` (a vocabulary) gives it. Missing
    and unknown ones share the code after the last.

    Each column joins its part of the staged vocabulary; its files have a known size, so Spark
    broadcasts it only while that is small. For the case that it is not, categories that hold more
    than one row in ``HOT`` are looked up in the plan, so that no key of the join is hot: there are
    fewer of them than ``HOT`` a column.
    """
    words = stage(words, "vocabulary")
    sizes = {r["feature"]: r["n"] for r in words.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    hot = _hot(df, words, features)
    for f in features:
        own = words.where(F.col("feature") == f).select(
            F.col("category").alias("_word"), F.col("code").alias("_code"))
        known = _lookup(hot[f], F.col(f))
        key = F.when(known.isNull(), F.col(f).cast("string"))
        df = df.withColumn("_key", key).join(own, F.col("_key") == F.col("_word"), "left").withColumn(
            f + suffix, F.coalesce(known, F.col("_code"), F.lit(sizes.get(f, 0)))
        ).drop("_key", "_word", "_code")
    return df


def _hot(df: DataFrame, words: DataFrame, features: Sequence[str]) -> dict[str, dict[str, int]]:
    share = Window.partitionBy("feature")
    often = (_counted(df, features).withColumn("all", F.sum("n").over(share))
             .where(F.col("n") * HOT > F.col("all")))
    found = often.join(words, ["feature", "category"]).collect()
    return {f: {r["category"]: r["code"] for r in found if r["feature"] == f} for f in features}


def _lookup(codes: dict[str, int], value: Column) -> Column:
    if not codes:
        return F.lit(None).cast("int")
    return F.create_map(*(F.lit(x) for pair in sorted(codes.items()) for x in pair))[
        value.cast("string")]
