"""Data contracts: each check counts the rows that break it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _long(counted: DataFrame, names: list[str]) -> DataFrame:
    pairs = F.array(*(F.struct(F.lit(n).alias("check"), F.col(n).alias("n_bad")) for n in names))
    return counted.select(F.inline(pairs))


class BrokenContract(ValueError):
    """Raised by a batch whose rows break a contract."""


def row_checks() -> dict[str, Column]:
    """The checks of cleaned loans that one row alone can break, as aggregates without a shuffle."""
    flag, lgd = F.col("default_flag"), F.col("actual_lgd")
    return {
        "id_missing": F.count_if(F.col("id").isNull()),
        "flag_outside_domain": F.count_if(flag.isNotNull() & ~flag.isin(0, 1)),
        "lgd_outside_unit_range": F.count_if((lgd < 0) | (lgd > 1)),
        "lgd_without_default": F.count_if(lgd.isNotNull() & (flag != 1)),
        "ead_negative": F.count_if(F.col("ead") < 0),
    }


def repeated_ids() -> Column:
    return F.count("id") - F.count_distinct("id")


def clean_contracts(loans: DataFrame) -> DataFrame:
    """(check, n_bad) for the cleaned loans, in one pass."""
    checks: Mapping[str, Column] = {**row_checks(), "id_repeated": repeated_ids()}
    counted = loans.agg(*(check.alias(name) for name, check in checks.items()))
    return _long(counted, list(checks))


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose ``key`` the dimension lacks, as (dimension_key, n_orphans).

    The fact is counted per key before the join, so a key that holds a third of the fact joins as
    one row.
    """
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return (
        per_key.join(dim.select(key), key, "left_anti")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_orphans"))
        .select(F.lit(key).alias("dimension_key"), "n_orphans")
    )


def repeated_keys(dim: DataFrame, key: str) -> DataFrame:
    """Number of keys that occur more than once, as (dimension_key, n_repeated)."""
    per_key = dim.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.count_if(F.col("n") > 1).alias("n_repeated")).select(
        F.lit(key).alias("dimension_key"), "n_repeated")


def row_parity(fact: DataFrame, borrowers: DataFrame) -> DataFrame:
    """Loans in the fact against borrowers, and the difference."""
    n = F.count(F.lit(1))
    none = F.lit(0).cast("bigint")
    both = fact.agg(n.alias("n_fact"), none.alias("n_borrower")).unionByName(
        borrowers.agg(none.alias("n_fact"), n.alias("n_borrower")))
    return both.agg(F.max("n_fact").alias("n_fact"), F.max("n_borrower").alias("n_borrower")) \
        .withColumn("n_dropped", F.col("n_borrower") - F.col("n_fact"))
