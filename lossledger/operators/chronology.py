"""Strictly chronological slices: train/calibration/test splits and walk-forward folds.

Loans are ordered by issue date, and within a date by a digest of their id, so that every order
is reproducible and a date holding a third of all loans still divides evenly. A slice boundary is
the first loan of the later slice; once its date and digest are known, the slice of any loan is a
plain comparison with literals. Labelling therefore needs neither a sort nor a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossledger.operators.ordered import running_totals

ROWS_PER_SORT = 1_000_000
HOLDOUT = 0.2
DEFAULT_FOLDS = 5


def digest(key: str) -> Column:
    return F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))


@dataclass(frozen=True)
class Instant:
    """A time as microseconds of the epoch. Python's own times would pass through the time zone of
    the driver on their way from and to Spark."""

    micros: int


def _literal(value) -> Column:
    if isinstance(value, Instant):
        return F.timestamp_micros(F.lit(value.micros).cast("bigint"))
    return F.lit(value)


@dataclass(frozen=True)
class Boundary:
    """``rank`` loans lie before it; without a date, all loans do."""

    rank: int
    date: Instant | None = None
    digest: str | None = None

    def before(self, when: str = "issue_date", key: str = "id") -> Column:
        """Predicate of the loans before it. Its first term can be pushed to the scan."""
        if self.date is None:
            return F.lit(True)
        stamp = _literal(self.date)
        return (F.col(when) <= stamp) & ((F.col(when) < stamp) | (digest(key) < self.digest))

    def onwards(self, when: str = "issue_date", key: str = "id") -> Column:
        """Predicate of the loans from it on."""
        if self.date is None:
            return F.lit(False)
        stamp = _literal(self.date)
        return (F.col(when) >= stamp) & ((F.col(when) > stamp) | (digest(key) >= self.digest))


def boundaries(df: DataFrame, ranks_for: Callable[[int], Sequence[int]], when: str = "issue_date",
               key: str = "id", rows_per_sort: int = ROWS_PER_SORT) -> list[Boundary]:
    """The boundary at each rank of ``ranks_for(row count)``.

    Narrowed down in steps: count by date, then (only for the dates hit) by digest prefix, then
    sort the few loans that share date and prefix. Only the boundaries reach the driver. Copies of
    one id count as one group and never straddle a boundary.
    """
    dates = running_totals(
        df.where(F.col(when).isNotNull()).groupBy(when).agg(F.count(F.lit(1)).alias("n")),
        when, ["n"])
    total = dates.agg(F.max("n_total")).first()[0] or 0
    ranks = list(ranks_for(total))
    wanted = sorted({r for r in ranks if r < total})
    if not wanted:
        return [Boundary(r) for r in ranks]
    hit = _holding(dates, F.array(*map(F.lit, wanted)), [when]).withColumn(
        "micros", F.unix_micros(F.col(when).cast("timestamp"))).drop(when).collect()
    found = {row["rank"]: (Instant(row["micros"]), "", row["rank"] - row["n_before"])
             for row in hit}
    found = _to_full_digest(df.select(when, digest(key).alias("digest")), when, found,
                            max(row["n"] for row in hit), rows_per_sort)
    return [Boundary(r, *found[r][:2]) if r in found else Boundary(r) for r in ranks]


def digest_at(df: DataFrame, rank: int, key: str,
              rows_per_sort: int = ROWS_PER_SORT) -> tuple[str, int] | None:
    """The digest of the row at a 0-based rank and how many rows of this digest come before it, or
    None if there are no more rows."""
    total = df.count()
    if rank >= total:
        return None
    keys = df.select(F.lit(0).alias("all"), digest(key).alias("digest"))
    return _to_full_digest(keys, "all", {rank: (0, "", rank)}, total, rows_per_sort)[rank][1:]


def _to_full_digest(loans: DataFrame, when: str, found: dict, most: int,
                    rows_per_sort: int) -> dict:
    """Via a prefix that leaves at most ``rows_per_sort`` of the ``most`` rows of a date."""
    digits = 0
    while most / 16 ** digits > rows_per_sort:
        digits += 1
    if digits:
        found = _narrow(loans, when, F.substring("digest", 1, digits), found)
    return _narrow(loans, when, F.col("digest"), found)


def _holding(totals: DataFrame, ranks: Column, keep: list[str]) -> DataFrame:
    """One row per rank: the row of ``totals`` within whose count the rank falls."""
    inside = F.filter(ranks, lambda r: (r >= F.col("n_before"))
                      & (r < F.col("n_before") + F.col("n")))
    return totals.select(*keep, "n", "n_before", F.explode(inside).alias("rank"))


def _narrow(loans: DataFrame, when: str, part: Column, found: dict) -> dict:
    """Refine (date, digest so far, rank inside it) to a longer part of the digest."""
    here = F.lit(False)
    inner = F.array().cast("array<struct<rank:bigint,inside:bigint>>")
    for rank, (date, known, inside) in found.items():
        place = (F.col(when) == _literal(date)) & F.startswith(F.col("digest"), F.lit(known))
        here = here | place
    counts = loans.where(here).groupBy(when, part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"))
    for rank, (date, known, inside) in found.items():
        place = (F.col(when) == _literal(date)) & F.startswith(F.col("part"), F.lit(known))
        one = F.array(F.struct(F.lit(rank).cast("bigint").alias("rank"),
                               F.lit(inside).cast("bigint").alias("inside")))
        inner = F.when(place, F.concat(inner, one)).otherwise(inner)
    known_length = len(next(iter(found.values()))[1])
    group = Window.partitionBy(when, F.substring("part", 1, known_length)).orderBy("part")
    earlier = F.sum("n").over(group.rowsBetween(Window.unboundedPreceding, -1))
    rows = (
        counts.withColumn("n_before", F.coalesce(earlier, F.lit(0)))
        .select(when, "part", "n", "n_before", F.explode(inner).alias("r"))
        .where((F.col("r.inside") >= F.col("n_before"))
               & (F.col("r.inside") < F.col("n_before") + F.col("n")))
        .select("part", F.col("r.rank").alias("rank"),
                (F.col("r.inside") - F.col("n_before")).alias("inside")).collect()
    )
    return {row["rank"]: (found[row["rank"]][0], row["part"], row["inside"]) for row in rows}


def holdout_rank(n: int, fraction: float = HOLDOUT) -> int:
    return int(n * (1 - fraction))


def three_way_ranks(n: int) -> list[int]:
    """Train up to the first rank, calibration up to the second, out of time after it."""
    test_from = holdout_rank(n)
    return [holdout_rank(test_from), test_from]


def label_splits(df: DataFrame, when: str = "issue_date", key: str = "id") -> DataFrame:
    """Adds ``split``: train, calibration or oot (out of time)."""
    train, test = boundaries(df, three_way_ranks, when, key)
    return df.withColumn("split", F.when(train.before(when, key), "train")
                         .when(test.before(when, key), "calibration").otherwise("oot"))


def label_holdout(df: DataFrame, when: str = "issue_date", key: str = "id") -> DataFrame:
    """Adds ``split``: train or oot."""
    (test,) = boundaries(df, lambda n: [holdout_rank(n)], when, key)
    return df.withColumn("split", F.when(test.before(when, key), "train").otherwise("oot"))


def split_summary(df: DataFrame, when: str = "issue_date") -> DataFrame:
    """Size and date range of each split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min(when).alias("start"), F.max(when).alias("end"))


def fold_boundaries(df: DataFrame, folds: int = DEFAULT_FOLDS, when: str = "issue_date",
                    key: str = "id") -> list[Boundary]:
    """The boundaries between ``folds + 1`` equal chronological segments."""
    parts = folds + 1
    return boundaries(df, lambda n: [int(n * i / parts) for i in range(1, parts)], when, key)


def with_segment(df: DataFrame, cuts: Sequence[Boundary], when: str = "issue_date",
                 key: str = "id") -> DataFrame:
    """Adds ``segment`` 0..folds.

    Fold i trains on the segments before i and tests on segment i, so a loan is tested at most
    once and the fold of a test loan is its segment.
    """
    segment = F.lit(0)
    for cut in cuts:
        segment = segment + F.when(cut.before(when, key), 0).otherwise(1)
    return df.withColumn("segment", segment)


def label_segments(df: DataFrame, folds: int = DEFAULT_FOLDS, when: str = "issue_date",
                   key: str = "id") -> DataFrame:
    return with_segment(df, fold_boundaries(df, folds, when, key), when, key)


def fold_windows(df: DataFrame, cuts: Sequence[Boundary], fold: int) -> tuple:
    """Training and test loans of a fold (1-based), as date ranges the scan can prune by."""
    start = cuts[fold - 1]
    test = df.where(start.onwards())
    if fold < len(cuts):
        test = test.where(cuts[fold].before())
    return df.where(start.before()), test


def fold_summary(segmented: DataFrame, when: str = "issue_date") -> DataFrame:
    """Per fold the size and date range of its training and test windows.

    Cumulates the per-segment totals, of which there is one more than folds.
    """
    parts = segmented.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n_test"), F.min(when).alias("test_start"),
        F.max(when).alias("test_end"))
    earlier = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        F.col("segment").alias("fold"),
        F.min("test_start").over(earlier).alias("train_start"),
        F.max("test_end").over(earlier).alias("train_end"),
        "test_start", "test_end",
        F.sum("n_test").over(earlier).alias("n_train"), "n_test",
    ).where(F.col("fold") > 0)
