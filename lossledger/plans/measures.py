"""The measure catalogue: named aggregates that answer any slice and grouping in one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossledger.functions.numeric import (
    blank_minus, cap_at_one, exact_avg, exact_sum, expected_loss, ratio)


def _weighted(risk: str) -> Column:
    return ratio(exact_sum(F.col(risk) * F.col("ead")), exact_sum(F.col("ead")))


def _loss(pd_by: float = 1.0, lgd_by: float = 1.0) -> Column:
    return exact_sum(expected_loss(cap_at_one(F.col("pd") * F.lit(pd_by)),
                                   cap_at_one(F.col("lgd") * F.lit(lgd_by)), F.col("ead")))


def _total_loss() -> Column:
    return exact_sum(expected_loss(F.col("pd"), F.col("lgd"), F.col("ead")))


def _default_rate() -> Column:
    return ratio(F.count_if(F.col("default_flag") == 1), F.count("default_flag"))


def _realized_loss() -> Column:
    return exact_sum(F.when(F.col("default_flag") == 1, F.col("actual_lgd") * F.col("ead")))


MEASURES: dict[str, Callable[[], Column]] = {
    "total_ead": lambda: exact_sum(F.col("ead")),
    "total_funded_amount": lambda: exact_sum(F.col("funded_amnt")),
    "loan_count": lambda: F.nullif(F.count(F.lit(1)), F.lit(0)),
    "weighted_pd": lambda: _weighted("pd"),
    "weighted_lgd": lambda: _weighted("lgd"),
    "average_pd": lambda: exact_avg(F.col("pd")),
    "total_expected_loss": _total_loss,
    "el_rate": lambda: ratio(_total_loss(), exact_sum(F.col("ead"))),
    "realized_default_rate": _default_rate,
    "realized_loss_amount": _realized_loss,
    "pd_calibration_gap": lambda: blank_minus(_weighted("pd"), _default_rate()),
    "average_int_rate": lambda: exact_avg(F.col("int_rate")),
}


def stress_measures(pd_by: float = 1.0, lgd_by: float = 1.0) -> dict[str, Callable[[], Column]]:
    """Stressed counterparts under what-if multipliers."""
    return {
        "stressed_expected_loss": lambda: _loss(pd_by, lgd_by),
        "stress_el_delta": lambda: blank_minus(_loss(pd_by, lgd_by), _total_loss()),
        "stress_el_rate": lambda: ratio(_loss(pd_by, lgd_by), exact_sum(F.col("ead"))),
    }


def in_slice(sub_grades: Sequence[str] | None = None, first_vintage: str | None = None,
             last_vintage: str | None = None) -> Column:
    """Predicate of a slice; the text order of vintages is their time order."""
    keep = F.lit(True)
    if sub_grades is not None:
        keep = keep & F.col("sub_grade").isin(list(sub_grades))
    if first_vintage is not None:
        keep = keep & (F.col("vintage") >= first_vintage)
    if last_vintage is not None:
        keep = keep & (F.col("vintage") <= last_vintage)
    return keep


def evaluate(loans: DataFrame, names: Sequence[str], by: Sequence[str] = (),
             where: Column | None = None,
             extra: dict[str, Callable[[], Column]] | None = None) -> DataFrame:
    """The named measures per ``by``, all in one aggregation."""
    known = {**MEASURES, **(extra or {})}
    sliced = loans if where is None else loans.where(where)
    return sliced.groupBy(*by).agg(*(known[name]().alias(name) for name in names))


def beside_prior(cells: DataFrame, vintages: DataFrame, names: Sequence[str],
                 by: Sequence[str] = ()) -> DataFrame:
    """Adds ``prior_<name>``: the value of the same ``by`` one vintage earlier.

    Every cell speaks for its own vintage and, as a prior, for the next one; regrouping brings
    both together without joining the cells to themselves. A group absent in one quarter has no
    prior in the next (a lag would take an older one), and a group that vanishes keeps a row with
    only a prior.
    """
    here = ", ".join(f"{n} AS {n}, NULL AS prior_{n}" for n in names)
    next_one = ", ".join(f"NULL AS {n}, {n} AS prior_{n}" for n in names)
    both = F.expr(
        f"inline(array(struct(vintage_key AS vintage_key, {here}, false AS has_prior), "
        f"struct(vintage_key + 1 AS vintage_key, {next_one}, true AS has_prior)))")
    columns = [*names, *(f"prior_{n}" for n in names), "has_prior"]
    regrouped = cells.select(*by, both).groupBy("vintage_key", *by).agg(
        *(F.max(column).alias(column) for column in columns))
    return regrouped.join(vintages.select("vintage_key", "vintage"), "vintage_key")


def pd_migration(loans: DataFrame, vintages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Weighted PD against the vintage before: difference and relative difference."""
    return migration_of(evaluate(loans, ["weighted_pd"], ["vintage_key", *by]), vintages, by)


def migration_of(cells: DataFrame, vintages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``cells``(vintage_key, *by, weighted_pd) against the vintage before."""
    out = beside_prior(cells, vintages, ["weighted_pd"], by)
    delta = blank_minus(F.col("weighted_pd"), F.col("prior_weighted_pd"))
    return out.withColumns({"pd_delta": delta,
                            "pd_delta_share": ratio(delta, F.col("prior_weighted_pd"))})


def grade_mix_shift(loans: DataFrame, vintages: DataFrame, grade: str = "grade",
                    where: Column | None = None) -> DataFrame:
    """A grade's share of its vintage's loans, and the shift in percentage points.

    ``where`` is a slice by grade or sub-grade: it picks the loans that are counted, while the
    share remains one of all loans of the vintage. Slice by anything else beforehand.
    """
    counted = F.lit(True) if where is None else where
    cells = loans.groupBy("vintage_key", grade).agg(
        F.count_if(counted).alias("n"), F.count(F.lit(1)).alias("n_all"))
    everyone = F.sum("n_all").over(Window.partitionBy("vintage_key"))
    shares = cells.withColumn("grade_mix", ratio(F.col("n"), everyone)).where("n > 0")
    out = beside_prior(shares, vintages, ["grade_mix"], [grade])
    return out.withColumn("mix_shift_pp", F.lit(100.0) * blank_minus(
        F.col("grade_mix"), F.col("prior_grade_mix")))


def el_change(loans: DataFrame, vintages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Expected loss against the vintage before."""
    cells = evaluate(loans, ["total_expected_loss"], ["vintage_key", *by])
    return loss_change_of(cells, vintages, by)


def loss_change_of(cells: DataFrame, vintages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``cells``(vintage_key, *by, total_expected_loss) against the vintage before."""
    out = beside_prior(cells, vintages, ["total_expected_loss"], by)
    return out.withColumn("el_delta", blank_minus(
        F.col("total_expected_loss"), F.col("prior_total_expected_loss")))


def latest_migration(loans: DataFrame, vintages: DataFrame) -> DataFrame:
    """Without a vintage in the grouping: PD of the whole slice against the vintage before the
    last of ``vintages``. A slice by grade does not move that vintage, even where it has no loans in
    the last one; a slice by time comes with the vintages that it leaves.

    One row of the dimension is looked up first; the loans are read once.
    """
    last = vintages.agg(F.max("vintage_key")).first()[0]
    prior = F.col("vintage_key") == F.lit(last) - 1
    risk, ead = F.col("pd") * F.col("ead"), F.col("ead")
    return loans.agg(
        ratio(exact_sum(risk), exact_sum(ead)).alias("weighted_pd"),
        ratio(exact_sum(F.when(prior, risk)), exact_sum(F.when(prior, ead)))
        .alias("prior_weighted_pd")).withColumn(
            "pd_delta", blank_minus(F.col("weighted_pd"), F.col("prior_weighted_pd")))
