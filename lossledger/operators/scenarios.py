"""Macro scenarios: revaluing every loan under shocked risk parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lossledger.functions.numeric import cap_at_one, exact_sum, expected_loss, ratio


@dataclass(frozen=True)
class Scenario:
    name: str
    pd_multiplier: float
    lgd_multiplier: float
    ccf_undrawn: float
    sort_order: int


# The scenario set in order of severity.
SCENARIOS = [
    Scenario("Baseline", 1.00, 1.00, 0.00, 1),
    Scenario("Adverse", 1.25, 1.15, 0.00, 2),
    Scenario("Severely Adverse", 1.60, 1.25, 0.20, 3),
]


def _literals(scenarios: list[Scenario]) -> Column:
    return F.array(*(
        F.struct(F.lit(s.name).alias("scenario"), F.lit(s.pd_multiplier).alias("pd_multiplier"),
                 F.lit(s.lgd_multiplier).alias("lgd_multiplier"),
                 F.lit(s.ccf_undrawn).alias("ccf_undrawn"),
                 F.lit(s.sort_order).alias("sort_order")) for s in scenarios))


def dim_scenario(spark: SparkSession, scenarios: list[Scenario] | None = None) -> DataFrame:
    return spark.range(1).select(F.inline(_literals(scenarios or SCENARIOS)))


def scenario_fact(fact: DataFrame, undrawn: Column | None = None,
                  scenarios: list[Scenario] | None = None) -> DataFrame:
    """Every loan under every scenario, long.

    Each row expands in place from a literal array, so no join or shuffle is involved. ``undrawn``
    is the undrawn commitment; term loans have none.
    """
    undrawn = F.lit(0.0) if undrawn is None else undrawn
    keys = ["loan_id", "borrower_key", "vintage_key", "credit_grade_key"]
    wide = fact.select(*keys, "ead", "pd", "lgd", undrawn.alias("undrawn"),
                       F.inline(_literals(scenarios or SCENARIOS)))
    shocked = wide.select(
        *keys,
        (F.col("ead") + F.col("ccf_undrawn") * F.col("undrawn")).alias("ead"),
        cap_at_one(F.col("pd") * F.col("pd_multiplier")).alias("pd"),
        cap_at_one(F.col("lgd") * F.col("lgd_multiplier")).alias("lgd"),
        "scenario", "sort_order",
    )
    return shocked.withColumn(
        "expected_loss", expected_loss(F.col("pd"), F.col("lgd"), F.col("ead")))


def scenario_totals(scenarios: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Exposure, weighted PD and expected loss per scenario, in severity order."""
    ead = exact_sum(F.col("ead"))
    return scenarios.groupBy(*by, "scenario", "sort_order").agg(
        ead.alias("total_ead"),
        ratio(exact_sum(F.col("pd") * F.col("ead")), ead).alias("weighted_pd"),
        exact_sum(F.col("expected_loss")).alias("total_expected_loss"),
    )


def scenario_increment(totals: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Expected loss over Baseline, and over the next milder scenario (for a waterfall)."""
    el = F.col("total_expected_loss")
    group = Window.partitionBy(*(by or [F.lit(0)]))
    base = F.max(F.when(F.col("scenario") == "Baseline", el)).over(group)
    milder = F.lag(el).over(group.orderBy("sort_order"))
    return totals.select(*by, "scenario", "sort_order", "total_expected_loss",
                         (el - base).alias("vs_baseline"),
                         F.coalesce(el - milder, F.lit(0.0)).alias("vs_previous"))


def what_if(loans: DataFrame, pd_multiplier: float = 1.0, lgd_multiplier: float = 1.0,
            by: tuple[str, ...] = ()) -> DataFrame:
    """A slice before and after an ad-hoc shock, in one pass over the slice."""
    ead = F.col("ead")
    pd = cap_at_one(F.col("pd") * F.lit(pd_multiplier))
    lgd = cap_at_one(F.col("lgd") * F.lit(lgd_multiplier))
    before = exact_sum(expected_loss(F.col("pd"), F.col("lgd"), ead))
    after = exact_sum(expected_loss(pd, lgd, ead))
    pd_before = ratio(exact_sum(F.col("pd") * ead), exact_sum(ead))
    pd_after = ratio(exact_sum(pd * ead), exact_sum(ead))
    return loans.groupBy(*by).agg(
        exact_sum(ead).alias("total_ead"),
        pd_before.alias("pd_before"), pd_after.alias("pd_after"),
        ((pd_after - pd_before) * 100.0).alias("pd_delta_pp"),
        before.alias("el_before"), after.alias("el_after"),
        (after - before).alias("el_delta"),
    )
