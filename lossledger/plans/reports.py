"""The report queries: the data behind each page of a portfolio dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossledger.functions.numeric import ratio
from lossledger.operators.sampling import PLOT_SAMPLE, hash_sample
from lossledger.operators.scenarios import scenario_totals
from lossledger.plans.measures import evaluate

HEADLINE = ["total_ead", "weighted_pd", "total_expected_loss"]


def kpis(loans: DataFrame, where: Column | None = None) -> DataFrame:
    """The headline row; the loss rate is 0 where there is no exposure."""
    row = evaluate(loans, [*HEADLINE, "el_rate"], where=where)
    return row.withColumn("el_rate", F.coalesce("el_rate", F.lit(0.0)))


def grade_table(loans: DataFrame, where: Column | None = None) -> DataFrame:
    return evaluate(loans, [*HEADLINE, "el_rate"], ["grade"], where).orderBy("grade")


def loss_by_grade(loans: DataFrame, where: Column | None = None) -> DataFrame:
    return evaluate(loans, ["total_expected_loss"], ["grade"], where).orderBy("grade")


def rate_against_pd_sample(loans: DataFrame, n: int = PLOT_SAMPLE) -> DataFrame:
    """One point per sampled loan."""
    return hash_sample(loans, n, "loan_id").select("loan_id", "int_rate", "pd", "grade")


def rate_against_pd(loans: DataFrame) -> DataFrame:
    """One point per sub-grade."""
    return evaluate(loans, ["average_int_rate", "weighted_pd"], ["sub_grade"])


def default_rate_by_vintage(loans: DataFrame, where: Column | None = None) -> DataFrame:
    """Realized defaults among resolved loans; NULL where none is resolved."""
    sliced = loans if where is None else loans.where(where)
    defaults, resolved = F.count_if(F.col("default_flag") == 1), F.count("default_flag")
    return sliced.groupBy("vintage").agg(
        defaults.alias("n_default"), resolved.alias("n_resolved"),
        ratio(defaults, resolved).alias("cumulative_default_rate")).orderBy("vintage")


#: Columns that the status matrix finds by itself.
MOST_STATUSES = 200


def status_mix(loans: DataFrame, by: str) -> DataFrame:
    """Share in percent of each status within ``by``, long form."""
    counts = loans.groupBy(by, "loan_status").agg(F.count(F.lit(1)).alias("n"))
    everyone = F.sum("n").over(Window.partitionBy(by))
    return counts.withColumn("pct", ratio(F.col("n") * 100.0, everyone))


def status_matrix(loans: DataFrame, by: str, statuses: Sequence[str] | None = None) -> DataFrame:
    """The same as one row per ``by`` and one column per status, 0 where absent.

    Without a list, the columns are the statuses that occur, in text order, found by one
    aggregation; more than ``MOST_STATUSES`` are refused, for a table that wide wants a list. With one, all others share the column ``other``. Shares are of all loans of the
    row either way; loans without a status count as ``unknown``.
    """
    status = F.coalesce("loan_status", F.lit("unknown"))
    if statuses is None:
        found = loans.select(status).distinct().limit(MOST_STATUSES + 1).collect()
        if len(found) > MOST_STATUSES:
            raise ValueError(f"over {MOST_STATUSES} statuses: name those that get a column")
        names = sorted(r[0] for r in found)
    else:
        names = [*statuses, "other"]
        status = F.when(status.isin(list(statuses)), status).otherwise("other")
    counts = loans.select(by, status.alias("status")).groupBy(by)
    wide = counts.pivot("status", names).agg(F.count(F.lit(1)).cast("double"))
    filled = wide.na.fill(0.0, names)
    total = sum((F.col(f"`{s}`") for s in names), F.lit(0.0))
    return filled.select(by, *(ratio(F.col(f"`{s}`") * 100.0, total).alias(s) for s in names))


def exposure_trend(loans: DataFrame) -> DataFrame:
    """Exposure and loss per vintage, in time order."""
    return evaluate(loans, ["total_ead", "total_expected_loss"],
                    ["vintage_key", "vintage"]).orderBy("vintage_key")


def pd_by_vintage_and_grade(loans: DataFrame) -> DataFrame:
    return evaluate(loans, ["weighted_pd"], ["vintage", "grade"])


def modeled_against_realized(loans: DataFrame) -> DataFrame:
    """Predicted and observed risk per vintage. Predicted covers all loans, observed resolved."""
    return evaluate(loans, ["weighted_pd", "realized_default_rate", "pd_calibration_gap"],
                    ["vintage"])


def scenario_table(scenario_loans: DataFrame, where: Column | None = None) -> DataFrame:
    """Totals per scenario in order of severity, for a slice of the described scenario fact."""
    sliced = scenario_loans if where is None else scenario_loans.where(where)
    return scenario_totals(sliced).orderBy("sort_order")


def filter_options(loans: DataFrame) -> DataFrame:
    """(option, value) lists of the slicers, from one scan."""
    pairs = F.array(*(F.struct(F.lit(o).alias("option"), F.col(o).alias("value"))
                      for o in ["sub_grade", "vintage"]))
    return loans.select(F.inline(pairs)).distinct().orderBy("option", "value")


def top_drivers(reasons: DataFrame, n: int = 10) -> DataFrame:
    """The features most often ranked first."""
    return (reasons.where(F.col("reason_rank") == 1).groupBy("feature")
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "feature").limit(n))
