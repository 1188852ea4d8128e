"""A mart of additive measure states: the measure catalogue under any slice, by regrouping.

Every measure of the catalogue is made of sums and counts. They are kept once per vintage,
sub-grade, state, purpose and status, so the number of cells is bounded by the product of those
lists, whatever the number of loans, and a question reads cells instead of loans. Sums stay
decimals: regrouping them gives what the loans give, to the last digit.

Stressed measures cap each loan at one. They do not add up and are asked of the loans.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.functions.numeric import blank_minus, decimal_sum, expected_loss, ratio
from lossledger.operators.star import GRADE_COLUMNS, VINTAGE_COLUMNS
from lossledger.plans import measures

SLICERS = ["addr_state", "purpose", "loan_status"]


def states() -> dict[str, Column]:
    """The sums and counts of a cell, as aggregates over loans."""
    col = F.col
    defaulted = col("default_flag") == 1
    return {
        "n": F.count(F.lit(1)),
        "ead": decimal_sum(col("ead")),
        "funded": decimal_sum(col("funded_amnt")),
        "pd_ead": decimal_sum(col("pd") * col("ead")),
        "lgd_ead": decimal_sum(col("lgd") * col("ead")),
        "loss": decimal_sum(expected_loss(col("pd"), col("lgd"), col("ead"))),
        "pd": decimal_sum(col("pd")),
        "n_pd": F.count("pd"),
        "rate": decimal_sum(col("int_rate")),
        "n_rate": F.count("int_rate"),
        "n_default": F.count_if(defaulted),
        "n_resolved": F.count("default_flag"),
        "realized": decimal_sum(F.when(defaulted, col("actual_lgd") * col("ead"))),
    }


def measure_mart(scored: DataFrame, vintages: DataFrame) -> DataFrame:
    """One row per vintage, sub-grade, state, purpose and status of the scored loans.

    Loans without a vintage or grade drop out, as they do from the fact. Missing states, purposes
    and statuses are cells of their own. The cells are joined with the vintages, not the loans.
    """
    keys = [*VINTAGE_COLUMNS, *GRADE_COLUMNS]
    dated = scored.dropna(subset=keys)
    cells = dated.groupBy(*keys, *SLICERS).agg(*(v.alias(f"s_{k}") for k, v in states().items()))
    return cells.join(vintages, VINTAGE_COLUMNS)


def _total(state: str) -> Column:
    return F.sum(f"s_{state}").cast("double")


def _share(top: str, bottom: str) -> Column:
    return ratio(_total(top), _total(bottom))


#: The catalogue's measures as aggregates over cells.
MEASURES: dict[str, Callable[[], Column]] = {
    "total_ead": lambda: _total("ead"),
    "total_funded_amount": lambda: _total("funded"),
    "loan_count": lambda: F.nullif(F.sum("s_n"), F.lit(0)),
    "weighted_pd": lambda: _share("pd_ead", "ead"),
    "weighted_lgd": lambda: _share("lgd_ead", "ead"),
    "average_pd": lambda: _share("pd", "n_pd"),
    "total_expected_loss": lambda: _total("loss"),
    "el_rate": lambda: _share("loss", "ead"),
    "realized_default_rate": lambda: _share("n_default", "n_resolved"),
    "realized_loss_amount": lambda: _total("realized"),
    "pd_calibration_gap": lambda: blank_minus(_share("pd_ead", "ead"),
                                              _share("n_default", "n_resolved")),
    "average_int_rate": lambda: _share("rate", "n_rate"),
}


def evaluate(mart: DataFrame, names: Sequence[str], by: Sequence[str] = (),
             where: Column | None = None) -> DataFrame:
    """The named measures per ``by``, any of the mart's attributes, of the cells in ``where``.
    Without ``by`` an empty slice is one row of blanks."""
    sliced = mart if where is None else mart.where(where)
    return sliced.groupBy(*by).agg(*(MEASURES[name]().alias(name) for name in names))


def pd_migration(mart: DataFrame, vintages: DataFrame, by: Sequence[str] = (),
                 where: Column | None = None) -> DataFrame:
    """Weighted PD of a slice against the vintage before, as ``measures.pd_migration``."""
    cells = evaluate(mart, ["weighted_pd"], ["vintage_key", *by], where)
    return measures.migration_of(cells, vintages, by)


def el_change(mart: DataFrame, vintages: DataFrame, by: Sequence[str] = (),
              where: Column | None = None) -> DataFrame:
    """Expected loss of a slice against the vintage before, as ``measures.el_change``."""
    cells = evaluate(mart, ["total_expected_loss"], ["vintage_key", *by], where)
    return measures.loss_change_of(cells, vintages, by)
