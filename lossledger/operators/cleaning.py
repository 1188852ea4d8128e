"""All-text loans to typed, labelled loans with derived risk features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.functions import coerce
from lossledger.functions.numeric import expected_loss, ratio
from lossledger.sources import columns as c


def typed_loans(raw: DataFrame) -> DataFrame:
    """The loan columns with their types; footer rows without an id or amount are dropped.

    One projection over the scan: Parquet reads only the listed columns, of however many the
    extract has.
    """
    kept = raw.where(F.col("id").isNotNull() & coerce.number("loan_amnt").isNotNull())
    return kept.select(
        *c.TEXT,
        *(coerce.number(name).alias(name) for name in c.NUMBERS),
        *(coerce.percent(name).alias(name) for name in c.PERCENTS),
        coerce.first_integer(c.TERM).alias("term_months"),
        coerce.employment_years(c.EMPLOYMENT).alias("emp_length_years"),
        coerce.month_stamp(c.ISSUED).alias("issue_date"),
        coerce.month_stamp(c.FIRST_CREDIT).alias("earliest_cr_line_date"),
    )


def outcome_flag(status: Column) -> Column:
    """1 defaulted, 0 repaid, NULL still active."""
    return F.when(status.isin(c.DEFAULT_STATUSES), 1).when(status.isin(c.PAID_STATUSES), 0)


def realized_lgd(status: Column, funded: Column, principal: Column, recovered: Column,
                 fee: Column) -> Column:
    """Share of a defaulted loan not recovered net of fees, within [0, 1].

    greatest() skips NULL, so a default with an unknown payment has a loss of 0, as in the
    tables this must agree with.
    """
    lost = F.lit(1.0) - ratio(principal + recovered - fee, funded)
    bounded = F.least(F.greatest(lost, F.lit(0.0)), F.lit(1.0))
    return F.when(status.isin(c.DEFAULT_STATUSES), bounded)


def derive(typed: DataFrame) -> DataFrame:
    """Vintage, affordability, utilization, outcome, exposure and realized loss."""
    col = F.col
    dated = typed.where(col("issue_date").isNotNull()).withColumns({
        "issue_year": F.year("issue_date").cast("bigint"),
        "issue_quarter": F.quarter("issue_date").cast("bigint"),
    })
    return dated.withColumns({
        "vintage": coerce.vintage_label("issue_year", "issue_quarter"),
        "credit_history_months": coerce.months_between(
            "earliest_cr_line_date", "issue_date"),
        "installment_to_income": ratio(col("installment") * 12.0, col("annual_inc")),
        "loan_to_income": ratio(col("funded_amnt"), col("annual_inc")),
        "revol_bal_to_income": ratio(col("revol_bal"), col("annual_inc")),
        "credit_utilization": col("revol_util") / F.lit(100.0),
        "bankcard_utilization": col("bc_util") / F.lit(100.0),
        "default_flag": outcome_flag(col("loan_status")),
        "ead": col("funded_amnt"),
        "actual_lgd": realized_lgd(
            col("loan_status"), col("funded_amnt"), col("total_rec_prncp"),
            col("recoveries"), col("collection_recovery_fee")),
    })


def clean_loans(raw: DataFrame) -> DataFrame:
    return derive(typed_loans(raw))


def resolved(loans: DataFrame) -> DataFrame:
    """Loans whose outcome is known: the default-model population."""
    return loans.where(F.col("default_flag").isNotNull())


def with_realized_lgd(loans: DataFrame) -> DataFrame:
    """Loans with a realized loss: the severity-model population."""
    return loans.where(F.col("actual_lgd").isNotNull())


def audit_counts() -> dict[str, Column]:
    """Row counts by outcome, as aggregates without a shuffle."""
    flag = F.col("default_flag")
    return {
        "n_rows": F.count(F.lit(1)),
        "n_default": F.count_if(flag == 1),
        "n_paid": F.count_if(flag == 0),
        "n_active": F.count_if(flag.isNull()),
        "n_with_lgd": F.count_if(F.col("actual_lgd").isNotNull()),
    }


def load_audit(loans: DataFrame) -> DataFrame:
    """Row counts by outcome in one pass."""
    return loans.agg(*(count.alias(name) for name, count in audit_counts().items()))


def with_expected_loss(loans: DataFrame) -> DataFrame:
    return loans.withColumn("expected_loss",
                            expected_loss(F.col("pd"), F.col("lgd"), F.col("ead")))
