"""Named queries over a folder of the given tables.

The raw loans, the cleaned loans and the star schema are built once per application and input
state and read from the shared folder by every later query, as a portfolio's users would. Queries
about cleaning read the raw loans each time. Amounts are rounded in the last step only.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lossledger.functions.numeric import exact_sum
from lossledger.operators import (
    attribution, backtest, chronology, cleaning, contracts, learners, scenarios, search,
    stability, star)
from lossledger.operators.binning import Bins
from lossledger.operators.boosting import BINS, MISSING, Tree
from lossledger.operators.discrimination import discrimination, regression_error
from lossledger.operators.isotonic import fit_isotonic
from lossledger.operators.ordered import exact_quantiles
from lossledger.operators.sampling import EXPLAIN_SAMPLE, hash_sample
from lossledger.operators.vocabulary import encoded, frequent, vocabulary
from lossledger.plans import additive, governance, measures, reports
from lossledger.session import bounded, built, cores, once, side_by_side, stage, staging_path, tune
from lossledger.sources import columns as c
from lossledger.sources import files
from lossledger.sources.order_book import fixture_scores, raw_loans

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(bounded(tune(spark), folder), folder)

    QUERIES[build.__name__] = run
    return run


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name), n) for name, n in digits.items()})


def days(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd") for n in names})


def sample_slice() -> Column:
    return measures.in_slice(["A2", "B1", "C3", "E5"], "1996Q1", "1999Q4")


def raw_extract(spark: SparkSession, folder: str) -> DataFrame:
    """The raw text loans as a table of their own: the input of cleaning."""
    return once(spark, "raw", folder, lambda: stage(raw_loans(spark, folder), "raw"))


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned loans as a plan, from the raw table only if there is one already: cleaning reads
    each raw loan once, so it needs none."""
    raw = built(spark, "raw", folder)
    return cleaning.clean_loans(raw_loans(spark, folder) if raw is None else raw)


def scored_loans(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned loans from the shared folder, with the arithmetic scores added on the fly."""
    return fixture_scores(once(spark, "clean", folder,
                               lambda: stage(_cleaned(spark, folder), "clean")))


def loans_read_once(spark: SparkSession, folder: str) -> DataFrame:
    """The same loans for a query that reads them a single time: from the table if there is one
    already, else as a plan, of which only the columns that the query reads are computed."""
    clean = built(spark, "clean", folder)
    return fixture_scores(_cleaned(spark, folder) if clean is None else clean)


def portfolio(spark: SparkSession, folder: str) -> star.Star:
    """The star of all loans. Where the cleaned loans are no table yet, those of its columns that
    its tables share are staged, not all."""
    def build() -> star.Star:
        if built(spark, "clean", folder) is not None:
            return star.build_star(scored_loans(spark, folder), stage_fact=True)
        loans = stage(loans_read_once(spark, folder).select(*star.COLUMNS), "star_loans")
        return star.build_star(loans, stage_fact=True)

    return once(spark, "star", folder, build)


def measure_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The additive measure states of all loans, built once."""
    return once(spark, "measure_mart", folder, lambda: stage(additive.measure_mart(
        scored_loans(spark, folder), portfolio(spark, folder).vintages), "measures"))


def described(spark: SparkSession, folder: str) -> DataFrame:
    return portfolio(spark, folder).loans


def resolved_loans(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.resolved(scored_loans(spark, folder))


def split_loans(spark: SparkSession, folder: str) -> DataFrame:
    """Resolved loans with their split. The boundaries are located once; the label is a filter."""
    loans = resolved_loans(spark, folder)
    train, test = once(spark, "split", folder, lambda: chronology.boundaries(
        loans, chronology.three_way_ranks))
    return loans.withColumn("split", F.when(train.before(), "train")
                            .when(test.before(), "calibration").otherwise("oot"))


# -- ingestion and cleaning ------------------------------------------------------------------


@query
def csv_ingest(spark, folder):
    """Raw loans written as CSV text and read back: rows, and present values per column."""
    path = staging_path(spark, "csv")
    raw_extract(spark, folder).write.option("header", True).option("escape", '"').csv(path)
    back = files.read_text_csv(spark, path)
    return back.agg(F.count(F.lit(1)).alias("n_rows"), *(F.count(x).alias(x) for x in c.RAW))


@query
def csv_ingest_values(spark, folder):
    """Raw loans written as CSV text, converted to Parquet and cleaned: every value."""
    path = staging_path(spark, "csv")
    raw_extract(spark, folder).write.option("header", True).option("escape", '"').csv(path)
    files.csv_to_parquet(spark, path, f"{path}-parquet")
    cleaned = cleaning.clean_loans(spark.read.parquet(f"{path}-parquet"))
    return days(cleaned, "issue_date", "earliest_cr_line_date")


@query
def clean_loans(spark, folder):
    return days(_clean(spark, folder), "issue_date", "earliest_cr_line_date")


def _clean(spark, folder):
    return cleaning.clean_loans(raw_extract(spark, folder))


@query
def coerce_percent_and_terms(spark, folder):
    return _clean(spark, folder).select(
        "id", "term_months", "int_rate", "revol_util", "loan_amnt", "dti", "bc_util")


@query
def employment_years(spark, folder):
    return _clean(spark, folder).groupBy("emp_length_years").agg(F.count(F.lit(1)).alias("n"))


@query
def vintage_and_history(spark, folder):
    return days(_clean(spark, folder).select(
        "id", "issue_year", "issue_quarter", "vintage", "credit_history_months", "issue_date"),
        "issue_date")


@query
def affordability_ratios(spark, folder):
    return _clean(spark, folder).select("id", *c.RATIOS)


@query
def outcome_labels(spark, folder):
    return _clean(spark, folder).groupBy("loan_status", "default_flag").agg(
        F.count(F.lit(1)).alias("n"))


@query
def realized_lgd(spark, folder):
    return _clean(spark, folder).where(F.col("default_flag") == 1).select(
        "id", "ead", "actual_lgd")


@query
def load_audit(spark, folder):
    return cleaning.load_audit(loans_read_once(spark, folder))


@query
def clean_contracts(spark, folder):
    return contracts.clean_contracts(loans_read_once(spark, folder))


@query
def category_vocabulary(spark, folder):
    return vocabulary(scored_loans(spark, folder))


@query
def scored_portfolio(spark, folder):
    """Carried columns and features beside the scores: only these are read from the table."""
    return days(loans_read_once(spark, folder).select(*c.PORTFOLIO, "pd", "lgd", "expected_loss"),
                "issue_date")


@query
def resolved_population(spark, folder):
    """Loans that train each model: outcome known, realized loss known."""
    return loans_read_once(spark, folder).agg(
        F.count("default_flag").alias("n_resolved"), F.count("actual_lgd").alias("n_with_lgd"),
        *(F.date_format(how(F.when(F.col(flag).isNotNull(), F.col("issue_date"))), "yyyy-MM-dd")
          .alias(f"{name}_{flag}") for flag in ["default_flag", "actual_lgd"]
          for name, how in [("first", F.min), ("last", F.max)]))


# -- star schema -----------------------------------------------------------------------------


def _dimension(spark, folder, name: str, build) -> DataFrame:
    """A dimension of the star if it is built, else this one alone, from one pass of the loans."""
    mart = built(spark, "star", folder)
    return build(loans_read_once(spark, folder)) if mart is None else getattr(mart, name)


@query
def dim_vintage(spark, folder):
    return _dimension(spark, folder, "vintages", star.dim_vintage)


@query
def dim_credit_grade(spark, folder):
    return _dimension(spark, folder, "grades", star.dim_credit_grade)


@query
def dim_borrower(spark, folder):
    return _dimension(spark, folder, "borrowers", star.dim_borrower)


@query
def fact_loans(spark, folder):
    return portfolio(spark, folder).fact


def _dims(mart: star.Star) -> dict[str, DataFrame]:
    return {"borrower_key": mart.borrowers, "vintage_key": mart.vintages,
            "credit_grade_key": mart.grades}


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def mart_orphans(spark, folder):
    mart = portfolio(spark, folder)
    return _union([contracts.orphans(mart.fact, d, k) for k, d in _dims(mart).items()])


@query
def mart_key_uniqueness(spark, folder):
    mart = portfolio(spark, folder)
    return _union([contracts.repeated_keys(d, k) for k, d in _dims(mart).items()])


@query
def mart_row_parity(spark, folder):
    mart = portfolio(spark, folder)
    return contracts.row_parity(mart.fact, mart.borrowers)


# -- measures and reports --------------------------------------------------------------------

HEADLINE = {"total_ead": 2, "weighted_pd": 6, "total_expected_loss": 2, "el_rate": 6}
CORE = {**HEADLINE, "total_funded_amount": 2, "weighted_lgd": 6, "average_pd": 6,
        "realized_default_rate": 6, "realized_loss_amount": 2, "pd_calibration_gap": 6}


@query
def portfolio_kpis(spark, folder):
    return rounded(reports.kpis(described(spark, folder)), **HEADLINE)


@query
def slice_kpis(spark, folder):
    return rounded(reports.kpis(described(spark, folder), sample_slice()), **HEADLINE)


@query
def grade_summary(spark, folder):
    return rounded(reports.grade_table(described(spark, folder)), **HEADLINE)


@query
def expected_loss_by_grade(spark, folder):
    return rounded(reports.loss_by_grade(described(spark, folder)), total_expected_loss=2)


@query
def core_measures_by_grade_and_vintage(spark, folder):
    return rounded(measures.evaluate(
        described(spark, folder), [*CORE, "loan_count"], ["grade", "vintage"]), **CORE)


@query
def core_measures_total(spark, folder):
    return rounded(measures.evaluate(described(spark, folder), [*CORE, "loan_count"]), **CORE)


@query
def weighted_lgd_by_state(spark, folder):
    mart = portfolio(spark, folder)
    loans = mart.fact.join(mart.borrowers.select("borrower_key", "addr_state"), "borrower_key")
    return rounded(measures.evaluate(loans, ["weighted_lgd"], ["addr_state"]), weighted_lgd=6)


@query
def realized_loss_by_sub_grade(spark, folder):
    return rounded(measures.evaluate(described(spark, folder), ["realized_loss_amount"],
                                     ["sub_grade"]), realized_loss_amount=2)


@query
def default_rate_by_vintage(spark, folder):
    return rounded(reports.default_rate_by_vintage(described(spark, folder)),
                   cumulative_default_rate=6)


@query
def default_rate_of_slice(spark, folder):
    return rounded(reports.default_rate_by_vintage(described(spark, folder), sample_slice()),
                   cumulative_default_rate=6)


@query
def expected_loss_of_slice(spark, folder):
    return rounded(reports.loss_by_grade(described(spark, folder), sample_slice()),
                   total_expected_loss=2)


@query
def status_mix_by_grade(spark, folder):
    return rounded(reports.status_mix(described(spark, folder), "grade"), pct=6)


@query
def status_mix_by_sub_grade(spark, folder):
    return rounded(reports.status_mix(described(spark, folder), "sub_grade"), pct=6)


@query
def status_matrix_by_grade(spark, folder):
    matrix = reports.status_matrix(described(spark, folder), "grade")
    return rounded(matrix, **dict.fromkeys(matrix.columns[1:], 6))


@query
def status_matrix_of_resolved(spark, folder):
    """Listed statuses and the rest."""
    matrix = reports.status_matrix(described(spark, folder), "sub_grade",
                                   ["Charged Off", "Fully Paid"])
    return rounded(matrix, **dict.fromkeys(matrix.columns[1:], 6))


@query
def rate_vs_pd_by_subgrade(spark, folder):
    return rounded(reports.rate_against_pd(described(spark, folder)),
                   average_int_rate=6, weighted_pd=6)


@query
def rate_vs_pd_sample(spark, folder):
    return reports.rate_against_pd_sample(described(spark, folder))


@query
def hash_sample_of_resolved(spark, folder):
    return hash_sample(resolved_loans(spark, folder), EXPLAIN_SAMPLE).select(
        "id", "grade", "default_flag")


@query
def exposure_trend(spark, folder):
    return rounded(reports.exposure_trend(described(spark, folder)),
                   total_ead=2, total_expected_loss=2)


@query
def pd_by_vintage_and_grade(spark, folder):
    return rounded(reports.pd_by_vintage_and_grade(described(spark, folder)), weighted_pd=6)


@query
def modeled_vs_realized(spark, folder):
    return rounded(reports.modeled_against_realized(described(spark, folder)),
                   weighted_pd=6, realized_default_rate=6, pd_calibration_gap=6)


@query
def filter_options(spark, folder):
    return reports.filter_options(described(spark, folder))


MIGRATION = {"weighted_pd": 6, "prior_weighted_pd": 6, "pd_delta": 6, "pd_delta_share": 6}
MIX = {"grade_mix": 6, "prior_grade_mix": 6, "mix_shift_pp": 6}


@query
def pd_migration(spark, folder):
    mart = portfolio(spark, folder)
    return rounded(measures.pd_migration(mart.loans, mart.vintages), **MIGRATION)


@query
def pd_migration_by_grade(spark, folder):
    mart = portfolio(spark, folder)
    return rounded(measures.pd_migration(mart.loans, mart.vintages, ["grade"]), **MIGRATION)


@query
def pd_migration_by_sub_grade(spark, folder):
    mart = portfolio(spark, folder)
    return rounded(measures.pd_migration(mart.loans, mart.vintages, ["sub_grade"]), **MIGRATION)


@query
def pd_migration_latest(spark, folder):
    mart = portfolio(spark, folder)
    return rounded(measures.latest_migration(mart.loans, mart.vintages),
                   weighted_pd=6, prior_weighted_pd=6, pd_delta=6)


@query
def pd_migration_latest_of_slice(spark, folder):
    """Loans of some sub-grades with an even key in the last two vintages: the vintage before the
    last remains that of the dimension."""
    mart = portfolio(spark, folder)
    loans = mart.loans.where("sub_grade in ('A2', 'B1') and vintage < '2001Q3'")
    return rounded(measures.latest_migration(loans, mart.vintages),
                   weighted_pd=6, prior_weighted_pd=6, pd_delta=6)


@query
def grade_mix_shift_of_slice(spark, folder):
    """Shares of all loans, shown for a slice by sub-grade."""
    mart = portfolio(spark, folder)
    return rounded(measures.grade_mix_shift(
        mart.loans, mart.vintages, where=F.col("sub_grade").isin("A2", "B1", "B3")), **MIX)


@query
def grade_mix_shift_by_grade(spark, folder):
    mart = portfolio(spark, folder)
    return rounded(measures.grade_mix_shift(mart.loans, mart.vintages), **MIX)


@query
def grade_mix_shift_by_sub_grade(spark, folder):
    mart = portfolio(spark, folder)
    return rounded(measures.grade_mix_shift(mart.loans, mart.vintages, "sub_grade"), **MIX)


@query
def el_qoq(spark, folder):
    mart = portfolio(spark, folder)
    return rounded(measures.el_change(mart.loans, mart.vintages), total_expected_loss=2,
                   prior_total_expected_loss=2, el_delta=2)


# -- measures by regrouping ------------------------------------------------------------------


def mart_slice() -> Column:
    """A slice by attributes of borrower, loan and time together."""
    return (F.col("purpose").isin("credit_card", "other") & (F.col("loan_status") != "Current")
            & F.col("addr_state").between("C", "M") & measures.in_slice(last_vintage="1998Q2"))


@query
def measure_mart_cells(spark, folder):
    """Every cell with its counts and sums. Many cells hold one loan, so sums keep all digits that
    their terms have; the loss has more than a double, and is asked of larger groups below."""
    digits = {"ead": 2, "funded": 2, "pd_ead": 7, "lgd_ead": 6, "pd": 5, "rate": 2, "realized": 4}
    return measure_mart(spark, folder).select(
        "vintage_key", "vintage", *star.GRADE_COLUMNS, *additive.SLICERS,
        *(F.col(f"s_{k}").alias(k) for k in ["n", "n_pd", "n_rate", "n_default", "n_resolved"]),
        *(F.round(F.col(f"s_{k}").cast("double"), n).alias(k) for k, n in digits.items()))


@query
def measure_mart_by_grade_and_vintage(spark, folder):
    """The core measures without reading a loan."""
    return rounded(additive.evaluate(measure_mart(spark, folder), [*CORE, "loan_count"],
                                     ["grade", "vintage"]), **CORE)


@query
def measure_mart_total(spark, folder):
    return rounded(additive.evaluate(measure_mart(spark, folder), [*CORE, "loan_count"]), **CORE)


@query
def measure_mart_by_state_and_purpose(spark, folder):
    return rounded(additive.evaluate(measure_mart(spark, folder), [*CORE, "loan_count"],
                                     ["addr_state", "purpose"]), **CORE)


@query
def measure_mart_of_slice(spark, folder):
    return rounded(additive.evaluate(measure_mart(spark, folder), [*CORE, "loan_count"],
                                     ["sub_grade"], mart_slice()), **CORE)


@query
def measure_mart_migration_of_slice(spark, folder):
    """PD against the vintage before by purpose, of two sub-grades' resolved loans."""
    where = F.col("sub_grade").isin("A2", "B1") & (F.col("loan_status") != "Current")
    return rounded(additive.pd_migration(
        measure_mart(spark, folder), portfolio(spark, folder).vintages, ["purpose"], where),
        **MIGRATION)


@query
def measure_mart_loss_change_by_state(spark, folder):
    return rounded(additive.el_change(
        measure_mart(spark, folder), portfolio(spark, folder).vintages, ["addr_state"]),
        total_expected_loss=2, prior_total_expected_loss=2, el_delta=2)


# -- written tables ---------------------------------------------------------------------------


@query
def grade_summary_of_written_marts(spark, folder):
    """The star schema written, read back and asked by SQL over named views."""
    path = staging_path(spark, "marts")
    star.publish_star(portfolio(spark, folder), path)
    star.published_star(spark, path).register("written_")
    return spark.sql("""
        select g.grade, count(*) as n, count(b.borrower_key) as n_borrowers,
            round(cast(sum(cast(f.ead as decimal(38, 12))) as double), 2) as total_ead
        from written_fact_loans f
        join written_dim_credit_grade g on g.credit_grade_key = f.credit_grade_key
        left join written_dim_borrower b on b.borrower_key = f.borrower_key
        group by g.grade""")


@query
def grade_report_files(spark, folder):
    """The grade table as a CSV report and its total as a JSON record, both read back."""
    path = staging_path(spark, "reports")
    table = rounded(reports.grade_table(described(spark, folder)), **HEADLINE)
    files.write_report_csv(table, f"{path}/grades")
    files.write_record_json(table.agg(F.count(F.lit(1)).alias("n_grades")), f"{path}/record")
    n = files.load_params(spark, f"{path}/record")["n_grades"]
    return spark.read.option("header", True).schema(table.schema).csv(f"{path}/grades").withColumn(
        "n_grades", F.lit(n).cast("bigint"))


@query
def scenario_fact_with_undrawn(spark, folder):
    """Scenario totals where a tenth of each loan is undrawn."""
    mart = portfolio(spark, folder)
    revalued = scenarios.scenario_fact(mart.fact, F.col("loan_amnt") * 0.1)
    return rounded(scenarios.scenario_totals(revalued), **TOTALS)


# -- scenarios -------------------------------------------------------------------------------


def _scenarios(spark, folder):
    return scenarios.scenario_fact(portfolio(spark, folder).fact)


TOTALS = {"total_ead": 2, "weighted_pd": 6, "total_expected_loss": 2}
STEPS = {"total_expected_loss": 2, "vs_baseline": 2, "vs_previous": 2}


@query
def dim_scenario(spark, folder):
    """The scenario dimension, with the loans each scenario revalues."""
    counts = _scenarios(spark, folder).groupBy("scenario").agg(
        F.count("loan_id").alias("n_loans"))
    return scenarios.dim_scenario(spark).join(counts, "scenario")


@query
def scenario_fact(spark, folder):
    return _scenarios(spark, folder).drop("sort_order")


@query
def scenario_summary(spark, folder):
    return rounded(scenarios.scenario_totals(_scenarios(spark, folder)), **TOTALS)


@query
def scenario_table_of_slice(spark, folder):
    mart = portfolio(spark, folder)
    view = star.describe(_scenarios(spark, folder), mart.vintages, mart.grades)
    return rounded(reports.scenario_table(view, sample_slice()), **TOTALS)


@query
def scenario_by_grade(spark, folder):
    mart = portfolio(spark, folder)
    view = star.describe(_scenarios(spark, folder), mart.vintages, mart.grades)
    return rounded(scenarios.scenario_totals(view, ("grade",)), **TOTALS)


@query
def scenario_increment(spark, folder):
    totals = scenarios.scenario_totals(_scenarios(spark, folder))
    return rounded(scenarios.scenario_increment(totals), **STEPS)


@query
def scenario_increment_by_grade(spark, folder):
    mart = portfolio(spark, folder)
    view = star.describe(_scenarios(spark, folder), mart.vintages, mart.grades)
    totals = scenarios.scenario_totals(view, ("grade",))
    return rounded(scenarios.scenario_increment(totals, ("grade",)), **STEPS)


@query
def what_if_shock(spark, folder):
    sliced = described(spark, folder).where(sample_slice())
    return rounded(scenarios.what_if(sliced, 1.4, 1.25), total_ead=2, pd_before=6, pd_after=6,
                   pd_delta_pp=6, el_before=2, el_after=2, el_delta=2)


@query
def stress_measures_by_grade(spark, folder):
    extra = measures.stress_measures(1.4, 1.25)
    return rounded(measures.evaluate(described(spark, folder), list(extra), ["grade"],
                                     extra=extra),
                   stressed_expected_loss=2, stress_el_delta=2, stress_el_rate=6)


# -- chronological slices --------------------------------------------------------------------


@query
def time_split_members(spark, folder):
    return split_loans(spark, folder).select("id", "split")


@query
def time_split_summary(spark, folder):
    return days(chronology.split_summary(split_loans(spark, folder)), "start", "end")


@query
def tuning_split_summary(spark, folder):
    train = split_loans(spark, folder).where(F.col("split") == "train").drop("split")
    return days(chronology.split_summary(chronology.label_holdout(train)), "start", "end")


@query
def lgd_split_summary(spark, folder):
    loans = cleaning.with_realized_lgd(scored_loans(spark, folder))
    return days(chronology.split_summary(chronology.label_holdout(loans)), "start", "end")


FOLD_DAYS = ["train_start", "train_end", "test_start", "test_end"]


def _segments(spark, folder):
    return chronology.label_segments(resolved_loans(spark, folder))


def _lgd_segments(spark, folder):
    return chronology.label_segments(cleaning.with_realized_lgd(scored_loans(spark, folder)))


@query
def walk_forward_folds(spark, folder):
    return days(chronology.fold_summary(_segments(spark, folder)), *FOLD_DAYS)


@query
def walk_forward_folds_lgd(spark, folder):
    return days(chronology.fold_summary(_lgd_segments(spark, folder)), *FOLD_DAYS)


# -- validation statistics on the arithmetic scores ------------------------------------------

SEPARATION = {"roc_auc": 6, "gini": 6, "average_precision": 6, "ks": 6, "brier": 6}


def _separation(spark, folder, *names):
    found = discrimination(resolved_loans(spark, folder), "pd", "default_flag")
    return rounded(found, **SEPARATION).select(*names)


@query
def roc_auc_gini(spark, folder):
    return _separation(spark, folder, "n", "n_pos", "roc_auc", "gini")


@query
def average_precision(spark, folder):
    return _separation(spark, folder, "average_precision")


@query
def ks_statistic(spark, folder):
    return _separation(spark, folder, "ks")


@query
def brier_by_vintage(spark, folder):
    miss = F.col("pd") - F.col("default_flag")
    return resolved_loans(spark, folder).groupBy("vintage").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(miss * miss), 6).alias("brier"))


@query
def discrimination_by_grade(spark, folder):
    return rounded(discrimination(resolved_loans(spark, folder), "pd", "default_flag",
                                  ["grade"]), **SEPARATION)


@query
def discrimination_by_grade_in_blocks(spark, folder):
    """The same in many blocks of the order, as for more scores than one task should hold."""
    return rounded(discrimination(resolved_loans(spark, folder), "pd", "default_flag",
                                  ["grade"], rows_per_block=200), **SEPARATION)


@query
def score_quantiles_in_blocks(spark, folder):
    return rounded(exact_quantiles(resolved_loans(spark, folder), "pd", stability.even_shares(10),
                                   ["grade"], rows_per_block=200), quantile=9)


@query
def discrimination_by_split(spark, folder):
    return rounded(discrimination(split_loans(spark, folder), "pd", "default_flag",
                                  ["split"]), **SEPARATION)


def _fold_metrics(spark, folder):
    segments = _segments(spark, folder)
    tested = segments.where("segment > 0").withColumnRenamed("segment", "fold")
    found = discrimination(tested, "pd", "default_flag", ["fold"]).select(
        "fold", F.round(F.col("roc_auc"), 4).alias("roc_auc"),
        F.round(F.col("average_precision"), 4).alias("pr_auc"),
        F.round(F.col("brier"), 4).alias("brier_score"))
    return chronology.fold_summary(segments).join(found, "fold")


@query
def walk_forward_discrimination(spark, folder):
    return days(_fold_metrics(spark, folder), *FOLD_DAYS)


@query
def walk_forward_stability(spark, folder):
    return _fold_metrics(spark, folder).agg(
        F.count(F.lit(1)).alias("n_folds"),
        *(F.round(how(m), 4).alias(f"{m}_{name}") for m in ["roc_auc", "brier_score"]
          for name, how in [("mean", F.avg), ("std", F.stddev_samp)]))


@query
def lgd_error(spark, folder):
    # Only defaults have a realized loss; their status is known before any join.
    defaults = loans_read_once(spark, folder).where(F.col("loan_status").isin(c.DEFAULT_STATUSES))
    loans = cleaning.with_realized_lgd(defaults)
    return rounded(regression_error(loans, "lgd", "actual_lgd", ["grade"]), rmse=6, mae=6)


@query
def walk_forward_lgd_error(spark, folder):
    segments = _lgd_segments(spark, folder)
    tested = segments.where("segment > 0").withColumnRenamed("segment", "fold")
    found = regression_error(tested, "lgd", "actual_lgd", ["fold"]).drop("n")
    return rounded(days(chronology.fold_summary(segments).join(found, "fold"), *FOLD_DAYS),
                   rmse=4, mae=4)


@query
def score_quantiles(spark, folder):
    return rounded(exact_quantiles(resolved_loans(spark, folder), "pd",
                                   stability.even_shares(10), ["grade"]), quantile=9)


@query
def reliability_curve(spark, folder):
    return rounded(stability.reliability_curve(resolved_loans(spark, folder), "pd",
                                               "default_flag"),
                   predicted_pd=6, empirical_default_rate=6)


def _psi(spark, folder):
    loans = split_loans(spark, folder).withColumn("predicted_pd", F.col("pd"))
    found = stability.stability_index(loans, ["predicted_pd", *c.MONITORED],
                                      F.col("split") == "train")
    return rounded(found, psi=4)


@query
def psi_by_vintage(spark, folder):
    return _psi(spark, folder)


@query
def psi_flags(spark, folder):
    return stability.flagged(_psi(spark, folder))


@query
def psi_flag_count(spark, folder):
    return _psi(spark, folder).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("flag") != "stable").alias("n_flagged"))


# -- fitted models (no SQL counterpart) ------------------------------------------------------

def _categories(spark, folder):
    return once(spark, "categories", folder, lambda: frequent(scored_loans(spark, folder)))


def _unscored(spark, folder):
    return scored_loans(spark, folder).drop("pd", "lgd", "expected_loss")


def _labelled(spark, folder):
    return split_loans(spark, folder).drop("pd", "lgd", "expected_loss")


def _defaulted(spark, folder):
    loans = cleaning.with_realized_lgd(_unscored(spark, folder))
    (test,) = once(spark, "lgd_split", folder, lambda: chronology.boundaries(
        loans, lambda n: [chronology.holdout_rank(n)]))
    return loans.withColumn("split", F.when(test.before(), "train").otherwise("oot"))


def default_model(spark, folder) -> learners.DefaultModel:
    return once(spark, "pd_model", folder, lambda: learners.fit_default_model(
        _labelled(spark, folder), _categories(spark, folder)))


def severity_model(spark, folder):
    return once(spark, "lgd_model", folder, lambda: learners.fit_severity_model(
        _defaulted(spark, folder), _categories(spark, folder)))


def _models(spark, folder):
    """Both models, fitted side by side."""
    _categories(spark, folder)
    return side_by_side(lambda: default_model(spark, folder), lambda: severity_model(spark, folder))


@query
def score_portfolio(spark, folder):
    """Every loan with the fitted models' pd, lgd and expected loss."""
    return learners.score_portfolio(_unscored(spark, folder), *_models(spark, folder)).select("id", "grade", "vintage", "ead", "pd", "lgd", "expected_loss")


@query
def score_portfolio_reloaded(spark, folder):
    """The grade table from models saved to and loaded from the shared folder."""
    path = staging_path(spark, "models")
    default_model(spark, folder).save(spark, f"{path}/pd")
    severity_model(spark, folder).save(spark, f"{path}/lgd")
    scored = learners.score_portfolio(
        _unscored(spark, folder), learners.DefaultModel.load(spark, f"{path}/pd"),
        learners.TreeModel.load(spark, f"{path}/lgd"))
    return rounded(reports.grade_table(scored), **HEADLINE)


@query
def calibration_compare(spark, folder):
    return rounded(governance.calibration_compare(
        _labelled(spark, folder), default_model(spark, folder)),
        roc_auc=6, pr_auc=6, brier_score=6)


def _default_folds(spark, folder):
    return once(spark, "default_folds", folder, lambda: stage(backtest.backtest_default(
        cleaning.resolved(_unscored(spark, folder)), _categories(spark, folder)), "folds"))


def _severity_folds(spark, folder):
    return once(spark, "severity_folds", folder, lambda: stage(backtest.backtest_severity(
        cleaning.with_realized_lgd(_unscored(spark, folder)), _categories(spark, folder)),
        "folds"))


@query
def backtest_pd(spark, folder):
    return days(_default_folds(spark, folder), *FOLD_DAYS)


@query
def backtest_lgd(spark, folder):
    return days(_severity_folds(spark, folder), *FOLD_DAYS)


def _both_folds(spark, folder):
    """Both backtests, fitted side by side."""
    _categories(spark, folder)
    return side_by_side(lambda: _default_folds(spark, folder),
                        lambda: _severity_folds(spark, folder))


@query
def backtest_summary(spark, folder):
    return backtest.backtest_summary(*_both_folds(spark, folder))


@query
def tuning_trials_pd(spark, folder):
    """All trials of the default search, at the sizes that it draws."""
    train = _labelled(spark, folder).where("split = 'train'").drop("split")
    return once(spark, "trials_pd", folder, lambda: search.tune_default(
        train, _categories(spark, folder)))


@query
def tuning_trials_lgd(spark, folder):
    train = _defaulted(spark, folder).where("split = 'train'").drop("split")
    return once(spark, "trials_lgd", folder, lambda: search.tune_severity(
        train, _categories(spark, folder)))


def _reasons(spark, folder):
    return once(spark, "reasons", folder, lambda: stage(attribution.reason_codes(
        cleaning.resolved(_unscored(spark, folder)), default_model(spark, folder).trees),
        "reasons"))


@query
def reason_codes(spark, folder):
    """The top five drivers of every resolved loan."""
    return _reasons(spark, folder)


@query
def reason_codes_of_sample(spark, folder):
    """The same for a reproducible sample, as for a report."""
    sample = hash_sample(cleaning.resolved(_unscored(spark, folder)), EXPLAIN_SAMPLE)
    # Each task builds the tables of all trees: a few loans in each part of the table would cost more.
    few = sample.repartition(cores(spark)[0])
    return attribution.reason_codes(few, default_model(spark, folder).trees)


@query
def top_drivers(spark, folder):
    return reports.top_drivers(_reasons(spark, folder))


def _model_risk(spark, folder):
    def build():
        default, severity = _models(spark, folder)
        return governance.model_risk(_labelled(spark, folder), default,
                                     _defaulted(spark, folder), severity)

    return once(spark, "model_risk", folder, build)


@query
def governance_summary(spark, folder):
    record = _model_risk(spark, folder).summary.drop("generated_at")
    return record.select(*(f"{name}.*" for name in record.columns))


@query
def governance_psi_report(spark, folder):
    return _model_risk(spark, folder).psi


@query
def governance_reliability(spark, folder):
    return rounded(_model_risk(spark, folder).reliability,
                   predicted_pd=6, empirical_default_rate=6)


# -- fits and scores that SQL repeats --------------------------------------------------------


@query
def category_codes(spark, folder):
    """Every loan's category codes, joined from the vocabulary."""
    loans = scored_loans(spark, folder)
    return encoded(loans, vocabulary(loans)).select(
        "id", *(f"{x}_code" for x in c.CATEGORICAL_FEATURES))


@query
def isotonic_fit(spark, folder):
    """The isotonic map of interest rates, in quarters, to default rates, fitted in several
    ranges."""
    loans = resolved_loans(spark, folder).withColumn(
        "score", F.floor(F.col("int_rate") * 4).cast("double") / 4)
    fitted = fit_isotonic(loans, "score", "default_flag", ranges=40)
    return loans.groupBy("score").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "calibrated", F.round(fitted.apply(F.col("score")), 9))


def stated_trees() -> learners.TreeModel:
    """A small stated ensemble, as a fit would give one: numbers cut at edges, a category, missing
    values on either side, a column that comes twice on a path."""
    bins = Bins({"int_rate": [9.0, 12.0, 16.0], "dti": [50.0, 100.0]},
                {"grade": ["B", "A", "C"]})

    def goes(levels: list[int], gap: bool = False) -> bytes:
        mask = np.zeros(BINS, bool)
        mask[levels] = True
        mask[MISSING] = gap
        return np.packbits(mask).tobytes()

    leaf = b""
    first = Tree([0, 1, 2, -1, -1, 0, -1, -1, -1],
                 [goes([0, 1]), goes([0], True), goes([0, 1, 2]), leaf, leaf, goes([0, 1, 2]),
                  leaf, leaf, leaf],
                 [1, 3, 5, -1, -1, 7, -1, -1, -1], [2, 4, 6, -1, -1, 8, -1, -1, -1],
                 [0.0, 0.0, 0.0, -0.9, -0.4, 0.0, 0.7, 0.1, 0.3],
                 [100, 60, 40, 25, 35, 16, 24, 12, 4])
    second = Tree([2, -1, 1, -1, -1], [goes([0, 1]), leaf, goes([0, 1]), leaf, leaf],
                  [1, -1, 3, -1, -1], [2, -1, 4, -1, -1], [0.0, -0.3, 0.0, 0.2, 0.6],
                  [100, 45, 55, 30, 25])
    return learners.TreeModel(bins, -1.5, True, [first, second])


@query
def stated_trees_scores(spark, folder):
    """Every loan's probability by the stated ensemble."""
    scored = learners.with_raw_pd(scored_loans(spark, folder), stated_trees())
    return rounded(scored.select("id", "raw_pd"), raw_pd=9)


@query
def stated_trees_reasons(spark, folder):
    """What each column adds to the log-odds of the stated ensemble."""
    model = stated_trees()
    told = attribution.with_contributions(scored_loans(spark, folder), model)
    return told.select("id", F.round("base", 9).alias("base"), *(
        F.round(F.col("contributions")[i], 9).alias(f"of_{x}")
        for i, x in enumerate(model.bins.features)))


# -- what does not depend on the fitted trees ------------------------------------------------


def _unit(name: str) -> Column:
    return F.col(name).isNotNull() & F.col(name).between(0.0, 1.0)


@query
def score_portfolio_checks(spark, folder):
    """Per grade: loans, exposure, scores outside [0, 1], losses other than their product."""
    product = F.col("pd") * F.col("lgd") * F.col("ead")
    wrong = F.abs(F.col("expected_loss") - product) > F.lit(1e-9) * F.col("ead")
    return QUERIES["score_portfolio"](spark, folder).groupBy("grade").agg(
        F.count(F.lit(1)).alias("n"), F.round(exact_sum(F.col("ead")), 2).alias("total_ead"),
        F.count_if(~_unit("pd")).alias("n_bad_pd"), F.count_if(~_unit("lgd")).alias("n_bad_lgd"),
        F.count_if(F.coalesce(wrong, F.lit(True))).alias("n_bad_loss"))


@query
def score_portfolio_reloaded_checks(spark, folder):
    """The reloaded models give the grade table that the models in memory give."""
    scored = learners.score_portfolio(_unscored(spark, folder), default_model(spark, folder),
                                      severity_model(spark, folder))
    own = rounded(reports.grade_table(scored), **HEADLINE)
    again = QUERIES["score_portfolio_reloaded"](spark, folder)
    return again.join(own.withColumnRenamed("total_expected_loss", "own"), "grade").select(
        "grade", own["total_ead"], (F.abs(F.col("total_expected_loss") - F.col("own")) < 0.02)
        .alias("same_loss"))


@query
def calibration_is_monotone(spark, folder):
    """Calibrated scores rise with raw ones and stay between the smallest and largest rate."""
    scored = stage(default_model(spark, folder).with_pd(_labelled(spark, folder)).groupBy(
        "split", "raw_pd").agg(F.min("pd").alias("low"), F.max("pd").alias("high"),
                               F.count(F.lit(1)).alias("n")), "calibrated")
    order = Window.partitionBy("split").orderBy("raw_pd")
    falls = F.col("low") < F.lag("high").over(order)
    return scored.withColumn("falls", F.coalesce(falls, F.lit(False))).groupBy("split").agg(
        F.sum("n").alias("n"), F.count_if("falls").alias("n_falls"),
        F.count_if((F.col("low") != F.col("high")) | ~_unit("low")).alias("n_bad"))


@query
def calibration_fit_residual(spark, folder):
    """On the slice that fits it, an isotonic map keeps the mean of the labels."""
    fitted = default_model(spark, folder).with_pd(_labelled(spark, folder)).where(
        "split = 'calibration'")
    return fitted.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("default_flag") == 1).alias("n_default"),
        (F.abs(F.avg("pd") - F.avg("default_flag")) < 1e-9).alias("keeps_mean"))


@query
def calibration_compare_checks(spark, folder):
    unit = F.least("roc_auc", "pr_auc", F.lit(1.0) - F.col("brier_score")) > 0
    return QUERIES["calibration_compare"](spark, folder).select(
        "model", "n", (unit & (F.col("roc_auc") > 0.5)).alias("sound"))


@query
def backtest_pd_windows(spark, folder):
    return QUERIES["backtest_pd"](spark, folder).drop("roc_auc", "pr_auc", "brier_score")


@query
def backtest_lgd_windows(spark, folder):
    return QUERIES["backtest_lgd"](spark, folder).drop("rmse", "mae")


@query
def backtest_summary_checks(spark, folder):
    """Mean and deviation, computed again from the folds by their definition."""
    def again(folds, model, metric):
        value, n = F.col(metric), F.count(metric)
        mean = F.sum(value) / n
        spread = F.sqrt((F.sum(value * value) - n * mean * mean) / (n - 1))
        return folds.agg(F.lit(model).alias("model"), F.lit(metric).alias("metric"),
                         mean.alias("m"), spread.alias("s"))

    default, severity = _both_folds(spark, folder)
    own = _union([again(default, "pd_model", "roc_auc"),
                  again(default, "pd_model", "brier_score"),
                  again(severity, "lgd_model", "rmse")])
    same = (F.abs(F.col("mean") - F.col("m")) < 1e-4) & (F.abs(F.col("std") - F.col("s")) < 1e-4)
    return QUERIES["backtest_summary"](spark, folder).join(own, ["model", "metric"]).select(
        "model", "metric", "n_folds", same.alias("agrees"))


def _trial_checks(trials: DataFrame, metric: str, sign: int) -> DataFrame:
    found = trials.withColumn("place", F.monotonically_increasing_id())
    order = Window.orderBy("place")
    worse = sign * F.col(metric) > sign * F.lag(metric).over(order)
    return found.withColumn("worse", F.coalesce(worse, F.lit(False))).agg(
        F.count(F.lit(1)).alias("n_trials"), F.count_distinct("trial").alias("n_distinct"),
        F.count_if("worse").alias("n_out_of_order"))


@query
def tuning_trials_pd_checks(spark, folder):
    return _trial_checks(QUERIES["tuning_trials_pd"](spark, folder), "roc_auc", 1)


@query
def tuning_trials_lgd_checks(spark, folder):
    return _trial_checks(QUERIES["tuning_trials_lgd"](spark, folder), "rmse", -1)


def _reason_checks(reasons: DataFrame) -> DataFrame:
    """Loans, ranks and the order of reasons by the size of their contribution."""
    per_loan = reasons.groupBy("loan_id").agg(
        F.array_sort(F.collect_list(F.struct("reason_rank", F.abs("shap_value").alias("size"),
                                             "direction", "shap_value"))).alias("r"))
    sizes = F.transform("r", lambda x: x["size"])
    direction = F.exists("r", lambda x: (x["shap_value"] > 0) != x["direction"].startswith("inc"))
    return per_loan.agg(
        F.count(F.lit(1)).alias("n_loans"), F.sum(F.size("r")).alias("n_reasons"),
        F.count_if(F.transform("r", lambda x: x["reason_rank"]) != F.transform(
            F.sequence(F.lit(1), F.size("r")), lambda i: i)).alias("n_bad_ranks"),
        F.count_if(sizes != F.reverse(F.array_sort(sizes))).alias("n_out_of_order"),
        F.count_if(direction).alias("n_bad_directions"))


@query
def reason_codes_checks(spark, folder):
    return _reason_checks(QUERIES["reason_codes"](spark, folder))


@query
def reason_codes_of_sample_checks(spark, folder):
    return _reason_checks(QUERIES["reason_codes_of_sample"](spark, folder))


@query
def top_drivers_checks(spark, folder):
    """Every resolved loan has one first reason; the report keeps the most frequent."""
    first = QUERIES["reason_codes"](spark, folder).where("reason_rank = 1")
    top = QUERIES["top_drivers"](spark, folder)
    counts = first.groupBy("feature").agg(F.count(F.lit(1)).alias("own"))
    return counts.join(top, "feature", "left").agg(
        F.sum("own").alias("n_loans"), F.count_if(F.col("n") != F.col("own")).alias("n_wrong"),
        (F.coalesce(F.max(F.when(F.col("n").isNull(), F.col("own"))), F.lit(0))
         <= F.min("n")).alias("are_the_most_frequent"))


@query
def governance_period(spark, folder):
    record = _model_risk(spark, folder).summary
    return record.select(
        F.col("oot_test_period.start").alias("start"), F.col("oot_test_period.end").alias("end"),
        "population_stability.moderate_threshold", "population_stability.significant_threshold")


@query
def governance_psi_sizes(spark, folder):
    return _model_risk(spark, folder).psi.select("metric", "vintage", "n")


@query
def governance_psi_of_inputs(spark, folder):
    """The monitored inputs do not depend on the model."""
    return _model_risk(spark, folder).psi.where("metric <> 'predicted_pd'").select(
        "metric", "vintage", "n", "psi", "flag")


@query
def governance_reliability_sizes(spark, folder):
    return _model_risk(spark, folder).reliability.agg(
        F.sum("count").alias("n"),
        F.round(F.sum(F.col("empirical_default_rate") * F.col("count")), 3).alias("n_default"))
