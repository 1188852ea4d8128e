"""The whole batch: raw text loans to scored portfolio, star schema, scenarios and reports.

Each stage hands over by a table in the output folder, which is also what a rerun of a later
stage or a report reads.
"""

from __future__ import annotations

from dataclasses import dataclass
from fnmatch import fnmatch

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lossledger.operators import (
    attribution, backtest, chronology, cleaning, contracts, learners, scenarios, search, star)
from lossledger.operators.sampling import EXPLAIN_SAMPLE, hash_sample
from lossledger.operators.vocabulary import frequent
from lossledger.plans import additive, governance, reports
from lossledger.session import leaves_nothing, stage, temporary_stages, tune
from lossledger.sources import columns, files


@dataclass(frozen=True)
class Layout:
    """Where the batch puts things below its output folder."""

    folder: str

    def __getattr__(self, name: str) -> str:
        return f"{self.folder}/{name}"


def run_ingest(spark: SparkSession, source: str, layout: Layout, pattern: str = "*.csv*",
               multiline: bool = False) -> DataFrame:
    """The raw loans: a Parquet table as it is; a CSV file, or the first one below a folder whose
    name matches ``pattern``, converted once."""
    files.require(spark, source, "raw loans")
    if fnmatch(source.rsplit("/", 1)[-1], pattern):
        path = source
    elif files.is_parquet(spark, source):
        return spark.read.parquet(source)
    else:
        path = files.pick_source(spark, source, pattern)
    files.csv_to_parquet(spark, path, layout.raw_loans, multiline)
    return spark.read.parquet(layout.raw_loans)


def run_cleaning(raw: DataFrame, layout: Layout,
                 partition_by: tuple[str, ...] = ("issue_year",), strict: bool = True) -> dict:
    """Writes the cleaned loans; returns their counts by outcome. They are partitioned by year of
    issue, which later date filters prune by.

    Audit and row contracts are observed by the tasks that write, without another scan. They sit in
    the last stage of the job, where Spark counts a partition once however often a lost executor
    makes it run. Only repeated ids need a shuffle: of the written id column alone. If a contract is
    broken, the report is written and, unless ``strict`` is off, the loans are refused: they do not
    replace those of the run before.
    """
    spark = raw.sparkSession
    audit, checks = cleaning.audit_counts(), contracts.row_checks()
    seen = Observation("cleaning")
    loans = cleaning.clean_loans(raw).observe(
        seen, *(c.alias(name) for name, c in {**audit, **checks}.items()))
    version = files.new_version(layout.clean_loans)
    files.write_table(loans, version, partition_by)
    found = seen.get
    bad = {name: found[name] for name in checks}
    bad["id_repeated"] = spark.read.parquet(version).agg(contracts.repeated_ids()).first()[0]
    report = spark.createDataFrame(list(bad.items()), "check string, n_bad bigint")
    files.write_report_csv(report, f"{layout.reports}/clean_contracts")
    broken = {name: n for name, n in bad.items() if n}
    if broken and strict:
        files.delete(spark, version)
        raise contracts.BrokenContract(f"cleaned loans break {broken}")
    files.publish(spark, layout.clean_loans, version)
    return {name: found[name] for name in audit}


def cleaned(spark: SparkSession, layout: Layout) -> DataFrame:
    """The cleaned loans; a year that is a folder's name is as long as the others again."""
    loans = spark.read.parquet(files.current(spark, layout.clean_loans, "cleaned loans"))
    return loans.withColumn("issue_year", F.col("issue_year").cast("bigint"))


def _params(spark: SparkSession, path: str, given: dict | None) -> dict | None:
    """Explicit parameters, else those an earlier search saved, else the defaults."""
    return given if given is not None else files.load_params(spark, path)


@leaves_nothing
def run_search(spark: SparkSession, layout: Layout, trials: int = search.DEFAULT_TRIALS,
               **fixed) -> None:
    """Searches parameters for both models and saves the best of each."""
    clean = cleaned(spark, layout)
    categories = frequent(clean)
    resolved = chronology.label_splits(cleaning.resolved(clean)).where("split = 'train'")
    defaulted = chronology.label_holdout(cleaning.with_realized_lgd(clean))
    found = search.tune_default(resolved.drop("split"), categories, trials, **fixed)
    files.save_params(spark, search.best_params(found), layout.pd_params)
    found = search.tune_severity(defaulted.where("split = 'train'").drop("split"), categories,
                                 trials, **fixed)
    files.save_params(spark, search.best_params(found), layout.lgd_params)


@leaves_nothing
def run_training(spark: SparkSession, layout: Layout, pd_params: dict | None = None,
                 lgd_params: dict | None = None) -> None:
    clean = cleaned(spark, layout)
    categories = frequent(clean)
    labelled = chronology.label_splits(cleaning.resolved(clean))
    learners.fit_default_model(
        labelled, categories, _params(spark, layout.pd_params, pd_params)
    ).save(spark, layout.pd_model)
    defaulted = chronology.label_holdout(cleaning.with_realized_lgd(clean))
    learners.fit_severity_model(
        defaulted, categories, _params(spark, layout.lgd_params, lgd_params)
    ).save(spark, layout.lgd_model)


def load_models(spark: SparkSession, layout: Layout):
    return (learners.DefaultModel.load(spark, layout.pd_model),
            learners.TreeModel.load(spark, layout.lgd_model))


@leaves_nothing
def run_scoring(spark: SparkSession, layout: Layout) -> None:
    clean = cleaned(spark, layout)
    files.write_table(learners.score_portfolio(clean.select(*columns.PORTFOLIO),
                                               *load_models(spark, layout)), layout.scored_loans)


@leaves_nothing
def run_marts(spark: SparkSession, layout: Layout) -> None:
    scored = spark.read.parquet(files.require(spark, layout.scored_loans, "scored loans"))
    star.publish_star(star.build_star(scored), layout.marts)


def load_star(spark: SparkSession, layout: Layout) -> star.Star:
    return star.published_star(spark, layout.marts)


@leaves_nothing
def run_scenarios(spark: SparkSession, layout: Layout) -> None:
    """Writes the scenario fact into the version of the star that it belongs to."""
    current = files.current(spark, layout.marts, "star schema")
    fact = spark.read.parquet(f"{current}/fact_loans")
    folder = f"{current}/fact_scenarios"
    version = files.new_version(folder)
    files.write_table(scenarios.scenario_fact(fact).drop("sort_order"), version)
    files.publish(spark, folder, version)


def load_scenarios(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """The scenario fact of the current star, or None where the optional stage has not run on it."""
    if not files.published(spark, layout.marts):
        return None
    folder = f"{files.current(spark, layout.marts, 'star schema')}/fact_scenarios"
    if not files.published(spark, folder):
        return None
    return spark.read.parquet(files.current(spark, folder, "scenario fact"))


@leaves_nothing
def run_measures(spark: SparkSession, layout: Layout) -> None:
    """Writes the mart of additive measure states into the version of the star it belongs to."""
    current = files.current(spark, layout.marts, "star schema")
    scored = spark.read.parquet(files.require(spark, layout.scored_loans, "scored loans"))
    vintages = spark.read.parquet(f"{current}/dim_vintage")
    folder = f"{current}/measures"
    version = files.new_version(folder)
    files.write_table(additive.measure_mart(scored, vintages), version)
    files.publish(spark, folder, version)


def load_measures(spark: SparkSession, layout: Layout) -> DataFrame:
    folder = f"{files.current(spark, layout.marts, 'star schema')}/measures"
    return spark.read.parquet(files.current(spark, folder, "measure mart"))


@leaves_nothing
def run_governance(spark: SparkSession, layout: Layout) -> None:
    clean = cleaned(spark, layout)
    default_model, severity_model = load_models(spark, layout)
    report = governance.model_risk(
        chronology.label_splits(cleaning.resolved(clean)), default_model,
        chronology.label_holdout(cleaning.with_realized_lgd(clean)), severity_model)
    governance.write_model_risk(report, layout.reports)


@leaves_nothing
def run_backtest(spark: SparkSession, layout: Layout, folds: int = chronology.DEFAULT_FOLDS,
                 pd_params: dict | None = None, lgd_params: dict | None = None) -> dict:
    """Walk-forward reports of both models; returns the summary record."""
    clean = cleaned(spark, layout)
    categories = frequent(clean)
    default_folds = stage(backtest.backtest_default(
        cleaning.resolved(clean), categories, _params(spark, layout.pd_params, pd_params), folds),
        "folds")
    severity_folds = stage(backtest.backtest_severity(
        cleaning.with_realized_lgd(clean), categories,
        _params(spark, layout.lgd_params, lgd_params), folds), "folds")
    files.write_report_csv(default_folds.orderBy("fold"), f"{layout.reports}/rolling_backtest_pd")
    files.write_report_csv(severity_folds.orderBy("fold"),
                           f"{layout.reports}/rolling_backtest_lgd")
    record = backtest.summary_record(
        backtest.backtest_summary(default_folds, severity_folds), folds)
    files.write_record_json(files.record_frame(spark, record),
                            f"{layout.reports}/rolling_backtest_summary")
    return record


@leaves_nothing
def run_reasons(spark: SparkSession, layout: Layout, n: int = EXPLAIN_SAMPLE) -> DataFrame:
    """Writes the reason codes of a sample of resolved loans; returns the top drivers."""
    clean = cleaned(spark, layout)
    default_model, _ = load_models(spark, layout)
    sample = hash_sample(cleaning.resolved(clean), n)
    files.write_table(attribution.reason_codes(sample, default_model.trees),
                      f"{layout.reports}/loan_reason_codes")
    return reports.top_drivers(spark.read.parquet(f"{layout.reports}/loan_reason_codes"))


def run(spark: SparkSession, raw_path: str, folder: str, pd_params: dict | None = None,
        lgd_params: dict | None = None, with_scenarios: bool = False) -> DataFrame:
    """All stages in order; returns the grade table of the scored portfolio. ``raw_path`` is a
    Parquet table or CSV text. Its intermediate tables are deleted at the end."""
    tune(spark)
    layout = Layout(folder)
    with temporary_stages(spark):
        run_cleaning(run_ingest(spark, raw_path, layout), layout)
        run_training(spark, layout, pd_params, lgd_params)
        run_scoring(spark, layout)
        run_marts(spark, layout)
        run_measures(spark, layout)
        if with_scenarios:
            run_scenarios(spark, layout)
    return reports.grade_table(load_star(spark, layout).loans)
