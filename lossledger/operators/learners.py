"""Default-probability and loss-severity models: boosted trees and isotonic calibration."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossledger.functions.numeric import exact_avg, unit_clip
from lossledger.operators import boosting
from lossledger.operators.binning import Bins, fit_bins
from lossledger.operators.boosting import Scorer, Settings, Tree
from lossledger.operators.cleaning import with_expected_loss
from lossledger.operators.helpers import shares
from lossledger.operators.isotonic import Isotonic, fit_isotonic
from lossledger.session import cores, side_by_side, stage
from lossledger.sources.columns import PORTFOLIO

SEED = 42

# Default training parameters, under their usual names.
DEFAULT_PD_PARAMS = {"n_estimators": 500, "learning_rate": 0.05, "num_leaves": 63,
                     "subsample": 0.8, "colsample_bytree": 0.8}
DEFAULT_LGD_PARAMS = {"n_estimators": 400, "learning_rate": 0.05, "num_leaves": 31,
                      "subsample": 0.8, "colsample_bytree": 0.8}

# Fits by rounds whose jobs share the cluster: each waits for its driver between two jobs.
FITS_AT_ONCE = 5
# Fewer rows are not worth a process of their own.
ROWS_PER_HELPER = 25_000

_SCORERS: dict[str, Scorer] = {}
# Models whose tables a worker keeps: those of a round of trials score the same batches in turn.
SCORERS_KEPT = 10


def scorer_of(key: str, trees: list[Tree]) -> Scorer:
    """A worker builds the tables of a model once."""
    if key not in _SCORERS:
        while len(_SCORERS) >= SCORERS_KEPT:
            del _SCORERS[next(iter(_SCORERS))]
        _SCORERS[key] = Scorer(trees)
    return _SCORERS[key]


def unpacked(vectors: pa.Array, width: int) -> np.ndarray:
    """One row per feature from an Arrow column of byte vectors."""
    joined = b"".join(vectors.to_pylist())
    return np.ascontiguousarray(np.frombuffer(joined, np.uint8).reshape(-1, width).T)


@dataclass(frozen=True)
class TreeModel:
    """Boosted trees over binned loans. ``base`` is the margin before the first tree."""

    bins: Bins
    base: float
    binary: bool
    trees: list[Tree]
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def margin(self, vector: Column | None = None) -> Column:
        """The sum of leaf values: log-odds of default, or the loss itself. ``vector`` are loans
        that the model's bins have packed already."""
        base, trees, key, width = self.base, self.trees, self.key, len(self.bins.features)

        @F.arrow_udf("double")
        def scored(vectors: pa.Array) -> pa.Array:
            if not len(vectors):
                return pa.array([], pa.float64())
            return pa.array(base + scorer_of(key, trees)(unpacked(vectors, width)))

        return scored(self.bins.vector() if vector is None else vector)

    def save(self, spark: SparkSession, path: str) -> None:
        boosting.tree_frame(spark, self.trees).coalesce(1).write.mode("overwrite").parquet(
            f"{path}/trees")
        told = json.dumps({"edges": self.bins.edges, "categories": self.bins.categories,
                           "base": self.base, "binary": self.binary})
        spark.createDataFrame([(told,)], "model string").coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TreeModel:
        told = json.loads(spark.read.parquet(f"{path}/settings").first()["model"])
        trees = boosting.trees_of(spark.read.parquet(f"{path}/trees"))
        return TreeModel(Bins(told["edges"], told["categories"]), told["base"], told["binary"],
                         trees)


@dataclass(frozen=True)
class TrainingSet:
    """Binned rows (x, y), staged, and what a fit on them starts from."""

    bins: Bins
    base: float
    unit: float
    n: int
    binary: bool
    rows: DataFrame


def training_set(train: DataFrame, categories: dict[str, list[str]], label: str,
                 binary: bool) -> TrainingSet:
    """Scans the loans once for their bins and once to bin them. Loans without a label are left
    out. The base is the label's mean, for classes its log-odds."""
    value = F.col(label).cast("double")
    labelled = train.where(value.isNotNull())
    bins, told = fit_bins(labelled, categories, exact_avg(value).alias("_mean"),
                          F.min(value).alias("_low"), F.max(value).alias("_high"),
                          F.count(F.lit(1)).alias("_n"))
    mean = told["_mean"] if told["_mean"] is not None else 0.0
    if binary:
        mean = min(max(mean, 1e-9), 1 - 1e-9)
        base, unit = math.log(mean / (1 - mean)), 2.0 ** -30
    else:
        reach = max((told["_high"] or 0.0) - (told["_low"] or 0.0), 1e-9)
        base, unit = mean, 2.0 ** (math.ceil(math.log2(reach)) - 30)
    rows = stage(labelled.select(bins.vector().alias("x"), value.alias("y")), "binned")
    return TrainingSet(bins, base, unit, told["_n"], binary, rows)


def fit_models(sets: Sequence[TrainingSet], jobs: Sequence[tuple[int, dict]],
               rows_in_task: int = boosting.ROWS_IN_TASK) -> list[TreeModel]:
    """A model per job: (number of its training set, parameters over the library's own).

    Jobs on sets of up to ``rows_in_task`` rows run side by side, a task each, which share the cores
    by their work; larger sets are fitted over all tasks, ``FITS_AT_ONCE`` of them beside one another and beside the smaller ones.
    Both give the same trees.
    """
    settings = [Settings.of({"seed": SEED, **params}, sets[at].binary) for at, params in jobs]
    few = [i for i, (at, _) in enumerate(jobs) if 0 < sets[at].n <= rows_in_task]
    rows = {i: sets[jobs[i][0]].n for i in few}
    helping = shares({i: rows[i] * settings[i].n_estimators for i in few},
                     {i: rows[i] // ROWS_PER_HELPER for i in few},
                     *cores(sets[0].rows.sparkSession))
    small = {i: (settings[i], sets[jobs[i][0]].base, sets[jobs[i][0]].unit, helping[i])
             for i in few}

    def in_tasks() -> dict[int, list[Tree]]:
        parts = []
        for at, one in enumerate(sets):
            own = [F.lit(i) for i in small if jobs[i][0] == at]
            if own:
                parts.append(one.rows.select(F.explode(F.array(*own)).alias("model"), "x", "y"))
        return boosting.fit_in_tasks(reduce(DataFrame.unionByName, parts), small,
                                     sets[0].bins.categorical)

    def by_rounds(i: int) -> list[Tree]:
        one = sets[jobs[i][0]]
        return boosting.fit_by_rounds(one.rows, settings[i], one.base, one.unit,
                                      one.bins.categorical) if one.n else []

    large = [i for i in range(len(jobs)) if i not in small]

    def all_by_rounds() -> dict[int, list[Tree]]:
        found: dict[int, list[Tree]] = {}
        for k in range(0, len(large), FITS_AT_ONCE):
            some = large[k:k + FITS_AT_ONCE]
            found.update(zip(some, side_by_side(*(partial(by_rounds, i) for i in some))))
        return found

    trees: dict[int, list[Tree]] = {}
    both = [fit for fit, some in ((in_tasks, small), (all_by_rounds, large)) if some]
    for found in side_by_side(*both) if both else []:
        trees.update(found)
    return [TreeModel(sets[at].bins, sets[at].base, sets[at].binary, trees[i])
            for i, (at, _) in enumerate(jobs)]


def pd_params(params: dict | None) -> dict:
    return {**DEFAULT_PD_PARAMS, **(params or {})}


def lgd_params(params: dict | None) -> dict:
    return {**DEFAULT_LGD_PARAMS, **(params or {})}


def fit_default_trees(train: DataFrame, categories: dict[str, list[str]],
                      params: dict | None = None, label: str = "default_flag") -> TreeModel:
    return fit_models([training_set(train, categories, label, True)], [(0, pd_params(params))])[0]


def fit_severity_trees(train: DataFrame, categories: dict[str, list[str]],
                       params: dict | None = None, label: str = "actual_lgd") -> TreeModel:
    return fit_models([training_set(train, categories, label, False)], [(0, lgd_params(params))])[0]


def with_raw_pd(loans: DataFrame, trees: TreeModel, name: str = "raw_pd") -> DataFrame:
    """Adds the uncalibrated default probability."""
    return loans.withColumn(name, F.lit(1.0) / (F.lit(1.0) + F.exp(-trees.margin())))


def with_lgd(loans: DataFrame, trees: TreeModel, name: str = "lgd") -> DataFrame:
    """Adds the predicted loss given default, within [0, 1]."""
    return loans.withColumn(name, trees.margin()).withColumn(name, unit_clip(F.col(name)))


def fit_calibration(scored: DataFrame, score: str = "raw_pd",
                    label: str = "default_flag") -> Isotonic:
    """Monotone map from score to observed default rate."""
    return fit_isotonic(scored, score, label)


@dataclass(frozen=True)
class DefaultModel:
    """Trees and their calibration; the trees alone serve reason codes."""

    trees: TreeModel
    calibration: Isotonic

    def with_pd(self, loans: DataFrame) -> DataFrame:
        """Adds ``raw_pd`` and the calibrated ``pd``."""
        scored = with_raw_pd(loans, self.trees)
        return scored.withColumn("pd", self.calibration.apply(F.col("raw_pd")))

    def save(self, spark: SparkSession, path: str) -> None:
        self.trees.save(spark, f"{path}/trees")
        spark.createDataFrame(list(zip(self.calibration.x, self.calibration.y)),
                              "x double, y double").coalesce(1).write.mode("overwrite").parquet(
                                  f"{path}/calibration")

    @staticmethod
    def load(spark: SparkSession, path: str) -> DefaultModel:
        knots = sorted(map(tuple, spark.read.parquet(f"{path}/calibration").collect()))
        return DefaultModel(TreeModel.load(spark, f"{path}/trees"),
                            Isotonic(tuple(x for x, _ in knots), tuple(y for _, y in knots)))


def fit_default_model(labelled: DataFrame, categories: dict[str, list[str]],
                      params: dict | None = None) -> DefaultModel:
    """Trees on the train split, calibration on the slice after it; later loans stay unseen."""
    trees = fit_default_trees(labelled.where("split = 'train'"), categories, params)
    later = with_raw_pd(labelled.where("split = 'calibration'"), trees)
    return DefaultModel(trees, fit_calibration(later))


def fit_severity_model(labelled: DataFrame, categories: dict[str, list[str]],
                       params: dict | None = None) -> TreeModel:
    return fit_severity_trees(labelled.where("split = 'train'"), categories, params)


def score_portfolio(loans: DataFrame, default_model: DefaultModel,
                    severity_model: TreeModel) -> DataFrame:
    """pd, lgd and expected loss for every loan, active ones included. Narrow: no shuffle."""
    carried = loans.select(*PORTFOLIO)
    with_pd = default_model.with_pd(carried).drop("raw_pd")
    return with_expected_loss(with_lgd(with_pd, severity_model))
