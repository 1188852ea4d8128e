"""How well scores order and match outcomes: AUC, Gini, average precision, KS, Brier, errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossledger.functions.numeric import ratio
from lossledger.operators.ordered import ROWS_PER_BLOCK, running_totals


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score with its positives and negatives.

    The counts combine before the shuffle, so a score shared by a third of all loans is one row
    per task.
    """
    return (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"),
             F.count_if(F.col(label) == 0).alias("neg"))
    )


def discrimination(df: DataFrame, score: str, label: str, by: Sequence[str] = (),
                   rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Per ``by``: n, n_pos, roc_auc, gini, average_precision, ks, brier.

    All come from running counts over the distinct scores. AUC counts tied pairs half. Average
    precision is the step sum, not the trapezoid. KS is the largest two-sided distance of the two
    classes' distribution functions. A measure that needs the class that is absent is NULL.
    """
    placed = running_totals(score_counts(df, score, label, by), "score", ["pos", "neg"], by,
                            rows_per_block)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    pos_below, neg_below = F.col("pos_before"), F.col("neg_before")
    all_pos, all_neg = F.col("pos_total").cast("double"), F.col("neg_total").cast("double")
    hits = all_pos - pos_below
    flagged = hits + (all_neg - neg_below)
    gap = F.abs(ratio(pos_below + pos, all_pos) - ratio(neg_below + neg, all_neg))
    s = F.col("score")
    out = placed.groupBy(*by).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n"),
        F.sum("pos").alias("n_pos"),
        F.sum(ratio(pos * (neg_below + neg / 2.0), all_pos * all_neg)).alias("roc_auc"),
        F.sum(ratio(pos, all_pos) * ratio(hits, flagged)).alias("average_precision"),
        F.max(gap).alias("ks"),
        ratio(F.sum(pos * (1.0 - s) * (1.0 - s) + neg * s * s),
              F.sum(pos + neg)).alias("brier"),
    )
    return out.select(*by, "n", "n_pos", "roc_auc",
                      (2.0 * F.col("roc_auc") - 1.0).alias("gini"),
                      "average_precision", "ks", "brier")


def regression_error(df: DataFrame, predicted: str, actual: str,
                     by: Sequence[str] = ()) -> DataFrame:
    """Per ``by``: n, rmse and mae; one pass."""
    miss = F.col(predicted) - F.col(actual)
    return df.groupBy(*by).agg(
        F.count(miss).alias("n"),
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.avg(F.abs(miss)).alias("mae"),
    )
