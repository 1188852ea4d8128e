"""Figures of the derived loans at sf0.01 that were established beforehand in both engines."""

import pytest
from scales import MEDIUM
from pyspark.sql import functions as F

from lossledger.operators import stability
from lossledger.plans import registry


def test_load_audit(spark):
    row = registry.QUERIES["load_audit"](spark, MEDIUM).first().asDict()
    assert row == {"n_rows": 15000, "n_default": 2323, "n_paid": 7753, "n_active": 4924,
                   "n_with_lgd": 2323}


def test_expected_loss_by_grade(spark):
    rows = registry.QUERIES["expected_loss_by_grade"](spark, MEDIUM).collect()
    assert [r["total_expected_loss"] for r in rows] == [
        139305946.54, 181911827.75, 218723376.17, 265765691.59, 298135542.98]


def test_separation(spark):
    auc = registry.QUERIES["roc_auc_gini"](spark, MEDIUM).first()
    assert auc["roc_auc"] == 0.656241
    assert registry.QUERIES["average_precision"](spark, MEDIUM).first()[0] == 0.331414
    assert registry.QUERIES["ks_statistic"](spark, MEDIUM).first()[0] == 0.234649


def test_psi_against_loans_before_1999(spark):
    loans = registry.resolved_loans(spark, MEDIUM)
    found = stability.stability_index(loans, ["int_rate"], F.col("issue_year") < 1999)
    psi = {r["vintage"]: round(r["psi"], 6) for r in found.collect()}
    assert len(psi) == 11
    assert (psi["1999Q1"], psi["1999Q2"]) == (0.019487, 0.014532)


def test_splits_and_reliability(spark):
    sizes = {r["split"]: r["n"] for r in
             registry.QUERIES["time_split_summary"](spark, MEDIUM).collect()}
    assert sizes == {"train": 6448, "calibration": 1612, "oot": 2016}
    curve = sorted(registry.QUERIES["reliability_curve"](spark, MEDIUM).collect())
    assert len(curve) == 10
    assert tuple(curve[0])[1:] == pytest.approx((0.234177, 0.082178, 1010))
    assert tuple(curve[-1])[1:] == pytest.approx((0.569917, 0.374751, 1006))


def test_scenarios(spark):
    el = {r["scenario"]: r["total_expected_loss"] for r in
          registry.QUERIES["scenario_summary"](spark, MEDIUM).collect()}
    assert el["Baseline"] == 1103842385.03
    assert el["Adverse"] == pytest.approx(1586657406.9, abs=0.01)
