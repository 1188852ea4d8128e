"""Order-dependent operators against brute force, with blocks small enough to matter."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lossledger.operators import chronology, discrimination, sampling, stability
from lossledger.operators.ordered import exact_quantiles, running_totals


@pytest.fixture(scope="module")
def scores(spark):
    """3,000 scores; a third of the rows share one score; one group's scores are missing."""
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({
        "g": rng.choice(["a", "b"], 3000),
        "s": np.round(rng.beta(2, 5, 3000), 3)})
    pdf.loc[::3, "s"] = 0.25
    pdf["y"] = (rng.random(3000) < pdf["s"]).astype(int)
    pdf["v"] = "2020Q" + pd.Series(rng.integers(1, 5, 3000)).astype(str)
    return spark.createDataFrame(pdf).persist(), pdf


@pytest.mark.parametrize("block", [7, 1_000_000])
def test_running_totals(spark, block):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], 500), "x": rng.normal(size=500),
                        "n": rng.integers(0, 9, 500)})
    found = running_totals(spark.createDataFrame(pdf), "x", ["n"], ["g"], block).toPandas()
    pdf = pdf.sort_values("x")
    groups = pdf.groupby("g", dropna=False)["n"]
    expected = pd.DataFrame({"x": pdf["x"], "before": groups.cumsum() - pdf["n"],
                             "total": groups.transform("sum")}).sort_values("x")
    found = found.sort_values("x")
    assert (found["n_before"].to_numpy() == expected["before"].to_numpy()).all()
    assert (found["n_total"].to_numpy() == expected["total"].to_numpy()).all()


@pytest.mark.parametrize("block", [11, 1_000_000])
def test_quantiles(scores, block):
    df, pdf = scores
    shares = stability.even_shares(10)
    found = exact_quantiles(df, "s", shares, ["g"], block).collect()
    for g, part in pdf.groupby("g"):
        got = [r["quantile"] for r in sorted(found, key=lambda r: r["share_index"])
               if r["g"] == g]
        assert got == pytest.approx(list(np.quantile(part["s"], shares)), abs=1e-15)


def brute_separation(pdf):
    pos, neg = pdf[pdf.y == 1].s.to_numpy(), pdf[pdf.y == 0].s.to_numpy()
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    levels = np.unique(pdf.s)[::-1]
    precision = [pdf[pdf.s >= t].y.mean() for t in levels]
    recall = [pdf[pdf.s >= t].y.sum() / len(pos) for t in levels]
    ap = sum((r - q) * p for r, q, p in zip(recall, [0, *recall], precision))
    ks = max(abs((pos <= t).mean() - (neg <= t).mean()) for t in levels)
    return wins / len(pos) / len(neg), ap, ks, ((pdf.s - pdf.y) ** 2).mean()


@pytest.mark.parametrize("block", [13, 1_000_000])
def test_discrimination(scores, block):
    df, pdf = scores
    found = discrimination.discrimination(df, "s", "y", ["g"], block).collect()
    for row in found:
        expected = brute_separation(pdf[pdf.g == row["g"]])
        got = (row["roc_auc"], row["average_precision"], row["ks"], row["brier"])
        assert got == pytest.approx(expected, abs=1e-12)
        assert row["gini"] == pytest.approx(2 * row["roc_auc"] - 1)


def test_separation_extremes(spark):
    perfect = spark.createDataFrame([(0.1, 0)] * 100 + [(0.9, 1)] * 100, "s double, y int")
    row = discrimination.discrimination(perfect, "s", "y").first()
    assert (row["ks"], row["roc_auc"], row["average_precision"]) == (1.0, 1.0, 1.0)
    single = discrimination.discrimination(perfect.where("y = 1"), "s", "y").first()
    assert single["roc_auc"] is None and single["brier"] == pytest.approx(0.01)


def brute_psi(expected, actual):
    expected, actual = expected[~np.isnan(expected)], actual[~np.isnan(actual)]
    if not len(expected) or not len(actual):
        return None
    edges = np.unique(np.quantile(expected, stability.even_shares(10)))
    if len(edges) < 3:
        return 0.0
    shares = []
    for values in (expected, actual):
        slot = np.searchsorted(edges[1:-1], values, side="right")
        shares.append(np.maximum(np.bincount(slot, minlength=len(edges) - 1) / len(values), 1e-6))
    return float(((shares[1] - shares[0]) * np.log(shares[1] / shares[0])).sum())


@pytest.mark.parametrize("block", [17, 1_000_000])
def test_psi(spark, block):
    rng = np.random.default_rng(42)
    pdf = pd.DataFrame({
        "vintage": ["base"] * 2000 + ["same"] * 1000 + ["moved"] * 1000 + ["none"] * 50,
        "wide": np.concatenate([rng.normal(size=2000), rng.normal(size=1000),
                                rng.normal(2, 1, 1000), np.full(50, np.nan)]),
        "steps": np.concatenate([rng.integers(0, 4, 4000).astype(float), np.full(50, np.nan)]),
        "flat": np.full(4050, 3.0),
    })
    pdf.loc[::10, "steps"] = np.nan
    metrics = ["wide", "steps", "flat"]
    found = stability.stability_index(spark.createDataFrame(pdf), metrics,
                                      F.col("vintage") == "base", rows_per_block=block).collect()
    assert len(found) == 9
    base = pdf[pdf.vintage == "base"]
    for row in found:
        here = pdf[pdf.vintage == row["vintage"]]
        assert row["n"] == len(here)
        expected = brute_psi(base[row["metric"]].to_numpy(), here[row["metric"]].to_numpy())
        assert row["psi"] == (None if expected is None else pytest.approx(expected, abs=1e-12))
    flags = {(r["metric"], r["vintage"]): r["flag"] for r in found}
    assert flags["wide", "moved"] == "significant shift"
    assert flags["wide", "same"] == "stable"
    assert flags["wide", "none"] == "insufficient data"
    assert flags["flat", "moved"] == "stable"


def test_psi_thresholds_are_strict(spark):
    df = spark.createDataFrame([(0.1,), (0.15,), (0.25,), (0.3,), (None,)], "p double")
    assert [r[0] for r in df.select(stability.classify(F.col("p"))).collect()] == [
        "stable", "moderate shift", "moderate shift", "significant shift", "insufficient data"]


def test_reliability_curve(scores):
    df, pdf = scores
    found = sorted(stability.reliability_curve(df, "s", "y", rows_per_block=50).collect())
    bins = pd.qcut(pdf["s"], 10, duplicates="drop")
    expected = pdf.groupby(bins, observed=True).agg(p=("s", "mean"), r=("y", "mean"),
                                                    n=("y", "size"))
    assert [tuple(r)[1:] for r in found] == [pytest.approx(tuple(e)) for e in
                                             expected.itertuples(index=False)]
    constant = df.withColumn("s", F.lit(0.5))
    assert stability.reliability_curve(constant, "s", "y").count() == 0


@pytest.fixture(scope="module")
def hot_month(spark):
    """Loans by month, two thirds of them in one."""
    start = datetime(2015, 1, 1)
    rows = [(str(i), start + timedelta(days=31 * (0 if i % 3 else i % 30))) for i in range(900)]
    return spark.createDataFrame(rows, "id string, issue_date timestamp").persist()


@pytest.mark.parametrize("rows_per_sort", [5, 1_000_000])
def test_boundaries_are_exact(hot_month, rows_per_sort):
    ranks = [0, 1, 17, 450, 599, 600, 899, 900]
    cuts = chronology.boundaries(hot_month, lambda n: ranks, rows_per_sort=rows_per_sort)
    assert [hot_month.where(cut.before()).count() for cut in cuts] == ranks
    assert [hot_month.where(cut.onwards()).count() for cut in cuts] == [900 - r for r in ranks]


def test_copies_of_one_id_stay_together(spark):
    rows = [("hot", datetime(2020, 1, 1))] * 30 + [(str(i), datetime(2020, 1, 1))
                                                   for i in range(60)]
    df = spark.createDataFrame(rows, "id string, issue_date timestamp")
    for cut in chronology.boundaries(df, lambda n: [10, 45, 80], rows_per_sort=4):
        copies = df.where(cut.before() & (F.col("id") == "hot")).count()
        assert copies in (0, 30)


@pytest.mark.parametrize("n, folds", [(600, 5), (1000, 1), (1000, 3), (1000, 10)])
def test_walk_forward(spark, n, folds):
    df = spark.range(n).selectExpr("string(id) id", "id as value",
                                   "timestamp'2015-01-01' + make_dt_interval(int(id)) issue_date")
    segmented = chronology.label_segments(df, folds).persist()
    summary = chronology.fold_summary(segmented).orderBy("fold").collect()
    assert [r["fold"] for r in summary] == list(range(1, folds + 1))
    edges = [int(n * i / (folds + 1)) for i in range(folds + 2)]
    assert [r["n_train"] for r in summary] == edges[1:-1]
    assert [r["n_test"] for r in summary] == [b - a for a, b in zip(edges[1:], edges[2:])]
    assert all(r["train_end"] < r["test_start"] for r in summary)
    cuts = chronology.fold_boundaries(df, folds)
    for row in summary:
        train, test = chronology.fold_windows(df, cuts, row["fold"])
        assert (train.count(), test.count()) == (row["n_train"], row["n_test"])
    order = [r[0] for r in segmented.orderBy("value").select("segment").collect()]
    assert order == sorted(order)


def test_split_shares(spark):
    df = spark.range(1000).selectExpr(
        "string(id) id", "timestamp'2015-01-01' + make_dt_interval(int(id)) issue_date")
    rows = chronology.label_splits(df).groupBy("split").count().collect()
    assert dict(rows) == {"train": 640, "calibration": 160, "oot": 200}


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000).selectExpr("string(id) id")
    one = {r[0] for r in sampling.hash_sample(df, 777).collect()}
    two = {r[0] for r in sampling.hash_sample(df.repartition(13), 777).collect()}
    other = {r[0] for r in sampling.hash_sample(df, 777, seed=1).collect()}
    assert len(one) == 777 and one == two and one != other
    assert sampling.hash_sample(df, 9999).count() == 5000


def test_sample_has_its_size_where_ids_repeat(spark):
    df = spark.createDataFrame([(x, i) for i, x in enumerate("aaabc")], "id string, n int")
    for n in range(1, 6):
        one = sorted(r["n"] for r in sampling.hash_sample(df, n).collect())
        assert len(one) == n
        assert one == sorted(r["n"] for r in sampling.hash_sample(df.repartition(3), n).collect())


def test_boundaries_do_not_depend_on_the_drivers_time_zone(spark, monkeypatch):
    import time

    df = spark.range(2000).selectExpr(
        "string(id) as id", "timestamp'2016-10-01 00:00:00' + make_dt_interval(int(id % 90)) "
        "as issue_date")
    found = []
    for zone in ["UTC", "America/New_York", "Asia/Tokyo"]:
        monkeypatch.setenv("TZ", zone)
        time.tzset()
        try:
            split = chronology.label_splits(df)
            days = chronology.split_summary(split).selectExpr(
                "split", "n", "date_format(start, 'yyyy-MM-dd')", "date_format(end, 'yyyy-MM-dd')")
            found.append(sorted(map(tuple, days.collect())))
        finally:
            monkeypatch.delenv("TZ")
            time.tzset()
    assert found[0] == found[1] == found[2]
    assert found[0][2][1] == 1280
