"""Fitted models: invariants, and brute force on small cases."""

from itertools import combinations
from math import factorial
from threading import Barrier

import numpy as np
import pyarrow as pa
import pytest
from scales import SMALL
from pyspark.sql import functions as F

from lossledger import session
from lossledger.operators import attribution, backtest, boosting, isotonic, learners, search
from lossledger.operators.binning import fit_bins
from lossledger.operators.helpers import Helpers, shares
from lossledger.operators.vocabulary import encoded, frequent, vocabulary
from lossledger.plans import batch, governance, registry
from lossledger.sources.columns import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES

TINY = {"n_estimators": 3, "learning_rate": 0.3, "num_leaves": 8, "min_child_samples": 5}


@pytest.fixture(scope="module")
def labelled(spark):
    registry.tune(spark)
    return registry._labelled(spark, SMALL)


@pytest.fixture(scope="module")
def categories(labelled):
    return frequent(labelled)


@pytest.fixture(scope="module")
def model(labelled, categories):
    return learners.fit_default_model(labelled, categories, TINY)


def test_feature_lists():
    assert len(NUMERIC_FEATURES) == 35 and len(CATEGORICAL_FEATURES) == 8
    assert len(set(FEATURES)) == 43


def test_parameters_merge_over_the_defaults():
    s = boosting.Settings.of(learners.pd_params({"num_leaves": 98.0}), True)
    assert (s.n_estimators, s.num_leaves, s.learning_rate, s.seed) == (500, 98, 0.05, 42)


def test_unknown_and_missing_categories_share_a_code(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "grade string")
    words = vocabulary(df, ["grade"])
    assert [tuple(r) for r in words.orderBy("code").collect()] == [
        ("grade", "a", 0), ("grade", "b", 1)]
    seen = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "grade string")
    found = {r["grade"]: r["grade_code"] for r in encoded(seen, words, ["grade"]).collect()}
    assert found == {"a": 0, "b": 1, "z": 2, None: 2}
    assert frequent(df, ["grade"], 1) == {"grade": ["b"]}


def test_a_hundred_thousand_categories(spark):
    df = spark.range(200_000).selectExpr(
        "if(id % 3 = 0, 'often', string(id % 150000)) AS grade", "id AS n", "'x' AS purpose")
    out = encoded(df, vocabulary(df, ["grade", "purpose"]), ["grade", "purpose"])
    told = df.select("grade").distinct().toPandas()["grade"].tolist()
    assert len(told) > 100_000
    place = {w: i for i, w in enumerate(sorted(told))}
    got = out.select("n", "grade", "grade_code", "purpose_code").toPandas()
    assert len(got) == 200_000 and (got.purpose_code == 0).all()
    assert (got.grade.map(place) == got.grade_code).all()
    assert frequent(df, ["grade"])["grade"][0] == "often"


def plain_bin(value, edges):
    return boosting.MISSING if value is None else sum(value > e for e in edges)


def test_vectors_of_bytes(spark):
    rng = np.random.default_rng(1)
    rows = [(float(np.round(rng.normal(), 1)) if i % 9 else None, "abc"[i % 3] if i % 7 else None)
            for i in range(300)] + [(float("nan"), "z"), (float("inf"), "")]
    df = spark.createDataFrame(rows, "dti double, grade string").repartition(3)
    known = frequent(df, ["grade"], 2)
    bins, told = fit_bins(df, known, F.count(F.lit(1)).alias("n"), numeric=["dti"])
    assert told == {"n": 302} and bins.features == ["dti", "grade"]
    finite = [v for v, _ in rows if v is not None and np.isfinite(v)]
    assert set(bins.edges["dti"]) <= set(finite) and len(bins.edges["dti"]) < boosting.MISSING
    for r in df.withColumn("x", bins.vector()).collect():
        value = r["dti"] if r["dti"] is not None and np.isfinite(r["dti"]) else None
        place = known["grade"].index(r["grade"]) if r["grade"] in known["grade"] else 63
        assert list(r["x"]) == [plain_bin(value, bins.edges["dti"]), place]


def toy(n, seed=0, width=6):
    """Bytes with gaps, the last two columns categories, and labels that depend on them."""
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (n, width)).astype(np.uint8)
    x[rng.random((n, width)) < 0.1] = boosting.MISSING
    z = (x[:, 0] > 6) * 1.5 + (x[:, 1] == boosting.MISSING) * 1.0 + np.isin(x[:, 4], [1, 5, 7]) * 2.0
    y = (rng.random(n) < 1 / (1 + np.exp(1.5 - z))).astype(float)
    kinds = np.array([False] * (width - 2) + [True] * 2)
    return x, y, kinds


@pytest.mark.parametrize("alpha,lam,least", [(0.0, 0.0, 1), (0.5, 2.0, 10), (0.0, 1.0, 100)])
def test_best_split_against_all_splits(alpha, lam, least):
    x, y, kinds = toy(200)
    unit = 2.0 ** -30
    s = boosting.Settings(min_child_samples=least, reg_alpha=alpha, reg_lambda=lam)
    g, h = boosting.gradients(np.zeros(200), y, unit, True)
    found = boosting.best_split(boosting.histogram(x, g, h), np.arange(6), kinds, unit, s)
    g, h = g * unit, h * unit

    def score(rows, more=0.0):
        size = max(abs(g[rows].sum()) - alpha, 0.0)
        return size * size / (h[rows].sum() + lam + more)

    best = 0.0
    whole = np.ones(200, bool)
    for j in range(6):
        if kinds[j]:
            known = [c for c in np.unique(x[:, j]) if c != boosting.MISSING]
            mean = {c: g[x[:, j] == c].sum() / (h[x[:, j] == c].sum() + boosting.SMOOTH)
                    for c in known}
            order = sorted(known, key=mean.get)
            sides = [np.isin(x[:, j], order[:i]) for i in range(1, len(order) + 1)]
        else:
            sides = [(x[:, j] <= c) | (gap & (x[:, j] == boosting.MISSING))
                     for c in range(12) for gap in (False, True)]
        for left in sides:
            if min(left.sum(), (~left).sum()) >= least:
                more = boosting.SMOOTH if kinds[j] else 0.0
                best = max(best, score(left, more) + score(~left, more) - score(whole))
    if best <= 1e-12:
        assert found is None
        return
    assert found.gain == pytest.approx(best, rel=1e-9)
    mask = np.unpackbits(np.frombuffer(found.goes_left, np.uint8)).astype(bool)
    left = mask[x[:, found.feature]]
    assert found.left == pytest.approx((g[left].sum(), h[left].sum(), left.sum()))
    assert found.right == pytest.approx((g[~left].sum(), h[~left].sum(), (~left).sum()))


def plain_margin(x, base, trees):
    out = []
    for row in x:
        total = base
        for tree in trees:
            node = 0
            while tree.left[node] >= 0:
                side = tree.mask(node)[row[tree.feature[node]]]
                node = tree.left[node] if side else tree.right[node]
            total += tree.value[node]
        out.append(total)
    return np.array(out)


def test_trees_grow_best_leaf_first_and_lower_the_loss():
    x, y, kinds = toy(600, 3)
    s = boosting.Settings(n_estimators=12, num_leaves=9, min_child_samples=5, learning_rate=0.2)
    trees = boosting.fit_rows(x, y, kinds, 0.1, 2.0 ** -30, s)
    assert all(len(t.leaves()) <= 9 for t in trees) and len(trees[0].leaves()) == 9
    losses = []
    for n in (0, 4, 12):
        p = 1 / (1 + np.exp(-plain_margin(x, 0.1, trees[:n])))
        losses.append(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
    assert losses == sorted(losses, reverse=True)
    first = trees[0]
    assert first.rows[0] == 600
    for i in range(len(first.left)):
        if first.left[i] >= 0:
            assert first.rows[i] == first.rows[first.left[i]] + first.rows[first.right[i]]


@pytest.mark.parametrize("leaves", [1, 2, 31, 64, 65, 127])
def test_scorer_finds_the_leaf_of_every_row(leaves):
    x, y, kinds = toy(900, leaves)
    s = boosting.Settings(n_estimators=3, num_leaves=leaves, min_child_samples=1)
    trees = boosting.fit_rows(x, y, kinds, 0.0, 2.0 ** -30, s)
    got = boosting.Scorer(trees)(np.ascontiguousarray(x.T))
    assert got == pytest.approx(plain_margin(x, 0.0, trees), abs=1e-12)


def test_both_ways_to_fit_give_the_same_trees(spark):
    x, y, kinds = toy(700, 5)
    rows = spark.createDataFrame([(bytes(r), float(v)) for r, v in zip(x, y)],
                                 "x binary, y double").repartition(5)
    for binary in (True, False):
        s = boosting.Settings(n_estimators=3, num_leaves=7, min_child_samples=5, binary=binary,
                              colsample_bytree=0.7)
        here = boosting.fit_rows(x, y, kinds, 0.2, 2.0 ** -30, s)
        over = boosting.fit_by_rounds(rows, s, 0.2, 2.0 ** -30, kinds)
        side = boosting.fit_in_tasks(rows.selectExpr("explode(array(4, 9)) AS model", "x", "y"),
                                     {4: (s, 0.2, 2.0 ** -30), 9: (s, 0.2, 2.0 ** -30)}, kinds)
        assert over == here and side == {4: here, 9: here}


def test_counts_by_pairs_are_the_histogram():
    x, y, _ = toy(9_000, 4, 7)
    rows, unit = np.flatnonzero(y), 2.0 ** -30
    for binary in (True, False):
        g, h = boosting.gradients(np.zeros(len(y)), y, unit, binary)
        for features in (np.array([3]), np.array([0, 2, 5]), np.arange(6)):
            pairs = boosting.pairs_of(np.ascontiguousarray(x.T), features)
            assert len(pairs) == (len(features) + 1) // 2
            got = boosting.paired_histogram(pairs, len(features), rows, g, h, binary)
            assert (got == boosting.histogram(x[rows][:, features], g[rows], h[rows])).all()


def test_large_leaves_give_the_trees_of_small_ones(monkeypatch):
    x, y, kinds = toy(3_000, 6)
    for binary in (True, False):
        s = boosting.Settings(n_estimators=3, num_leaves=9, binary=binary, colsample_bytree=0.8)
        one = boosting.fit_rows(x, y, kinds, 0.1, 2.0 ** -30, s)
        monkeypatch.setattr(boosting, "ROWS_FOR_PAIRS", 20)
        assert boosting.fit_rows(x, y, kinds, 0.1, 2.0 ** -30, s) == one
        monkeypatch.undo()


def test_a_root_whose_rows_are_counted_and_leaves_far_apart_give_the_same_sums(monkeypatch):
    x, y, kinds = toy(4_000, 8)
    columns = np.ascontiguousarray(x.T)
    counts = np.stack([np.bincount(c, minlength=boosting.BINS) for c in columns])
    features = np.array([1, 3, 4])
    monkeypatch.setattr(boosting, "ROWS_FOR_PAIRS", 20)
    monkeypatch.setattr(boosting, "SPARSE", 2)
    fetched = []
    monkeypatch.setattr(boosting, "pairs_of", lambda c, f, of=boosting.pairs_of: fetched.append(
        c.shape[1]) or of(c, f))
    for binary in (True, False):
        s = boosting.Settings(binary=binary)
        g, h = boosting.gradients(np.zeros(len(y)), y, 2.0 ** -30, binary)
        here = boosting._RowsHere(x, columns, g, h, features, kinds, 2.0 ** -30, s, counts)
        here.rows[(0,)] = np.arange(0, 4_000, 40)
        del fetched[:]
        for path, rows in (((), np.arange(4_000)), ((0,), here.rows[(0,)])):
            own = boosting.histogram(x[rows][:, features], g[rows], h[rows])
            assert (here._histogram(path) == own).all()
        assert fetched == [100]


def test_rounds_take_only_the_turns_to_the_leaves_they_measure():
    x, y, kinds = toy(2_000, 4)
    columns, s = np.ascontiguousarray(x.T), boosting.Settings(num_leaves=6)
    g, h = boosting.gradients(np.zeros(len(y)), y, 2.0 ** -30, True)
    here = boosting._RowsHere(x, columns, g, h, np.arange(6), kinds, 2.0 ** -30, s)
    splits = {}
    tree, place = boosting.grow(lambda p, known: splits.update(known) or here(p, known), s, False)
    for path in place:
        splits.setdefault(path[:-1], boosting._split_of(tree, place[path]))
    leaves = [p for p in sorted(place) if p in here.rows]
    for some in (leaves, leaves[:1], leaves[-1:]):
        reached = boosting._reach(columns, some, splits)
        assert list(reached) == some
        assert all((reached[p] == here.rows[p]).all() for p in some)
    assert (boosting._reach(columns, [()], {})[()] == np.arange(2_000)).all()


def test_small_sets_are_fitted_beside_large_ones(spark, model, monkeypatch):
    both = Barrier(2, timeout=60)

    def in_tasks(rows, models, kinds):
        both.wait()
        return {m: [] for m in models}

    def by_rounds(*_):
        both.wait()
        return []

    monkeypatch.setattr(boosting, "fit_in_tasks", in_tasks)
    monkeypatch.setattr(boosting, "fit_by_rounds", by_rounds)
    rows = spark.createDataFrame([(b"", 0.0)], "x binary, y double")
    sets = [learners.TrainingSet(model.trees.bins, 0.0, 2.0 ** -30, n, True, rows) for n in (5, 50)]
    found = learners.fit_models(sets, [(0, TINY), (1, TINY)], rows_in_task=10)
    assert [m.trees for m in found] == [[], []]


def test_the_largest_fold_of_six_million_loans_is_fitted_in_a_task(spark, model, monkeypatch):
    monkeypatch.setattr(boosting, "fit_in_tasks", lambda rows, models, kinds: {
        m: [] for m in models})
    rows = spark.createDataFrame([(b"", 0.0)], "x binary, y double")
    one = learners.TrainingSet(model.trees.bins, 0.0, 2.0 ** -30, 5_037_800, True, rows)
    assert learners.fit_models([one], [(0, TINY)])[0].trees == []


def test_more_rows_than_a_task_may_hold_are_fitted_by_rounds(labelled, categories):
    one = learners.training_set(labelled, categories, "default_flag", True)
    small = {**TINY, "n_estimators": 2, "num_leaves": 4}
    near = learners.fit_models([one], [(0, small)])[0]
    far = learners.fit_models([one], [(0, small)], rows_in_task=10)[0]
    assert near.trees == far.trees and len(near.trees) == 2


def test_rounds_of_a_tree_follow_its_depth():
    x, y, kinds = toy(3_000, 5, 6)
    s = boosting.Settings(num_leaves=40, min_child_samples=5)
    g, h = boosting.gradients(np.zeros(len(y)), y, 2.0 ** -30, True)
    trees, rounds = [], []
    for ahead in (False, True):
        here = boosting._RowsHere(x, np.ascontiguousarray(x.T), g, h, np.arange(6), kinds,
                                  2.0 ** -30, s)
        asked = []
        tree, place = boosting.grow(lambda p, known: asked.append(p) or here(p, known), s, ahead)
        trees.append(tree)
        rounds.append(len(asked))
    assert trees[0] == trees[1] and len(place) == 40
    assert rounds[1] <= max(map(len, place)) + 1 < rounds[0]


def test_fit_by_rounds_keeps_its_state_in_bounded_pieces(spark, monkeypatch):
    monkeypatch.setattr(boosting, "ROWS_PER_STATE", 40)
    monkeypatch.setattr(boosting, "TREES_PER_STAGE", 2)
    monkeypatch.setattr(boosting, "TASKS_ADDED_AT_ONCE", 4)
    x, y, kinds = toy(700, 5)
    rows = spark.createDataFrame([(bytes(r), float(v)) for r, v in zip(x, y)],
                                 "x binary, y double").repartition(3)
    s = boosting.Settings(n_estimators=4, num_leaves=9, min_child_samples=5)
    assert boosting.fit_by_rounds(rows, s, 0.2, 2.0 ** -30, kinds) == boosting.fit_rows(
        x, y, kinds, 0.2, 2.0 ** -30, s)


def test_exchanges_of_large_inputs_are_bounded(spark, monkeypatch):
    other = spark.newSession()
    names = ["files.maxPartitionBytes", "adaptive.advisoryPartitionSizeInBytes",
             "adaptive.coalescePartitions.initialPartitionNum"]

    def told():
        return [other.conf.get(f"spark.sql.{name}", None) for name in names]

    other.conf.set("spark.sql.files.maxPartitionBytes", session.PARTITION)
    own = [session.PARTITION, None, None]
    session.bounded(other, SMALL)
    assert told() == own
    monkeypatch.setattr(session, "LARGE", 1_000)
    session.bounded(other, SMALL)
    assert told() == [session.PARTITION, session.PARTITION, session.PARTITIONS]
    session.bounded(other, "/root/testdata/none")
    assert told() == own


def test_no_rows_give_the_base_alone(labelled, categories):
    trees = learners.fit_default_trees(labelled.limit(0), categories, TINY)
    assert trees.trees == []
    assert len(learners.with_raw_pd(labelled.limit(2), trees).collect()) == 2


def pooled(y, w):
    """Isotonic fit by the max-min formula."""
    n = len(y)
    mean = [[np.average(y[a:b + 1], weights=w[a:b + 1]) if b >= a else np.nan
             for b in range(n)] for a in range(n)]
    return [max(min(mean[a][b] for b in range(i, n)) for a in range(i + 1)) for i in range(n)]


@pytest.mark.parametrize("digits,ranges", [(1, 8), (6, 1), (6, 40)])
def test_calibration_is_the_isotonic_fit(spark, digits, ranges):
    rng = np.random.default_rng(3)
    score = np.round(rng.random(300), digits)
    flag = (rng.random(300) < score).astype(int)
    odd = [(None, 1), (float("nan"), 1), (0.5, None)]
    df = spark.createDataFrame([(float(s), int(f)) for s, f in zip(score, flag)] + odd,
                               "raw_pd double, default_flag int")
    fitted = isotonic.fit_isotonic(df, "raw_pd", "default_flag", ranges)
    levels = np.unique(score)
    expected = pooled(np.array([flag[score == s].mean() for s in levels]),
                      np.array([(score == s).sum() for s in levels]))
    ask = spark.createDataFrame([(float(s),) for s in levels], "s double")
    got = [r["pd"] for r in ask.orderBy("s").select(fitted.apply(F.col("s")).alias("pd")).collect()]
    assert got == pytest.approx(expected, abs=1e-12)
    ends = spark.createDataFrame([(-5.0,), (5.0,), (None,)], "s double")
    low, high, none = [r[0] for r in ends.select(fitted.apply(F.col("s"))).collect()]
    assert (low, high) == pytest.approx((expected[0], expected[-1])) and none is None


def test_calibration_of_nothing(spark):
    df = spark.createDataFrame([], "raw_pd double, default_flag int")
    fitted = learners.fit_calibration(df)
    assert spark.range(1).select(fitted.apply(F.lit(0.5))).first()[0] is None


def test_calibration_keeps_the_order(model, labelled):
    rows = model.with_pd(labelled).select("raw_pd", "pd").orderBy("raw_pd").toPandas()
    assert rows["pd"].is_monotonic_increasing
    assert rows["pd"].between(0, 1).all()


def test_scoring_whole_portfolio(spark):
    scored = registry.QUERIES["score_portfolio"](spark, SMALL).toPandas()
    assert len(scored) == registry.scored_loans(spark, SMALL).count()
    assert scored["pd"].between(0, 1).all() and scored["lgd"].between(0, 1).all()
    assert np.allclose(scored.expected_loss, scored.pd * scored.lgd * scored.ead)


def test_saved_model_scores_alike(spark, tmp_path, model, labelled):
    model.save(spark, str(tmp_path / "m"))
    again = learners.DefaultModel.load(spark, str(tmp_path / "m"))
    assert again.trees.trees == model.trees.trees and again.calibration == model.calibration
    one = model.with_pd(labelled).select("id", "pd")
    two = again.with_pd(labelled).select("id", F.col("pd").alias("other"))
    assert one.join(two, "id").where("pd <> other").count() == 0


def expected_margin(row, known, trees):
    """Margin when only the columns in ``known`` are taken from ``row``."""
    def value(tree, node):
        if tree.left[node] < 0:
            return tree.value[node]
        left, right = tree.left[node], tree.right[node]
        if tree.feature[node] in known:
            return value(tree, left if tree.mask(node)[row[tree.feature[node]]] else right)
        return (tree.rows[left] * value(tree, left)
                + tree.rows[right] * value(tree, right)) / tree.rows[node]

    return sum(value(t, 0) for t in trees)


@pytest.mark.parametrize("wide", [10, 1])
def test_attribution_against_all_coalitions(monkeypatch, wide):
    monkeypatch.setattr(attribution, "WIDE", wide)
    x, y, kinds = toy(400, 8, 5)
    s = boosting.Settings(n_estimators=3, num_leaves=12, min_child_samples=3)
    trees = boosting.fit_rows(x, y, kinds, 0.0, 2.0 ** -30, s)
    got = attribution.contributions(np.ascontiguousarray(x[:15].T), trees, 5)
    for row, phi in zip(x[:15], got):
        for j in range(5):
            others = [k for k in range(5) if k != j]
            value = 0.0
            for size in range(5):
                weight = factorial(size) * factorial(4 - size) / factorial(5)
                for known in combinations(others, size):
                    value += weight * (expected_margin(row, {*known, j}, trees)
                                       - expected_margin(row, set(known), trees))
            assert phi[j] == pytest.approx(value, abs=1e-12)


def test_batches_are_gathered_for_the_tables_of_a_tree():
    batches = [pa.array([b"a"] * n, pa.binary()) for n in (3, 0, 4, 9, 1)]
    assert [len(x) for x in attribution.gathered(iter(batches), 6)] == [7, 9, 1]
    assert list(attribution.gathered(iter([]))) == []


def test_contributions_add_up_to_the_log_odds(model, labelled):
    loans = labelled.where("split = 'oot'")
    attributed = attribution.with_contributions(loans, model.trees).select(
        "id", "base", "contributions")
    margin = loans.select("id", model.trees.margin().alias("odds"))
    for row in attributed.join(margin, "id").collect():
        assert row["base"] + sum(row["contributions"]) == pytest.approx(row["odds"], abs=1e-9)


def test_reason_codes(model, labelled):
    loans = labelled.where("split = 'calibration'")
    rows = attribution.reason_codes(loans, model.trees, 3).toPandas()
    assert len(rows) == 3 * loans.count()
    assert set(rows["reason_rank"]) == {1, 2, 3} and set(rows["feature"]) <= set(FEATURES)
    ranked = rows.sort_values(["loan_id", "reason_rank"])
    size = ranked["shap_value"].abs().groupby(ranked["loan_id"])
    assert size.apply(lambda s: s.is_monotonic_decreasing).all()
    assert ((rows.shap_value > 0) == (rows.direction == "increases_risk")).all()


def test_backtest(labelled, categories):
    folds = backtest.backtest_default(labelled.drop("split"), categories, TINY, folds=2).collect()
    assert [f["fold"] for f in folds] == [1, 2]
    assert all(0.4 < f["roc_auc"] <= 1 and 0 < f["brier_score"] < 0.5 for f in folds)
    assert folds[1]["n_train"] == folds[0]["n_train"] + folds[0]["n_test"]


def test_summary_of_one_fold_has_no_deviation(spark):
    one = spark.createDataFrame([(0.7, 0.1)], "roc_auc double, brier_score double")
    two = spark.createDataFrame([(0.2,), (0.4,)], "rmse double")
    found = {r["metric"]: (r["n_folds"], r["mean"], r["std"])
             for r in backtest.backtest_summary(one, two).collect()}
    assert found == {"roc_auc": (1, 0.7, None), "brier_score": (1, 0.1, None),
                     "rmse": (2, 0.3, 0.1414)}


def test_search_space():
    trials = search.draw_trials(200)
    assert trials == search.draw_trials(200) and trials[:3] == search.draw_trials(3)
    for t in trials:
        assert all(search.SPACE[n].low <= v <= search.SPACE[n].high for n, v in t.items())
        assert set(t) == set(search.SPACE) and t["n_estimators"] % 50 == 0
    assert {t["n_estimators"] for t in trials} == set(range(200, 801, 50))


def bowl(trials):
    return [(t["reg_alpha"] - 3.0) ** 2 + 40 * (t["colsample_bytree"] - 0.7) ** 2
            + (np.log(t["learning_rate"]) + 3.0) ** 2 for t in trials]


def test_search_closes_in_and_repeats():
    found = search.search(bowl, 60, seed=7)
    assert found == search.search(bowl, 60, seed=7) and len(found) == 60
    assert [p for p, _ in found[:10]] == search.draw_trials(10, 7)
    losses = [v for _, v in found]
    at_random = [min(bowl(search.draw_trials(60, seed))) for seed in range(20)]
    assert min(losses) < np.median(at_random)
    assert np.median(losses[-20:]) < 0.5 * np.median(losses[:20])


def test_density_integrates_to_one():
    d = search.Density([0.2, 0.9, 0.9], 0.0, 1.0)
    grid = np.linspace(0, 1, 20_001)
    assert np.exp(d.log(grid)).mean() == pytest.approx(1.0, abs=1e-3)
    drawn = d.draw(np.random.default_rng(0), 500)
    assert ((drawn >= 0) & (drawn <= 1)).all()


def test_search_ranks_trials(labelled, categories):
    train = labelled.where("split = 'train'").drop("split")
    found = search.tune_default(train, categories, 3, n_estimators=2, num_leaves=8).collect()
    aucs = [r["roc_auc"] for r in found]
    assert len(aucs) == 3 and aucs == sorted(aucs, reverse=True)
    assert {r["n_estimators"] for r in found} == {2}
    drawn = {t["min_child_samples"] for t in search.draw_trials(3)}
    assert {r["min_child_samples"] for r in found} == drawn


def test_batch_end_to_end(spark, tmp_path):
    raw = str(tmp_path / "raw")
    registry.raw_extract(spark, SMALL).write.parquet(raw)
    table = batch.run(spark, raw, str(tmp_path / "out"), TINY, TINY, with_scenarios=True)
    assert table.count() == 5
    layout = batch.Layout(str(tmp_path / "out"))
    fact = batch.load_star(spark, layout).fact.count()
    assert batch.load_scenarios(spark, layout).count() == 3 * fact
    assert batch.load_scenarios(spark, batch.Layout(str(tmp_path / "none"))) is None
    cells = batch.load_measures(spark, layout)
    assert cells.agg({"s_n": "sum"}).first()[0] == fact
    batch.run_governance(spark, layout)
    record = spark.read.json(f"{layout.reports}/model_risk_summary").first()
    assert 0 < record["pd_model"]["roc_auc"] <= 1
    assert record["population_stability"]["report_csv"].endswith("psi_report")
    report = spark.read.option("header", True).csv(f"{layout.reports}/psi_report")
    assert set(report.columns) == {"metric", "vintage", "n", "psi", "flag"}
    drivers = batch.run_reasons(spark, layout, 50).collect()
    assert sum(r["n"] for r in drivers) == 50
    summary = batch.run_backtest(spark, layout, 2, TINY, TINY)
    written = spark.read.json(f"{layout.reports}/rolling_backtest_summary").first()
    assert written["pd_model"].asDict() == summary["pd_model"] and written["n_folds"] == 2
    folds = spark.read.option("header", True).csv(f"{layout.reports}/rolling_backtest_lgd")
    assert [r["fold"] for r in folds.collect()] == ["1", "2"]


def test_calibration_comparison(model, labelled):
    rows = {r["model"]: r for r in governance.calibration_compare(labelled, model).collect()}
    assert set(rows) == {"uncalibrated", "calibrated"}
    assert rows["calibrated"]["n"] == labelled.where("split = 'oot'").count()


def test_a_worker_keeps_the_tables_of_several_models(monkeypatch):
    monkeypatch.setattr(learners, "_SCORERS", {})
    x, y, kinds = toy(200, 2)
    trees = boosting.fit_rows(x, y, kinds, 0.0, 2.0 ** -30, boosting.Settings(n_estimators=1))
    keys = [str(i) for i in range(learners.SCORERS_KEPT)]
    first = [learners.scorer_of(k, trees) for k in keys]
    assert [learners.scorer_of(k, trees) for k in keys] == first
    learners.scorer_of("one more", trees)
    assert len(learners._SCORERS) == learners.SCORERS_KEPT and "0" not in learners._SCORERS


def test_work_side_by_side_gives_its_results_in_order_and_its_errors():
    meet = Barrier(2)
    assert session.side_by_side(lambda: meet.wait(20) >= 0, lambda: meet.wait(20) + 9 >= 9) == [
        True, True]
    with pytest.raises(ZeroDivisionError):
        session.side_by_side(lambda: 1, lambda: 1 / 0)


def test_few_rows_are_summed_and_counted_at_once():
    x, y, _ = toy(2_500, 4, 9)
    for binary in (True, False):
        for unit in (2.0 ** -30, 2.0 ** -45):
            for n in (2_500, 3, 0):
                g, h = boosting.gradients(np.zeros(n), y[:n], unit, binary)
                got = boosting.small_histogram(x[:n], g, h, binary)
                assert (got == boosting.histogram(x[:n], g, h)).all()


def test_helpers_give_the_trees_of_one_process(spark):
    x, y, kinds = toy(5_000, 7)
    rows = spark.createDataFrame([(bytes(r), float(v)) for r, v in zip(x, y)],
                                 "x binary, y double").repartition(3)
    for binary in (True, False):
        s = boosting.Settings(n_estimators=4, num_leaves=12, binary=binary, colsample_bytree=0.7)
        one = boosting.fit_rows(x, y, kinds, 0.1, 2.0 ** -30, s)
        both = boosting.fit_in_tasks(rows.selectExpr("explode(array(1, 2)) AS model", "x", "y"), {
            1: (s, 0.1, 2.0 ** -30, 3), 2: (s, 0.1, 2.0 ** -30, 1)}, kinds)
        assert both == {1: one, 2: one}


def test_helpers_end_with_their_task():
    helpers = Helpers(3, Tally, 4)
    for i in range(3):
        helpers.tell(i, "add", i + 1)
    assert helpers.add_up(2, "put").tolist() == [6.0, 12.0]
    helpers.close()
    assert [p.exitcode for p in helpers.processes] == [0, 0, 0]


class Tally:
    n = 0

    def add(self, n):
        self.n += n

    def put(self, out):
        out[:] = self.n, 2 * self.n


def test_cores_are_shared_by_work():
    assert shares({0: 1.0, 1: 2.0, 2: 5.0}, {0: 9, 1: 9, 2: 9}, 8, 8) == {0: 1, 1: 2, 2: 5}
    assert shares({0: 5.0}, {0: 9}, 12, 4) == {0: 4}
    assert shares({0: 5.0}, {0: 0}, 12, 4) == {0: 1}
    assert shares({i: 1.0 for i in range(10)}, {i: 9 for i in range(10)}, 8, 8)[3] == 1
    assert shares({}, {}, 8, 8) == {}


def test_a_large_fit_is_given_helpers(spark, model, monkeypatch):
    told = {}
    monkeypatch.setattr(boosting, "fit_in_tasks", lambda rows, models, kinds: told.update(models)
                        or {m: [] for m in models})
    rows = spark.createDataFrame([(b"", 0.0)], "x binary, y double")
    one = learners.TrainingSet(model.trees.bins, 0.0, 2.0 ** -30, 3_855_120, True, rows)
    learners.fit_models([one], [(0, TINY)])
    assert told[0][3] == session.cores(spark)[0] == 8


def test_groups_of_leaves_pay_what_their_leaves_pay(monkeypatch):
    x, y, kinds = toy(3_000, 11)
    s = boosting.Settings(n_estimators=3, num_leaves=40, min_child_samples=5)
    trees = boosting.fit_rows(x, y, kinds, 0.0, 2.0 ** -30, s)
    columns = np.ascontiguousarray(x.T)
    each = attribution.contributions(columns, trees, 6)
    monkeypatch.setattr(attribution, "FEW", 0)
    together = attribution.contributions(columns, trees, 6)
    assert np.abs(together - each).max() < 1e-12
    groups = [attribution.leaf_groups(tree) for tree in trees]
    payers = [sum(1 for value, path in attribution.leaf_paths(tree) if path and value)
              for tree in trees]
    assert [sum(len(leaves) for leaves, _ in some) + len(wide) for some, wide in groups] == payers
    assert 2 * sum(len(some) for some, _ in groups) < sum(payers)
    monkeypatch.setattr(attribution, "CELLS", 1)
    assert [len(some) + len(wide) for some, wide in map(attribution.leaf_groups, trees)] == payers
    alone = attribution.contributions(columns, trees, 6)
    assert np.abs(together - alone).max() < 1e-12
    monkeypatch.setattr(attribution, "WIDE", 0)
    assert np.abs(together - attribution.contributions(columns, trees, 6)).max() < 1e-12
