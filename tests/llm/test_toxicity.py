import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lossledger.llm import toxicity


def test_features_are_the_distinct_ngrams():
    texts = ["Ab  c\nab C", "", None, " x ", "idiot", "é" * 3, "ÀÉ日本語 z", "🙂🙂 a🙂"]
    find = toxicity.Columns(1 << 20, (2, 3))
    got = [sorted(x) for x in find(pa.array(texts))]
    for text, own in zip(texts, got):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        flat = " " + "".join(w + " " for w in low.split())
        want = set()
        for n in (2, 3):
            want |= {flat[i:i + n] for i in range(len(flat) - n + 1)}
        assert len(own) == len(want)
    assert got[0] == sorted(set(got[0]))


def test_regression_finds_the_optimum():
    rng = np.random.default_rng(3)
    rows = np.repeat(np.arange(200), 5)
    columns = rng.integers(0, 30, 1000)
    values = rng.normal(size=30)
    label = rng.integers(0, 2, 200)
    weights, bias = toxicity.logistic(rows, columns, values, label, steps=300)
    dense = np.zeros((200, 30))
    np.add.at(dense, (rows, columns), values[columns])
    own = weights / values
    p = 1 / (1 + np.exp(-(dense @ own + bias)))
    assert np.abs(dense.T @ (p - label) + toxicity.RIDGE * own).max() < 0.02
    assert abs((p - label).sum()) < 0.02


def test_held_out_rows_teach_nothing(lspark):
    docs = lspark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = lspark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    flipped = labels.withColumn("toxic", toxicity.F.when(
        toxicity.held_out(toxicity.F.col("doc_id")), 1 - toxicity.F.col("toxic"))
        .otherwise(toxicity.F.col("toxic")))
    one, two = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert (one.kept == two.kept).all() and (one.weights == two.weights).all()
    held = [r[0] for r in docs.select(toxicity.held_out(toxicity.F.col("doc_id"))).collect()]
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    assert held == [zlib.crc32(str(i).encode()) % 3 == 1 for i in ids]


def test_held_out_accuracy(lspark):
    docs = lspark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = lspark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity.scored(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where(
        toxicity.held_out(toxicity.F.col("doc_id"))).select("score", "toxic").collect()
    score = np.array([r.score for r in rows])
    toxic = np.array([r.toxic for r in rows]) == 1
    assert ((score >= 0) & (score <= 1)).all()
    order = score.argsort().argsort()
    area = (order[toxic].mean() - (toxic.sum() - 1) / 2) / (~toxic).sum()
    assert area > 0.85
    assert (score[~toxic] >= toxicity.THRESHOLD).mean() < 0.01
    assert (score[toxic] >= toxicity.THRESHOLD).mean() > 0.5


def test_a_small_fit_keeps_the_rate_of_the_labels(lspark):
    """Both classes have more labels than half of the fit, so they are taken at different rates."""
    docs = lspark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = lspark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity.scored(docs, toxicity.train(docs, labels, fit=610)).join(labels, "doc_id").where(
        toxicity.held_out(toxicity.F.col("doc_id"))).select("score", "toxic").collect()
    score = np.array([r.score for r in rows])
    toxic = np.array([r.toxic for r in rows]) == 1
    assert (score[~toxic] >= toxicity.THRESHOLD).mean() < 0.01
    assert abs(score.mean() - toxic.mean()) < 0.05


def plain_scores(texts, labelled):
    """The classifier without Spark, sparse columns and limited memory: Newton steps on a matrix."""
    sets = [set(next(iter(toxicity.Columns()(pa.array([t])))).tolist()) for t in texts]
    y = np.array([label for _, label in labelled])
    own = [sets[i] for i, _ in labelled]
    counts = {}
    for found, label in zip(own, y):
        for c in found:
            counts.setdefault(c, [0, 0])[label] += 1
    columns = sorted(c for c, n in counts.items() if sum(n) >= toxicity.LEAST_TEXTS)
    n = np.array([counts[c] for c in columns], float)
    p, q = n[:, 1] + 1, n[:, 0] + 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    best = sorted(range(len(columns)), key=lambda i: -abs(ratio[i]) * math.sqrt(n[i].sum()))
    at = sorted(best[:toxicity.KEPT])
    row = lambda found: [ratio[i] * (columns[i] in found) for i in at] + [1.0]
    x = np.array([row(found) for found in own])
    ridge = np.diag([toxicity.RIDGE] * len(at) + [0.0])
    w = np.zeros(len(at) + 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (p - y) + ridge @ w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)),
                             grad)
    return [1 / (1 + math.exp(-(np.array(row(found)) @ w))) for found in sets]


def some_documents(n, seed=2):
    dice = np.random.default_rng(seed)
    words = ["day", "sun", "rain", "idiot", "stupid", "walk", "tree", "né", "日本"]
    rows = []
    for i in range(n):
        toxic = int(dice.random() < 0.3)
        odds = np.array([3, 3, 3, 1 + 4 * toxic, 1 + 4 * toxic, 3, 3, 1, 1], float)
        rows.append((i, " ".join(dice.choice(words, 12, p=odds / odds.sum())), toxic))
    return rows


def test_scores_are_those_of_a_plain_fit(lspark):
    rows = some_documents(150)
    docs = lspark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    labels = lspark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    used = [(i, r[2]) for i, r in enumerate(rows) if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    want = plain_scores([r[1] for r in rows], used)
    found = toxicity.scored(docs, toxicity.train(docs, labels)).collect()
    for r in found:
        assert r["score"] == pytest.approx(want[r["doc_id"]], abs=0.02)


def test_labels_without_documents_take_no_place(lspark):
    rows = some_documents(400)
    docs = lspark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    own = lspark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    others = lspark.range(1000, 20_600).selectExpr("id AS doc_id", "int(id % 2) AS toxic")
    one = toxicity.train(docs, own, fit=200)
    two = toxicity.train(docs, own.union(others), fit=200)
    assert len(one.kept) > 20 and (one.kept == two.kept).all()
    assert (one.weights == two.weights).all() and one.bias == two.bias


def test_a_document_that_repeats_is_learned_once(lspark):
    rows = some_documents(60)
    docs = lspark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = lspark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    hot = next(r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1)
    more = docs.union(lspark.range(3000).selectExpr(f"{hot[0]}L", f"'{hot[1]}'"))
    one, two = toxicity.train(docs, labels), toxicity.train(more, labels)
    assert (one.kept == two.kept).all() and (one.weights == two.weights).all()


def test_shift_of_the_intercept():
    assert toxicity.shift({0: 800, 1: 100}, 1000) == 0
    assert toxicity.shift({0: 800, 1: 100}, 400) == pytest.approx(math.log(1 / 2))
    assert toxicity.shift({0: 800, 1: 100}, 50) == pytest.approx(math.log(1 / 8))
    assert toxicity.shift({0: 800}, 50) == toxicity.shift({}, 50) == 0


def test_edges(lspark):
    docs = lspark.createDataFrame(
        [(1, "you idiot", 5.0), (2, "a fine day", 5.0), (3, None, 5.0), (4, "", 5.0),
         (None, "idiot", 5.0), (2, "idiot", 5.0), (7, "you idiot " * 200_000, 5.0)],
        "doc_id long, text string, score double")
    labels = lspark.createDataFrame([(1, 1), (1, None), (2, 0), (9, 1), (None, 1), (4, 7)],
                                    "doc_id long, toxic int")
    for own in (labels, labels.limit(0), labels.where("toxic = 0")):
        model = toxicity.train(docs, own)
        got = toxicity.scored(docs, model).collect()
        assert len(got) == 7 and all(0 <= r.score <= 1 and not math.isnan(r.score) for r in got)
    assert toxicity.scored(docs.limit(0), model).collect() == []
    assert pytest.approx(0.5) == 1 / (1 + math.exp(-toxicity.train(docs, labels.limit(0)).bias))
