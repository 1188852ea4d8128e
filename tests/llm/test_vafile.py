"""Exact top-k search against the scores of all rows."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossledger.llm import frames, vafile

SCHEMA = "vec_id long, embedding array<float>, label int"


def scaled(vector):
    if not vector or any(x is None or math.isnan(x) or math.isinf(x) for x in vector):
        return None
    whole = [math.floor(256 * float(np.float32(x))) for x in vector]
    return whole if sum(x * x for x in whole) < 2 ** 62 else None


def plain(rows, k=5, every=5):
    vectors = [(i, r[0], scaled(r[1])) for i, r in enumerate(rows)]
    vectors = [x for x in vectors if x[2]]
    out = []
    for i, key, q in vectors:
        if key is None or key % every:
            continue
        found = sorted((-sum(x * y for x, y in zip(q, v)), other is None, other or 0)
                       for j, other, v in vectors if j != i and len(v) == len(q))
        out += [(key, at + 1, None if no else other, -score)
                for at, (score, no, other) in enumerate(found[:k])]
    return sorted(out, key=str)


def found(spark, rows, k=5, every=5):
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "score").repartition(4)
    out = vafile.top_k(frame, F.col("vec_id") % every == 0, k=k)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, out.collect()), key=str)


def some(n, dim, seed=1, kinds=10_000):
    dice = random.Random(seed)
    pool = [[dice.gauss(0, 0.12) for _ in range(dim)] for _ in range(min(n, kinds))]
    return [(i, dice.choice(pool), 0) for i in range(n)]


ODD = [(5, None, 1), (10, [], 1), (15, [0.0, None], 1), (20, [float("nan"), 1.0], 1),
       (25, [float("inf"), 1.0], 1), (30, [0.0, 0.0], None), (35, [1.0, -2.0], 1), (40, [3.0], 1),
       (41, [-3.0], 1), (None, [0.5, 0.5], 1), (45, [1e30, 1.0], 1), (50, [7e6, -7e6], 1),
       (51, [7e6, -6.9e6], 1), (52, [-0.001, 0.001], 1)]


CASES = {"random": some(400, 16), "ties": some(300, 3, 2, 20), "all equal": some(40, 4, 3, 1),
         "empty": [], "few": some(3, 8), "odd": ODD + some(60, 2, 4)}


@pytest.mark.parametrize("case", CASES)
def test_results_are_those_of_all_scores(lspark, monkeypatch, case):
    monkeypatch.setattr(vafile, "LEAST", 50)
    rows = CASES[case]
    assert found(lspark, rows) == plain(rows)


def test_repeated_keys_are_rows_of_their_own(lspark):
    rows = some(60, 3, 5, 30)
    rows += rows[:20] + [(7, rows[3][1], 0)] * 3
    assert found(lspark, rows, k=2) == plain(rows, k=2)


def test_bounds_hold_and_spare_reading():
    dice = np.random.default_rng(3)
    v = dice.integers(-5000, 5000, (600, 12))
    q = dice.integers(-5000, 5000, (9, 12))
    members = vafile.pa.array([[i] for i in range(len(v))], vafile.pa.list_(vafile.pa.int64()))
    row = vafile._pack(12, 0, np.arange(len(v)), v, members, 2)
    unit = {c: row.column(c)[0].as_py() for c in row.schema.names}
    middle, slack = vafile._bounds(unit, q)
    exact = q @ v.T
    assert (np.abs(2 * exact - middle) <= slack[:, None]).all() and (slack > 0).all()
    for i in range(len(q)):
        at, scores = vafile._nearest(q[i], v, middle[i], slack[i], -np.inf, 2)
        assert len(at) < 200 and (scores == exact[i][at]).all()
        assert sorted(scores)[-3:] == sorted(exact[i])[-3:]


def test_hot_keys_are_dealt_over_tasks(lspark):
    left = lspark.range(900).selectExpr("if(id % 3 = 0, 7, id) AS k", "id AS v")
    right = lspark.range(0, 900, 2).selectExpr("id + 1 AS k", "id AS w")
    want = {r: r for r in map(tuple, left.join(right, "k").collect())}
    joined = frames.spread_join(left, right, "k")
    assert "_salt" not in joined.columns
    assert {r: r for r in map(tuple, joined.collect())} == want
    lefts = frames.spread_join(left, right, "k", "left").collect()
    assert sorted(map(str, lefts)) == sorted(map(str, left.join(right, "k", "left").collect()))


def test_a_search_has_results(lspark):
    with pytest.raises(ValueError):
        vafile.top_k(lspark.createDataFrame([], SCHEMA), F.lit(True), k=0)


def test_packed_rows_are_never_broadcast(lspark, monkeypatch, capsys):
    def staged(df, label):
        df.explain()
        return own(df, label)

    own = vafile.stage
    monkeypatch.setattr(vafile, "stage", staged)
    frame = lspark.createDataFrame(some(300, 8), SCHEMA)
    vafile.top_k(frame, F.col("vec_id") % 5 == 0).explain()
    joins = [line for line in capsys.readouterr().out.splitlines() if "Join" in line]
    assert any("SortMergeJoin" in line for line in joins)
    assert not [line for line in joins if re.search(r"HashJoin \[[^\]]*\b(qb|block|hash)#", line)]
