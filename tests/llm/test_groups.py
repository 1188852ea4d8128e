"""Near-duplicate documents and vectors, and connected components, against brute force."""

import math
import random
import re

import numpy as np
import pytest

from lossledger.llm import components, minhash, vector_dedup


def closure(nodes, links):
    """The smallest node that each one reaches."""
    least = {n: n for n in nodes}

    def root(n):
        while least[n] != n:
            n = least[n]
        return n

    for x, y in links:
        x, y = sorted((root(x), root(y)))
        least[y] = x
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("shape", ["random", "chain", "hub", "none"])
def test_components(lspark, shape):
    rng = random.Random(3)
    links = {"random": [(rng.randrange(400), rng.randrange(400)) for _ in range(260)],
             "chain": [(rng.choice([(i, i + 1), (i + 1, i)])) for i in range(90)],
             "hub": [(500, i) for i in range(300)] + [(5, 5), (None, 3)], "none": []}[shape]
    found = components.connected(lspark.createDataFrame(links, "a long, b long")).collect()
    links = [x for x in links if None not in x and x[0] != x[1]]
    assert dict(map(tuple, found)) == closure({n for x in links for n in x}, links)
    assert len(found) == len({n for x in links for n in x})


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def near(texts, n):
    sets = {k: shingles(t, n) for k, t in texts.items()}
    keys = [k for k in sets if sets[k]]
    links = [(x, y) for i, x in enumerate(keys) for y in keys[:i]
             if 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])]
    least = closure(texts, links)
    return {k: (len(sets[k]), least[k], least[k] == k) for k in texts}


def documents(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)


def rows(df, key):
    return {r[key]: tuple(r[c] for c in df.columns if c != key) for r in df.collect()}


@pytest.mark.parametrize("n", [2, 5])
def test_documents_match_brute_force(lspark, n):
    docs = lspark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert rows(minhash.near_duplicates(docs, words=n), "doc_id") == near(texts, n)


def test_links_that_the_smallest_member_does_not_have(lspark):
    """Many versions of one text: outer members of a bucket link with one another only."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for k in range(150):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([2, 9, 14, 18])):
            words[at] = f"x{rng.randrange(10 ** 6)}"
        texts[k] = " ".join(words)
    texts |= {200 + k: texts[k] for k in range(0, 150, 7)}
    assert rows(minhash.near_duplicates(documents(lspark, texts), words=2), "doc_id") == near(
        texts, 2)


def test_documents_at_the_edges(lspark):
    texts = {1: "one", 2: "ONE", 3: "one two", 4: None, 5: "", 6: " \n", 7: "a b c d e f",
             8: "a b c d e f g", 9: "É", 10: "é", 11: "z" * 2_500_000, 12: "z" * 2_500_000,
             13: "a b c d e f"}
    got = rows(minhash.near_duplicates(documents(lspark, texts), words=2), "doc_id")
    assert got == near(texts, 2)
    again = lspark.createDataFrame(
        [(1, "a b c", 0), (1, "a b c", 0), (1, "q r s", 0), (None, "a b c", 0), (None, None, 0)],
        "doc_id long, text string, kept int")
    found = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept)
                   for r in minhash.near_duplicates(again, words=2).collect())
    assert [f[:3] for f in found] == [(-1, 0, -1), (-1, 2, 1), (1, 2, 1), (1, 2, 1), (1, 2, 1)]
    assert sum(f[3] for f in found) == 3
    empty = lspark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).collect() == []


def test_recall_of_the_sketch():
    rng = np.random.default_rng(4)
    missed = 0
    for size in [5, 9, 40, 400] * 40:
        union = np.unique(rng.integers(0, 2 ** 64, size, dtype=np.uint64))
        cut = max(1, size // 5)
        left, right = union[rng.permutation(size)[:size - cut // 2]], union
        left = np.sort(left)
        missed += not (minhash._bands(minhash.sketch(left))
                       == minhash._bands(minhash.sketch(right))).any()
    assert missed == 0


def vectors(rng, n=900, dim=24):
    points = rng.normal(size=(n, dim))
    for i in range(0, n, 3):
        points[i] = points[rng.integers(0, n // 6)] + rng.normal(size=dim) * rng.choice(
            [0, 0.1, 0.25, 0.38])
    points[n // 2:n // 2 + 220] = points[0] + rng.normal(size=(220, dim)) * 0.2
    return points


def brute_vectors(found, cosine):
    ok = {k: np.array(v, float) for k, (v, g) in found.items()
          if v and g is not None and None not in v and np.isfinite(np.array(v, float)).all()
          and any(v)}
    links = [(x, y) for i, x in enumerate(ok) for y in list(ok)[:i]
             if found[x][1] == found[y][1] and len(ok[x]) == len(ok[y])
             and ok[x] @ ok[y] / math.sqrt(ok[x] @ ok[x]) / math.sqrt(ok[y] @ ok[y]) >= cosine]
    least = closure(found, links)
    count = {k: 0 for k in found}
    for x, y in links:
        count[x] += 1
        count[y] += 1
    return {k: (count[k], least[k], least[k] == k) for k in found}


@pytest.mark.parametrize("block", [vector_dedup.BLOCK, 32])
def test_vectors_match_brute_force(lspark, block, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    rng = np.random.default_rng(8)
    found = {i: ([float(x) for x in v], int(i % 2 and i % 3)) for i, v in enumerate(vectors(rng))}
    frame = lspark.createDataFrame([(k, v, g) for k, (v, g) in found.items()],
                                   "vec_id long, embedding array<double>, label int")
    assert rows(vector_dedup.near_vectors(frame), "vec_id") == brute_vectors(found, 0.93)


def test_vectors_at_the_edges(lspark):
    inf, nan = float("inf"), float("nan")
    found = {1: ([1.0, 0.0], 1), 2: ([2.0, 0.0], 1), 3: ([1.0, 0.0], 2), 4: ([1.0, 0.0], None),
             5: (None, 1), 6: ([], 1), 7: ([0.0, 0.0], 1), 8: ([1.0, None], 1), 9: ([nan, 1.0], 1),
             10: ([inf, 1.0], 1), 11: ([1.0], 1), 12: ([1.0], 1), 13: ([-1.0, 0.0], 1),
             14: ([3e38, 0.0], 1), 15: ([1e-30, 0.0], 1)}
    frame = lspark.createDataFrame([(k, v, g, 7) for k, (v, g) in found.items()],
                                   "vec_id long, embedding array<float>, label int, v int")
    got = rows(vector_dedup.near_vectors(frame), "vec_id")
    assert got == brute_vectors({k: (v and [None if x is None else float(np.float32(x)) for x in v],
                                     g) for k, (v, g) in found.items()}, 0.93)
    twice = lspark.createDataFrame([(1, [1.0], 1), (1, [1.0], 1), (None, [1.0], 1)],
                                   "vec_id long, embedding array<double>, label int")
    out = vector_dedup.near_vectors(twice).collect()
    assert [(r.n_links, r.component_id) for r in out] == [(2, 1)] * 3
    assert vector_dedup.near_vectors(twice.limit(0)).collect() == []


def test_a_vector_that_a_third_of_all_rows_share(lspark):
    rng = np.random.default_rng(2)
    found = {i: ([float(x) for x in rng.normal(size=8)], 1) for i in range(120)}
    found |= {i: ([1.0] * 8, 1) for i in range(200, 260)}
    frame = lspark.createDataFrame([(k, v, g) for k, (v, g) in found.items()],
                                   "vec_id long, embedding array<double>, label int")
    assert rows(vector_dedup.near_vectors(frame), "vec_id") == brute_vectors(found, 0.93)


def test_a_vector_is_sent_few_times(lspark, monkeypatch):
    """Directions at random are the worst case: most cells' borders are near."""
    pairs, sent = vector_dedup._pairs, []

    def counted(members):
        out = pairs(members)
        sent.append(out.count() / members.count())
        return out

    monkeypatch.setattr(vector_dedup, "_pairs", counted)
    for n in (500, 4_000):
        frame = lspark.createDataFrame(
            [(i, v.tolist(), 1) for i, v in enumerate(
                np.random.default_rng(n).normal(size=(n, 32)))],
            "vec_id long, embedding array<double>, label int")
        vector_dedup.near_vectors(frame).collect()
    assert max(sent) < 8


def test_blocks_of_long_vectors_are_small(lspark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK_VALUES", 24 * 20)
    found = {i: ([float(x) for x in v], 1) for i, v in enumerate(
        vectors(np.random.default_rng(3), n=600))}
    frame = lspark.createDataFrame([(k, v, g) for k, (v, g) in found.items()],
                                   "vec_id long, embedding array<double>, label int")
    assert rows(vector_dedup.near_vectors(frame), "vec_id") == brute_vectors(found, 0.93)
