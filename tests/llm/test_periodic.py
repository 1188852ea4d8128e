"""Periodic runs against a comparison of all periods."""

import hashlib
import random
import re

import numpy as np
import pytest

from lossledger.llm import periodic


def plain_runs(words, shortest=12):
    """Every stretch that agrees with itself q words further on, and has no smaller period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(shortest, 2 * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain(text, shortest=12):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = plain_runs(words, shortest)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    told = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(words), runs, told, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(told.encode()).hexdigest())


def some_texts(seed, n, letters):
    dice = random.Random(seed)
    out = []
    for _ in range(n):
        words = []
        while len(words) < dice.choice([5, 30, 80]):
            part = [dice.choice("abcdefgh"[:letters]) for _ in range(dice.randint(1, 9))]
            words += part * dice.choice([1, 1, 2, 3, 7]) + part[:dice.randint(0, len(part))]
        out.append(dice.choice([" ", "\n", " \t "]).join(words))
    return out


FIBONACCI = ["b", "a"]
while len(FIBONACCI[-1]) < 300:
    FIBONACCI.append(FIBONACCI[-1] + FIBONACCI[-2])
CASES = {
    "none": [None, "", "  \n", "one", " ".join(map(str, range(100)))],
    "one word": ["x " * n for n in (11, 12, 13, 400)],
    "edges": ["a b c " * 4, "a b c " * 3 + "a b", "z " + "a b c " * 4 + "z", "é  ü " * 6],
    "multiples": [("a b " * 6 + "c ") * 2, "a a b " * 9 + "a", ("a " * 12 + "b ") * 3],
    "words of few letters": some_texts(1, 60, 2), "more letters": some_texts(2, 60, 6),
    "overlapping": [" ".join(FIBONACCI[-1]), " ".join("abaab" * 9 + "ab" * 9)],
    "copies": some_texts(3, 3, 3) * 3,
    "long": [" ".join(str(i % 997) for i in range(5000)), "w" * 300_000],
}


@pytest.mark.parametrize("case", CASES)
def test_runs_are_those_of_all_periods(lspark, case):
    texts = CASES[case]
    docs = lspark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.selectExpr("doc_id AS runs_of", "text", "doc_id AS n_words", "'x' AS runs", "1 AS row")
    found = periodic.periodic_runs(docs).collect()
    assert len(found) == len(texts)
    for row in found:
        assert (row["n_words"], [tuple(r) for r in row["runs"]], row["collapsed_text"],
                row["runs_sha256"], row["collapsed_sha256"]) == plain(texts[row["runs_of"]])


@pytest.mark.parametrize("seed", range(40))
def test_one_sequence(seed):
    dice = np.random.default_rng(seed)
    letters = dice.integers(0, 1 + seed % 4, dice.integers(1, 200))
    for shortest in (4, 12):
        found = sorted(zip(*(x.tolist() for x in periodic.runs_of(letters, shortest))))
        assert found == plain_runs(letters.tolist(), shortest)


def test_suffix_array():
    letters = np.random.default_rng(4).integers(0, 3, 300)
    array = periodic.SuffixArray(letters)
    told = sorted(range(300), key=lambda i: letters[i:].tolist())
    assert array.order.tolist() == told and (array.rank[array.order] == np.arange(300)).all()
    for k in range(1, 300):
        x, y = letters[told[k - 1]:], letters[told[k]:]
        n = min(len(x), len(y))
        same = np.flatnonzero(x[:n] != y[:n])
        assert array.common[k] == (same[0] if len(same) else n)


def test_nearest_smaller():
    values = np.random.default_rng(5).integers(0, 9, 500)
    told = [next((j for j in range(i + 1, 500) if values[j] < values[i]), 500) for i in range(500)]
    assert periodic.nearest_smaller(values).tolist() == told


def test_longest_breaks_ties(lspark):
    kind = "array<struct<start:bigint,length:bigint,period:bigint>>"
    rows = [([(9, 20, 3), (4, 20, 5), (4, 20, 2), (0, 12, 1)],), ([],)]
    got = lspark.createDataFrame(rows, f"runs {kind}").select(periodic.longest().alias("b")).collect()
    assert (got[0]["b"]["start"], got[0]["b"]["period"]) == (4, 2) and got[1]["b"] is None


def test_no_rows_and_short_limits(lspark):
    docs = lspark.createDataFrame([], "doc_id long, text string")
    assert periodic.periodic_runs(docs).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, shortest=3)
