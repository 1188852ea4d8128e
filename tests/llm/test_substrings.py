import hashlib
import re

import pytest

from lossledger.llm import substrings


def brute(rows, length):
    """(n_words, n_removed, digest) of each row, rows in order of their id."""
    seen, out = set(), []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for k in range(len(words) - length + 1):
            window = tuple(words[k:k + length])
            if window in seen:
                gone[k:k + length] = [True] * length
            seen.add(window)
        left = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((len(words), sum(gone), hashlib.sha256(left.encode()).hexdigest()))
    return out


def results(df, key="doc_id"):
    return [(r[key], (r.n_words, r.n_removed, r.kept_sha256)) for r in df.collect()]


@pytest.mark.parametrize("flush", [substrings.FLUSH, 500])
def test_matches_brute_force(lspark, flush, monkeypatch):
    monkeypatch.setattr(substrings, "FLUSH", flush)
    docs = lspark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = dict(results(substrings.cut_repeats(docs.repartition(7))))
    assert [got[i] for i, _ in rows] == brute(rows, 20)


def test_repeats_within_one_text_and_at_the_edges(lspark):
    run = " ".join(f"w{i}" for i in range(30))
    rows = [(1, f"{run}\t{run} tail"), (2, f"head {run}"), (3, " ".join(run.split()[:20])),
            (4, " ".join(run.split()[:19])), (5, "same " * 50), (6, f"é{run} {run}"),
            (7, "x" * 3_000_000 + " " + run)]
    docs = lspark.createDataFrame(rows, "doc_id long, text string")
    got = dict(results(substrings.cut_repeats(docs)))
    assert [got[i] for i, _ in rows] == brute(rows, 20)


def test_kept_text(lspark):
    docs = lspark.createDataFrame([(1, "a b c d"), (2, "x a b c y")], "doc_id long, text string")
    got = substrings.cut_repeats(docs, length=3, anchor=2).orderBy("doc_id").collect()
    assert [r.kept_text for r in got] == ["a b c d", "x y"]


def test_nulls_repeated_keys_and_clashing_columns(lspark):
    run = " ".join(f"w{i}" for i in range(25))
    rows = [(None, run, 9, "p"), (3, run, 9, None), (3, run, 9, "q"), (4, None, 9, "r"),
            (5, "", 9, "s"), (6, " \t\n", 9, "t"), (None, None, 9, "u")]
    docs = lspark.createDataFrame(rows, "doc_id long, text string, n_words int, doc string")
    got = substrings.cut_repeats(docs)
    assert sorted(got.columns) == sorted(
        ["doc_id", "text", "doc", "n_words", "n_removed", "kept_sha256", "kept_text"])
    found = {(r.doc_id, r.doc): (r.n_words, r.n_removed) for r in got.collect()}
    assert sorted([found[3, None], found[3, "q"]]) == [(25, 0), (25, 25)]
    assert found[None, "p"] == (25, 25)
    assert all(found[k] == (0, 0) for k in [(4, "r"), (5, "s"), (6, "t"), (None, "u")])


def test_no_rows(lspark):
    docs = lspark.createDataFrame([], "doc_id long, text string, lang string")
    assert substrings.cut_repeats(docs).collect() == []
