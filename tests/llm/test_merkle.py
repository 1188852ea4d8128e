"""The Merkle manifest against a plain recursive version."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lossledger.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_leaf(row):
    doc_id, text, lang, source, n_chars, _ = row
    return sha("".join(map(told, (doc_id, source, lang, n_chars, text))))


def climb(digests, fan):
    """The top of a tree and, per leaf, its (left, right) from the run up."""
    paths = [[] for _ in digests]
    cover = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, covers = [], []
        for i in range(0, len(digests), fan):
            run = digests[i:i + fan]
            for j in range(len(run)):
                for one in cover[i + j]:
                    paths[one].append(("".join(run[:j]), "".join(run[j + 1:])))
            above.append(sha("".join(run)))
            covers.append(sum(cover[i:i + fan], []))
        digests, cover = above, covers
    return digests[0], paths


def plain(rows, fan=8):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    found, tops = [], []
    for lang in langs:
        here = sorted((r[0] is None, r[0] or 0, plain_leaf(r)) for r in groups[lang])
        top, paths = climb([x[2] for x in here], fan)
        tops.append(top)
        found.append([(None if x[0] else x[1], x[2], top, p) for x, p in zip(here, paths)])
    root, uppers = climb(tops, fan) if tops else (None, [])
    return sorted(((str(i), leaf, top, root, p + upper) for part, upper in zip(found, uppers)
                   for i, leaf, top, p in part), key=str)


def built(spark, rows, fan=8):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = merkle.manifest(docs, carry=["doc_id"], fan=fan)
    folds = out.withColumn("again", merkle.folded(F.col("leaf"))).collect()
    assert all(r["again"] == r["root"] for r in folds)
    return sorted(((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"],
                    [(p["left"], p["right"]) for p in r["path"]]) for r in folds), key=str)


def some(n, langs, seed=5):
    dice = random.Random(seed)
    return [(i, dice.choice(["", "Ab c", "é\nü", None, "x" * 5000]), dice.choice(langs),
             dice.choice([None, "web"]), dice.choice([None, 3]), "clash") for i in range(n)]


@pytest.mark.parametrize("n,langs,fan", [
    (0, ["en"], 8), (1, ["en"], 8), (65, [None], 8), (130, ["en", None, "", "de"], 8),
    (90, [str(i) for i in range(80)], 8), (12, ["en", "Ä", "z", "Z"], 2)])
def test_manifest_is_the_plain_tree(lspark, n, langs, fan):
    rows = some(n, langs)
    assert built(lspark, rows, fan) == plain(rows, fan)


def test_repeated_and_missing_ids_are_leaves_of_their_own(lspark):
    rows = some(20, ["en", "de"])
    rows += rows[:7] + [(None, "a", "en", None, None, "")] * 3 + [(4, "other", "en", "", 0, "")]
    assert built(lspark, rows) == plain(rows)


def test_a_changed_field_changes_the_fold_only_there(lspark):
    rows = some(40, ["en", "de"])
    docs = lspark.createDataFrame(rows, SCHEMA).withColumn("other", merkle.leaf(
        ["doc_id", "source", "lang", "n_chars", F.upper("text")]))
    out = merkle.manifest(docs, carry=["doc_id", "other", "text"]).select(
        "text", (merkle.folded(F.col("other")) == F.col("root")).alias("ok")).collect()
    assert all(r["ok"] == (r["text"] is None or r["text"].upper() == r["text"]) for r in out)


def test_a_run_is_two_nodes_or_more(lspark):
    with pytest.raises(ValueError):
        merkle.manifest(lspark.createDataFrame([], SCHEMA), fan=1)
