import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lossledger.llm import decontaminate as d


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def nearest(item, part):
    """Edit distance of the item to the nearest stretch of a list of words."""
    row = [0] * (len(part) + 1)
    for i, x in enumerate(item):
        new = [i + 1]
        for j, y in enumerate(part):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rng, item, edits):
    out = list(item)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = f"x{rng.randrange(10 ** 6)}"
        elif kind == 1:
            out.insert(at, f"y{rng.randrange(10 ** 6)}")
        else:
            del out[at]
    return out


@pytest.mark.parametrize("vocabulary", [3000, 60])
def test_every_edited_passage_is_found_and_nothing_else(vocabulary):
    rng = random.Random(vocabulary)
    text = lambda n: [f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(n)]
    items = [text(rng.randrange(5, 70)) for _ in range(60)]
    table = d.Items([(i, " ".join(x)) for i, x in enumerate(items)])
    found = missed = extra = 0
    for trial in range(500):
        i = rng.randrange(60)
        limit = int(0.2 * len(items[i]) + 1e-9)
        edits = rng.choice([0, 1, limit, limit, limit + 1, limit + 4])
        doc = text(rng.randrange(40)) + edited(rng, items[i], edits) + text(rng.randrange(200))
        slices = d.a.text_slices(pa.array(["", " ".join(doc), "other"]))
        hits = [h for _, data, offsets in slices
                for h in table.matches(*d.words_of(data, offsets))]
        near = nearest(items[i], doc)
        own = [h for h in hits if h[1] == i]
        if near <= limit:
            found += bool(own)
            missed += not own
        extra += sum(h[0] != 1 or nearest(items[h[1]], doc[h[2]:h[2] + h[3]]) != h[4]
                     or h[4] > table.edits[h[1]] for h in hits)
        if own and min(h[4] for h in own) != near:
            extra += 1
    assert extra == 0
    assert missed <= 0.01 * (found + missed) and found > 200


def test_agreement_of_walks_at_the_largest_distance():
    """The share of places that the number of repetitions is based on."""
    rng = random.Random(4)
    shares = []
    for _ in range(300):
        n = rng.randrange(8, 60)
        item = [f"w{rng.randrange(3000)}" for _ in range(n)]
        other = (edited(rng, item, int(0.2 * n)) + ["z"] * n)[:n]
        hashes = [d.words_of(np.frombuffer(" ".join(x).encode(), np.uint8),
                             np.array([0, len(" ".join(x).encode())]))[1] for x in (item, other)]
        walk = d.Walk(n, 60)
        one, two = (walk.embed(d.padded(h, np.array([0]), np.array([n]), n)) for h in hashes)
        shares.append(np.mean([(one[step] == two[step]).mean() for step in one]))
    assert np.mean(shares) > d.AGREEMENT


@pytest.mark.parametrize("n", [8, 15, 20, 30, 45, 59])
def test_buckets_select(lspark, n):
    """Unrelated windows of real texts share a bucket in less than one case of a hundred."""
    docs = lspark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300).toArrow()
    hashes = np.concatenate([d.words_of(data, offsets)[1] for _, data, offsets in
                             d.a.text_slices(docs["text"])])
    dice = np.random.default_rng(n)
    walk = d.Walk(n, d.repetitions())
    keys = []
    for _ in range(2):
        starts = dice.integers(0, len(hashes) - n, 1500)
        keys.append(walk.keys(d.padded(hashes, starts, starts + n, n)))
    same = [(one == other).any() for one in keys[0][:300] for other in keys[1][:200]]
    assert np.mean(same) < 0.01


def test_distances_are_those_of_the_table():
    rng = random.Random(6)
    for _ in range(200):
        size = rng.choice([1, 3, 8, 70, 130])
        item = np.array([rng.randrange(9) for _ in range(size)], np.uint64)
        part = np.array([rng.randrange(9) for _ in range(rng.randrange(90))], np.uint64)
        for free in (True, False):
            row = list(range(size + 1))
            want = [size]
            for j, y in enumerate(part):
                new = [0 if free else j + 1]
                for i, x in enumerate(item):
                    new.append(min(row[i] + (x != y), row[i + 1] + 1, new[i] + 1))
                row = new
                want.append(row[-1])
            assert d._distances(item, part, free) == want


def test_long_items_walk_in_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in rng.integers(0, 400, 9000)]
    table = d.Items([(1, " ".join(words[1000:4000]))])
    changed = words[:2000] + ["x"] * 30 + words[2030:]
    data = np.frombuffer(" ".join(changed).encode(), np.uint8)
    tracemalloc.start()
    hits = list(table.matches(*d.words_of(data, np.array([0, len(data)]))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [h[1:] for h in hits] == [(0, 1000, 3000, 30)] and peak < 300 << 20


def rows(spark, texts, name):
    return spark.createDataFrame(list(enumerate(texts)), f"{name} long, text string")


def test_leaks_of_the_given_tables(lspark):
    docs = lspark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = lspark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    texts = {r.doc_id: " ".join(words(r.text)) for r in docs.collect()}
    want = {(k, r.item_id) for r in items.collect() for k, t in texts.items()
            if f" {' '.join(words(r.text))} " in f" {t} "}
    got = d.leaks(docs.repartition(5), items).collect()
    assert want and want <= {(r.doc_id, r.item_id) for r in got}
    for r in got:
        item = words(next(x.text for x in items.collect() if x.item_id == r.item_id))
        part = texts[r.doc_id].split()[r.first_word:r.first_word + r.n_words]
        assert nearest(item, part) <= r.edits <= 0.2 * len(item)
        assert r.similarity == pytest.approx(1 - r.edits / len(item))


def test_edges(lspark, monkeypatch):
    item = "Alpha, beta gamma: delta epsilon zeta eta theta iota kappa"
    docs = rows(lspark, [item, item.upper(), f"{item} {item} {item}", None, "", "- ...",
                         item.replace(" ", "\n\t"), "É " + item[7:], "alpha beta"], "doc_id")
    items = rows(lspark, [item, None, "", "alpha beta", item], "item_id")
    got = sorted((r.doc_id, r.item_id, r.first_word, r.edits) for r in d.leaks(docs, items, shortest=3).collect())
    want = [(k, i, p, 0) for k, p in [(0, 0), (1, 0), (2, 0), (2, 10), (2, 20), (6, 0)]
            for i in (0, 4)] + [(7, 0, 0, 1), (7, 4, 0, 1)]
    assert [(k, i, e) for k, i, _, e in got] == sorted((k, i, e) for k, i, _, e in want)
    monkeypatch.setattr(d, "PORTION", 10)
    assert sorted((r.doc_id, r.item_id, r.first_word, r.edits)
                  for r in d.leaks(docs, items, shortest=3).collect()) == got
    assert d.leaks(docs.limit(0), items).collect() == []
    assert d.leaks(docs, items.limit(0)).collect() == []
    accents = d.leaks(rows(lspark, ["ÉTÉ Ça Öl à b c d e f"], "doc_id"),
                      rows(lspark, ["été ça öl À B C D E F"], "item_id")).collect()
    assert [r.edits for r in accents] == [0]


def test_short_items_follow_the_same_rule(lspark, monkeypatch):
    monkeypatch.setattr(d, "_ROWS", 2)
    items = rows(lspark, ["Who wrote Hamlet?", "yes", "a b a", "who wrote hamlet", "...",
                          "alpha beta gamma delta epsilon"], "item_id")
    docs = rows(lspark, ["He asked: who  wrote\nHAMLET? Yes.", "who wrote", "hamlet", "a b a b a b a",
                         "who wrote no hamlet", None, "yes", "alpha beta gamma x epsilon yes",
                         "alpha beta x x epsilon"], "doc_id")
    got = d.leaks(docs.coalesce(1), items).collect()
    assert sorted((r.doc_id, r.item_id, r.first_word, r.n_words, r.edits) for r in got) == [
        (0, 0, 2, 3, 0), (0, 1, 5, 1, 0), (0, 3, 2, 3, 0), (3, 2, 0, 3, 0), (3, 2, 4, 3, 0),
        (6, 1, 0, 1, 0), (7, 1, 5, 1, 0), (7, 5, 0, 5, 1)]
    assert {r.item_id for r in d.leaks(docs, items, shortest=2).collect()} == {0, 2, 3, 5}


def test_equal_items_are_searched_once_and_all_reported(lspark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    items = lspark.createDataFrame([(i, item) for i in range(40)] + [(None, item)],
                                   "item_id long, text string")
    got = d.leaks(rows(lspark, [f"so {item}"], "doc_id"), items).collect()
    assert sorted(str(r.item_id) for r in got) == sorted([str(i) for i in range(40)] + ["None"])


def test_characters_are_words_in_scripts_without_spaces(lspark):
    long = "法国的首都是哪一座城市"
    items = rows(lspark, [long, "富士山", "เมืองหลวง", "𠮷野家"], "item_id")
    docs = rows(lspark, [f"问:{long}?", f"答案{long[:5]}不{long[6:]}。", "日本の富士山は高い",
                         "富士の山", "ชื่อเมืองหลวงคือ", "abc𠮷野家 def", "Ελλάδα Привет 한국어"], "doc_id")
    got = sorted((r.doc_id, r.item_id, r.edits) for r in d.leaks(docs, items).collect())
    assert got == [(0, 0, 0), (1, 0, 1), (2, 1, 0), (4, 2, 0), (5, 3, 0)]
    for text, count in [("Ελλάδα Привет 한국어 “x”", 4), ("abc漢字def ghi", 5), ("é漢", 2)]:
        data = np.frombuffer(text.encode(), np.uint8)
        assert d.words_of(data, np.array([0, len(data)]))[0].tolist() == [0, count]
    texts = ["漢字", "", "a 漢b", "c"]
    data, ends = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum(
        [0] + [len(t.encode()) for t in texts])
    assert d.words_of(data, ends)[0].tolist() == [0, 2, 2, 5, 6]
