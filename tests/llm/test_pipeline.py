"""The pipeline against a plain version of every stage, and the registered queries against SQL."""

import math
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from compare import connect, difference
from lossledger.llm import queries
from test_decontaminate import nearest, words
from test_groups import near
from test_tokens import WORD, crc, packed

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def passages(rows, length=20):
    """The words that each text keeps, rows in order."""
    seen, out = set(), []
    for text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(own)
        for k in range(len(own) - length + 1):
            window = tuple(own[k:k + length])
            if window in seen:
                gone[k:k + length] = [True] * length
            seen.add(window)
        out.append(text if not any(gone) else " ".join(w for w, g in zip(own, gone) if not g))
    return out


def test_stages_match_plain_versions(lspark, tmp_path):
    docs = lspark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = {r.doc_id: r.text for r in docs.collect()}
    toxic, *others, (_, pack) = corpus_pipeline.STAGES

    def step(stage, docs):
        stage[1](lspark, docs, SMALL).write.parquet(f"{tmp_path}/{stage[0]}")
        out = lspark.read.parquet(f"{tmp_path}/{stage[0]}")
        assert out.columns == columns
        return out, {r.doc_id: r.text for r in out.collect()}

    # The rejected texts are those that the classifier, tested by itself, scores high.
    model = corpus_pipeline.toxicity.train(docs, lspark.read.parquet(f"{SMALL}/labels.parquet"))
    high = {r.doc_id for r in corpus_pipeline.toxicity.scored(docs, model).collect()
            if r.score >= 0.7}
    docs, found = step(toxic, docs)
    kept = {k: t for k, t in kept.items() if k not in high}
    assert found == kept

    docs, found = step(others[0], docs)
    kept = {k: kept[k] for k, v in near(kept, 5).items() if v[2]}
    assert found == kept

    docs, found = step(others[1], docs)
    order = sorted(kept)
    kept = dict(zip(order, passages([kept[k] for k in order])))
    assert found == kept
    assert all(r.n_chars == len(r.text) for r in docs.collect())

    docs, found = step(others[2], docs)
    items = [words(r.text) for r in lspark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaked = {k for k, t in kept.items() if any(
        nearest(i, words(t)) <= int(0.2 * len(i) + 1e-9) for i in items if len(i) >= 8)}
    assert leaked
    assert found == {k: t for k, t in kept.items() if k not in leaked}

    plain = Tokenizer.from_file(WORD)
    want = {k: plain.encode(t or "", add_special_tokens=False).ids + [2] for k, t in found.items()}
    pieces = packed(pack(lspark, docs, SMALL))
    assert sum(r.length for r in pieces) == sum(map(len, want.values()))
    assert all(r.ids_crc32 == crc(want[r.doc_id][r.start:r.start + r.length]) for r in pieces)


def test_run_applies_all_stages(lspark):
    pieces = packed(queries.QUERIES["pipeline"](lspark, SMALL))
    at = 0
    for r in pieces:
        assert divmod(at, 4096) == (r.sequence_id, r.offset)
        at += r.length
    assert pieces


def test_odd_rows_go_through_all_stages(lspark, tmp_path):
    rows = [(1, "a b c d e f g", "en", None, 13), (1, "a b c d e f g", "en", "s", 13),
            (None, None, None, None, None), (None, "x y", "en", "s", 3), (4, "", None, "s", 0)]
    docs = lspark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "1 as _row", "2 as score", "'z' as shard")
    for empty in (docs, docs.limit(0)):
        out = empty
        for i, (_, step) in enumerate(corpus_pipeline.STAGES[:-1]):
            out = step(lspark, out, SMALL)
            assert out.columns == docs.columns
        assert len(out.collect()) == (4 if empty is docs else 0)
        assert len(corpus_pipeline.STAGES[-1][1](lspark, out, SMALL).collect()) == (
            4 if empty is docs else 0)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(lspark, name):
    con = connect(MEDIUM)
    assert difference(queries.QUERIES[name](lspark, MEDIUM), con, queries.ORACLE[name]) is None


def test_every_operator_has_its_query():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES if n.startswith("op")]
    assert sorted(numbers) == list(range(1, 11)) and "pipeline" in queries.QUERIES


def test_scores_of_the_query(lspark):
    rows = queries.QUERIES["op9_toxicity"](lspark, SMALL).collect()
    assert len(rows) == lspark.read.parquet(f"{SMALL}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and not math.isnan(r.score)
        assert r.predicted == int(r.score >= 0.7)


def test_coded_query_matches_whole_text_encoding(lspark):
    from test_tokens import coded_brute

    docs = lspark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op8_rans_tokens"](lspark, SMALL).collect()
    assert sorted(map(tuple, got)) == coded_brute(sorted(map(tuple, docs)))
    assert np.unique([r.doc_id for r in got]).size == len(docs)
