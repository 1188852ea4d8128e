"""Token ids, packing and the coded files against whole-text encoding."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lossledger.llm import packing, rans, tokens

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a", " a", "a ", "\n\n a  b\t\tc \n", "x  y", "x  y", "x　 　y",
       "don't I'll 's 't", "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b  <|startoftext|>",
       "ΟΔΟΣ ΟΔΟΣ. Σ", "é ́ e", "İ İ", "\x1c a \x1d\x1e b", "\u0085 x   y",
       "日本語 テスト 12 345", "🙂 🙂🙂 a🙂", "a​ b", "Ⅷ ½ x²", "word " * 300, "y" * 5000,
       "  a  b  c", "a\x0bb\x0cc", "é été É", "no­break", " ́x"]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def encode_all(path, texts):
    out = []
    for _, ids, bounds in tokens.Encoder(path).encode(pa.array(texts, pa.string())):
        out += [ids[x:y].tolist() for x, y in zip(bounds, bounds[1:])]
    return out


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_are_those_of_whole_texts(path, monkeypatch):
    rng = random.Random(2)
    alphabet = list("aB'sé.9 \n\t 　<|>\x1ć\u0085ß")
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(1500)]
    plain = Tokenizer.from_file(path)
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert encode_all(path, [*texts, None]) == [*want, []]
    monkeypatch.setattr(tokens, "MEMORY", 20)
    monkeypatch.setattr(tokens.a, "SLICE", 50)
    assert encode_all(path, texts[:200]) == want[:200]


def packed(df):
    return sorted(df.collect(), key=lambda r: (r.sequence_id, r.offset))


def check_pieces(pieces, want, size):
    """``want``: key -> ids with the end id. Pieces cover each once and fill sequences."""
    at, seen = 0, {}
    for r in pieces:
        assert divmod(at, size) == (r.sequence_id, r.offset)
        at += r.length
        ids = want[r.doc_id]
        assert r.start == seen.get(r.doc_id, 0) and r.doc_tokens == len(ids) and r.length > 0
        seen[r.doc_id] = r.start + r.length
        assert r.ids_crc32 == crc(ids[r.start:r.start + r.length])
    assert seen == {k: len(v) for k, v in want.items()}


def test_packing_matches_whole_text_encoding(lspark):
    docs = lspark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plain = Tokenizer.from_file(WORD)
    want = {r.doc_id: plain.encode(r.text or "", add_special_tokens=False).ids + [2]
            for r in docs.collect()}
    pieces = packed(packing.pack(docs.repartition(6), WORD))
    assert len({r.doc_id for r in pieces}) == docs.count()
    # A document's pieces follow on one another, so they come in the order of their starts.
    check_pieces(pieces, want, 4096)


def test_packing_at_the_edges(lspark):
    rows = [(1, None, 5), (2, "", 5), (3, "word " * 700, 5), (4, "a", None)]
    docs = lspark.createDataFrame(rows, "doc_id long, text string, length int")
    plain = Tokenizer.from_file(WORD)
    want = {k: plain.encode(t or "", add_special_tokens=False).ids + [2] for k, t, _ in rows}
    for size in (1, 64, 100_000):
        check_pieces(packed(packing.pack(docs, WORD, size=size)), want, size)
    with_ids = packed(packing.pack(docs, WORD, size=64, with_ids=True))
    flat = [i for r in with_ids for i in r.ids]
    assert sorted(flat) == sorted(i for v in want.values() for i in v)
    twice = lspark.createDataFrame([(None, "a"), (7, "b"), (7, "b")], "doc_id long, text string")
    assert [r.doc_tokens for r in packed(packing.pack(twice, WORD))] == [2, 2, 2]
    assert packing.pack(docs.limit(0), WORD).collect() == []


def test_blocks_decode_alone():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.3, 30_000) % 5000
    table = rans.Table(rans.Table.scaled(np.bincount(ids)))
    docs = np.array([(5, 0, 29_990), (0, 1, 10)], rans._DOC)
    data = rans.encode_file(ids.astype(np.uint32), docs, 17, table, lanes=64, block=4096) + b"\n"
    assert len(data) < 1.05 * sum(-np.log2(table.frequency[ids] / 2 ** table.bits)) / 8 + 6000
    file = rans.File(data, table)
    for i in reversed(range(len(file.index))):
        assert (file.decoded(i) == ids[i * 4096:(i + 1) * 4096]).all()
    assert list(file.documents()) == [(5, 17, 29_990, crc(ids[:29_990])),
                                      (None, 30_007, 10, crc(ids[29_990:]))]
    damaged = bytearray(data)
    damaged[-500] ^= 1
    for bad in (bytes(damaged), data[:-40], data[:-1]):
        with pytest.raises(ValueError):
            rans.File(bad, table)
    other = rans.Table(rans.Table.scaled(np.bincount(ids) + 1))
    with pytest.raises(ValueError):
        rans.File(data, other)


@pytest.mark.parametrize("counts", [[0], [5], [1, 0, 10 ** 9], [1] * 50_000, [10 ** 9] + [1] * 9999])
def test_frequencies_add_up(counts):
    found = rans.Table.scaled(np.array(counts), 16)
    assert found.sum() == 1 << 16 and (found[np.array(counts) > 0] > 0).all()
    table = rans.Table(found, 16)
    ids = np.flatnonzero(found).astype(np.uint32)
    for n in (1, 3, len(ids)):
        coded = rans.encode_block(ids[:n], table, 8)
        assert (rans.decode_block(coded, len(ids[:n]), table, 8) == ids[:n]).all()


def coded_brute(rows):
    plain = Tokenizer.from_file(BYTE)
    out, before = [], 0
    for key, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((key, before, len(ids), crc(ids)))
        before += len(ids)
    return out


@pytest.mark.parametrize("size", [rans.FILE, 3000])
def test_coded_files_round_trip(lspark, size, monkeypatch):
    monkeypatch.setattr(rans, "FILE", size)
    docs = lspark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = rans.coded_ids(docs.repartition(5), BYTE)
    assert sorted(map(tuple, got.collect())) == coded_brute(rows)


def test_coded_files_at_the_edges(lspark):
    rows = [(-3, "a b"), (1, None), (2, ""), (2, ""), (9, "<|endoftext|> x" * 9), (None, "z")]
    docs = lspark.createDataFrame(rows, "doc_id long, text string")
    got = rans.coded_ids(docs, BYTE).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == coded_brute(rows)
    assert rans.coded_ids(docs.limit(0), BYTE).collect() == []


def test_a_hot_id_is_dealt_over_tasks_and_texts_are_no_ids(lspark, tmp_path):
    docs = lspark.range(4000).selectExpr("if(id % 2 = 0, 7L, id) AS doc_id", "string(id) AS text")
    rows = rans.coded_ids(docs, BYTE).collect()
    assert len(rows) == 4000 and sum(r["doc_id"] == 7 for r in rows) == 2001
    starts = sorted((r["start"], r["n_tokens"]) for r in rows)
    assert all(x + n == y for (x, n), (y, _) in zip(starts, starts[1:]))
    with pytest.raises(ValueError):
        rans.write_coded(docs.withColumn("doc_id", docs.text), str(tmp_path), BYTE)


def test_slices_of_texts_are_small_and_whole():
    texts = pa.array(["ab" * 300_000, None, "c" * 700_000, "", "d" * 2_500_000, "e"])
    found = [(row, bytes(data), offsets) for row, data, offsets in tokens.a.text_slices(texts)]
    assert b"".join(data for _, data, _ in found).decode() == "".join(
        t or "" for t in texts.to_pylist())
    assert all(len(data) <= 1_000_000 or len(offsets) == 2 for _, data, offsets in found)
    assert [row for row, _, _ in found] == [0, 2, 4, 5]
