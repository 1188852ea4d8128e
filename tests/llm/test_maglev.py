import hashlib
from collections import Counter

import pytest

from lossledger.llm import maglev


def brute(shards, slots):
    """Fills the table from whole preference lists."""
    prefer = []
    for s in shards:
        h = hashlib.blake2b(s.encode(), digest_size=16).digest()
        at = int.from_bytes(h[:8], "little") % slots
        skip = int.from_bytes(h[8:], "little") % (slots - 1) + 1
        prefer.append([(at + j * skip) % slots for j in range(slots)])
    table, turn = {}, 0
    while len(table) < slots:
        i = turn % len(shards)
        table[next(s for s in prefer[i] if s not in table)] = i
        turn += 1
    return [table[s] for s in range(slots)]


@pytest.mark.parametrize("n, slots", [(1, 7), (3, 13), (7, 101), (13, 13)])
def test_table_matches_brute_force(n, slots):
    table = maglev.lookup_table(maglev.names(n), slots)
    assert table == brute(maglev.names(n), slots)
    assert max(Counter(table).values()) - min(Counter(table).values()) <= 1


def test_a_lost_shard_moves_few_slots():
    names = maglev.names(20)
    before = maglev.lookup_table(names, 10_007)
    less = [n for n in names if n != names[4]]
    after = maglev.lookup_table(less, 10_007)
    moved = sum(names[x] != less[y] for x, y in zip(before, after) if x != 4)
    assert moved < 0.05 * 10_007


@pytest.mark.parametrize("names, slots", [([], 7), (["a", "a"], 7), (["a"], 8), (["a"] * 9, 7)])
def test_wrong_tables_are_refused(names, slots):
    with pytest.raises(ValueError):
        maglev.lookup_table(names, slots)


def test_placement(lspark):
    docs = lspark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = maglev.placed(docs, "doc_id", maglev.names(8), 1009)
    table = maglev.lookup_table(maglev.names(8), 1009)
    rows = got.collect()
    assert len(rows) == docs.count() and all(r.shard == table[r.slot] for r in rows)
    sizes = Counter(r.shard for r in rows)
    assert len(sizes) == 8 and max(sizes.values()) < 1.5 * len(rows) / 8
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_hot_keys_spread_and_null_is_a_key(lspark):
    rows = [("hot", i) for i in range(600)] + [(None, i) for i in range(300)]
    rows += [(f"k{i}", i) for i in range(300)]
    frame = lspark.createDataFrame(rows, "key string, shard int")
    got = maglev.placed(frame.withColumnRenamed("shard", "n"), "key", maglev.names(10), 1009)
    sizes = Counter(r.shard for r in got.collect())
    assert sum(sizes.values()) == 1200 and max(sizes.values()) < 400
    assert len({r.shard for r in got.where("key = 'hot'").collect()}) > 3
    small = maglev.placed(frame.where("key like 'k%'"), "key", maglev.names(10), 1009)
    assert all(r.piece == 0 for r in small.collect())
    assert maglev.placed(frame.limit(0), "key", maglev.names(3), 13).collect() == []


def test_equal_rows_of_a_hot_key_spread(lspark):
    rows = [("hot",)] * 600 + [(None,)] * 300 + [(f"k{i}",) for i in range(300)]
    frame = lspark.createDataFrame(rows, "key string").repartition(5)
    got = maglev.placed(frame, "key", maglev.names(10), 1009).collect()
    sizes = Counter(r.shard for r in got)
    assert Counter(r.key for r in got) == Counter(k for k, in rows)
    assert max(sizes.values()) < 400
    for key in ("hot", None):
        pieces = Counter(r.piece for r in got if r.key == key)
        assert len(pieces) > 3 and max(pieces.values()) - min(pieces.values()) <= 1
        assert len({r.shard for r in got if r.key == key}) > 2
    table = maglev.lookup_table(maglev.names(10), 1009)
    assert all(r.shard == table[r.slot] for r in got)


def test_shards_are_written(lspark):
    from lossledger.session import staging_path

    docs = lspark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    placed = maglev.placed(docs, "doc_id", maglev.names(5), 101)
    folder = staging_path(lspark, "shards")
    maglev.write_shards(placed, folder)
    back = maglev.read_shards(lspark, folder, placed.schema)
    assert back.columns == placed.columns
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, placed.collect()))


def test_a_large_shard_is_written_by_many_tasks(lspark):
    from lossledger.session import staging_path

    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = lspark.conf.get(size)
    lspark.conf.set(size, "200KB")
    try:
        rows = lspark.range(0, 20_000, 1, 16).selectExpr(
            "id", "sha2(string(id), 512) as text", "if(id % 3 = 0, 0, 1 + id % 4) as shard")
        folder = staging_path(lspark, "shards")
        maglev.write_shards(rows, folder)
        back = maglev.read_shards(lspark, folder, rows.schema)
        files = Counter(r.shard for r in back.selectExpr(
            "shard", "_metadata.file_path as f").distinct().collect())
        assert files[0] > 2 and back.count() == 20_000
    finally:
        lspark.conf.set(size, before)


def test_query_places_whole_rows(lspark):
    from lossledger.llm import queries

    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in lspark.read.parquet(f"{folder}/documents.parquet").collect()}
    table = maglev.lookup_table(maglev.names())
    rows = queries.QUERIES["op7_sharding"](lspark, folder).collect()
    assert len(rows) == len(docs) and {r.doc_id for r in rows} == set(docs)
    for r in rows:
        text = docs[r.doc_id]
        expected = None if text is None else hashlib.sha256(text.encode()).hexdigest()
        assert r.text_sha256 == expected and r.shard == table[r.slot]
