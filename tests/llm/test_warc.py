import gzip
import hashlib
import heapq
import random

import pytest

from lossledger.llm import warc


def test_loser_tree():
    rng = random.Random(1)
    for k in range(12):
        runs = [sorted(rng.choices(range(50), k=rng.randrange(9))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == list(heapq.merge(*runs))


@pytest.mark.parametrize("url, key", [
    ("https://www.Example.com:8080/A/b?x=1#top", "com,example)/a/b?x=1"),
    ("http://user@a.b.c", "c,b,a)"), ("a.b?q", "b,a)?q"), ("", ""), (None, "")])
def test_url_key(url, key):
    assert warc.url_key(url) == key


def brute(rows):
    """page_id -> (bytes, digest, type, refers_to)"""
    found, first = {}, {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100:
            first[data] = min(first.get(data, page), page)
    for page, _, html in rows:
        data = (html or "").encode()
        own = first.get(data, page) == page
        found[page] = (len(data), hashlib.sha256(data).hexdigest(),
                       "response" if own else "revisit", None if own else first[data])
    return found


def compared(index):
    return {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
            for r in index.collect()}


def test_pages_round_trip(lspark):
    pages = lspark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    rows += [(10_000 + i, rows[i][1], rows[i // 3][2]) for i in range(60)]
    frame = lspark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    index = warc.archived(frame)
    assert compared(index) == brute(rows)
    ranked = [(r.url_key, r.captured_at, r.page_id)
              for r in index.orderBy("capture_rank").collect()]
    assert ranked == sorted(ranked) and len(ranked) == len(rows)
    assert [r.capture_rank for r in index.orderBy("capture_rank").collect()] == list(
        range(len(rows)))


def test_pages_at_the_edges(lspark):
    long, odd = "x" * 150, "a\r\n\r\nWARC/1.1\r\nb\x00é🙂" * 20
    rows = [(5, "http://a.b/c\r\nX: y", long), (3, "http://a.b/c", long), (4, None, long),
            (6, "http://é.x/ä ö", odd), (7, "http://q", odd), (8, None, None), (9, "", ""),
            (10, "http://s", "y" * 99), (11, "http://s", "y" * 99), (12, "u", "z" * 3_000_000)]
    frame = lspark.createDataFrame([(*r, 1) for r in rows],
                                   "page_id long, url string, html string, sha int")
    assert compared(warc.archived(frame)) == brute(rows)
    twice = lspark.createDataFrame([(1, "u", long), (1, "u", long), (None, "v", long),
                                    (None, None, None)], "page_id long, url string, html string")
    got = sorted((r.page_id or 0, r.record_type, r.payload_bytes)
                 for r in warc.archived(twice).collect())
    assert got == [(0, "response", 0), (0, "response", 150), (1, "response", 150),
                   (1, "response", 150)]
    assert warc.archived(frame.limit(0)).collect() == []


def test_damage_is_found():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    assert [(o, b) for o, _, b in warc.parse(gzip.compress(record) + gzip.compress(record))] == [
        (0, b"abcd"), (len(record), b"abcd")]
    for bad in (record[:-2], record[5:], record.replace(b"abcd", b"abcde")):
        with pytest.raises(ValueError):
            list(warc.parse(gzip.compress(bad)))


def test_times_order_the_captures_of_a_url(lspark):
    frame = lspark.createDataFrame(
        [(1, "u", "a", "2020-01-03"), (2, "u", "b", "2020-01-01"), (3, "t", "c", None)],
        "page_id long, url string, html string, at string")
    folder = warc.staging_path(lspark, "archives")
    warc.write_archives(frame, folder, captured="at")
    index = warc.merged_index(warc.sorted_runs(lspark, folder))
    assert [r.page_id for r in index.orderBy("capture_rank").collect()] == [3, 2, 1]


def test_a_payload_of_half_the_pages_divides(lspark):
    """Neither broadcast nor the skew split of adaptive plans helps here."""
    rows = [(i, f"http://h{i % 7}/{i}", "hot" * 50 if i % 2 else f"{i}" * 60) for i in range(2_000)]
    frame = lspark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: lspark.conf.get(k) for k in off}
    for k, v in off.items():
        lspark.conf.set(k, v)
    try:
        spread = warc.records(frame).where("value like '%: revisit%'").rdd.mapPartitions(
            lambda part: [sum(1 for _ in part)]).collect()
        assert sum(spread) == 999 and max(spread) < 500
        index = warc.archived(frame)
        parts = index.where("record_type = 'revisit'").rdd.mapPartitions(
            lambda part: [sum(1 for _ in part)]).collect()
        assert sum(parts) == 999 and max(parts) < 500
        assert compared(index) == brute(rows)
    finally:
        for k, v in before.items():
            lspark.conf.set(k, v)


def test_ranges_are_bounded(lspark):
    rows = [(i, "http://one/page", f"{i}" * 40) for i in range(3_000)]
    frame = lspark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    folder = warc.staging_path(lspark, "archives")
    warc.write_archives(frame, folder, per_file=200)
    index = warc.merged_index(warc.sorted_runs(lspark, folder), range_rows=100).collect()
    assert [r.page_id for r in sorted(index, key=lambda r: r.capture_rank)] == list(range(3_000))
