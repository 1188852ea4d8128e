"""Web archives and their capture index.

Writing: every page becomes a record; a payload that an earlier record (smaller id) has already is
a revisit of that record. Spark's text writer ends each record with the two blank lines that the
format asks for, so archives are written by Spark's own committer, as bounded gzip files.

Index: reading back, each task gives one run of captures, sorted by URL key and time. Runs meet by
ranges of the key (URL key, time, id), so that the captures of one URL, however many, may span
ranges; in each range a loser tree merges the runs' parts. A running total over the ranges turns
places into ranks of one global order.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossledger.llm.frames import partitions, running_total
from lossledger.session import stage, staging_path

# Payloads shorter than this are always written.
LEAST = 100
RECORDS_PER_FILE = 2_000
# When pages have no time of their own: this one plus their id in seconds.
EPOCH = 946_684_800

# Rows that one task merges: its memory does not grow with the archive.
RANGE_ROWS = 200_000
# Rows of one payload are dealt to this many join keys, whatever they hold of all rows.
SALTS = 16

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_CAPTURES_SQL = ("url_key string, captured_at string, page_id long, url string, "
                 "record_type string, payload_bytes long, payload_digest string, refers_to long, "
                 "file string, offset long")


def _salt(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS))


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                      F.lit(SALTS - 1).cast("long"))))


# -- writing ---------------------------------------------------------------------------------


def _record_id(page: Column, url: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("-")),
                          F.coalesce(url, F.lit("-")), digest))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, *c) for c in cuts)),
                    F.lit(">"))


def records(pages: DataFrame, least: int = LEAST, captured: str | None = None) -> DataFrame:
    """``pages(page_id, url, html)`` as (page_id, value): one record each, without its last blank
    lines.

    Of the pages with equal payloads of at least ``least`` bytes that with the smallest id is a
    response, and so is every row with that id; the others are revisits. A page without an id is a
    response. A null payload is empty, a null URL has no target line. ``captured`` names a column
    of times; without one, or where it is null, the time follows from the id.
    """
    seconds = F.lit(EPOCH) + F.coalesce(F.pmod(F.col("page_id"), F.lit(3_000_000_000)), F.lit(0))
    time = F.timestamp_seconds(seconds)
    if captured:
        time = F.coalesce(F.col(captured).cast("timestamp"), time)
    payload = F.coalesce(F.col("html"), F.lit(""))
    full = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
                        payload.alias("payload"), F.sha2(payload.cast("binary"), 256).alias("sha"))
    long = F.octet_length("payload") >= least
    # Counted and compared before any payload moves: one narrow row per page.
    first = (full.where(long).groupBy("sha").agg(
        F.min(F.struct("page_id", "url")).alias("any"),
        F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first"),
        F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
        .select(F.col("sha").alias("same"), "first"))
    first = stage(first, "payloads")
    dealt = _salt("page_id", "url") == F.col("salt")
    marked = full.join(_salted(first), long & (F.col("sha") == F.col("same")) & dealt, "left")
    again = F.coalesce(F.col("first.page_id") != F.col("page_id"), F.lit(False))

    def line(name: str, value: Column, when: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
        return text if when is None else F.when(when, text).otherwise("")

    clean = lambda url: F.regexp_replace(url, r"[\x00-\x20\x7f]", "%20")
    http = F.concat(F.lit(_HTTP), line("Content-Length", F.octet_length("payload").cast("string")),
                    F.lit("\r\n"))
    block = F.concat(http, F.when(again, "").otherwise(F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("url"), F.col("sha"))),
        line("WARC-Date", F.col("time")),
        line("WARC-Target-URI", clean(F.col("url")), F.col("url").isNotNull()),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("sha"))),
        line("WARC-Profile", F.lit(_PROFILE), again),
        line("WARC-Refers-To", _record_id(F.col("first.page_id"), F.col("first.url"),
                                          F.col("sha")), again),
        line("X-Page-ID", F.col("page_id").cast("string"), F.col("page_id").isNotNull()),
        line("X-Refers-To-Page-ID", F.col("first.page_id").cast("string"), again),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    return marked.select("page_id", F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, folder: str, least: int = LEAST,
                   captured: str | None = None, per_file: int = RECORDS_PER_FILE) -> None:
    """Archives of all pages; files hold at most ``per_file`` records. No rows, no records."""
    (records(pages, least, captured).select("value").write.option("compression", "gzip")
     .option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file).text(folder))


# -- reading ---------------------------------------------------------------------------------


class _Stream:
    """The bytes of a gzip file, decompressed as they are asked for."""

    def __init__(self, data: bytes):
        self.rest, self.zip, self.have, self.at = data, zlib.decompressobj(31), b"", 0

    def _more(self) -> bool:
        if not self.rest:
            return False
        got = self.zip.decompress(self.rest, 1 << 20)
        if self.zip.eof:
            self.rest, self.zip = self.zip.unused_data, zlib.decompressobj(31)
        else:
            self.rest = self.zip.unconsumed_tail
        self.have += got
        return True

    def take(self, n: int) -> bytes:
        while len(self.have) < n:
            if not self._more():
                raise ValueError("an archive is cut short")
        out, self.have = self.have[:n], self.have[n:]
        self.at += n
        return out

    def head(self) -> bytes | None:
        """Up to the next blank line, without it; None at the end."""
        while (cut := self.have.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.have:
                    raise ValueError("an archive is cut short")
                return None
        out = self.take(cut)
        self.take(4)
        return out


def parse(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record of a gzip archive."""
    stream = _Stream(data)
    while True:
        offset = stream.at
        head = stream.head()
        if head is None:
            return
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("a record does not begin where it should")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        block = stream.take(int(headers["Content-Length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where it should")
        yield offset, headers, block


def url_key(url: str | None) -> str:
    """Host labels from the last to the first, then path and query, in lower case; no scheme,
    leading www, port or fragment. Empty without a URL."""
    if not url:
        return ""
    rest = url.split("#", 1)[0].split("://", 1)[-1].lower()
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host = rest[:cut].rsplit("@", 1)[-1].split(":", 1)[0].removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + rest[cut:]


def _captures(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows = []
            for offset, headers, block in parse(content.as_py()):
                kind = headers["WARC-Type"]
                digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                size = None
                if kind == "response":
                    payload = block[block.index(b"\r\n\r\n") + 4:]
                    size = len(payload)
                    if hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError("a payload does not match its digest")
                url = headers.get("WARC-Target-URI")
                page, other = (headers.get(k) for k in ("X-Page-ID", "X-Refers-To-Page-ID"))
                rows.append((url_key(url), headers["WARC-Date"], page and int(page), url, kind,
                             size, digest, other and int(other), quote(path, safe="/:"), offset))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                     pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=[c.split()[0] for c in _CAPTURES_SQL.split(", ")])


def sorted_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The captures of the archives, each task's in order, with the number of their run."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return stage(files.select("path", "content").mapInArrow(_captures, _CAPTURES_SQL)
                 .withColumn("run", F.spark_partition_id())
                 .sortWithinPartitions("url_key", "captured_at", F.col("page_id").asc_nulls_last(),
                                       "file", "offset"), "runs")


# -- merging ---------------------------------------------------------------------------------


class LoserTree:
    """Merges sorted sequences of comparable items.

    Inner nodes hold the loser of their match and the overall winner is kept apart, so the next
    item costs one match per level, on the path of the sequence that has won.
    """

    def __init__(self, runs: Iterable[Iterable]):
        self.runs = [iter(r) for r in runs]
        self.size = max(1, len(self.runs))
        self.heads = [next(r, None) for r in self.runs] or [None]
        self.losers = [-1] * self.size
        self.winner = self._play(1)

    def _beats(self, x: int, y: int) -> bool:
        a, b = self.heads[x], self.heads[y]
        if a is None or b is None:
            return b is None and (a is not None or x < y)
        return a < b or (a == b and x < y)

    def _play(self, node: int) -> int:
        """Winner below ``node``; leaves are the nodes from ``size`` on."""
        if node >= self.size:
            return node - self.size
        left, right = self._play(2 * node), self._play(2 * node + 1)
        won, lost = (left, right) if self._beats(left, right) else (right, left)
        self.losers[node] = lost
        return won

    def __iter__(self):
        while self.heads[self.winner] is not None:
            at = self.winner
            yield self.heads[at]
            self.heads[at] = next(self.runs[at], None)
            node = (at + self.size) // 2
            while node >= 1:
                if self._beats(self.losers[node], at):
                    self.losers[node], at = at, self.losers[node]
                node //= 2
            self.winner = at


def _merge(batches) -> Iterator[pa.RecordBatch]:
    """The rows of one range come run by run, each in order; they leave in one order."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    rows = pa.Table.from_batches(tables).combine_chunks()
    key = list(zip(rows["url_key"].to_pylist(), rows["captured_at"].to_pylist(),
                   ((x is None, x or 0) for x in rows["page_id"].to_pylist()),
                   rows["file"].to_pylist(), rows["offset"].to_pylist(), range(rows.num_rows)))
    run = rows["run"].to_pylist()
    cuts = [0, *(i for i in range(1, len(run)) if run[i] != run[i - 1]), len(run)]
    order = [item[-1] for item in LoserTree(key[x:y] for x, y in zip(cuts, cuts[1:]))]
    merged = rows.take(pa.array(order)).append_column("at", pa.array(range(len(order)), pa.int64()))
    yield from merged.to_batches(max_chunksize=10_000)


def merged_index(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All captures with ``capture_rank``, their 0-based rank by URL key, time and id.

    Captures without an id come after others of the same URL and time; equal ones follow by file
    and place. No captures give no rows. There are so many ranges that none holds more than about
    ``RANGE_ROWS`` captures.
    """
    spark = runs.sparkSession
    n_ranges = max(partitions(spark), -(-runs.count() // range_rows))
    order = ["url_key", "captured_at", F.col("page_id").asc_nulls_last(), "file", "offset"]
    ranges = runs.repartitionByRange(n_ranges, *order).sortWithinPartitions("run", *order)
    merged = ranges.mapInArrow(_merge, f"{_CAPTURES_SQL}, run int, at long")
    merged = stage(merged.withColumn("part", F.spark_partition_id()), "merged")
    sizes = merged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    return merged.join(running_total(sizes, "part", "n", "before"), "part").withColumn(
        "capture_rank", F.col("before") + F.col("at")).drop("part", "before", "at", "run")


def resolved(index: DataFrame) -> DataFrame:
    """The index with payload_bytes of revisits, from the response that holds the payload.

    Responses know their size and are not joined. A digest that many revisits name is counted once
    before its response is looked up, and its revisits are dealt to several join keys.
    """
    again = index.where("record_type = 'revisit'").drop("payload_bytes")
    named = again.select(F.col("payload_digest").alias("digest")).distinct()
    sizes = index.where("record_type = 'response'").join(
        named, F.col("payload_digest") == F.col("digest"), "left_semi").groupBy(
        F.col("payload_digest").alias("digest")).agg(F.max("payload_bytes").alias("payload_bytes"))
    found = again.join(_salted(stage(sizes, "sizes")),
                       (F.col("payload_digest") == F.col("digest"))
                       & (_salt("file", "offset") == F.col("salt")), "left")
    return index.where("record_type <> 'revisit'").unionByName(found.select(*index.columns))


def archived(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Writes the pages to archives in the shared folder and reads their merged index back."""
    spark = pages.sparkSession
    folder = staging_path(spark, "archives")
    write_archives(pages, folder, least)
    return resolved(merged_index(sorted_runs(spark, folder)))
