"""Coded token files: static range asymmetric numeral system, independent interleaved blocks.

File format, all numbers little-endian:

    header   "RANS" | u16 version | u8 scale bits | u8 0 | u32 lanes | u32 block ids | u32 documents
             | u64 ids in this file | i64 ids before this file | u32 CRC of the frequency table
    documents  i64 key, u8 key is null, u32 ids: one entry per document, ids with the end id
    index    per block: u64 first id, u64 first byte (after the index), u32 bytes, u32 ids,
             u32 CRC-32 of the block's ids as little-endian unsigned 32-bit numbers
    blocks   per block: one u64 state per lane, then the u32 words of all lanes in reading order
    trailer  u32 CRC of everything before | a line feed

The index holds checkpoints: any block decodes alone, from its own bytes and the shared table. The
table belongs to a data set and is one small file next to the data. Symbol ``k`` of a block belongs
to lane ``k mod lanes``; all lanes advance together, as vectors. Spark's text writer appends the
line feed, so that files are written by Spark's own committer, one row one file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.llm.frames import partitions, running_total
from lossledger.llm.tokens import encoder
from lossledger.session import stage, staging_path

SCALE = 20
LANES = 1024
BLOCK = 1 << 18
END = 0
# Ids of one file, about; a file holds whole documents.
FILE = 1 << 21

_HEAD = struct.Struct("<4sHBBIIIQqI")
_DOC = np.dtype([("key", "<i8"), ("null", "u1"), ("ids", "<u4")])
_INDEX = np.dtype([("first", "<u8"), ("at", "<u8"), ("bytes", "<u4"), ("ids", "<u4"),
                   ("crc", "<u4")])
_LOW = np.uint64(1 << 31)
_PACKED_SQL = "part long, inner long, tokens long, docs binary, ids binary"


class Table:
    """Frequencies of all symbols, scaled to a sum of ``1 << bits``; each used one keeps some."""

    def __init__(self, frequencies: np.ndarray, bits: int = SCALE):
        self.bits = bits
        self.frequency = np.asarray(frequencies, np.uint64)
        if int(self.frequency.sum()) != 1 << bits:
            raise ValueError("frequencies do not add up to the scale")
        self.start = np.cumsum(self.frequency) - self.frequency
        self.symbol = np.repeat(np.arange(len(self.frequency), dtype=np.uint32),
                                self.frequency.astype(np.int64))
        self.crc = zlib.crc32(self.frequency.astype("<u4").tobytes())

    @staticmethod
    def scaled(counts: np.ndarray, bits: int = SCALE) -> np.ndarray:
        """Counts to frequencies: at least 1 where a count is not 0; the largest take the rest."""
        counts = np.asarray(counts, float)
        used = counts > 0
        if used.sum() > 1 << bits:
            raise ValueError("more symbols than the scale can tell apart")
        out = np.zeros(len(counts), np.int64)
        if not used.any():
            out[0] = 1 << bits
            return out
        out[used] = np.maximum(1, np.floor(counts[used] / counts.sum() * (1 << bits)))
        order = np.argsort(-out, kind="stable")
        rest = (1 << bits) - int(out.sum())
        while rest:
            if rest > 0:
                out[order[0]] += rest
                break
            spare = out[order] - 1
            take = np.minimum(spare, np.maximum(spare * -rest // max(int(spare.sum()), 1), 0))
            if not take.any():
                take[np.flatnonzero(spare > 0)[:-rest]] = 1
            out[order] -= take
            rest = (1 << bits) - int(out.sum())
        return out


def encode_block(ids: np.ndarray, table: Table, lanes: int) -> bytes:
    """The last symbols first, so that decoding runs forward."""
    n = len(ids)
    state = np.full(lanes, _LOW)
    bits, limit = np.uint64(table.bits), np.uint64(63 - table.bits)
    words: list[np.ndarray] = []
    for row in range(-(-n // lanes) - 1, -1, -1):
        symbols = ids[row * lanes:(row + 1) * lanes]
        x = state[:len(symbols)]
        f, s = table.frequency[symbols], table.start[symbols]
        full = x >= (f << limit)
        words.append(x[full].astype("<u4"))
        x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        state[:len(symbols)] = (q << bits) + (x - q * f) + s
    return state.astype("<u8").tobytes() + b"".join(w.tobytes() for w in reversed(words))


def decode_block(data: bytes, n: int, table: Table, lanes: int) -> np.ndarray:
    state = np.frombuffer(data, "<u8", lanes).astype(np.uint64)
    words = np.frombuffer(data, "<u4", offset=8 * lanes).astype(np.uint64)
    out = np.empty(n, np.uint32)
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    at = 0
    for first in range(0, n, lanes):
        size = min(lanes, n - first)
        x = state[:size]
        slot = x & mask
        symbols = table.symbol[slot.astype(np.int64)]
        out[first:first + size] = symbols
        x = table.frequency[symbols] * (x >> bits) + slot - table.start[symbols]
        low = np.flatnonzero(x < _LOW)
        x[low] = x[low] << np.uint64(32) | words[at:at + len(low)]
        at += len(low)
        state[:size] = x
    if at != len(words) or (state != _LOW).any():
        raise ValueError("a block does not end where its symbols do")
    return out


def encode_file(ids: np.ndarray, docs: np.ndarray, before: int, table: Table,
                lanes: int = LANES, block: int = BLOCK) -> bytes:
    """A file without the line feed that ends it."""
    index, blocks, at = np.zeros(-(-len(ids) // block), _INDEX), [], 0
    for i, first in enumerate(range(0, len(ids), block)):
        part = ids[first:first + block]
        blocks.append(encode_block(part, table, lanes))
        index[i] = (first, at, len(blocks[-1]), len(part),
                    zlib.crc32(part.astype("<u4").tobytes()))
        at += len(blocks[-1])
    body = _HEAD.pack(b"RANS", 1, table.bits, 0, lanes, block, len(docs), len(ids), before,
                      table.crc) + docs.tobytes() + index.tobytes() + b"".join(blocks)
    return body + struct.pack("<I", zlib.crc32(body))


class File:
    """Reads a coded file; blocks decode one by one and in any order."""

    def __init__(self, data: bytes, table: Table):
        if len(data) < _HEAD.size + 5 or data[-1:] != b"\n":
            raise ValueError("a coded file is cut short")
        body, (crc,) = data[:-5], struct.unpack("<I", data[-5:-1])
        magic, version, bits, _, self.lanes, self.block, docs, self.size, self.before, own = (
            _HEAD.unpack_from(body))
        if magic != b"RANS" or version != 1:
            raise ValueError("not a coded file")
        if crc != zlib.crc32(body):
            raise ValueError("a coded file is damaged")
        if bits != table.bits or own != table.crc:
            raise ValueError("a coded file needs another frequency table")
        self.table = table
        self.docs = np.frombuffer(body, _DOC, docs, _HEAD.size)
        at = _HEAD.size + self.docs.nbytes
        self.index = np.frombuffer(body, _INDEX, -(-self.size // self.block), at)
        self.data = memoryview(body)[at + self.index.nbytes:]

    def decoded(self, i: int) -> np.ndarray:
        """The ids of one block."""
        entry = self.index[i]
        at = int(entry["at"])
        ids = decode_block(self.data[at:at + int(entry["bytes"])], int(entry["ids"]), self.table,
                           self.lanes)
        if zlib.crc32(ids.astype("<u4").tobytes()) != entry["crc"]:
            raise ValueError(f"block {i} is damaged")
        return ids

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(key, ids before, ids, CRC of them) per document, one block in memory at a time."""
        at, have, block, crc = 0, np.zeros(0, np.uint32), 0, 0
        for key, null, size in self.docs.tolist():
            left, crc = size, 0
            while left:
                if not len(have):
                    have, block = self.decoded(block), block + 1
                crc = zlib.crc32(have[:left].astype("<u4").tobytes(), crc)
                taken = min(left, len(have))
                have, left = have[taken:], left - taken
            yield (None if null else key), self.before + at, size, crc
            at += size


# -- Spark -----------------------------------------------------------------------------------


def write_coded(docs: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text",
                end: int = END) -> None:
    """Writes the ids of every text, each followed by ``end``, in the order of ``key``.

    Each file holds whole documents that follow on one another, and its header tells how many ids
    come before it. A null text is empty; rows without a key come last; equal keys keep one row
    each, in any order, and are dealt over tasks like others. Keys are whole numbers; any other kind
    is refused. No rows write no files. The frequency table, over the ids of all texts, is a Parquet
    table beside them.
    """
    spark = docs.sparkSession
    if docs.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError(f"{key} is no column of whole numbers")
    order = [F.col("key").asc_nulls_last(), F.col("tie")]
    ordered = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"),
                          F.monotonically_increasing_id().alias("tie"))
    packed = stage(ordered.repartitionByRange(partitions(spark), *order)
                   .sortWithinPartitions(*order).drop("tie")
                   .withColumn("part", F.spark_partition_id().cast("long"))
                   .mapInArrow(lambda it: _pack(it, path, end), _PACKED_SQL), "packed")
    counts = packed.select("ids").mapInArrow(_count, "id int, n long").groupBy("id").agg(
        F.sum("n").alias("n"))
    found = {r["id"]: r["n"] for r in counts.collect()}  # at most one row per vocabulary entry
    if not found:
        return
    dense = np.zeros(max(found) + 1)
    dense[list(found)] = list(found.values())
    frequencies = Table.scaled(dense)
    spark.createDataFrame([(i, int(f)) for i, f in enumerate(frequencies) if f],
                          "id int, frequency long").coalesce(1).write.parquet(f"{folder}/table")

    totals = running_total(packed.groupBy("part").agg(F.sum("tokens").alias("n")),
                           "part", "n", "offset")
    coded = packed.join(totals, "part").select(
        (F.col("offset") + F.col("inner")).alias("before"), "docs", "ids").mapInArrow(
            lambda it: _code(it, frequencies), "blob binary")
    coded.select(F.col("blob").cast("string").alias("value")).write.option(
        "maxRecordsPerFile", 1).text(f"{folder}/data")


def read_coded(spark: SparkSession, folder: str) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) per document, decoded from the files."""
    out = "key long, start long, n_tokens long, ids_crc32 long"
    table = spark.read.schema("id int, frequency long").parquet(f"{folder}/table").collect()
    dense = np.zeros(max(r["id"] for r in table) + 1, np.int64)
    dense[[r["id"] for r in table]] = [r["frequency"] for r in table]
    files = spark.read.format("binaryFile").load(f"{folder}/data")
    return files.select("content").mapInArrow(lambda it: _decode(it, dense), out)


def coded_ids(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the coded files and reads them back: (key, start, n_tokens, ids_crc32)."""
    spark = docs.sparkSession
    folder = staging_path(spark, "coded")
    write_coded(docs, folder, path, key, text)
    schema = T.StructType([docs.schema[key]] + [
        T.StructField(n, T.LongType()) for n in ("start", "n_tokens", "ids_crc32")])
    if docs.isEmpty():
        return spark.createDataFrame([], schema)
    return read_coded(spark, folder).withColumnRenamed("key", key)


def _pack(batches, path: str, end: int):
    """Whole documents until a file is full; one row per file."""
    tokens = encoder(path)
    held_ids: list[np.ndarray] = []
    held_docs: list[np.ndarray] = []
    size, inner, part = 0, 0, None
    for batch in batches:
        keys = batch.column("key")
        for row, ids, bounds in tokens.encode(batch.column("text")):
            part = batch.column("part")[0].as_py()
            flat = np.insert(ids, bounds[1:], end).astype(np.uint32)
            docs = np.zeros(len(bounds) - 1, _DOC)
            own = keys.slice(row, len(docs))
            docs["null"] = own.is_null().to_numpy(zero_copy_only=False)
            docs["key"] = own.fill_null(0).to_numpy()
            docs["ids"] = np.diff(bounds) + 1
            held_ids.append(flat)
            held_docs.append(docs)
            size += len(flat)
            if size >= FILE:
                yield _packed(part, inner, held_docs, held_ids)
                held_ids, held_docs, size, inner = [], [], 0, inner + size
    if size:
        yield _packed(part, inner, held_docs, held_ids)


def _packed(part, inner, docs, ids) -> pa.RecordBatch:
    flat = np.concatenate(ids)
    small = flat.max() < 1 << 16
    blob = (b"\x02" if small else b"\x04") + flat.astype("<u2" if small else "<u4").tobytes()
    return pa.RecordBatch.from_arrays([
        pa.array([part], pa.int64()), pa.array([inner], pa.int64()),
        pa.array([len(flat)], pa.int64()), pa.array([np.concatenate(docs).tobytes()]),
        pa.array([blob])], names=["part", "inner", "tokens", "docs", "ids"])


def _ids(blob: pa.Scalar) -> np.ndarray:
    data = blob.as_buffer()
    wide = data.to_pybytes()[:1] == b"\x04" if data.size < 2 else data[0] == 4
    return np.frombuffer(data, "<u4" if wide else "<u2", offset=1)


def _count(batches):
    total = np.zeros(0, np.int64)
    for batch in batches:
        for blob in batch.column("ids"):
            found = np.bincount(_ids(blob))
            if len(found) > len(total):
                total = np.append(total, np.zeros(len(found) - len(total), np.int64))
            total[:len(found)] += found
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(total[used])], names=["id", "n"])


def _code(batches, frequencies: np.ndarray):
    table = Table(frequencies)
    for batch in batches:
        before = batch.column("before").to_pylist()
        for i in range(batch.num_rows):
            docs = np.frombuffer(batch.column("docs")[i].as_buffer(), _DOC)
            blob = encode_file(_ids(batch.column("ids")[i]), docs, before[i], table)
            yield pa.RecordBatch.from_arrays([pa.array([blob])], names=["blob"])


def _decode(batches, frequencies: np.ndarray):
    table = Table(frequencies)
    for batch in batches:
        for content in batch.column("content"):
            rows = list(File(content.as_py(), table).documents())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)],
                names=["key", "start", "n_tokens", "ids_crc32"])
