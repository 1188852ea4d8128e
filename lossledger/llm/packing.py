"""Packing by concatenation: documents' ids in one stream, cut every ``size`` ids.

The first pass encodes each text once and stages its ids with their place in the task's part of
the stream. The parts' totals, one row per task, are summed up: every id then has a global offset.
The second pass cuts each document where the stream crosses a multiple of ``size``; a document
that crosses one has boundary records on both sides. Only the last sequence is not full.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.llm import arrays as a
from lossledger.llm.frames import running_total
from lossledger.llm.tokens import encoder
from lossledger.session import stage

SIZE = 4096
END = 2

_ENCODED = T.StructType([T.StructField(n, T.LongType()) for n in ("part", "before", "tokens")]
                        + [T.StructField("ids", T.BinaryType())])
_PIECES = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", size: int = SIZE,
         end: int = END, with_ids: bool = False) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece of a document.

    A document's ids are those of its whole text (null: empty) and ``end``, so every row has at
    least one piece. ``start`` counts its ids before the piece, ``offset`` those before it in its
    sequence; both are without gaps. ids_crc32 is unsigned, over the ids as little-endian unsigned
    32-bit numbers. Rows are packed one by one, also those with equal or null keys. No rows give no
    rows. ``with_ids`` adds the ids themselves.
    """
    if size < 1:
        raise ValueError("a sequence has at least one id")
    kind = docs.schema[key].dataType
    out = T.StructType([T.StructField("key", kind), *_ENCODED])
    encoded = stage(docs.select(F.col(key).alias("key"), F.col(text).alias("text"),
                                F.spark_partition_id().cast("long").alias("part"))
                    .mapInArrow(lambda it: _encode(it, path, end), out), "encoded")
    totals = encoded.groupBy("part").agg(F.sum("tokens").alias("total"))
    placed = encoded.join(running_total(totals, "part", "total", "offset"), "part")
    pieces = T.StructType([T.StructField(key, kind)]
                          + [T.StructField(n, T.LongType()) for n in _PIECES]
                          + [T.StructField("ids", T.ArrayType(T.LongType()))] * with_ids)
    return placed.select("key", (F.col("before") + F.col("offset")).alias("at"), "ids").mapInArrow(
        lambda it: _cut(it, key, size, with_ids), pieces)


def _encode(batches, path: str, end: int):
    """Ids as 16-bit numbers if they fit, else 32-bit: the first byte of a row tells."""
    tokens = encoder(path)
    before = 0
    for batch in batches:
        blobs, counts = [], []
        for _, ids, bounds in tokens.encode(batch.column("text")):
            small = not len(ids) or (ids.max() < 1 << 16 and end < 1 << 16)
            flat = np.insert(ids, bounds[1:], end).astype("<u2" if small else "<u4")
            edges = bounds + np.arange(len(bounds))
            mark = b"\x02" if small else b"\x04"
            blobs += [mark + flat[x:y].tobytes() for x, y in zip(edges, edges[1:])]
            counts += list(np.diff(edges))
        sizes = np.array(counts, np.int64)
        yield pa.RecordBatch.from_arrays([
            batch.column("key"), batch.column("part"),
            pa.array(before + np.cumsum(sizes) - sizes), pa.array(sizes),
            pa.array(blobs, pa.binary())], names=["key", *_ENCODED.names])
        before += int(sizes.sum())


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<u2" if blob[0] == 2 else "<u4", offset=1).astype("<u4")


def _cut(batches, key: str, size: int, with_ids: bool):
    for batch in batches:
        at = batch.column("at").to_numpy()
        columns: list[list] = [[] for _ in _PIECES]
        take, parts = [], []
        for i, blob in enumerate(batch.column("ids")):
            ids = unpacked(blob.as_buffer().to_pybytes())
            first = int(at[i])
            place = 0
            while place < len(ids):
                sequence, offset = divmod(first + place, size)
                piece = ids[place:place + size - offset]
                row = (place, len(piece), zlib.crc32(piece.tobytes()), len(ids), sequence, offset)
                for column, value in zip(columns, row):
                    column.append(value)
                take.append(i)
                if with_ids:
                    parts.append(piece)
                place += len(piece)
        out = [batch.column("key").take(pa.array(take, pa.int64()))]
        out += [pa.array(c, pa.int64()) for c in columns]
        if with_ids:
            bounds = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int64)
            flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
            out.append(a.lists(flat.astype(np.int64), bounds, pa.int64()))
        yield pa.RecordBatch.from_arrays(out, names=[key, *_PIECES] + ["ids"] * with_ids)
