"""CSV whose quoted fields hold line breaks, read by as many tasks as the text has splits.

A split does not know whether it begins inside a quoted field. So each is read under both
assumptions first, which gives a function from the state at its begin to the state at its end; their
composition along a file gives the true state of every split. Then each split is cut into records
from its true state. A record that goes on in the next split leaves its pieces as fragments, a few
per split, which are put together by file and place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CORRUPT = "_malformed"


def ends_open(line: str, opened: bool) -> bool:
    """Whether a line ends inside a quoted field, from whether it begins inside one. A quote opens
    a field only at its begin; a doubled one stands for itself."""
    i = 0
    while True:
        if not opened:
            if line[i:i + 1] != '"':
                i = line.find(",", i) + 1
                if not i:
                    return False
                continue
            opened, i = True, i + 1
        i = line.find('"', i)
        if i < 0:
            return True
        if line[i + 1:i + 2] == '"':
            i += 2
            continue
        opened = False
        i = line.find(",", i) + 1
        if not i:
            return False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value")


def _splits(batches) -> Iterator[tuple[str, int, pa.Array, bool]]:
    """(file, block, lines, whether the split begins here): a task's lines in their order."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        here = list(zip(files, blocks))
        cuts = [0] + [i for i in range(1, len(here)) if here[i] != here[i - 1]] + [len(here)]
        for a, b in zip(cuts, cuts[1:]):
            yield (*here[a], batch.column("value").slice(a, b - a), here[a] != last)
            last = here[a]


def _quoted(lines: pa.Array) -> np.ndarray:
    """The places of the lines with quotes: the only ones that change the state."""
    return np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))


def _transitions(batches) -> Iterator[pa.RecordBatch]:
    out: list[list] = []
    for file, block, lines, first in _splits(batches):
        if first:
            out.append([file, block, False, True])
        for i in _quoted(lines):
            line = lines[int(i)].as_py()
            out[-1][2:] = [ends_open(line, state) for state in out[-1][2:]]
    columns = list(zip(*out)) if out else [[]] * 4
    yield pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
         pa.array(columns[2], pa.bool_()), pa.array(columns[3], pa.bool_())],
        names=["file", "block", "closed", "opened"])


def open_splits(lines: DataFrame) -> set[tuple[str, int]]:
    """The splits that begin inside a quoted field: one for each record that crosses into a split,
    so their number does not grow with that of the splits."""
    steps = lines.mapInArrow(_transitions, "file string, block long, closed boolean, opened boolean")
    along = F.array_sort(F.collect_list(F.struct("block", "closed", "opened")))
    state = F.aggregate(
        along, F.expr("named_struct('open', false, 'begins', cast(array() AS array<bigint>))"),
        lambda acc, s: F.struct(
            F.when(acc["open"], s["opened"]).otherwise(s["closed"]).alias("open"),
            F.when(acc["open"], F.concat(acc["begins"], F.array(s["block"])))
            .otherwise(acc["begins"]).alias("begins")))
    found = steps.groupBy("file").agg(state.alias("s")).select(
        "file", F.explode("s.begins").alias("block"))
    return {(r["file"], r["block"]) for r in found.collect()}


_PIECE = pa.schema([("file", pa.string()), ("block", pa.int64()), ("kind", pa.int32()),
                    ("record", pa.string())])
_PIECE_SQL = "file string, block long, kind int, record string"
WHOLE, TAIL, HEAD = 0, 1, 2


def _cut(batches, begins: set[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    """Whole records, and per split the tail of a record from before and the head of one that goes
    on. A split inside one record is a tail that does not close."""
    opened, tail, held, place = False, False, [], None

    def rest() -> list[tuple]:
        return [(*place, TAIL if tail else HEAD, "\n".join(held))] if held else []

    for file, block, lines, first in _splits(batches):
        out: list[tuple] = []
        if first:
            out += rest()
            opened = tail = (file, block) in begins
            held, place = [], (file, block)
        texts, quoted = lines.to_pylist(), set(_quoted(lines).tolist())
        for i, line in enumerate(texts):
            held.append(line)
            if i in quoted:
                opened = ends_open(line, opened)
            if not opened:
                out.append((*place, TAIL if tail else WHOLE, "\n".join(held)))
                held, tail = [], False
        yield pa.RecordBatch.from_pylist(
            [dict(zip(_PIECE.names, row)) for row in out], schema=_PIECE)
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(_PIECE.names, rest()[0]))], schema=_PIECE)


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, record): every record's text, line breaks in quotes as one newline."""
    from lossledger.session import stage  # the session's own module reads files

    lines = _lines(spark, path)
    begins = open_splits(lines)
    pieces = stage(lines.mapInArrow(lambda it: _cut(it, begins), _PIECE_SQL), "records")
    broken = pieces.where(F.col("kind") != WHOLE)
    # A head begins a record, the tails after it are the rest.
    order = Window.partitionBy("file").orderBy("block", "kind")
    joined = (broken.withColumn("number", F.sum((F.col("kind") == HEAD).cast("int")).over(order))
              .groupBy("file", "number")
              .agg(F.array_sort(F.collect_list(F.struct("block", "kind", "record"))).alias("parts"))
              .select("file", F.col("parts")[0]["block"].alias("block"),
                      F.array_join(F.col("parts.record"), "\n").alias("record")))
    return pieces.where(F.col("kind") == WHOLE).select("file", "block", "record").unionByName(joined)


def read_records(spark: SparkSession, path: str, names: list[str], header: str) -> DataFrame:
    """The columns as text and ``_malformed``: the record where its number of fields is wrong."""
    schema = ", ".join(f"`{n}` string" for n in [*names, CORRUPT])
    found = records(spark, path).where((F.col("record") != "") & (F.col("record") != header))
    parsed = F.from_csv("record", schema, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "quote": '"', "escape": '"',
        "multiLine": "true"})
    return found.select(parsed.alias("r")).select("r.*")
