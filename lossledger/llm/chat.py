"""Chat formatting of reply trees.

1. A node is a message with the message it answers. Joins of the table with itself double the
   distance that every node looks back, so a tree of depth d takes log2(d) rounds, also where one
   conversation holds most rows. They give each leaf its root and the score of its path.
2. The branches of a conversation are ranked by score; the best ``branches`` are chosen.
3. The same doubled links, applied from the farthest to the nearest, list the nodes of each chosen
   path without visiting it step by step.
4. Each path becomes one text. A path is one value, so its own texts meet in one task; rows arrive
   sorted and are formatted as they come.

Template, per message: <|im_start|>ROLE, line feed, TEXT, <|im_end|>, line feed. Control strings
inside texts and roles are escaped: a backslash goes between "<" and "|", after any that are there
already, and taking one away restores the text. In roles a line feed is written as backslash n and
a backslash as two.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.llm.frames import ROW, ranked
from lossledger.session import stage

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"

_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_MESSAGE = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


# -- trees -----------------------------------------------------------------------------------


def turns_as_tree(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """(node, parent, conv, role, text, score) of rows that follow one another by turn.

    A conversation without branches is a tree of one path. Equal turns follow by role and text;
    null turns come last. Rows without a conversation id form one conversation.
    """
    rows = ranked(turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                               F.col(role).alias("role"), F.col(text).alias("text")),
                  F.col("conv").asc_nulls_last(), F.col("turn").asc_nulls_last(),
                  F.col("role"), F.xxhash64("text"))
    roots = rows.groupBy("conv").agg(F.min(ROW).alias("root")).select("root")
    return rows.join(roots, F.col(ROW) == F.col("root"), "left").select(
        F.col(ROW).alias("node"), F.when(F.col("root").isNull(), F.col(ROW) - 1).alias("parent"),
        "conv", "role", "text", F.lit(0.0).alias("score"))


def best_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(path, branch, path_score, node, back) for the chosen paths.

    ``nodes(node, parent, conv, score)``: node ids are unique; a parent that is null, missing or in
    another conversation makes a root. ``path`` is the id of its leaf, ``branch`` its rank in the
    conversation from 1 by the sum of scores (null counts 0), equal ones by the smaller leaf, and
    ``back`` the number of messages after the node. Nodes on a cycle, and what only answers such
    nodes, have no root and are left out.
    """
    plain = nodes.select("node", "parent", "conv", F.coalesce("score", F.lit(0.0)).alias("score"))
    parents = plain.select(F.col("node").alias("p"), F.col("conv").alias("pc"))
    linked = plain.join(parents, (F.col("parent") == F.col("p"))
                        & F.col("conv").eqNullSafe(F.col("pc")), "left")
    state = stage(linked.select("node", "conv", F.col("p").alias("up"),
                                F.col("score").alias("total")), "nodes")
    leaves = stage(state.join(state.select(F.col("up").alias("node")).distinct(), "node",
                              "left_anti").select("node", "conv"), "leaves")
    jumps, count = [], state.count()
    while True:
        jump = state.where("up is not null").select("node", "up")
        if jump.isEmpty() or 1 << len(jumps) > max(count, 1):
            break
        jumps.append(jump)
        above = state.select(F.col("node").alias("up"), F.col("up").alias("next"),
                             F.col("total").alias("more"))
        # Nodes that have reached their root only wait; each round joins the others.
        moved = state.where("up is not null").join(above, "up").select(
            "node", "conv", F.col("next").alias("up"),
            (F.col("total") + F.col("more")).alias("total"))
        state = stage(state.where("up is null").union(
            moved.select(*state.columns)), "nodes")

    order = Window.partitionBy("conv").orderBy(F.desc("total"), "node")
    chosen = (state.where("up is null").join(leaves.select("node"), "node", "left_semi")
              .withColumn("branch", F.row_number().over(order))
              .where(F.col("branch") <= branches))
    paths = stage(chosen.select(F.col("node").alias("path"), "branch",
                                F.col("total").alias("path_score"), "node",
                                F.lit(0).cast("long").alias("back")), "paths")
    for k, jump in reversed(list(enumerate(jumps))):
        further = paths.join(jump, "node").select(
            "path", "branch", "path_score", F.col("up").alias("node"),
            (F.col("back") + (1 << k)).alias("back"))
        paths = stage(paths.union(further), "paths")
    return paths


# -- format ----------------------------------------------------------------------------------

_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                   T.StructField("end", T.LongType())]))


def formatted(nodes: DataFrame, branches: int = 1, learned: str = LEARNED) -> DataFrame:
    """(conv, branch, path_score, formatted, loss) per chosen path of ``nodes``.

    ``loss`` lists the spans of ``formatted``, in code points, that a model learns from: the text
    of each message of the role ``learned``, without its markers. Null roles and texts are empty.
    No nodes give no rows.
    """
    rows = best_paths(nodes, branches).join(nodes.select("node", "conv", "role", "text"), "node")
    rows = rows.select("path", "back", "branch", "path_score", "conv", "role", "text")
    schema = T.StructType([rows.schema["conv"], rows.schema["branch"], rows.schema["path_score"],
                           T.StructField("formatted", T.StringType()),
                           T.StructField("loss", _SPANS)])
    return rows.repartition("path").sortWithinPartitions("path", F.desc("back")).mapInArrow(
        lambda it: _format(it, learned), schema)


def _format(batches, learned: str):
    """Rows come path by path, the root first."""
    path, head, kind, parts, spans, at = None, None, None, [], [], 0
    for batch in batches:
        out, kind = [], batch.schema.field("conv").type
        for row in batch.to_pylist():
            if row["path"] != path:
                if parts:
                    out.append((*head, "".join(parts), spans))
                path, parts, spans, at = row["path"], [], [], 0
                head = row["conv"], row["branch"], row["path_score"]
            role, text = row["role"] or "", escape(row["text"] or "")
            front = f"{OPEN}{escape_role(role)}\n"
            if role == learned:
                spans.append({"start": at + len(front), "end": at + len(front) + len(text)})
            parts += [front, text, CLOSE, "\n"]
            at += len(front) + len(text) + len(CLOSE) + 1
        if out:
            yield _conversations(out, kind)
    if parts:
        yield _conversations([(*head, "".join(parts), spans)], kind)


def _conversations(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [kind, pa.int32(), pa.float64(), pa.string(), span]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, k) for column, k in zip(zip(*rows), kinds)],
        names=["conv", "branch", "path_score", "formatted", "loss"])


def messages(text: str) -> list[tuple[str, str]]:
    """(role, text) of each message of a formatted conversation."""
    found, at = [], 0
    for m in _MESSAGE.finditer(text):
        if m.start() != at:
            break
        at = m.end()
        found.append((unescape_role(m[1]), unescape(m[2])))
    if at != len(text):
        raise ValueError("not a formatted conversation")
    return found


def digests(conversations: DataFrame) -> DataFrame:
    """What formatted conversations hold, read back from them: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256 and formatted_chars."""
    schema = T.StructType([T.StructField("conv_id", conversations.schema["conv"].dataType)] + [
        T.StructField(n, T.StringType() if "sha" in n else T.LongType()) for n in
        ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")])
    return conversations.select("conv", "formatted", "loss").mapInArrow(_digest, schema)


def _digest(batches):
    for batch in batches:
        out = []
        for row in batch.select(["formatted", "loss"]).to_pylist():
            text = row["formatted"]
            turns = messages(text)
            whole = "".join(f"{r}\n{t}\n" for r, t in turns)
            learned = "".join(unescape(text[s["start"]:s["end"]]) for s in row["loss"])
            out.append((len(turns), _sha(whole), len(learned), _sha(learned), len(text)))
        columns = list(zip(*out)) or [()] * 5
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                   "formatted_chars"])


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
