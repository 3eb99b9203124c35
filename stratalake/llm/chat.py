"""Chat formatting: paths through reply trees as marked-up conversations with loss masks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import scratch

# The template's marks, and what stands for their characters inside roles and texts.
OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = {"\\": "\\b", "#": "\\h", ":": "\\c", "<": "\\l"}
LOSS_ROLE = "assistant"

_ESCAPE = str.maketrans(ESCAPES)
_BACK = {v: k for k, v in ESCAPES.items()}


def escape(text: str) -> str:
    """The text without any character that begins a mark; `unescape` gives it back."""
    return text.translate(_ESCAPE)


def unescape(text: str) -> str:
    return re.sub(r"\\[bhcl]", lambda m: _BACK[m[0]], text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """A conversation's text, and where in it (code points, end exclusive) the assistant's texts stand."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{BETWEEN}", escape(text)
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The roles and texts of a formatted conversation."""
    turns = []
    for part in formatted.split(CLOSE)[:-1]:
        role, _, text = part.removeprefix(OPEN).partition(BETWEEN)
        turns.append((unescape(role), unescape(text)))
    return turns


def chain(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees: each row replies to the one before it.

    Rows go by turn (null last), equal turns by role and text. Null roles and texts are empty. Rows without conv_id form one tree.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    tree = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    placed = rows.withColumn("tree", tree).withColumn("node", F.row_number().over(order).cast("long"))
    return placed.select(
        "conv_id", "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text"
    )


def ranked_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """The best root-to-leaf paths of reply trees (tree, node, parent, score): tree, rank, node, up (steps from the leaf).

    A branch's score is the sum of its nodes' scores (null counts 0); higher ones come first, equal ones by leaf. A node
    whose parent is null or missing is a root. Nodes on a cycle belong to no path from a root and are left out. (tree, node)
    must be unique.

    Self-joins double the ancestor each node knows and the score up to it, so a chain of 1,000 replies takes 10 rounds,
    not 1,000. The same steps, longest first, then list the chosen leaves' ancestors, each once.
    """
    base = scratch(nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")), "nodes")
    there = base.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    step = scratch(
        base.join(there, ["tree", "parent"], "left").select(
            "tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), F.col("score").alias("total")
        ),
        "steps",
    )
    steps, longest = [step], base.groupBy("tree").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    while (1 << (len(steps) - 1)) < longest and steps[-1].where("up is not null").limit(1).count():
        # nodes that have reached their root stay as they are; only the others are joined
        a, b = steps[-1].where("up is not null").alias("a"), steps[-1].alias("b")
        further = a.join(b, (F.col("a.tree") == F.col("b.tree")) & (F.col("a.up") == F.col("b.node"))).select(
            "a.tree", "a.node", "b.up", (F.col("a.total") + F.col("b.total")).alias("total")
        )
        steps.append(scratch(steps[-1].where("up is null").unionByName(further), "steps"))

    rooted = steps[-1].where("up is null")
    leaves = rooted.join(base.select("tree", F.col("parent").alias("node")).where("node is not null"), ["tree", "node"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    paths = scratch(chosen.select("tree", "rank", "node", F.lit(0).cast("long").alias("up")), "paths")
    for k in range(len(steps) - 1, -1, -1):
        jump = steps[k].where("up is not null").select("tree", "node", F.col("up").alias("to"))
        above = paths.join(jump, ["tree", "node"]).select("tree", "rank", F.col("to").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        paths = scratch(paths.unionByName(above), "paths")
    return paths


def format_conversations(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """One formatted conversation for each chosen path (see `ranked_paths`) of trees (conv_id, tree, node, parent, score, role, text).

    Returns conv_id, rank, formatted, and the loss mask as arrays of starts and ends. The template is
    `### <role>: <text></turn>` and a newline for each turn; the characters of its marks, and the backslash, are escaped in
    roles and texts, and `read_conversations` gives all turns back. Empty texts are turns too. An empty table gives no rows.
    """
    paths = ranked_paths(nodes, branches)
    turns = paths.join(nodes.select("conv_id", "tree", "node", "role", "text"), ["tree", "node"])
    grouped = turns.groupBy("tree", "rank").agg(
        F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text"))).alias("turns")
    )
    kind = nodes.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [format_turns([(t["role"], t["text"]) for t in turns.as_py()]) for turns in batch.column("turns")]
            starts, ends = ([[s[k] for s in spans] for _, spans in done] for k in (0, 1))
            longs = pa.list_(pa.int64())
            yield pa.record_batch(
                [batch.column("conv_id"), batch.column("rank"), pa.array([f for f, _ in done], pa.string()), pa.array(starts, longs), pa.array(ends, longs)],
                names=["conv_id", "rank", "formatted", "loss_starts", "loss_ends"],
            )

    return grouped.select("conv_id", "rank", "turns").mapInArrow(
        work, f"conv_id {kind}, rank int, formatted string, loss_starts array<bigint>, loss_ends array<bigint>"
    )


def read_conversations(formatted: DataFrame) -> DataFrame:
    """Digests of what formatted conversations and their masks say: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.select(["formatted", "loss_starts", "loss_ends"]).to_pylist():
                text = row["formatted"]
                turns, whole = read_turns(text), hashlib.sha256()
                for role, said in turns:
                    whole.update(f"{role}\n{said}\n".encode())
                loss = "".join(unescape(text[a:b]) for a, b in zip(row["loss_starts"], row["loss_ends"], strict=True))
                rows.append((len(turns), whole.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            columns = [pa.array(list(c)) for c in zip(*rows, strict=True)]
            if rows:
                yield pa.record_batch([batch.column("conv_id"), *columns], names=names)

    return formatted.mapInArrow(
        work,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
