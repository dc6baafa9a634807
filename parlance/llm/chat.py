"""Reply trees to formatted conversations.

Messages point to the message they reply to. Pointers are doubled by self-joins, so a thread of
depth d takes log2(d) rounds; each round adds up scores on the way. Leaves are branches: they are ranked
inside their tree by the mean score of their path, the best are chosen, and the same tables of
pointers, taken from far to near, list each chosen path's messages once each.

Template: ``<s>[INST]role[/INST]text</s>`` for each turn. A backslash goes before every control
string and every backslash inside roles and texts, so that no text can end its turn and
every conversation can be read back exactly. The loss mask covers the assistants' texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.llm.common import column, sent, written

OPEN, ROLE, TEXT, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
_CONTROL = r"</?s>|\[/?INST\]"
_TO_ESCAPE = re.compile(rf"\\|{_CONTROL}")
_ESCAPED = re.compile(rf"\\(\\|{_CONTROL})")
_TOKEN = re.compile(rf"\\(?:\\|{_CONTROL})|({_CONTROL})")
ASSISTANT = "assistant"


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one text, and the spans of its assistant texts in code points."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{ROLE}{escape(role)}{TEXT}", escape(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation; the inverse of ``format_turns``."""
    turns, role, start = [], "", 0
    for mark in _TOKEN.finditer(formatted):
        if mark.group(1) == ROLE:
            start = mark.end()
        elif mark.group(1) == TEXT:
            role, start = unescape(formatted[start : mark.start()]), mark.end()
        elif mark.group(1) == CLOSE:
            turns.append((role, unescape(formatted[start : mark.start()])))
    return turns


@dataclass
class Messages:
    """Replies (node, parent, score) and, apart from them, texts (node, conv, role, text): only the narrow half is searched.

    Nodes are unique among replies; texts may hold several rows of a node, which are then turns one after the other.
    """

    replies: DataFrame
    texts: DataFrame


def linear_threads(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Messages:
    """Conversations given by turn as messages, each replying to the one before.

    Turns are ordered by number, NULL first, then by a hash of role and text; repeated rows are turns of
    their own. NULL is a conversation of its own, apart from that of an empty id; NULL roles and texts are empty. A
    message's node is 128 bits of hash over all its columns, so texts are named where they are, and only hashes are put
    in order. Texts may have any length. An empty table gives no messages.
    """
    plain = rows.select(
        column(conv).alias("conv"), column(turn).alias("turn"), F.coalesce(column(role), F.lit("")).alias("role"),
        F.coalesce(column(text), F.lit("")).alias("text"))

    def half(seed: int) -> Column:  # a NULL leaves a hash as it is, so it is said whether there is one
        return F.xxhash64(F.lit(seed), F.col("conv").isNull(), "conv", F.col("turn").isNull(), "turn", "role", "text")

    named = plain.withColumn("node", F.struct(half(1).alias("h1"), half(2).alias("h2")))
    order = W.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "node")
    narrow = written(named.select("conv", "turn", "node").distinct(), "turns")
    replies = narrow.select("node", F.lag("node").over(order).alias("parent"), F.lit(0.0).alias("score"))
    return Messages(replies, named.select("node", "conv", "role", "text"))


def _doubled(messages: DataFrame, max_rounds: int) -> tuple[list[DataFrame], DataFrame]:
    """Tables (node, up) that lead 2^k replies up, and (node, steps, sum, root) of every node's whole path.

    A node leaves the rounds when it has reached its root, so later rounds hold only the deep threads.
    A parent that is not in the table makes its reply a root.
    """
    nodes = written(messages.select("node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")), "messages")
    known = nodes.select(F.col("node").alias("up"))
    step = written(nodes.join(known, F.col("parent") == F.col("up"), "left").select(
        "node", "up", F.lit(1).cast("bigint").alias("steps"), F.col("score").alias("sum"), F.col("node").alias("root")), "replies")
    tables, finished = [], step.where("up IS NULL")
    while True:
        active = step.where("up IS NOT NULL")
        if active.isEmpty():
            return tables, finished.drop("up")
        if len(tables) > max_rounds:
            raise ValueError("replies form a circle")
        tables.append(active.select("node", "up"))
        above = finished.unionByName(active).selectExpr("node AS mid", "up AS up_", "steps AS steps_", "sum AS sum_", "root AS root_")
        step = written(active.join(above, F.col("up") == F.col("mid")).select(
            "node", F.col("up_").alias("up"), (F.col("steps") + F.col("steps_")).alias("steps"),
            (F.col("sum") + F.col("sum_")).alias("sum"), F.col("root_").alias("root")), "replies")
        finished = finished.unionByName(step.where("up IS NULL"))


def best_paths(messages: DataFrame, n_best: int = 1, max_rounds: int = 40) -> DataFrame:
    """(root, leaf, rank, node, height) for every message of every chosen path; height 0 is the leaf.

    Messages have node (unique), parent and score, NULL counting as 0. Branches of a tree are ranked by
    the mean score of their messages, then by leaf. Replies in a circle are an error. A message that many others reply
    to is a hot key of narrow rows, whose join Spark splits. An empty table gives no rows.
    """
    tables, whole = _doubled(messages, max_rounds)
    leaves = whole.select("node", "root", (F.col("sum") / F.col("steps")).alias("mean"))
    if tables:
        leaves = leaves.join(tables[0].select(F.col("up").alias("node")).distinct(), "node", "left_anti")
    rank = F.row_number().over(W.partitionBy("root").orderBy(F.desc("mean"), "node"))
    chosen = written(leaves.withColumn("rank", rank).where(F.col("rank") <= n_best), "leaves")
    members = chosen.select("root", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("bigint").alias("height"))
    for k in reversed(range(len(tables))):  # every height is one sum of powers of two, so no message comes twice
        up = tables[k].select(F.col("node").alias("from"), "up")
        higher = members.join(up, F.col("node") == F.col("from")).select(
            "root", "leaf", "rank", F.col("up").alias("node"), (F.col("height") + (1 << k)).alias("height"))
        members = written(members.unionAll(higher), "paths")
    return members


def conversations(messages: DataFrame | Messages, n_best: int = 1) -> DataFrame:
    """One row per chosen path: conv, leaf, rank, formatted and mask, the spans that count for the loss.

    Messages have node, parent, score, conv, role and text, in one table or two. NULL roles and texts count as empty. Each
    path is one conversation and one output row, so its turns, however long, meet in one task. An empty table gives no
    rows; other columns are not read.
    """
    if isinstance(messages, DataFrame):
        messages = Messages(messages, messages)
    paths = best_paths(messages.replies, n_best).select("leaf", "rank", "node", "height")
    turns = messages.texts.select("node", "conv", "role", "text").join(paths, "node").groupBy("leaf", "rank").agg(
        F.first("conv").alias("conv"), F.sort_array(F.collect_list(F.struct(-F.col("height"), "role", "text"))).alias("turns"))
    kind, of_leaf = (turns.schema[c].dataType.simpleString() for c in ("conv", "leaf"))
    given = turns.select("conv", "leaf", "rank", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [format_turns([(r or "", t or "") for r, t in zip(roles, texts)])
                    for roles, texts in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:3], pa.array([m[0] for m in made], pa.string()),
                pa.array([[{"start": s, "end": e} for s, e in m[1]] for m in made], _SPANS),
            ], ["conv", "leaf", "rank", "formatted", "mask"])

    return sent(given).mapInArrow(
        run, f"conv {kind}, leaf {of_leaf}, rank int, formatted string, mask array<struct<start:bigint,end:bigint>>")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
