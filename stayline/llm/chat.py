"""Reply trees as chat training text.

A message names its parent. Jump pointers are doubled by self-joins: after k
rounds a message knows the ancestor 2**k steps up and the score of the way there,
so depth d takes log2(d) rounds. Leaves end the branches; branches of a tree are
ranked by score, and only the chosen ones are spelled out, again by doubling:
each ancestor's distance has one binary form, so it is reached exactly once.

A conversation is written as marked turns. Control strings inside roles and
texts are escaped, so no text can end its turn or open another, and reading the
output back gives the messages again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.arrow import small_batches
from stayline.llm.rows import numbered
from stayline.sources.staging import stage

#: Marks of the template (fixed values of the format).
START = "<|im_start|>"
END = "<|im_end|>"
LEARNED = "assistant"


def escape(text: str) -> str:
    """No control mark is left: every ``<|`` becomes ``<\\|`` and every backslash two."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(text: str) -> str:
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S) if "\\" in text else text


def branches(messages: DataFrame, top: int = 1) -> DataFrame:
    """tree_id, leaf and node of every message on the ``top`` best branches of each tree, with its depth.

    ``messages`` has tree_id, node, parent (null for a root) and score (null: 0).
    ``node`` must be unique. A parent that is not there makes a root. A branch's
    score is the sum of its messages' scores; of equal sums the longer branch
    wins, then the smaller leaf. Messages on or below a circle of parents are left out.
    """
    nodes = stage(
        messages.select("tree_id", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")),
        "messages",
    )
    there = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("_there"))
    first = nodes.join(there, "parent", "left").select(
        "node", F.when(F.col("_there"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("steps"), "score"
    )
    start = stage(first, "jumps")
    jumps, done = [start.filter("up is not null")], start.filter("up is null")
    # No way up is longer than the number of messages; what goes on beyond is a circle.
    rounds = nodes.count().bit_length()
    while len(jumps) <= rounds and not jumps[-1].isEmpty():
        # Only messages that have not met their root go on, so short branches cost few rounds.
        live = jumps[-1]
        above = live.unionByName(done).select(
            F.col("node").alias("up"), F.col("up").alias("_up"), F.col("steps").alias("_steps"), F.col("score").alias("_score")
        )
        further = live.join(above, "up").select(
            "node",
            F.col("_up").alias("up"),
            (F.col("steps") + F.col("_steps")).alias("steps"),
            (F.col("score") + F.col("_score")).alias("score"),
        )
        new = stage(further, "jumps")
        jumps.append(new.filter("up is not null"))
        done = done.unionByName(new.filter("up is null"))
    whole = done.select("node", F.col("steps").alias("depth"), F.col("score").alias("total"))
    leaves = (
        nodes.select("tree_id", "node")
        .join(nodes.select(F.col("parent").alias("node")).distinct(), "node", "left_anti")
        .join(whole, "node")
    )
    best = Window.partitionBy("tree_id").orderBy(F.desc("total"), F.desc("depth"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    path = chosen.select("tree_id", F.col("node").alias("leaf"), "rank", "node")
    for jump in reversed(jumps):
        further = path.join(jump.select("node", "up"), "node").select("tree_id", "leaf", "rank", F.col("up").alias("node"))
        path = stage(path.unionByName(further), "paths")
    return path.join(whole.select("node", "depth"), "node")


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = [], []
        for turns in batch.column("_turns").to_pylist():
            parts, loss, at = [], [], 0
            for turn in turns:
                head = f"{START}{escape_role(turn['role'])}\n"
                body = escape(turn["text"])
                if turn["role"] == LEARNED:
                    loss.append({"start": at + len(head), "end": at + len(head) + len(body)})
                parts += [head, body, END, "\n"]
                at += len(head) + len(body) + len(END) + 1
            texts.append("".join(parts))
            spans.append(loss)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("tree_id"), batch.column("leaf"), batch.column("rank"),
                pa.array(texts, pa.string()), pa.array(spans, _SPANS),
            ],
            ["tree_id", "leaf", "rank", "formatted", "loss_spans"],
        )


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def format_trees(messages: DataFrame, top: int = 1) -> DataFrame:
    """tree_id, leaf, rank, formatted and loss_spans of the best branches.

    ``messages`` as for ``branches``, with role and text (null: empty). The spans
    are code point ranges of ``formatted`` that hold the assistant's texts. An
    empty table gives no rows. One conversation is one row, however long.
    """
    small_batches(messages.sparkSession)
    said = messages.select("node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = (
        branches(messages, top)
        .join(said, "node")
        .groupBy("tree_id", "leaf", "rank")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("_turns"))
    )
    kind = turns.schema["tree_id"].dataType.simpleString()
    schema = f"tree_id {kind}, leaf long, rank int, formatted string, loss_spans array<struct<start:long,end:long>>"
    return turns.mapInArrow(_write, schema)


def read_turns(formatted: str) -> list[dict]:
    """Roles and texts of a formatted conversation."""
    out = []
    for turn in formatted.split(START)[1:]:
        role, _, rest = turn.partition("\n")
        out.append({"role": unescape(role), "text": unescape(rest.removesuffix("\n").removesuffix(END))})
    return out


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        turns, learned = [], []
        for text, spans in zip(
            batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist(), strict=True
        ):
            turns.append(read_turns(text))
            learned.append("".join(unescape(text[s["start"] : s["end"]]) for s in spans))
        yield pa.RecordBatch.from_arrays(
            [batch.column("tree_id"), batch.column("formatted"), pa.array(turns, _TURNS), pa.array(learned, pa.string())],
            ["tree_id", "formatted", "turns", "loss_text"],
        )


def read_back(formatted: DataFrame) -> DataFrame:
    """tree_id, formatted, its turns (role, text) and the text under the loss mask."""
    kind = formatted.schema["tree_id"].dataType.simpleString()
    schema = f"tree_id {kind}, formatted string, turns array<struct<role:string,text:string>>, loss_text string"
    return formatted.select("tree_id", "formatted", "loss_spans").mapInArrow(_read, schema)


def chains(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) as reply trees: each turn answers the one before.

    Turns that repeat a number are taken in the order of role and text, nulls first.
    """
    columns = conversations.select("conv_id", "turn", "role", "text")
    rows = numbered(columns, [F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text")], "node")
    rows = stage(rows, "turns")
    roots = rows.groupBy("conv_id").agg(F.min("node").alias("node")).select("node", F.lit(True).alias("_root"))
    return rows.join(roots, "node", "left").select(
        F.col("conv_id").alias("tree_id"),
        "node",
        F.when(F.col("_root").isNull(), F.col("node") - 1).alias("parent"),
        F.lit(0.0).alias("score"),
        "role",
        "text",
    )
