"""Reply trees to formatted conversations with a loss mask, and back (operator 8).

A message has a tree, an id, a parent and a score. Iterated self-joins double each message's jump
towards its root (2, 4, 8, ... steps), which sums the scores of its path in a logarithmic number of
joins; leaves are ranked per tree by that score (then by depth, then by id), and the kept jumps list the
messages of each chosen path.

The template writes ``<s>[INST]user[/INST]``, ``assistant</s>`` and, for any other role,
``<<SYS>>role<<SYS>>text<</SYS>>``. Inside texts and roles a backslash goes before each backslash and
before each control string, so a text can't end its turn and every text can be read back. The loss
mask lists the code-point ranges of the assistants' (escaped) texts.

Cases: null text or role counts as empty; a parent that does not exist makes its message a root;
messages on a cycle of parents, or below one, have no root and are left out, as are messages without a
tree or id; of several messages with the same tree and id the least (by parent, role, text) stays;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.blocks import hand_off

CONTROL = r"</?s>|\[/?INST\]|<</?SYS>>"
_BODY = rf"((?:[^\\<\[]++|\\(?:\\|{CONTROL})|(?!{CONTROL})[<\[])*+)"
_TURN = re.compile(rf"<s>\[INST\]{_BODY}\[/INST\]|<<SYS>>{_BODY}<<SYS>>{_BODY}<</SYS>>|{_BODY}</s>")
_ESCAPED = re.compile(rf"\\(\\|{CONTROL})")


def escape(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), rf"\\|{CONTROL}", r"\\$0")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def reply_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """``tree, branch, depth, id, role, text`` of the ``top`` best branches of each tree.

    ``messages`` has ``tree, id, parent, score, role, text``; ``branch`` counts from 1, ``depth`` from 0
    at the root.
    """
    named = messages.where("tree is not null and id is not null").groupBy("tree", "id").agg(F.min(F.struct("parent", "role", "text", "score")).alias("m"))
    nodes = hand_off(named.select("tree", "id", "m.*"), "messages")
    known = nodes.select("tree", F.col("id").alias("parent"), F.lit(True).alias("exists"))
    state = nodes.join(known, ["tree", "parent"], "left").select("tree", "id", F.expr("case when exists then parent end").alias("jump"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"), F.lit(1).alias("size"))
    moving, rooted, levels = hand_off(state, "jumps"), None, []
    first = moving
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    for _ in range(max(0, largest - 1).bit_length() + 1):
        # Messages that reached their root stay; only the others go on.
        reached = moving.where("jump is null")
        rooted = reached if rooted is None else rooted.unionByName(reached)
        jumping = moving.where("jump is not null")
        levels.append(jumping.select("tree", "id", "jump"))
        there = rooted.unionByName(jumping).select("tree", F.col("id").alias("jump"), F.col("jump").alias("next"), F.col("score").alias("more"), F.col("size").alias("further"))
        moving = hand_off(jumping.join(there, ["tree", "jump"]).select("tree", "id", F.col("next").alias("jump"), (F.col("score") + F.col("more")).alias("score"), (F.col("size") + F.col("further")).alias("size")), "jumps")
    # What still moves is on a cycle or below one.
    leaves = rooted.join(first.where("jump is not null").select("tree", F.col("jump").alias("id")), ["tree", "id"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("size"), "id"))
    path = leaves.withColumn("branch", rank).where(F.col("branch") <= top).select("tree", "branch", "id", (F.col("size") - 1).alias("depth"))
    path = hand_off(path, "paths")
    for k in reversed(range(len(levels))):
        up = path.join(levels[k], ["tree", "id"]).select("tree", "branch", F.col("jump").alias("id"), (F.col("depth") - 2**k).alias("depth"))
        path = hand_off(path.unionByName(up), "paths")  # else each level would plan all before it twice
    return path.join(nodes.select("tree", "id", "role", "text"), ["tree", "id"])


def format_paths(paths: DataFrame) -> DataFrame:
    """``tree, branch, formatted, loss array<struct<start, end>>``: one conversation per chosen path."""
    role, text = F.coalesce("role", F.lit("")), escape(F.col("text"))
    turn = (F.when(role == "user", F.concat(F.lit("<s>[INST]"), text, F.lit("[/INST]")))
            .when(role == "assistant", F.concat(text, F.lit("</s>")))
            .otherwise(F.concat(F.lit("<<SYS>>"), escape(role), F.lit("<<SYS>>"), text, F.lit("<</SYS>>"))))
    order = Window.partitionBy("tree", "branch").orderBy("depth")
    turns = paths.select("tree", "branch", "depth", turn.alias("turn"), F.when(role == "assistant", F.length(text)).alias("size"))
    turns = turns.withColumn("start", F.sum(F.length("turn")).over(order) - F.length("turn"))
    both = F.array_sort(F.collect_list(F.struct("depth", "turn", "start", "size")))
    found = turns.groupBy("tree", "branch").agg(both.alias("t"))
    loss = F.transform(F.filter("t", lambda x: x["size"].isNotNull()), lambda x: F.struct(x["start"].cast("long").alias("start"), (x["start"] + x["size"]).cast("long").alias("end")))
    return found.select("tree", "branch", F.array_join(F.transform("t", lambda x: x["turn"]), "").alias("formatted"), loss.alias("loss"))


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        user, role, other, assistant = m.groups()
        out.append(("user", unescape(user)) if user is not None else ("assistant", unescape(assistant)) if assistant is not None else (unescape(role), unescape(other)))
        at = m.end()
    return out


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    for batch in batches:
        formatted, loss = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        turns = [[{"role": r, "text": t} for r, t in read_turns(f)] for f in formatted]
        lost = ["".join(unescape(f[x["start"] : x["end"]]) for x in spans) for f, spans in zip(formatted, loss, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([len(f) for f in formatted], pa.int64()), pa.array(turns, turn), pa.array(lost, pa.string())], ["tree", "branch", "formatted_chars", "turns", "loss_text"])


def read_back(conversations: DataFrame) -> DataFrame:
    """``tree, branch, formatted_chars, turns array<struct<role, text>>, loss_text`` from the formatted text alone."""
    tree = conversations.schema["tree"].dataType.simpleString()
    return conversations.select("tree", "branch", "formatted", "loss").mapInArrow(_read, f"tree {tree}, branch int, formatted_chars long, turns array<struct<role:string,text:string>>, loss_text string")


def linear(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages of conversations given as rows by turn: each replies to the one before (equal turns by role, then text)."""
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = conversations.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("tree"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    rows = rows.withColumn("id", F.row_number().over(order).cast("long"))
    return rows.select("tree", "id", (F.col("id") - 1).alias("parent"), F.coalesce(F.length("text"), F.lit(0)).cast("double").alias("score"), "role", "text")
