"""Reply trees to conversations: paths by iterative self-joins, the best branches of each tree, one text for each.

A message names its parent within its conversation. Rounds of self-joins double the distance that each message sees
upwards (ancestor of the ancestor), so a chain of n replies takes log2(n) rounds over slim rows; the rounds give each
message its root, its depth and the score of its path. Leaves are ranked by the mean score of their path, and the
chosen ones are spread to their messages through the same tables of jumps, last round first.

Template: ``### role: text</turn>\\n`` for each turn. In roles and texts a backslash becomes ``\\b``, ``<`` ``\\l``, ``#``
``\\h``, and in roles ``:`` ``\\c``, so no control string can occur inside a turn; undoing the four in reverse order
gives the text back. The loss mask goes along as segments (text, loss); their texts joined are the formatted text.

Nulls and edges: a null role or text is empty; a null conversation is a conversation of its own; a message whose parent
is null or missing is a root; rows that repeat a message (same conversation and id) take the smallest role and text, in
that order; an empty table gives no rows. Messages on a cycle have no root and belong to no path. Extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

LEAD, SEP, END = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))


def escape(text: Column, role: bool = False) -> Column:
    for plain, coded in ESCAPES[: 4 if role else 3]:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, role: bool = False) -> Column:
    for plain, coded in reversed(ESCAPES[: 4 if role else 3]):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def chosen_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv, leaf, rank, node, depth) of the messages on the best branches of each tree. messages: conv (not null),
    node, parent, score; one row per (conv, node)."""
    nodes = messages.select("conv", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    known = nodes.select("conv", F.col("node").alias("parent"), F.lit(True).alias("known"))
    up = nodes.join(known, ["conv", "parent"], "left").select(
        "conv", "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.when(F.col("known"), 1).otherwise(0).cast("long").alias("depth"), "score",
    )
    # score: of the node and the depth - 1 messages above it; up: the message above those, null beyond the root
    jumps = [stash(up, "jumps")]
    nodes_n = None
    while True:
        now = jumps[-1]
        active = now.filter("up is not null")
        far = now.select("conv", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"), F.col("score").alias("score2"))
        moved = active.join(far, ["conv", "up"]).select(
            "conv", "node", F.col("up2").alias("up"), (F.col("depth") + F.col("depth2")).alias("depth"), (F.col("score") + F.col("score2")).alias("score"),
        )
        nxt = moved.unionByName(now.filter("up is null").select(moved.columns))
        if not active.head(1):
            break
        nodes_n = messages.count() if nodes_n is None else nodes_n
        if 1 << len(jumps) > 2 * nodes_n:  # only cycles are left
            now = now.filter("up is null")
            break
        jumps.append(stash(nxt, "jumps"))
    top = now.withColumn("mean", F.col("score") / (F.col("depth") + 1))
    parents = jumps[0].filter("up is not null").select("conv", F.col("up").alias("node")).distinct()
    leaves = top.join(parents, ["conv", "node"], "left_anti")
    # roots: a forest under one conversation has a best branch for each of its trees
    root = leaves
    if len(jumps) > 1:
        walk = leaves.select("conv", F.col("node").alias("leaf"), "node")
        for table in reversed(jumps[:-1]):
            step = table.filter("up is not null").select("conv", "node", "up")
            walk = walk.join(step, ["conv", "node"], "left").select("conv", "leaf", F.coalesce("up", "node").alias("node"))
        root = leaves.join(walk.select("conv", F.col("leaf").alias("node"), F.col("node").alias("root")), ["conv", "node"])
    else:
        root = leaves.withColumn("root", F.col("node"))
    rank = F.row_number().over(Window.partitionBy("conv", "root").orderBy(F.desc("mean"), F.desc("depth"), "node"))
    best = root.withColumn("rank", rank).filter(F.col("rank") <= branches).select("conv", F.col("node").alias("leaf"), "rank", "node", "depth")
    path = stash(best, "paths")
    for table in reversed(jumps[:-1]):
        step = table.filter("up is not null").select("conv", "node", "up", F.col("depth").alias("jump"))
        more = path.join(step, ["conv", "node"]).select("conv", "leaf", "rank", F.col("up").alias("node"), (F.col("depth") - F.col("jump")).alias("depth"))
        path = stash(path.unionByName(more), "paths")
    return path


def format_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv_id, leaf, rank, formatted, segments array<struct<text, loss>>), a row for each chosen path.
    messages: conv_id, node, parent, role, text, score (null: 0); loss covers the texts of role assistant."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))  # no id's text is that of a null one
    first = F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "parent", "score", "conv_id"))
    rows = stash(messages.groupBy(conv.alias("conv"), "node").agg(first.alias("m")).select("conv", "node", "m.*"), "messages")
    turns = chosen_paths(rows, branches).join(rows, ["conv", "node"])
    per_path = turns.groupBy("conv", "leaf", "rank").agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        part(F.concat(F.lit(LEAD), escape(t["role"], True), F.lit(SEP)), F.lit(False)),
        part(escape(t["text"]), t["role"] == "assistant"),
        part(F.lit(END), F.lit(False)),
    )))
    made = per_path.select("conv_id", "leaf", "rank", segments.alias("segments"))
    return made.select("conv_id", "leaf", "rank", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted text."""
    turns = F.filter(F.split(formatted, END), lambda x: x != "")
    body = lambda x: F.substr(x, F.lit(len(LEAD) + 1))
    return F.transform(turns, lambda x: F.struct(
        unescape(F.substring_index(body(x), SEP, 1), True).alias("role"),
        unescape(F.substr(body(x), F.length(F.substring_index(body(x), SEP, 1)) + F.lit(len(SEP) + 1))).alias("text"),
    ))


def masked(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return unescape(F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"]), ""))
