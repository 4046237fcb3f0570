"""Reply trees as training conversations, in DataFrame operations only.

Every message names the message it answers. Self-joins that double their reach each time give every message its
depth and the score of its branch, and the same tables, read backwards, list the messages between a chosen
leaf and its root. The rounds grow with the logarithm of the deepest tree, not with its depth.

A turn is written ``<|im_start|>role<|im_sep|>text<|im_end|>``. Backslashes and control strings in a role or text are
escaped with a backslash, so they can't be taken for marks and come back as they were.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import cut

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = (START, SEP, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        text = F.replace(text, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _same(a: str, b: str) -> Column:
    return F.expr(f"{a}.tree <=> {b}.tree")


def chosen_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, branch, place, node): the messages of the best root-to-leaf paths of every tree, from the root.

    ``messages`` has tree, node, parent and score. Branches are ranked by the mean score of their messages
    (null scores count as 0), then by length, longer first, then by the leaf's node. A parent that is
    null or not in the tree makes a root. Of messages that repeat a (tree, node) one stays, with the
    least parent and score. Messages on or under a circle are on no path. A null tree is a tree.
    """
    nodes = (
        messages.where("node IS NOT NULL")
        .groupBy("tree", "node").agg(F.min(F.struct("parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))).alias("m"))
        .select("tree", "node", F.col("m.parent").alias("parent"), F.col("m.score").alias("score"))
    )
    known = nodes.select("tree", "node")
    first = cut(
        nodes.alias("n").join(known.alias("p"), _same("n", "p") & F.expr("n.parent = p.node"), "left")
        .select("n.tree", "n.node", F.col("p.node").alias("up"), F.lit(1).cast("bigint").alias("steps"), "n.score"),
        "jumps",
    )
    # messages whose way to the root is known, with depth and branch score; jumps[k] lead 2^k messages up
    whole, jumps = first.where("up IS NULL"), [first.where("up IS NOT NULL")]
    left = [None, jumps[0].count()]
    while left[-1] not in (0, left[-2]):  # a round that settles no message is left with circles only
        states = whole.union(jumps[-1])
        further = jumps[-1].alias("n").join(states.alias("p"), _same("n", "p") & F.expr("n.up = p.node"))
        reached = cut(
            further.select(
                "n.tree", "n.node", F.col("p.up").alias("up"),
                (F.col("n.steps") + F.col("p.steps")).alias("steps"), (F.col("n.score") + F.col("p.score")).alias("score"),
            ),
            "jumps",
        )
        whole = whole.union(reached.where("up IS NULL"))
        jumps.append(reached.where("up IS NOT NULL"))
        left.append(jumps[-1].count())
    inner = jumps[0].select("tree", F.col("up").alias("node")).distinct()
    leaves = whole.alias("n").join(inner.alias("p"), _same("n", "p") & F.expr("n.node = p.node"), "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc(F.col("score") / F.col("steps")), F.desc("steps"), "node")
    path = leaves.withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= branches).select("tree", "branch", "node")
    for jump in reversed(jumps[:-1]):
        up = path.alias("n").join(jump.alias("p"), _same("n", "p") & F.expr("n.node = p.node"))
        path = cut(path.union(up.select("n.tree", "n.branch", F.col("p.up").alias("node"))), "path")
    placed = path.alias("n").join(whole.alias("p"), _same("n", "p") & F.expr("n.node = p.node"))
    return placed.select("n.tree", "n.branch", F.col("p.steps").alias("place"), "n.node")


def format_paths(turns: DataFrame) -> DataFrame:
    """(tree, branch, formatted, loss): one conversation per row of ``turns(tree, branch, place, role, text)``.

    ``loss`` are the [start, end) code points of ``formatted`` with the (escaped) texts of the assistant. Null
    roles and texts are empty. A conversation is one row of the result and is put together in one task.
    """
    role, text = (escape(F.coalesce(F.col(c), F.lit(""))) for c in ("role", "text"))
    head = F.concat(F.lit(START), role, F.lit(SEP))
    pieces = turns.select(
        "tree", "branch", "place", F.concat(head, text, F.lit(END)).alias("piece"),
        F.length(head).alias("head"), F.length(text).alias("size"), (F.coalesce(F.col("role"), F.lit("")) == LOSS_ROLE).alias("learn"),
    )
    earlier = Window.partitionBy("tree", "branch").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("piece")).over(earlier), F.lit(0)) + F.col("head")
    spans = pieces.withColumn("span", F.when(F.col("learn"), F.struct(at.alias("start"), (at + F.col("size")).alias("end"))))
    rows = spans.groupBy("tree", "branch").agg(F.array_sort(F.collect_list(F.struct("place", "piece", "span"))).alias("turns"))
    return rows.select(
        "tree", "branch",
        F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.array_compact(F.col("turns.span")).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Rows of ``format_paths`` with ``roles``, ``texts`` and ``learned`` (the texts under the loss mask)."""
    quoted = [re.escape(x) for x in (START, SEP, END)]
    pattern = F.lit("(?s){}(.*?){}(.*?){}".format(*quoted))
    found = lambda group: F.transform(F.regexp_extract_all("formatted", pattern, F.lit(group)), unescape)
    learned = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.withColumn("roles", found(1)).withColumn("texts", found(2)).withColumn("learned", learned)


def format_conversations(conversations: DataFrame, branches: int = 1) -> DataFrame:
    """``format_paths`` of conversations(conv_id, turn, role, text), where a turn answers the one before.

    Rows of one conversation with equal turns follow each other by role, then text; a null turn comes first.
    An empty table gives an empty result; other columns are not read.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", F.row_number().over(order).cast("bigint").alias("node"), "role", "text")
    rows = cut(rows.select(F.col("conv_id").alias("tree"), "node", "role", "text"), "messages")
    messages = rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"))
    path = chosen_paths(messages, branches)
    turns = path.alias("n").join(rows.alias("p"), _same("n", "p") & F.expr("n.node = p.node"))
    return format_paths(turns.select("n.tree", "n.branch", "n.place", "p.role", "p.text"))
