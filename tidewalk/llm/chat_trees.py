"""Reply trees as training conversations, with DataFrame operations alone.

Messages form trees by parent.  Ancestors are found by iterative self-joins that double
their reach, so a chain of n messages takes log2(n) joins.  Leaves are ranked within
their tree by the mean score of their path, and each chosen root-to-leaf path becomes
one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn.  Inside roles and texts
every run of bars after ``<`` is made one bar longer, so what the template itself
writes, ``<|`` with a single bar, can't occur there, and reading takes that bar off
again.  A line end in a role is written ``<|n|>``.  The loss mask lists the spans of the
assistant's texts in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewalk.llm.common import Workspace

# Fixed values of the template.
START, END, LINE = "<|im_start|>", "<|im_end|>\n", "<|n|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\|+)", r"<\|$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\|(\|+)", r"<$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(escape(role), "\n", r"<\|n\|>")


def unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(role, r"<\|n\|>", "\n"))


def ancestors(nodes: DataFrame, work: Workspace) -> DataFrame:
    """``(tree, node, above, steps)``: every ancestor of the rows marked ``leaf``, themselves included at 0 steps.

    ``nodes`` has ``tree``, ``node``, ``parent`` and ``leaf``.  ``jump`` holds each
    node's 2**k-th ancestor; first it is doubled until none is left, then each leaf's
    row set grows by the jumps, largest first.  A cycle would never run out; reaches
    beyond the number of nodes are refused.
    """
    limit = max(nodes.groupBy("tree").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0, 1)
    jump = nodes.where("parent is not null").select("tree", "node", F.col("parent").alias("above"))
    jump = jump.join(nodes.select("tree", F.col("node").alias("above")), ["tree", "above"], "left_semi")
    jumps, reach = [], 1
    while True:
        jump = work.table(jump.select("tree", "node", "above"), f"jump-{len(jumps)}")
        if jump.isEmpty():
            break
        if reach > limit:
            raise ValueError("replies form a cycle")
        jumps.append((reach, jump))
        further = jump.select("tree", F.col("node").alias("above"), F.col("above").alias("far"))
        jump = jump.join(further, ["tree", "above"]).select("tree", "node", F.col("far").alias("above"))
        reach *= 2
    found = nodes.where("leaf").select("tree", "node", F.col("node").alias("above"), F.lit(0).cast("long").alias("steps"))
    for reach, jump in reversed(jumps):
        hop = jump.select("tree", F.col("node").alias("above"), F.col("above").alias("far"))
        more = found.join(hop, ["tree", "above"]).select("tree", "node", F.col("far").alias("above"), (F.col("steps") + reach).alias("steps"))
        # Written each time: left as a plan, it would double with every hop.
        found = work.table(found.unionByName(more), f"found-{reach}")
    return found


def reply_paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """Root-to-leaf paths: ``tree``, ``leaf``, ``rank`` and ``turns``, an array of (place, role, text) in order.

    ``messages`` has ``tree``, ``node`` (unique in its tree), ``parent`` (null at roots;
    one that isn't there makes a root too), ``role``, ``text`` and ``score`` (null: 0).
    Branches rank by their path's mean score, ties by leaf; ``branches`` keeps so many
    of each tree.  Null roles and texts are empty.  Rows without a tree or node are left
    out.  An empty table gives no paths.
    """
    work = Workspace(messages.sparkSession, "trees")
    usable = messages.where("tree is not null and node is not null")
    parents = usable.where("parent is not null").select("tree", F.col("parent").alias("node")).distinct().withColumn("inner", F.lit(True))
    nodes = work.table(usable.select("tree", "node", "parent").join(parents, ["tree", "node"], "left").select("tree", "node", "parent", F.col("inner").isNull().alias("leaf")), "nodes")
    steps = ancestors(nodes, work).select("tree", F.col("node").alias("leaf"), F.col("above").alias("node"), "steps")
    said = usable.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("score", F.lit(0.0)).alias("score"))
    placed = steps.join(said, ["tree", "node"])
    turn = F.struct((-F.col("steps")).alias("place"), "role", "text")
    paths = placed.groupBy("tree", "leaf").agg(F.avg("score").alias("score"), F.array_sort(F.collect_list(turn)).alias("turns"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("score").desc(), "leaf"))
    paths = paths.withColumn("rank", rank)
    return paths.where(F.col("rank") <= branches) if branches is not None else paths


def format_paths(paths: DataFrame) -> DataFrame:
    """``formatted`` and ``loss`` (spans of code points: start from 0, length) beside each path's other columns."""
    head = lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))
    pieces = F.transform("turns", lambda t: F.struct(head(t).alias("head"), escape(t["text"]).alias("body"), (t["role"] == LOSS_ROLE).alias("learn")))
    cut = paths.withColumn("pieces", pieces)
    none = F.array().cast("array<struct<start:long,length:long>>")

    def grow(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["head"])
        span = F.struct(start.cast("long").alias("start"), F.length(p["body"]).cast("long").alias("length"))
        return F.struct(
            (start + F.length(p["body"]) + len(END)).cast("long").alias("at"),
            F.when(p["learn"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    spans = F.aggregate("pieces", F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans")), grow, lambda acc: acc["spans"])
    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return cut.select(*paths.columns, formatted.alias("formatted"), spans.alias("loss")).drop("turns")


def parse_turns(formatted: Column) -> Column:
    """The turns that a formatted conversation says, as an array of (role, text)."""
    pieces = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30)

    def turn(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        body = F.substr(p, F.length(role) + 2)
        return F.struct(unescape_role(role).alias("role"), unescape(F.substr(body, F.lit(1), F.length(body) - len(END))).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def format_conversations(turns: DataFrame) -> DataFrame:
    """Rows of turns as one reply path per conversation: ``conv_id``, ``formatted``, ``loss``.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are not
    looked at.  Each turn replies to the one before; equal turns follow each other by
    role and text, null turns come first.  Null roles and texts are empty.  Rows with a
    null ``conv_id`` are left out.  An empty table gives no rows.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    numbered = turns.where("conv_id is not null").select("conv_id", "role", "text", F.row_number().over(order).alias("node"))
    work = Workspace(turns.sparkSession, "turns")
    numbered = work.table(numbered, "numbered")
    messages = numbered.select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))
    return format_paths(reply_paths(messages)).select(F.col("tree").alias("conv_id"), "formatted", "loss")
