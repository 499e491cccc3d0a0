"""Chat formatting of reply trees.

Messages form trees: each names its parent. Iterative self-joins with doubling
strides find, for every message, its root, its depth and the score of its path in
O(log depth) joins of narrow rows; leaves are then ranked within their tree, and
the messages of the chosen root-to-leaf paths are enumerated by walking the kept
strides back from the largest to the smallest, which names each ancestor exactly
once. Texts join only at the end. A chosen path becomes one conversation.

Template, for each turn: ``### role: text</turn>`` and a newline. In roles and texts
a backslash is written ``\\b``, ``<`` is ``\\l``, ``#`` is ``\\h`` and, in roles, ``:`` is
``\\c``; so neither control string can occur inside a turn, and reading back is exact.
The loss mask lists the code-point spans of the trained role's texts.

Defined results: null text and null role count as empty; a parent that does not exist
makes its child a root; messages in a cycle, or below one, have no root and so no
path; repeated messages (equal tree and message id) are kept once, the one least by
role and text; equal scores are ranked by message id of the leaf; an empty table gives
an empty result; extra columns are not read, whatever their names. Very long texts are
kept whole, and a very long conversation is read back in nearly linear time; one
conversation must fit one cell (2 GiB), and is put together in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from . import cuts
from .scratch import Scratch

# Fixed values of the template.
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\b"))
    out = F.replace(F.replace(out, F.lit("<"), F.lit("\\l")), F.lit("#"), F.lit("\\h"))
    return F.replace(out, F.lit(":"), F.lit("\\c")) if role else out


def unescape(text: Column) -> Column:
    # Each backslash starts a pair, so the pairs can be undone one kind at a time, the backslash last.
    out = F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\h"), F.lit("#"))
    return F.replace(F.replace(out, F.lit("\\c"), F.lit(":")), F.lit("\\b"), F.lit("\\"))


@dataclass(frozen=True)
class ChatParams:
    top: int | None = 1  # paths of a tree that are formatted; None: all
    trained_role: str = "assistant"


def chains(rows: DataFrame, *, tree: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text", block: int = 4096) -> DataFrame:
    """Rows as messages, each of which replies to the one before it by order, role and text: adds ``node`` and ``parent``.

    Null places come first. Rows are numbered within blocks of ``block`` places of a
    conversation, and blocks by a running sum of their sizes, so that no task sorts a long
    conversation; only rows that share one place are sorted together. Repeated rows are
    messages of their own.
    """
    # As a struct, a null conversation is equal to itself in the join.
    kept = rows.select(F.struct(F.col(tree).alias("k")).alias("tree"), F.col(order).alias("place"), F.col(role).alias("role"), F.col(text).alias("text"))
    kept = kept.withColumn("block", F.struct(F.floor(F.col("place") / block).cast("bigint").alias("b")))
    sizes = kept.groupBy("tree", "block").agg(F.count("*").alias("n"))
    before = W.partitionBy("tree").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("tree", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    number = F.row_number().over(W.partitionBy("tree", "block").orderBy("place", "role", "text"))
    placed = kept.withColumn("number", number).join(starts, ["tree", "block"]).withColumn("node", F.col("start") + F.col("number"))
    return placed.select(
        F.col("tree.k").alias(tree), F.col("place").alias(order), F.col("role").alias(role), F.col("text").alias(text), "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
    )


def paths(messages: DataFrame, params: ChatParams, scratch: Scratch) -> DataFrame:
    """``tree, leaf, node, at``: the chosen paths, ``at`` being the distance from the leaf.

    ``messages`` has ``tree, node, parent, score``, one row a node.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = nodes.select("tree", F.col("node").alias("parent")).withColumn("there", F.lit(True))
    # A parent that does not exist becomes null: the child is a root.
    first = nodes.join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), "score"
    )
    # up: the ancestor 2**k steps away, or null beyond the root; score and depth: summed over the steps passed.
    # A message that has passed its root is settled and takes part only where others look it up.
    now = scratch.save(first.withColumn("depth", F.lit(1)))
    bound = now.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    settled, active = now.where("up is null"), now.where("up is not null")
    strides = [active]
    while 1 << (len(strides) - 1) < bound and active.limit(1).count():
        state = settled.unionByName(active).select(
            "tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("score").alias("s2"), F.col("depth").alias("d2")
        )
        doubled = active.join(state, ["tree", "up"]).select(
            "tree",
            "node",
            F.col("up2").alias("up"),
            (F.col("score") + F.col("s2")).alias("score"),
            (F.col("depth") + F.col("d2")).alias("depth"),
        )
        now = scratch.save(doubled)
        settled, active = settled.unionByName(now.where("up is null")), now.where("up is not null")
        strides.append(active)
    # What is still active never passes a root: it is in a cycle or below one.
    inner = strides[0].select("tree", F.col("up").alias("node")).distinct()
    leaves = settled.join(inner, ["tree", "node"], "left_anti").withColumn("score", F.col("score") / F.col("depth"))
    if params.top is not None:
        rank = F.row_number().over(W.partitionBy("tree").orderBy(F.col("score").desc(), F.col("node")))
        leaves = leaves.withColumn("rank", rank).where(F.col("rank") <= params.top)
    walked = scratch.save(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("at")))
    for k in range(len(strides) - 1, -1, -1):
        step = strides[k].select("tree", "node", "up")
        further = walked.join(step, ["tree", "node"]).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("at") + F.lit(1 << k)).alias("at")
        )
        walked = scratch.save(walked.unionByName(further))
    return walked


def format_trees(
    messages: DataFrame,
    params: ChatParams = ChatParams(),
    *,
    tree: str = "conv_id",
    node: str = "node",
    parent: str = "parent",
    role: str = "role",
    text: str = "text",
    score: str | None = None,
) -> DataFrame:
    """``tree, leaf, n_turns, formatted, loss_spans`` of every chosen path.

    ``loss_spans`` is an array of (start, end), code points of ``formatted``.
    """
    scratch = Scratch(messages.sparkSession, "chat")
    rows = messages.select(
        # As structs, null ids are equal to each other in joins and groups.
        F.struct(F.col(tree).alias("k")).alias("tree"),
        F.struct(F.col(node).alias("k")).alias("node"),
        F.when(F.col(parent).isNotNull(), F.struct(F.col(parent).alias("k"))).alias("parent"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
        (F.col(score) if score else F.lit(0.0)).cast("double").alias("score"),
    )
    least = F.min(F.struct("role", "text", "parent", "score")).alias("m")
    kept = scratch.save(rows.groupBy("tree", "node").agg(least).select("tree", "node", "m.*"))
    messages_at = scratch.last
    chosen = paths(kept.select("tree", "node", "parent", "score"), params, scratch)
    scratch.sweep(messages_at, scratch.last)
    turns = chosen.join(kept.select("tree", "node", "role", "text"), ["tree", "node"])
    head = F.concat(F.lit(OPEN), escape(F.col("role"), True), F.lit(MIDDLE))
    shown = turns.select(
        "tree", "leaf", "at", "role", head.alias("head"), escape(F.col("text")).alias("body")
    ).withColumn("chars", F.length("head") + F.length("body") + F.lit(len(CLOSE)))
    along = W.partitionBy("tree", "leaf").orderBy(F.col("at").desc())
    placed = shown.withColumn(
        "start", F.coalesce(F.sum("chars").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    )
    body = F.col("start") + F.length("head")
    turn = F.struct(
        (-F.col("at")).alias("order"),
        F.concat("head", "body", F.lit(CLOSE)).alias("shown"),
        F.when(
            F.col("role") == params.trained_role,
            F.struct(body.cast("int").alias("start"), (body + F.length("body")).cast("int").alias("end")),
        ).alias("loss"),
    )
    gathered = placed.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return gathered.select(
        F.col("tree.k").alias("tree"),
        F.col("leaf.k").alias("leaf"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["loss"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    shown = F.split(formatted, CLOSE)
    kind = "array<struct<role:string,text:string>>"
    read = F.transform(
        F.slice(shown, F.lit(1), F.size(shown) - 1),
        lambda t: F.struct(
            unescape(F.regexp_extract(t, r"(?s)^### ([^:]*): ", 1)).alias("role"),
            unescape(F.regexp_extract(t, r"(?s)^### [^:]*: (.*)$", 1)).alias("text"),
        ),
    )
    return F.when(F.size(shown) > 1, read).otherwise(F.array().cast(kind))


def loss_text(formatted: str, spans: str) -> Column:
    """All text under the loss mask ``spans`` of the column ``formatted``, unescaped, nothing between the spans."""
    cut = f"transform({spans}, s -> {cuts.between('pieces', 's.start', 's.end')})"
    # Escapes do not reach over the end of a text, so all texts can be unescaped at once.
    return unescape(F.expr(cuts.let("pieces", cuts.chunks(formatted), f"array_join({cut}, '')")))
