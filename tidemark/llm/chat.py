"""Conversations from reply trees, formatted with a chat template. Native expressions only.

A reply names its parent; a path from the root to a leaf is one conversation. Paths are
followed by iterative self-joins that double their reach: after round k every node knows
its ancestor 2^k steps up and the score of the steps between, so a chain of a thousand
turns takes ten rounds. Leaves are ranked by the mean score of their path, and only the
paths of chosen leaves are listed turn by turn.

The template writes a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. A backslash goes in
front of every backslash, of the bar in every ``<|``, and of every line end in a role; so a
control string in the output is always the template's own, and taking one backslash away
gives every text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import written

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def chain(rows: DataFrame, tree_col: str, order_col: str, role_col: str, text_col: str) -> DataFrame:
    """(tree, node, parent, role, text, score): rows of one conversation as a tree without
    branches, in the order of ``order_col`` (nulls first; equal places by role, then text)."""
    place = F.row_number().over(Window.partitionBy(tree_col).orderBy(order_col, role_col, text_col))
    rows = rows.select(
        F.col(tree_col).alias("tree"), place.cast("long").alias("node"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select("tree", "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _keyed(nodes: DataFrame) -> DataFrame:
    key = F.when(F.col("tree").isNull(), "null").otherwise(F.concat(F.lit("="), F.col("tree").cast("string")))
    return nodes.withColumn("key", key)


def best_leaves(links: DataFrame, paths_per_tree: int) -> DataFrame:
    """(key, leaf, rank) of the chosen leaves; ``links`` has (key, node, parent, score)."""
    parents = links.where("parent is not null").select("key", F.col("parent").alias("node")).distinct()
    known = links.select("key", F.col("node").alias("parent"), F.lit(True).alias("known"))
    # a parent that is not there makes a root
    rooted = links.join(known, ["key", "parent"], "left").select(
        "key", "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.col("score").cast("double").alias("score")
    )
    leaves = rooted.join(parents, ["key", "node"], "left_anti").select("key", F.col("node").alias("leaf"))
    state = written(rooted.withColumn("steps", F.lit(1)), "jumps")
    finished = state.where("up is null")
    running = state.where("up is not null")
    nodes, reach = state.count(), 1
    while reach <= nodes and running.head(1):
        # only nodes that have not come to their root look further
        ahead = finished.unionByName(running).select(
            "key", F.col("node").alias("up"), F.col("up").alias("further"), F.col("score").alias("more"), F.col("steps").alias("extra")
        )
        state = written(running.join(ahead, ["key", "up"]).select(
            "key", "node", F.col("further").alias("up"), (F.col("score") + F.col("more")).alias("score"),
            (F.col("steps") + F.col("extra")).alias("steps"),
        ), "jumps")
        finished = finished.unionByName(state.where("up is null"))
        running = state.where("up is not null")
        reach *= 2
    # a node that looks beyond the number of all nodes runs into a cycle and has no root
    done = finished.select("key", F.col("node").alias("leaf"), (F.col("score") / F.col("steps")).alias("mean"))
    ranked = leaves.join(done, ["key", "leaf"])
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc_nulls_last("mean"), "leaf"))
    return ranked.select("key", "leaf", rank.alias("rank")).where(F.col("rank") <= paths_per_tree)


def path_nodes(links: DataFrame, leaves: DataFrame) -> DataFrame:
    """(key, leaf, rank, node, height): the nodes of each chosen path, the leaf at height 0."""
    jump = written(links.select("key", "node", F.col("parent").alias("up")).where("up is not null"), "jumps")
    members = written(leaves.select("key", "leaf", "rank", F.col("leaf").alias("node"), F.lit(0).alias("height")), "members")
    reach = 1
    while True:
        above = members.join(jump, ["key", "node"]).select("key", "leaf", "rank", F.col("up").alias("node"), (F.col("height") + reach).alias("height"))
        above = written(above.join(links.select("key", "node"), ["key", "node"], "left_semi"), "above")
        if not above.head(1):
            return members
        members = written(members.unionByName(above), "members")
        ahead = jump.select("key", F.col("node").alias("up"), F.col("up").alias("further"))
        jump = written(jump.join(ahead, ["key", "up"]).select("key", "node", F.col("further").alias("up")), "jumps")
        reach *= 2


def format_paths(nodes: DataFrame, paths_per_tree: int = 1) -> DataFrame:
    """(tree, leaf, rank, formatted, loss_spans): one conversation for each chosen path.

    ``nodes`` has (tree, node, parent, role, text, score); a node is named once in its tree,
    further columns are ignored. ``loss_spans`` are the (start, end) of the assistants'
    texts in ``formatted``, in code points. Null texts and roles count as empty, a null tree
    is a tree like another, a null score counts as 0. A parent that is missing makes its
    child a root; a path that runs into a cycle has no root and is left out; leaves of equal
    score are ranked by name. An empty table gives an empty result.
    """
    nodes = _keyed(nodes.select("tree", "node", "parent", "role", "text", F.coalesce("score", F.lit(0.0)).alias("score")))
    links = written(nodes.select("key", "node", "parent", "score"), "links")
    steps = path_nodes(links, best_leaves(links, paths_per_tree))
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(BEGIN), F.replace(escaped(role), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    turn = F.struct(
        (-F.col("height")).alias("place"), head.alias("head"), escaped(text).alias("body"), (role == ASSISTANT).alias("learnt")
    )
    turns = steps.join(nodes.select("key", "tree", "node", "role", "text"), ["key", "node"])
    paths = turns.groupBy("key", "leaf").agg(
        F.first("tree").alias("tree"), F.first("rank").alias("rank"), F.array_sort(F.collect_list(turn)).alias("turns")
    )
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(t["head"])
        end = start + F.length(t["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(END)).alias("at"), F.when(t["learnt"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return paths.select(
        "tree", "leaf", "rank", whole.alias("formatted"), F.aggregate("turns", zero, step, lambda s: s["spans"]).alias("loss_spans")
    )


def parsed(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""

    def turn(part: Column) -> Column:
        inner = F.substring(part, F.lit(len(BEGIN) + 1), F.length(part))
        role = F.regexp_extract(inner, r"(?s)^((?:[^\\\n]++|\\.)*+)\n", 1)
        text = F.substring(inner, F.length(role) + 2, F.length(inner))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")
