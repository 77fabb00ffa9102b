"""Reply trees as training conversations, with DataFrame operations only.

Messages are nodes (tree_id, node_id, parent_id, role, text, score); ids are unique in a tree. Self-joins double the
distance to an ancestor each round, so a tree of depth d takes log2(d) rounds: each node learns the score and length of
its path from the root. A branch ends in a leaf; branches of a tree are ranked by the sum of their scores (ties: the
smaller leaf), and the best `branches` are chosen. The doubled links, used from the longest to the shortest, then list
the nodes of each chosen path, and each path becomes one conversation.

Template: `<|im_start|>` role, line end, text `<|im_end|>`, line end. Inside roles and texts a backslash becomes two,
`<|` becomes `<\\|`, and a line end of a role gets a backslash; dropping each backslash that stands before a character
reverses this. The loss mask is a list of spans in code points, one for the text of each assistant turn.

A parent that is missing makes its child a root. Nodes on a cycle, or below one, have no root and are left out. Null
roles and texts count as empty, null scores as 0, a null tree_id is a tree of its own. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallylake.llm.staging import staged

BEGIN, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def threads(messages: DataFrame) -> DataFrame:
    """Nodes of linear conversations (conv_id, turn, role, text): each message answers the one before it. Rows that
    tie in turn follow each other by role and text."""
    rows = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.withColumn("node_id", F.row_number().over(order).cast("long")).select(
        F.col("conv_id").alias("tree_id"), "node_id",
        F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"),
    )


def paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, node, place): the nodes of the best branches of each tree; place counts from 1 at the root."""
    links = nodes.select(_key("tree_id").alias("tree"), F.col("node_id").alias("node"), F.col("parent_id").alias("up"),
                         F.coalesce("score", F.lit(0.0)).alias("total"))
    known = links.select("tree", F.col("node").alias("up"), F.lit(True).alias("found"))
    step = staged(
        links.join(known, ["tree", "up"], "left")
        .select("tree", "node", F.when(F.col("found"), F.col("up")).alias("up"), "total", F.lit(1).cast("long").alias("length")),
        "links",
    )
    parents = step.where("up is not null").select("tree", F.col("up").alias("node")).distinct()
    ladder, waiting = [step], -1
    while (left := step.where("up is not null").count()) not in (0, waiting):
        waiting = left
        above = step.select("tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("total").alias("more"),
                            F.col("length").alias("longer"))
        # Finished nodes need no join, so only links still under way are shuffled.
        moved = step.where("up is not null").join(above, ["tree", "up"]).select(
            "tree", "node", F.col("next").alias("up"), (F.col("total") + F.col("more")).alias("total"),
            (F.col("length") + F.col("longer")).alias("length"))
        step = staged(step.where("up is null").unionByName(moved), "links")
        ladder.append(step)
    whole = step.where("up is null")
    best = Window.partitionBy("tree").orderBy(F.col("total").desc(), "node")
    chosen = (
        whole.join(parents, ["tree", "node"], "left_anti")
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
        .select("tree", F.col("node").alias("leaf"), "node", F.col("length").alias("place"))
    )
    chosen = staged(chosen, "paths")
    for k in range(len(ladder) - 1, -1, -1):
        jumps = ladder[k].where("up is not null").select("tree", "node", "up")
        further = chosen.join(jumps, ["tree", "node"]).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("place") - F.lit(2**k)).alias("place"))
        chosen = staged(chosen.unionByName(further), "paths")
    return chosen


def conversations(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(tree_id, leaf, formatted, loss_spans): one conversation for each chosen branch; loss_spans holds start and
    length in code points."""
    chosen = paths(nodes, branches)
    said = nodes.select("tree_id", _key("tree_id").alias("tree"), F.col("node_id").alias("node"),
                        escaped(F.coalesce("role", F.lit(""))).alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("text"))
    turns = (
        chosen.join(said, ["tree", "node"])
        .groupBy("tree", "leaf")
        .agg(F.first("tree_id").alias("tree_id"), F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    )
    role = lambda t: F.replace(t["role"], F.lit("\n"), F.lit("\\\n"))
    head = lambda t: F.concat(F.lit(BEGIN), role(t), F.lit("\n"))
    shown = F.transform("turns", lambda t: F.concat(head(t), t["text"], F.lit(f"{END}\n")))
    # Each turn's share of the length, then the spans by running sums.
    sizes = F.transform("turns", lambda t: F.struct(
        F.length(head(t)).alias("head"), F.length(t["text"]).alias("text"), (t["role"] == LOSS_ROLE).alias("loss")))
    gathered = F.aggregate(
        F.col("sizes"),
        F.expr("struct(0 AS upto, cast(array() AS array<struct<start:int,length:int>>) AS spans)"),
        lambda acc, t: F.struct(
            (acc["upto"] + t["head"] + t["text"] + len(END) + 1).alias("upto"),
            F.when(t["loss"], F.array_append(acc["spans"], F.struct((acc["upto"] + t["head"]).alias("start"), t["text"].alias("length"))))
            .otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return (
        turns.withColumn("sizes", sizes)
        .select("tree_id", "leaf", F.array_join(shown, "").alias("formatted"), gathered.alias("loss_spans"))
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds `said`, the (role, text) turns, and `loss`, the text under the mask, both read from the output."""
    blocks = F.slice(F.split("formatted", r"<\|im_end\|>\n"), 1, F.size(F.split("formatted", r"<\|im_end\|>\n")) - 1)
    bodies = F.transform(blocks, lambda b: F.struct(
        F.substring(b, len(BEGIN) + 1, 2**31 - 1).alias("body"),
        F.regexp_extract(F.substring(b, len(BEGIN) + 1, 2**31 - 1), r"(?s)\A([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n", 1).alias("role")))
    said = F.transform(bodies, lambda b: F.struct(
        unescaped(b["role"]).alias("role"),
        unescaped(F.substr(b["body"], F.length(b["role"]) + 2)).alias("text")))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescaped(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    return formatted.withColumn("said", said).withColumn("loss", loss)
