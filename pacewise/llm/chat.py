"""Op 9: reply trees to formatted conversations, with built-in functions only.

Root-to-leaf paths come from iterative self-joins by pointer doubling: after ``k`` rounds every leaf
knows its ancestors up to ``2**k - 1`` steps away, so a chain of 400 turns takes nine rounds rather than
400. Paths are ranked in their tree by the sum of their nodes' scores. Template, one conversation:

    <s>  then for each turn  <|role|>\\n text </s>\\n

Inside roles and texts the control strings ``<s> </s> <| |> [INST] [/INST]`` lose their first character
to an escape (``~1 ~2 ~3``) and ``~`` becomes ``~0``, which ``unescape`` undoes. ``loss_spans`` are the code
points of assistant texts in the formatted string.

A conversation is one string by contract, hence one row. Everything before that is joins on
(tree, node), whose larger side AQE can split; the pointer tables are checkpointed in the shared
folder, so lost executors don't restart the iteration.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewise.session import checkpoint_root

BEGIN, OPEN, CLOSE, END = "<s>", "<|", "|>\n", "</s>\n"
# Fixed values: (pattern of a control string's first character, its escape), undone in reverse order.
ESCAPES = (("~", "~0", "~"), (r"<(?=/?s>|\|)", "~1", "<"), (r"\[(?=/?INST\])", "~2", "["), (r"\|(?=>)", "~3", "|"))


def escape(text: Column) -> Column:
    for pattern, code, _ in ESCAPES:
        text = F.regexp_replace(text, pattern, code)
    return text


def unescape(text: Column) -> Column:
    for _, code, plain in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def reply_chain(turns: DataFrame, tree: str = "conv_id", order: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """Turns as tree nodes, each the reply to the one before it: (tree, node, parent, role, text, score).

    Ties in ``order`` go by role, then text; nulls come first. Repeated turns stay.
    """
    w = Window.partitionBy(F.col(f"`{tree}`")).orderBy(F.col(f"`{order}`"), F.col(f"`{role}`"), F.col(f"`{text}`"))
    node = F.row_number().over(w).cast("long")
    return turns.select(F.col(f"`{tree}`").alias("tree"), node.alias("node"),
                        F.when(node > 1, node - 1).alias("parent"), F.col(f"`{role}`").alias("role"),
                        F.col(f"`{text}`").alias("text"), F.lit(0.0).alias("score"))


def paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, steps): for every leaf, the nodes on its way up to the root.

    A parent that isn't in the tree counts as none. Nodes that only lead into a cycle reach no root
    and are left out.
    """
    spark = nodes.sparkSession
    checkpoint_root(spark)
    known = nodes.select("tree", F.col("node").alias("parent"))
    jump = nodes.select("tree", "node", "parent").where("parent is not null").join(known, ["tree", "parent"], "left_semi")
    jump = jump.select("tree", "node", F.col("parent").alias("up")).checkpoint()
    roots = nodes.select("tree", "node").join(jump, ["tree", "node"], "left_anti")
    leaves = nodes.select("tree", "node").join(jump.select("tree", F.col("up").alias("node")), ["tree", "node"], "left_anti")
    found = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("steps"))
    rounds = max(1, nodes.count()).bit_length() + 1
    for k in range(rounds):
        if jump.isEmpty():
            break
        further = found.join(jump, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"),
                                                            (F.col("steps") + 2**k).alias("steps"))
        found = found.unionByName(further).checkpoint()
        after = jump.select("tree", F.col("node").alias("up"), F.col("up").alias("top"))
        jump = jump.join(after, ["tree", "up"]).select("tree", "node", F.col("top").alias("up")).checkpoint()
    ended = found.join(roots, ["tree", "node"]).select("tree", "leaf")
    return found.join(ended, ["tree", "leaf"], "left_semi")


def format_paths(nodes: DataFrame, best: int | None = None) -> DataFrame:
    """One row for each root-to-leaf path: tree, leaf, path_rank, path_score, n_turns, formatted and
    loss_spans (start, length in code points, in text order).

    ``nodes`` has tree, node (unique in its tree), parent, role, text and score. Paths rank in their tree by
    the sum of scores (null: 0), ties by the smaller leaf; ``best`` keeps that many for each tree. Null
    roles and texts are empty, null trees are a tree of their own. Other columns are ignored.
    """
    nodes = nodes.select(F.struct(F.col("tree").isNotNull().alias("given"), F.coalesce(F.col("tree"), F.lit(0)).alias("id")).alias("tree"),
                         "node", "parent", "role", "text", "score")
    part = nodes.select("tree", "node", F.coalesce("score", F.lit(0.0)).alias("score"),
                        (F.coalesce("role", F.lit("")) == "assistant").alias("said"),
                        F.concat(F.lit(OPEN), escape(F.coalesce("role", F.lit(""))), F.lit(CLOSE)).alias("head"),
                        escape(F.coalesce("text", F.lit(""))).alias("body"))
    along = paths(nodes).join(part, ["tree", "node"])
    size = F.length("head") + F.length("body") + len(END)
    before = Window.partitionBy("tree", "leaf").orderBy(F.col("steps").desc()).rowsBetween(Window.unboundedPreceding, -1)
    along = along.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + len(BEGIN) + F.length("head"))
    turn = F.struct(F.col("start"), F.length("body").cast("long").alias("length"), F.col("said"),
                    F.concat("head", "body", F.lit(END)).alias("piece"))
    whole = along.groupBy("tree", "leaf").agg(F.sum("score").alias("path_score"), F.array_sort(F.collect_list(turn)).alias("t"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("path_score").desc(), "leaf"))
    whole = whole.withColumn("path_rank", rank)
    if best is not None:
        whole = whole.where(F.col("path_rank") <= best)
    return whole.select(
        F.when(F.col("tree.given"), F.col("tree.id")).alias("tree"), "leaf", "path_rank", "path_score",
        F.size("t").cast("long").alias("n_turns"),
        F.concat(F.lit(BEGIN), F.array_join(F.transform("t", lambda x: x["piece"]), "")).alias("formatted"),
        F.transform(F.filter("t", lambda x: x["said"]), lambda x: F.struct(x["start"], x["length"])).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    body = F.substring(formatted, len(BEGIN) + 1, 2**31 - 1)
    pieces = F.filter(F.split(body, END, -1), lambda p: p != "")

    def turn(p: Column) -> Column:
        role = F.substring_index(F.substring(p, len(OPEN) + 1, 2**31 - 1), CLOSE, 1)
        rest = F.substr(p, F.length(role) + len(OPEN) + len(CLOSE) + 1)
        return F.struct(unescape(role).alias("role"), unescape(rest).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return unescape(F.array_join(F.transform(spans, lambda s: F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))), ""))
