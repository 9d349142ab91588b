"""Reply trees formatted as conversations, in DataFrame functions only.

Messages reply to messages.  Self-joins that double the distance passed find
every message's 1st, 2nd, 4th, 8th ... ancestor, and with them the length
and score of the path from the root to each leaf; the paths of a tree are
ranked by their mean score.  The chosen paths are enumerated by the same
jumps, longest first, so the joins grow with the logarithm of the longest
path and the rows with the paths themselves.  Only ids and scores take part
in these steps; texts meet the paths once.

Template: ``<|im_start|>role LF text <|im_end|> LF`` for each turn.  Inside
roles and texts every ``<`` + backslashes + ``|`` gets one backslash more, so
a control string never stands there and taking one away restores the text;
in roles LF is written ``\\n`` and a backslash ``\\b``.  ``spans`` has for each
turn where it starts in ``formatted`` (in characters) and the bounds of what
is learnt (the whole text of learnt roles; else start = end).

Defined cases: null role and text are empty, a null score is 0; a null tree
is a tree; rows without a message id are one message of their tree, to which
nothing replies; a message whose parent is null, unknown or itself is a root;
rows that share tree and message id are said one after another (by role,
then text), under the least parent and the highest score of them; messages
in a cycle of replies, or below one, are on no path; ties of scores go to
the longer path, then to the smaller leaf id; an empty table gives an empty
result; other columns are ignored.  A formatted conversation is one value,
so its messages meet in one task; everything before is split by message.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .worker import discard

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
UNNAMED = -(2 ** 63)
#: Joins between two written tables while paths are enumerated.
STEPS = 4


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _role_line(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _role(line: Column) -> Column:
    return F.replace(F.replace(unescape(line), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _levels(links: DataFrame) -> list[DataFrame]:
    """Level k: tree, node, up (the ancestor 2^k above; null: none), total and size of the path passed.

    A node is in level k if it has an ancestor 2^(k-1) above (all nodes in level 0).
    """
    nodes = links.groupBy("tree", "node").agg(F.min(F.nullif(F.col("parent"), F.col("node"))).alias("parent"), F.max("score").alias("score"))
    nodes = cut_lineage(nodes)
    known = nodes.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    first = nodes.join(known, _same("tree", "t") & (F.col("parent") == F.col("p")), "left")
    levels = [cut_lineage(first.select("tree", "node", F.col("p").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("size")))]
    longest = levels[0].count()
    while 1 << len(levels) <= 2 * longest:  # what is left beyond the number of messages lies in cycles
        active = levels[-1].filter("up is not null")
        if active.isEmpty():
            break
        state = reduce(DataFrame.unionByName, [*[x.filter("up is null") for x in levels[:-1]], levels[-1]])
        above = state.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("higher"),
                             F.col("total").alias("more"), F.col("size").alias("further"))
        levels.append(cut_lineage(active.join(above, _same("tree", "t") & (F.col("up") == F.col("n"))).select(
            "tree", "node", F.col("higher").alias("up"), (F.col("total") + F.col("more")).alias("total"),
            (F.col("size") + F.col("further")).alias("size"))))
    discard(nodes)
    return levels


def paths(links: DataFrame, branches: int | None = None) -> DataFrame:
    """tree, leaf, branch, score, node, pos of every message on the chosen root-to-leaf paths.

    ``links``: tree, node, parent (long), score.  ``branch`` ranks the paths of
    a tree from 1; ``branches`` keeps that many of each tree (None: all).
    """
    levels = _levels(links)
    whole = reduce(DataFrame.unionByName, [x.filter("up is null") for x in levels])
    parents = levels[0].filter("up is not null").select(F.col("tree").alias("t"), F.col("up").alias("p")).distinct()
    leaves = whole.join(parents, _same("tree", "t") & (F.col("node") == F.col("p")), "left_anti")
    rank = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("size"), "leaf")
    found = (leaves.select("tree", F.col("node").alias("leaf"), (F.col("total") / F.col("size")).alias("score"), "size")
             .withColumn("branch", F.row_number().over(rank)))
    if branches is not None:
        found = found.filter(F.col("branch") <= branches)
    at = cut_lineage(found.select("tree", "leaf", "branch", "score", F.col("leaf").alias("node"), (F.col("size") - 1).alias("pos")))
    old = [at]
    for k in reversed(range(len(levels))):
        jump = levels[k].filter("up is not null").select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        here = F.struct("node", "pos")
        there = F.struct(F.col("up").alias("node"), (F.col("pos") - (1 << k)).alias("pos"))
        both = F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, there))
        at = (at.join(jump, _same("tree", "t") & (F.col("node") == F.col("n")), "left")
              .select("tree", "leaf", "branch", "score", F.inline(both)))
        if k and (len(levels) - k) % STEPS == 0:
            at = cut_lineage(at)
            old.append(at)
    at = cut_lineage(at)
    discard(*levels, *old)
    return at


def format_trees(messages: DataFrame, links: DataFrame | None = None, branches: int | None = None, learn: Sequence[str] = ("assistant",),
                 tree: str = "tree", node: str = "node", parent: str = "parent", role: str = "role", text: str = "text",
                 score: str = "score") -> DataFrame:
    """tree, leaf, branch, score, formatted and spans of every chosen root-to-leaf path.

    ``messages`` has tree, node (integral), role and text; parent (integral)
    and score stand there as well, or in ``links``, a narrow table of its own.
    """
    given = messages if links is None else links
    at = paths(given.select(F.col(tree).alias("tree"), F.coalesce(F.col(node).cast("long"), F.lit(UNNAMED)).alias("node"),
                            F.col(parent).cast("long").alias("parent"), F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("score")), branches)
    said = messages.select(F.col(tree).alias("t"), F.coalesce(F.col(node).cast("long"), F.lit(UNNAMED)).alias("n"),
                           F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    turns = at.join(said, _same("tree", "t") & (F.col("node") == F.col("n"))).select(
        "tree", "leaf", "branch", "score", "pos", "role", "text",
        F.concat(F.lit(START), _role_line(F.col("role")), F.lit("\n")).alias("head"), escape(F.col("text")).alias("body"))
    order = Window.partitionBy("tree", "leaf").orderBy("pos", "role", "text")
    tail = END + "\n"
    size = F.length("head") + F.length("body") + len(tail)
    placed = (turns.withColumn("i", F.row_number().over(order)).withColumn("end", F.sum(size.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("loss_end", F.col("end") - len(tail))
              .withColumn("loss_start", F.when(F.col("role").isin(*learn), F.col("loss_end") - F.length("body")).otherwise(F.col("loss_end"))))
    turn = F.struct("i", (F.col("end") - size).alias("start"), "end", "loss_start", "loss_end", F.concat("head", "body", F.lit(tail)).alias("piece"))
    rows = (placed.select("tree", "leaf", "branch", "score", turn.alias("turn")).groupBy("tree", "leaf", "branch", "score")
            .agg(F.array_sort(F.collect_list("turn")).alias("turns")))
    return rows.select(
        "tree", F.when(F.col("leaf") != UNNAMED, F.col("leaf")).alias("leaf"), "branch", "score",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform("turns", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), t["loss_start"].alias("loss_start"),
                                                t["loss_end"].alias("loss_end"))).alias("spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns``: role, text and learnt text of every turn, taken from the output alone."""
    pieces = F.slice(F.split("formatted", r"<\|im_start\|>", -1), F.lit(2), F.size("spans"))

    def turn(piece: Column, span: Column) -> Column:
        line = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(line) + 2, F.length(piece) - F.length(line) - 1 - len(END + "\n"))
        learnt = F.substring(piece, (span["loss_start"] - span["start"] - len(START) + 1).cast("int"), (span["loss_end"] - span["loss_start"]).cast("int"))
        return F.struct(_role(line).alias("role"), unescape(body).alias("text"), unescape(learnt).alias("learnt"))

    return formatted.withColumn("turns", F.zip_with(pieces, "spans", turn))
