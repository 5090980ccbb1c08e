"""Conversations from reply trees, in DataFrame functions only.

Messages name the message they answer. Ancestors are found by iterative self-joins that
double their reach: from "parent" to "ancestor 2, 4, 8, ... steps up", with the sum of the scores
on the way. A branch is the path from a root to a leaf; its score is the mean score of its
messages, found in as many joins as there are tables, one row for a leaf. The best branches of
each tree are chosen by that, and only the chosen ones' messages are enumerated, through the same
tables; every chosen branch is written as one conversation.

The written form marks turns with control strings and escapes these inside roles and texts,
so that nobody can forge a turn:

    <|turn|>role\\n text <|end|>        for each turn

A backslash in a text is written as ``\\e`` and ``<`` as ``\\l`` (in a role, a line feed as
``\\n``): no ``<`` is left, so control strings stand only where the template put them, and
what was escaped is read back exactly. The output is a list of pieces, each with a flag that
says whether the loss counts it; joined they are the training text.

A path of one tree may hold a third of all rows. Its turns are joined to segments of
``SEGMENT`` turns first, spread over tasks, and only the segments meet in the conversation,
which is one value of the result and therefore has to fit in a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed

TURN, END = "<|turn|>", "<|end|>"
LOSS_ROLE = "assistant"
#: Turns that are joined in one task before they meet the others of their conversation.
SEGMENT = 64
#: A tree deeper than 2**MOST_DOUBLINGS messages is taken for a cycle.
MOST_DOUBLINGS = 40


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\e")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\e"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def ancestor_tables(nodes: DataFrame) -> list[DataFrame]:
    """``(node, up, passed)`` for ancestors 1, 2, 4, ... steps up, as long as any node has one.

    ``nodes`` has ``node, parent, score``; ``passed`` is the sum of the scores from the node up
    to, but without, the ancestor.

    A message whose parent is itself or part of a cycle would have ancestors for ever; the
    tables stop once their reach exceeds the number of messages.
    """
    hops = [checkpointed(nodes.where("parent IS NOT NULL").select(
        "node", F.col("parent").alias("up"), F.col("score").alias("passed")))]
    if hops[0].isEmpty():
        return []
    total = nodes.count()
    while 2 ** len(hops) < total and len(hops) < MOST_DOUBLINGS:
        above = hops[-1].select(F.col("node").alias("up"), F.col("up").alias("top"),
                                F.col("passed").alias("beyond"))
        wider = checkpointed(hops[-1].join(above, "up").select(
            "node", F.col("top").alias("up"), (F.col("passed") + F.col("beyond")).alias("passed")))
        if wider.isEmpty():
            break
        hops.append(wider)
    return hops


def branch_scores(leaves: DataFrame, hops: list[DataFrame], linked: DataFrame) -> DataFrame:
    """``(leaf, root, depth, mean)`` for every leaf that has a root; one row a leaf.

    The longest hops come first; as every hop is taken once at most, all together lead to the root.
    """
    at = leaves.select(F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("depth"),
                       F.lit(0.0).alias("total"))
    for k in range(len(hops) - 1, -1, -1):
        gone = F.col("up").isNotNull()
        at = at.join(hops[k], "node", "left").select(
            "leaf", F.coalesce("up", "node").alias("node"),
            F.when(gone, F.col("depth") + 2 ** k).otherwise(F.col("depth")).alias("depth"),
            F.when(gone, F.col("total") + F.col("passed")).otherwise(F.col("total")).alias("total"))
    mean = (F.col("total") + F.col("score")) / (F.col("depth") + 1)
    return at.join(linked.where("parent IS NULL"), "node").select(
        "leaf", F.col("node").alias("root"), "depth", mean.alias("mean"))


def branch_paths(leaves: DataFrame, hops: list[DataFrame]) -> DataFrame:
    """``(leaf, node, above)`` for every message on the path from one of ``leaves`` to its root.

    ``above`` is the number of steps up from the leaf. Every number of steps has one way to
    be written in powers of two, so each message of a path comes once.
    """
    paths = leaves.select(F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("above"))
    for k in range(len(hops) - 1, -1, -1):
        farther = paths.join(hops[k], "node").select(
            "leaf", F.col("up").alias("node"), (F.col("above") + 2 ** k).alias("above"))
        paths = checkpointed(paths.unionByName(farther))
    return paths


def best_branches(messages: DataFrame, *, most: int = 1) -> DataFrame:
    """Messages of the chosen branches: ``branch, rank, turn, node`` and all of ``messages``.

    ``messages`` has ``node`` (unique), ``parent`` (NULL for a root), ``score`` (NULL counts
    as 0) and whatever else is to be kept. Of every tree the ``most`` branches with the highest
    mean score are taken, ties going to the longer and then to the smaller leaf. ``branch`` is
    the leaf, ``turn`` counts from the root, from 0. A message whose parent is not among the
    messages is a root; messages on a cycle have no root and are left out, with all below them.
    """
    known = messages.select(F.col("node").alias("parent"))
    linked = messages.select("node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    linked = linked.join(known.withColumn("real", F.lit(True)), "parent", "left").select(
        "node", F.when(F.col("real"), F.col("parent")).alias("parent"), "score")
    linked = checkpointed(linked)
    leaves = linked.join(linked.select(F.col("parent").alias("node")).where("node IS NOT NULL")
                         .distinct(), "node", "left_anti")
    hops = ancestor_tables(linked)
    branches = branch_scores(leaves, hops, linked)
    better = F.struct((-F.col("mean")).alias("m"), (-F.col("depth")).alias("d"), F.col("leaf"))
    if most == 1:
        chosen = branches.groupBy("root").agg(F.min(F.struct(better.alias("b"), F.struct(
            "leaf", "depth").alias("v"))).alias("x")).select("x.v.*", F.lit(1).alias("rank"))
    else:
        # A tree's branches are first cut to its best within parts, then ranked together.
        part = F.pmod(F.xxhash64("leaf"), F.lit(64))
        near = Window.partitionBy("root", "part").orderBy(better)
        whole = Window.partitionBy("root").orderBy(better)
        chosen = (branches.withColumn("part", part).withColumn("r", F.row_number().over(near))
                  .where(F.col("r") <= most).withColumn("rank", F.row_number().over(whole))
                  .where(F.col("rank") <= most).select("leaf", "depth", "rank"))
    chosen = checkpointed(chosen)
    paths = branch_paths(chosen.select(F.col("leaf").alias("node")), hops)
    turns = paths.join(chosen, "leaf").select(
        F.col("leaf").alias("branch"), "rank", (F.col("depth") - F.col("above")).alias("turn"), "node")
    return turns.join(messages, "node")


def pieces_of(role: Column, text: Column, loss: Column) -> Column:
    """Pieces ``struct<text, loss>`` of one turn."""
    def piece(t: Column, counted: Column) -> Column:
        return F.struct(t.alias("text"), counted.alias("loss"))

    head = F.concat(F.lit(TURN), escape_role(role), F.lit("\n"))
    return F.array(piece(head, F.lit(False)), piece(escape(text), loss),
                   piece(F.lit(END), F.lit(False)))


def format_branches(turns: DataFrame, keys: list[str], *, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One conversation a row: ``keys, n_turns, pieces`` from rows ``keys, turn, role, text``.

    NULL roles and texts are written as empty. The loss counts the text of ``loss_role``, no
    marks and no other role's text.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    written = turns.select(*keys, "turn", pieces_of(role, text, role == loss_role).alias("p"))
    segments = written.groupBy(*keys, F.floor(F.col("turn") / SEGMENT).alias("segment")).agg(
        F.sort_array(F.collect_list(F.struct("turn", "p"))).alias("s"))
    segments = segments.select(*keys, "segment", F.size("s").cast("long").alias("n"),
                               F.flatten("s.p").alias("p"))
    whole = segments.groupBy(*keys).agg(F.sum("n").alias("n_turns"), F.sort_array(
        F.collect_list(F.struct("segment", "p"))).alias("s"))
    return whole.select(*keys, "n_turns", F.flatten("s.p").alias("pieces"))


def formatted(pieces: Column) -> Column:
    """The training text."""
    return F.concat_ws("", F.transform(pieces, lambda p: p["text"]))


def read_turns(text: Column) -> Column:
    """``array<struct<role, text>>`` read back from a training text."""
    turns = F.filter(F.split(text, r"<\|end\|>"), lambda t: t != "")

    def parsed(t: Column) -> Column:
        body = F.substring(t, F.lit(len(TURN) + 1), F.char_length(t))
        line = F.instr(body, "\n")
        return F.struct(unescape_role(F.substring(body, F.lit(1), line - 1)).alias("role"),
                        unescape(F.substring(body, line + 1, F.char_length(body))).alias("text"))

    return F.transform(turns, parsed)


def read_loss(pieces: Column) -> Column:
    """The text that the loss counts, as it was before escaping."""
    counted = F.filter(pieces, lambda p: p["loss"])
    return unescape(F.concat_ws("", F.transform(counted, lambda p: p["text"])))


def message_trees(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text", stretch: int = 256) -> DataFrame:
    """Messages of linear conversations as reply trees: each answers the one before it.

    Returns ``node, parent, score, conv_id, role, text``. Rows are ordered by turn (NULLs
    first), then role and text, so ties have a fixed order; repeated rows are messages of
    their own. Rows without a conversation id form one conversation. A conversation is
    numbered in stretches of ``stretch`` turns, each by itself, and only the stretches' sizes
    are summed along it, so a conversation of any length is spread over tasks.
    """
    plain = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("t"),
                        F.col(role_col).alias("role"), F.col(text_col).alias("text"),
                        F.floor(F.col(turn_col) / stretch).alias("stretch"))
    sizes = plain.groupBy("conv_id", "stretch").count()
    ahead = Window.partitionBy("conv_id").orderBy(F.col("stretch").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("conv_id").alias("c"), F.col("stretch").alias("s"),
                         F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("conv_id", "stretch").orderBy(
        F.col("t").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    numbered = plain.withColumn("k", F.row_number().over(inside)).join(
        sizes, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("stretch").eqNullSafe(F.col("s")))
    place = F.col("ahead") + F.col("k")
    return numbered.select(
        F.struct("conv_id", place.alias("place")).alias("node"),
        F.when(place > 1, F.struct("conv_id", (place - 1).alias("place"))).alias("parent"),
        F.lit(0.0).alias("score"), "conv_id", "role", "text")


def format_conversations(rows: DataFrame, **columns) -> DataFrame:
    """``conv_id, n_turns, pieces`` for the rows of linear conversations; see ``message_trees``.

    An empty table gives no conversations.
    """
    messages = checkpointed(message_trees(rows, **columns))
    return format_branches(best_branches(messages), ["conv_id"])
