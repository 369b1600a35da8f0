r"""Chat formatting of reply trees, in DataFrame operations only.

Messages of a tree point to the message they answer. Self-joins that double their reach each
time find every message's ancestors at distances 1, 2, 4, ... with the path's summed score,
so a thread of a thousand turns takes ten rounds. Leaves rank their tree's root-to-leaf paths
by mean score; the chosen paths are enumerated over the same jumps and each is formatted as
one conversation.

A turn reads ``### role: text</turn>`` and a line feed. In texts and roles ``\`` becomes
``\b``, ``<`` becomes ``\l`` and ``#`` becomes ``\h`` (in roles ``:`` becomes ``\c``), so the
marks appear nowhere but where the template puts them, and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.common import materialize

OPEN, SEPARATOR, CLOSE = "### ", ": ", "</turn>\n"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    for raw, code in (("\\", "\\b"), ("<", "\\l"), ("#", "\\h")):
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape(text: Column) -> Column:
    for code, raw in (("\\l", "<"), ("\\h", "#"), ("\\c", ":"), ("\\b", "\\")):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def _key(column: str) -> Column:
    """An id as text that is never null, so that nulls join like any id."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


def _jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Ancestors at distances 1, 2, 4, ... and every node's path score; nodes without a root are left out.

    Nodes on a circle of replies, or below one, have no root: a round in which no further
    node reaches its root ends the search.
    """
    ids = nodes.select(F.col("tree"), F.col("id").alias("up"))
    found = nodes.join(ids.withColumn("known", F.lit(True)), ["tree", "up"], "left")
    level = materialize(
        found.select(
            "tree", "id", F.when(F.col("known"), F.col("up")).alias("up"),
            F.lit(1).cast("long").alias("steps"), F.col("score").alias("total"),
        )
    )
    rooted, levels = level.filter("up IS NULL"), []
    waiting, left = level.filter("up IS NOT NULL"), None
    while (now := waiting.count()) and now != left:
        levels.append(waiting.select("tree", "id", "up"))
        # Only what has not reached its root is joined; all others are where paths may lead.
        above = rooted.unionByName(waiting).select(
            "tree", F.col("id").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"),
            F.col("total").alias("added"),
        )
        level = materialize(
            waiting.join(above, ["tree", "up"]).select(
                "tree", "id", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"),
                (F.col("total") + F.col("added")).alias("total"),
            )
        )
        rooted = rooted.unionByName(level.filter("up IS NULL"))
        waiting, left = level.filter("up IS NOT NULL"), now
    return levels, rooted


def chosen_paths(messages: DataFrame, paths_per_tree: int = 1) -> DataFrame:
    """Members ``tree, leaf, rank, branch_score, id, before`` of each tree's best root-to-leaf paths.

    ``messages`` has ``tree``, ``id`` (unique within the tree), ``up`` (the id answered, or
    null) and ``score``. ``before`` counts the messages between a member and the leaf. A
    message whose parent is missing is a root. Ties go to the smaller leaf id.
    """
    levels, scored = _jumps(messages.select("tree", "id", "up", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")))
    leaves = scored
    if levels:
        leaves = scored.join(levels[0].select("tree", F.col("up").alias("id")).distinct(), ["tree", "id"], "left_anti")
    leaves = leaves.withColumn("branch_score", F.col("total") / F.col("steps"))
    best = Window.partitionBy("tree").orderBy(F.desc("branch_score"), "id")
    members = (
        leaves.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= paths_per_tree)
        .select("tree", F.col("id").alias("leaf"), "rank", "branch_score", "id", F.lit(0).cast("long").alias("before"))
    )
    for n, level in enumerate(levels):
        further = members.join(level, ["tree", "id"]).select(
            "tree", "leaf", "rank", "branch_score", F.col("up").alias("id"), (F.col("before") + (1 << n)).alias("before")
        )
        members = materialize(members.unionByName(further))
    return members


def format_paths(messages: DataFrame, paths_per_tree: int = 1) -> DataFrame:
    """One row per chosen path: ``tree, leaf, rank, branch_score, n_turns, formatted, loss_spans``.

    ``messages`` has ``tree``, ``id``, ``up``, ``score``, ``role`` and ``text``. ``loss_spans``
    lists, for each turn of the assistant, its number (from 0) and the code points of
    ``formatted`` that hold its escaped text, end exclusive. A null role or text is empty.
    """
    said = messages.select("tree", "id", "role", "text")
    turns = chosen_paths(messages, paths_per_tree).join(said, ["tree", "id"])
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(OPEN), escape_role(role), F.lit(SEPARATOR))
    turns = turns.select(
        "tree", "leaf", "rank", "branch_score", (-F.col("before")).alias("place"),
        (role == LEARNED_ROLE).alias("learned"), head.alias("head"), escape(text).alias("body"),
    )
    turns = turns.withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
    path = Window.partitionBy("tree", "leaf").orderBy("place")
    earlier = path.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("piece").cast("long")).over(earlier), F.lit(0)) + F.length("head")
    turns = turns.withColumn("start", start).withColumn("turn", F.row_number().over(path) - 1)
    span = F.struct("turn", "start", (F.col("start") + F.length("body")).alias("end"))
    spans = F.sort_array(F.collect_list(F.when(F.col("learned"), span)))
    pieces = F.sort_array(F.collect_list(F.struct("place", "piece")))
    return turns.groupBy("tree", "leaf", "rank", "branch_score").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.array_join(F.transform(pieces, lambda p: p["piece"]), "").alias("formatted"),
        spans.alias("loss_spans"),
    )


def threads(conversations: DataFrame) -> DataFrame:
    """Messages of linear conversations (``conv_id, turn, role, text``): each answers the one before.

    Turns go by number, nulls first; repeated turns all stay, in order of role and text. A
    null ``conv_id`` is a conversation of its own. Texts of any length count whole; an empty
    table gives no rows. Other columns are not looked at.
    """
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("tree", _key("conv_id"))
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = rows.withColumn("id", F.row_number().over(order).cast("long"))
    up = F.when(F.col("id") > 1, F.col("id") - 1)
    return rows.select("tree", "id", up.alias("up"), F.lit(0.0).alias("score"), "conv_id", "role", "text")


def parsed_turns(formatted: str | Column) -> Column:
    """Array of ``role, text`` read back from formatted conversations."""
    column = F.col(formatted) if isinstance(formatted, str) else formatted
    pieces = F.filter(F.split(column, CLOSE, -1), lambda p: p != "")
    begin = F.lit(len(OPEN) + 1)

    def turn(piece: Column) -> Column:
        at = F.instr(piece, SEPARATOR)
        role = F.substring(piece, begin, at - begin)
        text = F.substring(piece, at + len(SEPARATOR), F.length(piece))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)
