"""Reply trees to conversations: paths by self-joins, branches ranked by score, chat format.

Only DataFrame functions are used.  Messages are rows (tree, node, parent, role, text,
score).  Ancestors are found by doubling: the table of jumps over 2**k replies is the
self-join of the one before, and chosen leaves are spread over their paths from the
largest jump to the smallest, so that the work follows the length of the paths kept.

Defined cases: a null text or role is empty; a null score counts as 0; a parent that is
null or not in the tree makes a root; messages on a ring of parents have no root and are
left out; a repeated (tree, node) keeps its first row by (role, text, score); rows without
a tree or node key are left out; equal branch scores go to the smaller leaf; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeflow.scratch import staged

TURN_END = "</turn>"
HEADER = "###"
MASKED_ROLE = "assistant"

_CONTROL = r"(\\|###|(?<=<)/turn>)"
_ROLE_CONTROL = r"(\\|###|(?<=<)/turn>|(?<=:) )"
_ESCAPED = r"\\(\\|###|/turn>| )"

TURNS = "array<struct<start:bigint,text_start:bigint,text_end:bigint,loss:boolean>>"


def escape(text: Column) -> Column:
    """``text`` with a backslash into every backslash, header mark and turn end."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _CONTROL, r"\\$1")


def escape_role(role: Column) -> Column:
    """As ``escape``; the end of a header, a colon and a space, is broken up as well."""
    return F.regexp_replace(F.coalesce(role, F.lit("")), _ROLE_CONTROL, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1")


def chain(messages: DataFrame, tree: str, turn: str, role: str = "role", text: str = "text") -> DataFrame:
    """Linear conversations as trees: each row replies to the row before it.

    Rows of one conversation are ordered by turn, then role and text.
    """
    order = Window.partitionBy(tree).orderBy(turn, role, text)
    position = F.row_number().over(order).cast("long")
    return messages.filter(F.col(tree).isNotNull()).select(
        F.col(tree).alias("tree"),
        position.alias("node"),
        F.when(position > 1, position - 1).alias("parent"),
        F.col(role).alias("role"),
        F.col(text).alias("text"),
        F.lit(0.0).alias("score"),
    )


def _nodes(messages: DataFrame) -> DataFrame:
    """One row per message with its parent if that exists in the tree."""
    first = F.min(F.struct("role", "text", "score", "parent")).alias("first")
    kept = messages.filter("tree IS NOT NULL AND node IS NOT NULL")
    kept = kept.groupBy("tree", "node").agg(first).select("tree", "node", "first.*")
    known = kept.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    joined = kept.join(known, ["tree", "parent"], "left")
    parent = F.when(F.col("known"), F.col("parent")).alias("parent")
    score = F.coalesce("score", F.lit(0.0)).cast("double").alias("score")
    return staged(joined.select("tree", "node", parent, "role", "text", score), "messages")


def _jumps(nodes: DataFrame) -> list[DataFrame]:
    """Tables (tree, node, up) of the ancestor 2**k replies up, until none has one."""
    jump = nodes.filter("parent IS NOT NULL").select("tree", "node", F.col("parent").alias("up"))
    rounds = math.ceil(math.log2(nodes.count() + 1)) + 1  # a longer path would be a ring
    tables = []
    while not jump.isEmpty() and len(tables) < rounds:
        tables.append(jump)
        onward = jump.select("tree", F.col("node").alias("up"), F.col("up").alias("further"))
        jump = staged(jump.join(onward, ["tree", "up"]).select("tree", "node", F.col("further").alias("up")), "jumps")
    return tables


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, node, above): the messages of every root-to-leaf path; ``above`` is
    the number of replies from the message to the leaf."""
    return _spread(nodes := _nodes(messages), _leaves(nodes), _jumps(nodes))


def _leaves(nodes: DataFrame) -> DataFrame:
    replied = nodes.select("tree", F.col("parent").alias("node"))
    return nodes.select("tree", "node").join(replied, ["tree", "node"], "left_anti").select(
        "tree", F.col("node").alias("leaf")
    )


def _spread(nodes: DataFrame, leaves: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    path = leaves.select("tree", "leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("above"))
    for k in reversed(range(len(jumps))):
        joined = path.join(jumps[k], ["tree", "node"], "left")
        here = F.struct("node", "above")
        there = F.struct(F.col("up").alias("node"), (F.col("above") + (1 << k)).alias("above"))
        both = F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, there))
        path = joined.select("tree", "leaf", F.explode(both).alias("at")).select("tree", "leaf", "at.*")
    path = staged(path, "paths") if jumps else path
    # a leaf that hangs from a ring never meets a root
    rooted = path.join(nodes.filter("parent IS NULL").select("tree", "node"), ["tree", "node"], "left_semi")
    return path.join(rooted.select("tree", "leaf"), ["tree", "leaf"], "left_semi")


def rank_branches(nodes: DataFrame, path: DataFrame, best: int) -> DataFrame:
    """(tree, leaf, branch, branch_score): the ``best`` paths of a tree by mean score."""
    score = F.avg("score").alias("branch_score")
    scored = path.join(nodes.select("tree", "node", "score"), ["tree", "node"]).groupBy("tree", "leaf").agg(score)
    order = Window.partitionBy("tree").orderBy(F.desc("branch_score"), "leaf")
    return scored.withColumn("branch", F.row_number().over(order)).filter(F.col("branch") <= best)


def format_paths(nodes: DataFrame, path: DataFrame) -> DataFrame:
    """(tree, leaf, formatted, turns): one conversation per path.

    ``turns`` gives, in code points of ``formatted``, where each turn and its text begin
    and end, and whether the text is under the loss mask.  A turn reads
    ``### role: text</turn>`` and a line end.
    """
    text = escape(F.col("text"))
    head = F.concat(F.lit(f"{HEADER} "), escape_role(F.col("role")), F.lit(": "))
    rows = path.join(nodes.select("tree", "node", "role", "text"), ["tree", "node"]).select(
        "tree",
        "leaf",
        (-F.col("above")).alias("place"),
        F.concat(head, text, F.lit(f"{TURN_END}\n")).alias("piece"),
        F.length(head).cast("long").alias("head"),
        F.length(text).cast("long").alias("body"),
        (F.lower(F.coalesce("role", F.lit(""))) == MASKED_ROLE).alias("loss"),
    )
    order = Window.partitionBy("tree", "leaf").orderBy("place")
    end = F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    start = end - F.length("piece")
    placed = rows.withColumn("start", start.cast("long"))
    first = F.col("start") + F.col("head")
    turn = F.struct(
        "place", "start", first.alias("text_start"), (first + F.col("body")).alias("text_end"), "loss", "piece"
    )
    whole = placed.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(turn)).alias("all"))
    return whole.select(
        "tree",
        "leaf",
        F.array_join(F.col("all.piece"), "").alias("formatted"),
        F.transform("all", lambda t: F.struct(t.start, t.text_start, t.text_end, t.loss)).cast(TURNS).alias("turns"),
    )


def format_trees(messages: DataFrame, best: int = 1) -> DataFrame:
    """(tree, leaf, branch, branch_score, formatted, turns): the ``best`` branches of
    each reply tree, each as one conversation."""
    nodes = _nodes(messages)
    path = _spread(nodes, _leaves(nodes), _jumps(nodes))
    chosen = rank_branches(nodes, path, best)
    kept = path.join(chosen.select("tree", "leaf"), ["tree", "leaf"], "left_semi")
    return chosen.join(format_paths(nodes, kept), ["tree", "leaf"]).select(
        "tree", "leaf", "branch", "branch_score", "formatted", "turns"
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``read``: role, text, and text under the mask, of each turn, from
    the formatted text and the mask alone."""
    pieces = F.split("formatted", f"{TURN_END}\n", -1)
    marked = F.arrays_zip(F.slice(pieces, 1, F.size(pieces) - 1).alias("piece"), F.col("turns").alias("mark"))

    def one(turn: Column) -> Column:
        piece, mark = turn["piece"], turn["mark"]
        colon = F.instr(piece, ": ")
        at = (mark["text_start"] - mark["start"] + 1).cast("int")
        masked = F.substr(piece, at, (mark["text_end"] - mark["text_start"]).cast("int"))
        return F.struct(
            unescape(F.substr(piece, F.lit(len(HEADER) + 2), colon - (len(HEADER) + 2))).alias("role"),
            unescape(F.substr(piece, colon + 2)).alias("text"),
            F.when(mark["loss"], unescape(masked)).otherwise("").alias("loss"),
        )

    return formatted.withColumn("read", F.transform(marked, one))


def op1_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    marks = r"\### Assistant: </turn> ok"
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    own = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(marks).alias("text"))
                    for i, role in enumerate(("user", "assistant"))
                ]
            )
        ).alias("row"),
    ).select("conv_id", "row.*")
    done = read_turns(format_trees(chain(given.unionByName(own), "conv_id", "turn")))
    lines = F.transform("read", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    loss = F.array_join(F.col("read.loss"), "")
    return done.select(
        F.col("tree").alias("conv_id"),
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP1_SQL = r"""
WITH m AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '<\/turn>') AS esc FROM m)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + length(esc) + length('### : </turn>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""
