"""Chat formatting of reply trees, with DataFrame functions only.

Self-joins that double the distance make jumps of 1, 2, 4, ... messages towards the root, each with the sum of the scores
that it passes: a tree of depth d takes log2(d) rounds. The jumps first give every leaf its path's score, one row a leaf;
paths are ranked by it, and only the chosen ones are enumerated, by the same jumps, and become one conversation each, with
a loss mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """Puts one more backslash between < and |, so that no text holds a control string."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """A role stands on one line: its line feeds become \\n, its backslashes are doubled."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    parts = F.split(unescape(role), r"\\\\")  # between pairs of backslashes, \n is a line feed
    return F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def _jumps(nodes: DataFrame) -> list[DataFrame]:
    """(conv_id, node, up, passed) for distances 1, 2, 4, ...: who stands so far above a node, and the sum of the scores of
    the node and those between. A node without one has no row."""
    known = nodes.select("conv_id", F.col("node").alias("up"))
    first = nodes.filter("parent is not null").select("conv_id", "node", F.col("parent").alias("up"), F.col("score").alias("passed")).join(known, ["conv_id", "up"], "left_semi")
    jumps, step = [stored(first, "chat-jump")], 1
    counts = nodes.groupBy("conv_id").agg(F.count(F.lit(1)).alias("most"))
    while not jumps[-1].isEmpty():
        step *= 2
        further = jumps[-1].select("conv_id", F.col("node").alias("up"), F.col("up").alias("far"), F.col("passed").alias("more"))
        twice = jumps[-1].join(further, ["conv_id", "up"]).select("conv_id", "node", F.col("far").alias("up"), (F.col("passed") + F.col("more")).alias("passed"))
        # No path is longer than its conversation; what still jumps then goes round a ring.
        jumps.append(stored(twice.join(counts, "conv_id").filter(F.col("most") > step).drop("most"), "chat-jump"))
    return jumps[:-1] or jumps


def ranked_leaves(nodes: DataFrame, jumps: list[DataFrame], top: int) -> DataFrame:
    """(conv_id, leaf, rank) of the best paths: by the sum of scores, ties by the smaller leaf. What hangs on a ring of
    parents reaches no root and has no path."""
    parents = jumps[0].select("conv_id", F.col("up").alias("node"))
    at = nodes.join(parents, ["conv_id", "node"], "left_anti").select("conv_id", F.col("node").alias("leaf"), "node", F.lit(0.0).alias("sum"))
    for jump in reversed(jumps):
        far = jump.select("conv_id", "node", "up", "passed")
        at = at.join(far, ["conv_id", "node"], "left").select("conv_id", "leaf", F.coalesce("up", "node").alias("node"), (F.col("sum") + F.coalesce("passed", F.lit(0.0))).alias("sum"))
    whole = at.join(jumps[0].select("conv_id", "node"), ["conv_id", "node"], "left_anti").join(nodes.select("conv_id", "node", "score"), ["conv_id", "node"])
    order = Window.partitionBy("conv_id").orderBy(F.desc(F.col("sum") + F.col("score")), "leaf")
    return whole.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("conv_id", "leaf", "rank")


def path_messages(leaves: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(conv_id, leaf, rank, node, distance): the messages of the leaves' paths; distance counts from the leaf."""
    member = leaves.select("conv_id", "leaf", "rank", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("distance"))
    for k, jump in enumerate(jumps):
        further = member.join(jump.select("conv_id", "node", "up"), ["conv_id", "node"]).select("conv_id", "leaf", "rank", F.col("up").alias("node"), (F.col("distance") + (1 << k)).alias("distance"))
        member = stored(member.union(further), "chat-paths")
    return member


def format_chats(messages: DataFrame, top: int = 1, trained_role: str = "assistant") -> DataFrame:
    """(conv_id, leaf, rank, formatted, mask): the best paths of every conversation as ChatML.

    messages: conv_id, node, parent, role, text, score. A root's parent is null or absent. Null roles and texts count as
    empty, null scores as 0. Paths are ranked by the sum of scores, ties by the smaller leaf. mask lists (at, length) in
    code points of formatted for the texts to train on. Rows with a null conv_id or node are left out; of rows that share
    a conv_id and a node, the one whose (parent, role, text, score) sorts first counts. Long texts and conversations are
    formatted whole. An empty table gives an empty result; other columns are ignored. Jobs run while the result is built."""
    messages = messages.filter("conv_id is not null and node is not null").select("conv_id", "node", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    once = F.row_number().over(Window.partitionBy("conv_id", "node").orderBy("parent", "role", "text", "score"))
    # Written once: the rounds read ids and scores alone, and texts are not numbered a second time for the final join.
    messages = stored(messages.withColumn("_nth", once).filter("_nth = 1").drop("_nth"), "chat-messages")
    nodes = messages.select("conv_id", "node", "parent", "score")
    jumps = _jumps(nodes)
    member = path_messages(stored(ranked_leaves(nodes, jumps, top), "chat-leaves"), jumps)
    turns = member.join(messages.drop("score", "parent"), ["conv_id", "node"])
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    turns = turns.withColumn("head", head).withColumn("body", escape(F.col("text"))).withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    order = Window.partitionBy("conv_id", "leaf").orderBy(F.desc("distance"))
    turns = turns.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("head"))
    span = F.when((F.col("role") == trained_role) & (F.length("body") > 0), F.struct("at", F.length("body").cast("long").alias("length")))
    grouped = turns.groupBy("conv_id", "leaf", "rank").agg(F.array_sort(F.collect_list(F.struct((-F.col("distance")).alias("k"), F.col("piece"), span.alias("span")))).alias("t"))
    return grouped.select("conv_id", "leaf", "rank", F.array_join(F.col("t.piece"), "").alias("formatted"), F.filter(F.col("t.span"), lambda x: x.isNotNull()).alias("mask"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> back from the formatted string."""

    def turn(x: Column) -> Column:
        role = F.substring_index(x, "\n", 1)
        body = F.substr(x, F.length(role) + 2, F.length(x) - F.length(role) - F.lit(1 + len(END) + 1))
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    pieces = F.split(formatted, r"<\|im_start\|>", -1)
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces) - 1), turn)


def masked_text(formatted: Column, mask: Column) -> Column:
    return F.array_join(F.transform(mask, lambda m: unescape(F.substr(formatted, (m["at"] + 1).cast("int"), m["length"].cast("int")))), "")


ORACLE = r"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(12 + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 10 + 1)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""
