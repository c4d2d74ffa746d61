"""Chat formatting of reply trees.

Messages are nodes ``(tree_id, msg_id, parent_id, role, text, score)``.  Paths from a root to each leaf are found by
iterative self-joins that double their reach: every node knows its ancestor 2^k steps up,
and every leaf the nodes on its path up to there; a round joins the two.  Paths are then ranked within their tree
by their mean score, and each chosen path is formatted as one conversation.

Format: every turn is ``### role: text</turn>\\n``.  In texts and roles, backslash, ``#`` and
``<`` are written as ``\\\\``, ``\\h`` and ``\\l`` (in roles also ``:`` as ``\\c``), so neither mark can
occur inside a text and the original comes back exactly.  The loss mask is the list of
character spans of the assistants' texts.

Defined cases: null roles and texts are empty; a parent that does not exist in the tree, or whose id is not
smaller than the child's, makes its child a root, so there are no cycles; a null ``tree_id`` or ``msg_id`` is
dropped; of repeated ids in a tree the row with the smallest (role, text) counts; null scores are 0; ties of
branches go to the smaller leaf id; an empty table gives no rows.  A conversation is one output row and has to
fit into it; its length is otherwise free (rounds grow with the logarithm of the depth).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import pick, stored

OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
NODE = ["tree_id", "msg_id"]


# ---------------------------------------------------------------- template
def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("#"), F.lit("\\h")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Pairs of backslashes stand for themselves; between them only the letter codes are left."""

    def codes(part: Column) -> Column:
        out = F.replace(F.replace(part, F.lit("\\h"), F.lit("#")), F.lit("\\l"), F.lit("<"))
        return F.replace(out, F.lit("\\c"), F.lit(":"))

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), codes), "\\")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


# ------------------------------------------------------------------- paths
def message_table(messages: DataFrame) -> DataFrame:
    """Clean nodes: one row per (tree_id, msg_id), parents that cannot be are null."""
    rows = pick(messages, tree_id="long", msg_id="long", parent_id="long", role="string", text="string", score="double")
    rows = rows.where(F.col("tree_id").isNotNull() & F.col("msg_id").isNotNull()).select(
        *NODE,
        F.when(F.col("parent_id") < F.col("msg_id"), F.col("parent_id")).alias("parent_id"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
    first = F.row_number().over(Window.partitionBy(*NODE).orderBy("role", "text", "parent_id"))
    return rows.withColumn("rn", first).where("rn = 1").drop("rn")


def paths(nodes: DataFrame) -> DataFrame:
    """(tree_id, leaf, msg_id, up): the nodes of each root-to-leaf path, ``up`` steps above the leaf.

    ``nodes`` (tree_id, msg_id, parent_id) is used several times and should be cheap to read.
    """
    links = nodes.select(*NODE, "parent_id")
    real = links.select("tree_id", F.col("msg_id").alias("parent_id"))
    jumps = links.where("parent_id is not null").join(real, ["tree_id", "parent_id"], "left_semi")
    jumps = stored(jumps.select(*NODE, F.col("parent_id").alias("to")), "reply-jumps")
    parents = jumps.select("tree_id", F.col("to").alias("msg_id"))
    leaves = links.join(parents, NODE, "left_anti")
    reach = leaves.select("tree_id", F.col("msg_id").alias("leaf"), "msg_id", F.lit(0).cast("long").alias("up"))
    reach, step = stored(reach, "reply-paths"), 1
    while not jumps.isEmpty():
        further = reach.join(jumps, NODE).select("tree_id", "leaf", F.col("to").alias("msg_id"), (F.col("up") + step).alias("up"))
        reach = stored(reach.union(further), "reply-paths")
        again = jumps.select("tree_id", F.col("msg_id").alias("start"), F.col("to").alias("msg_id"))
        jumps = stored(
            again.join(jumps, NODE).select("tree_id", F.col("start").alias("msg_id"), "to"), "reply-jumps"
        )
        step *= 2
    return reach


def rank_branches(reach: DataFrame, nodes: DataFrame, branches: int | None = None) -> DataFrame:
    """(tree_id, leaf, branch, branch_score): paths by falling mean score; the first ``branches`` of a tree, or all."""
    scored = reach.join(nodes.select(*NODE, "score"), NODE).groupBy("tree_id", "leaf").agg(
        F.avg("score").alias("branch_score")
    )
    branch = F.row_number().over(Window.partitionBy("tree_id").orderBy(F.desc("branch_score"), "leaf"))
    ranked = scored.withColumn("branch", branch)
    return ranked if branches is None else ranked.where(F.col("branch") <= branches)


# -------------------------------------------------------------- formatting
def format_trees(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """(tree_id, leaf, branch, branch_score, formatted, loss_spans): one row per chosen path.

    ``loss_spans`` holds (start, length) in characters of each assistant text, as it stands in ``formatted``.
    """
    nodes = stored(message_table(messages), "reply-nodes")
    reach = paths(nodes)
    chosen = rank_branches(reach, nodes, branches)
    turns = reach.join(nodes, NODE).select(
        "tree_id",
        "leaf",
        F.col("msg_id"),
        F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(COLON)).alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("role") == "assistant").alias("loss"),
    )
    # ids rise along a path
    grouped = turns.groupBy("tree_id", "leaf").agg(
        F.array_sort(F.collect_list(F.struct("msg_id", "head", "body", "loss"))).alias("turns")
    )
    close = len(CLOSE)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans"))

    def advance(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(turn["head"])
        size = F.length(turn["body"]).cast("long")
        span = F.array(F.struct(begin.alias("start"), size.alias("length")))
        return F.struct(
            (begin + size + close).alias("at"),
            F.when(turn["loss"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    pieces = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE)))
    formatted = grouped.select(
        "tree_id",
        "leaf",
        F.array_join(pieces, "").alias("formatted"),
        F.aggregate("turns", start, advance, lambda s: s["spans"]).alias("loss_spans"),
    )
    return chosen.join(formatted, ["tree_id", "leaf"])


def read_formatted(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) and ``loss_texts`` read back from ``formatted`` and ``loss_spans``."""
    parts = F.split("formatted", CLOSE, -1)
    bodies = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        colon = F.locate(COLON, part)
        role = F.substring(part, F.lit(len(OPEN) + 1), colon - len(OPEN) - 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substring(part, colon + len(COLON), F.length(part))).alias("text"))

    def loss(span: Column) -> Column:
        return unescape(F.substring(F.col("formatted"), (span["start"] + 1).cast("int"), span["length"].cast("int")))

    return formatted.select("*", F.transform(bodies, turn).alias("turns"), F.transform("loss_spans", loss).alias("loss_texts"))


def conversations_as_trees(conversations: DataFrame) -> DataFrame:
    """Turns of conversations as chains: each turn answers the one before it.

    Turns go by their number; repeated numbers by role and text, and repeated rows stay.
    """
    rows = pick(conversations, conv_id="long", turn="long", role="string", text="string")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.where("conv_id is not null").withColumn("msg_id", F.row_number().over(order).cast("long"))
    return numbered.select(
        F.col("conv_id").alias("tree_id"),
        "msg_id",
        F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def digests(read: DataFrame) -> DataFrame:
    """The figures of a formatted conversation, from what was read back of it."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return read.select(
        F.col("tree_id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
x AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
             length(text) + len(regexp_extract_all(text, '[\\#<]')) AS body,
             length(role) + len(regexp_extract_all(role, '[\\#<:]')) AS head FROM t)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + head + 2 + body + 8) AS BIGINT) AS formatted_chars
FROM x GROUP BY conv_id
"""
