"""Reply trees as chat texts, in DataFrame functions only.

Messages point at the message they answer. Iterative self-joins, each doubling the distance that a message sees upwards,
give every leaf its depth and score, in a few numbers a message; a tree's branches are ranked by score. The same jumps then
enumerate the messages on the paths of the chosen leaves alone, and each path is formatted as one conversation.

Template, per turn:  "### " role ": " text "</turn>" line feed.  In roles and texts "\\" is written "\\0", "<" "\\1" and "#"
"\\2", in roles also ":" "\\3"; so neither mark occurs inside them, and reading back gives every character again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from busframe.llm.common import Scratch, need

OPEN, AFTER_ROLE, END = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("#", "\\2"))


def escape(text: Column, *, role: bool = False) -> Column:
    for plain, coded in ESCAPES + ((":", "\\3"),) * role:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in ((":", "\\3"), *reversed(ESCAPES)):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def thread(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows of linear conversations as messages, each answering the one before it (null turns last, ties by role and text)."""
    need(rows, conv_col, turn_col, role_col, text_col)
    rows = rows.select(F.col(conv_col).alias("tree_id"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    place = F.row_number().over(Window.partitionBy("tree_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")).cast("long")
    rows = rows.withColumn("msg_id", place)
    return rows.select("tree_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def reply_leaves(messages: DataFrame, scratch: Scratch) -> tuple[DataFrame, list[DataFrame]]:
    """(tree_id, leaf_id, length: messages on the path, path_score) for every leaf that a root leads to; and the jumps: (t, m, up: the 2^k-th ancestor) for each k.

    A message whose parent isn't in its tree is a root. Messages on a cycle have no root and so no path.
    """
    base = messages.select("tree_id", "msg_id", "parent_id", "score")
    ids = base.select(F.col("tree_id").alias("t"), F.col("msg_id").alias("m"))
    links = base.join(ids, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("parent_id") == F.col("m")), "left").select("tree_id", "msg_id", F.col("m").alias("up"), F.lit(1).cast("long").alias("length"), F.coalesce("score", F.lit(0.0)).alias("path_score"))
    links, jumps = scratch.write(links, "links-0"), []
    open_ = links.where("up is not null").count()
    while open_:
        # Only what hasn't reached a root takes part; each sees twice as far, or ends.
        jumps.append(links.where("up is not null").select(F.col("tree_id").alias("t"), F.col("msg_id").alias("m"), "up"))
        above = links.select(F.col("tree_id").alias("t"), F.col("msg_id").alias("m"), F.col("up").alias("up2"), F.col("length").alias("length2"), F.col("path_score").alias("score2"))
        far = links.where("up is not null").join(above, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("up") == F.col("m")))
        far = far.select("tree_id", "msg_id", F.col("up2").alias("up"), (F.col("length") + F.col("length2")).alias("length"), (F.col("path_score") + F.col("score2")).alias("path_score"))
        links = scratch.write(links.where("up is null").unionByName(far), f"links-{len(jumps)}")
        now = links.where("up is not null").count()
        if now == open_:  # only cycles are left
            break
        open_ = now
    answered = base.where("parent_id is not null").select(F.col("tree_id").alias("t"), F.col("parent_id").alias("m")).distinct()
    leaves = links.where("up is null").join(answered, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("msg_id") == F.col("m")), "left_anti")
    return leaves.select("tree_id", F.col("msg_id").alias("leaf_id"), "length", "path_score"), jumps


def path_steps(leaves: DataFrame, jumps: list[DataFrame], scratch: Scratch) -> DataFrame:
    """Rows of `leaves` once for each message (step) on their path, with its place (pos, the root's is 1).

    Every distance to a leaf is a sum of different powers of two in one way, so each message is found once.
    """
    steps = leaves.withColumns({"step": F.col("leaf_id"), "pos": F.col("length")})
    for k, jump in enumerate(jumps):
        further = steps.join(jump, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("step") == F.col("m")))
        further = further.select(*leaves.columns, F.col("up").alias("step"), (F.col("pos") - (1 << k)).alias("pos"))
        steps = scratch.write(steps.unionByName(further), f"steps-{k}")
    scratch.drop(*[f"steps-{k}" for k in range(len(jumps) - 1)])
    return steps


def format_replies(messages: DataFrame, *, branches: int | None = 1, loss_role: str = "assistant") -> DataFrame:
    """The `branches` best paths of each reply tree (None: all of them), each as one text.

    messages: tree_id, msg_id (unique in its tree), parent_id (null: a root), role, text, score (a path's score is their
    sum; ties go to the smaller leaf). Returns tree_id, leaf_id, rank (from 1), path_score, formatted (string) and
    loss_spans (array of start, length in code points of `formatted`, start from 0): where the loss applies, which is the
    escaped text of each turn of `loss_role`.

    Null roles and texts are empty, null scores 0; a null tree_id is a tree of its own; other columns are ignored. An empty
    table gives no rows. A conversation is one row, so memory goes with the longest of them; what is kept of the other
    messages is a few numbers each.
    """
    need(messages, "tree_id", "msg_id", "parent_id", "role", "text", "score")
    scratch = Scratch(messages.sparkSession, "chat")
    messages = scratch.write(messages.select("tree_id", "msg_id", "parent_id", "role", "text", F.col("score").cast("double").alias("score")), "messages")
    paths, jumps = reply_leaves(messages, scratch)
    order = Window.partitionBy("tree_id").orderBy(F.col("path_score").desc(), "leaf_id")
    paths = paths.withColumn("rank", F.row_number().over(order))
    if branches is not None:
        paths = paths.where(F.col("rank") <= branches)
    steps = path_steps(scratch.write(paths, "chosen"), jumps, scratch)
    said = messages.select(F.col("tree_id").alias("t"), F.col("msg_id").alias("m"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    steps = steps.join(said, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("step") == F.col("m")))
    head = F.concat(F.lit(OPEN), escape(F.col("role"), role=True), F.lit(AFTER_ROLE))
    turn = F.struct("pos", F.concat(head, escape(F.col("text")), F.lit(END)).alias("turn"), F.length(head).alias("head"), (F.col("role") == loss_role).alias("loss"))
    talks = steps.groupBy("tree_id", "leaf_id", "rank", "path_score").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start: int, length: int>>)").alias("spans"))

    def add(acc: Column, x: Column) -> Column:
        span = F.struct((acc["at"] + x["head"]).alias("start"), (F.length(x["turn"]) - x["head"] - len(END)).alias("length"))
        return F.struct((acc["at"] + F.length(x["turn"])).alias("at"), F.when(x["loss"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return talks.select("tree_id", "leaf_id", "rank", "path_score", F.array_join(F.transform("turns", lambda x: x["turn"]), "").alias("formatted"), F.aggregate("turns", start, add)["spans"].alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss text of format_replies() output: adds turns (array of role, text) and loss_text, both unescaped."""
    parts = F.split("formatted", END)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def parse(x: Column) -> Column:
        at = F.instr(x, F.lit(AFTER_ROLE))
        return F.struct(unescape(F.substring(x, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)).alias("role"), unescape(F.substring(x, at + len(AFTER_ROLE), F.length(x))).alias("text"))

    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return formatted.withColumns({"turns": F.transform(parts, parse), "loss_text": F.array_join(loss, "")})
