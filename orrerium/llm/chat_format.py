"""Chat formatting from reply trees, in DataFrame operations.

A tree has nodes (conversation, node, parent). Self-joins with pointer doubling give every node its ancestor 1, 2, 4, ...
steps up and the score on the way, so that a tree of depth d takes log2(d) joins. Leaves rank the branches of their
conversation by the score of the path; the chosen leaves walk back up the same tables, which enumerates each node of a
path once, and every path becomes one conversation.

The template writes a turn as `### role: text</turn>` and a line end. A backslash before the last character of a control
string inside a role or text keeps it from being one; backslashes are doubled. Reading back is a split at the control
strings and the removal of those backslashes. The loss mask is the list of spans that assistants wrote.

Defined cases: a null role or text is an empty one; a node whose parent is missing is a root; nodes that only reach a
cycle belong to no path; nodes with equal (conversation, node) are folded into the least of them by role and text; ties of
branches go to the least leaf. An empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpoint

#: Fixed values of the template.
HEAD, MIDDLE, END, LINE = "### ", ": ", "</turn>", "\n"
TRAINED = "assistant"


def escaped(text: Column, role: bool = False) -> Column:
    """A control string is broken before its last sign: ##\\#, <\\/turn>, and in a role \\: too."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    out = F.regexp_replace(out, "(?<=##)#", r"\\#")
    out = F.replace(out, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(out, F.lit(":"), F.lit("\\:")) if role else out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def _ancestors(nodes: DataFrame) -> list[DataFrame]:
    """Tables (conv, node, up, score) by power of two: the ancestor 2**k steps up, and the score of the nodes passed."""
    step = nodes.select("conv", "node", F.col("parent").alias("up"), "score")
    known = nodes.select("conv", F.col("node").alias("up"))
    step = checkpoint(step.join(known, ["conv", "up"]).select("conv", "node", "up", "score"))
    out = [step]
    longest = nodes.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    while 2 ** len(out) < longest:
        upper = step.select("conv", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("score").alias("score2"))
        step = checkpoint(step.join(upper, ["conv", "up"]).select("conv", "node", F.col("up2").alias("up"), (F.col("score") + F.col("score2")).alias("score")))
        if step.isEmpty():
            break
        out.append(step)
    return out


def paths(tree: DataFrame, best: int = 1) -> DataFrame:
    """conv, leaf, rank, path_score, depth (0 at the root), role and text of each node on the best paths of each conversation.

    tree: conv, node, parent, role, text, score.
    """
    fold = F.min(F.struct(F.col("parent"), F.coalesce("score", F.lit(0.0)).alias("score"), "role", "text")).alias("n")
    nodes = checkpoint(tree.groupBy("conv", "node").agg(fold).select("conv", "node", "n.*"))
    tables = _ancestors(nodes.select("conv", "node", "parent", "score"))
    has_reply = tables[0].select("conv", F.col("up").alias("node"))
    leaves = nodes.select("conv", "node", "score").join(has_reply, ["conv", "node"], "left_anti")
    # Up from each leaf by the largest step that exists, then smaller ones: what is passed on the way adds up to the path.
    at = leaves.select("conv", F.col("node").alias("leaf"), "node", F.lit(0).cast("double").alias("passed"), F.lit(0).cast("long").alias("depth"))
    for k in reversed(range(len(tables))):
        up = tables[k].select("conv", "node", "up", F.col("score").alias("more"))
        at = at.join(up, ["conv", "node"], "left").select("conv", "leaf", F.coalesce("up", "node").alias("node"), (F.col("passed") + F.coalesce("more", F.lit(0.0))).alias("passed"), (F.col("depth") + F.when(F.col("up").isNotNull(), 2**k).otherwise(0)).alias("depth"))
    # Whoever climbed from below a cycle still stands in it; only nodes without a known parent are roots.
    root = nodes.join(tables[0].select("conv", "node"), ["conv", "node"], "left_anti").select("conv", "node", F.col("score").alias("own"))
    scored = at.join(root, ["conv", "node"]).select("conv", "leaf", (F.col("passed") + F.col("own")).alias("path_score"), "depth")
    rank = F.row_number().over(Window.partitionBy("conv").orderBy(F.desc("path_score"), "leaf"))
    chosen = checkpoint(scored.withColumn("rank", rank).filter(F.col("rank") <= best))
    walk = chosen.withColumn("node", F.col("leaf"))
    for k in reversed(range(len(tables))):
        # Each place on the path stays and, where it has an ancestor 2**k up, brings that one along.
        up = tables[k].select("conv", "node", "up")
        here = F.struct("node", "depth")
        above = F.struct(F.col("up").alias("node"), (F.col("depth") - 2**k).alias("depth"))
        both = F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, above))
        walk = walk.join(up, ["conv", "node"], "left").select("conv", "leaf", "path_score", "rank", F.inline(both))
    return walk.join(nodes.select("conv", "node", "role", "text"), ["conv", "node"]).select("conv", "leaf", "rank", "path_score", "depth", "role", "text")


def formatted(turns: DataFrame) -> DataFrame:
    """conv, leaf, rank, path_score, n_turns, formatted and loss_spans (start and length in code points) of each path."""
    head = F.concat(F.lit(HEAD), escaped(F.col("role"), role=True), F.lit(MIDDLE))
    turn, before = F.concat(head, escaped(F.col("text")), F.lit(END + LINE)), F.length(head)
    turns = turns.select("conv", "leaf", "rank", "path_score", "depth", turn.alias("turn"), before.alias("before"), F.coalesce(F.col("role") == TRAINED, F.lit(False)).alias("trained"))
    so_far = F.coalesce(F.sum(F.length("turn")).over(Window.partitionBy("conv", "leaf", "rank", "path_score").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    span = F.when(F.col("trained"), F.struct((so_far + F.col("before")).alias("start"), (F.length("turn") - F.col("before") - len(END + LINE)).cast("long").alias("length")))
    placed = turns.withColumn("span", span)
    all_ = placed.groupBy("conv", "leaf", "rank", "path_score").agg(F.array_sort(F.collect_list(F.struct("depth", "turn"))).alias("t"), F.array_sort(F.collect_list("span")).alias("loss_spans"))
    return all_.select("conv", "leaf", "rank", "path_score", F.size("t").cast("long").alias("n_turns"), F.array_join("t.turn", "").alias("formatted"), "loss_spans")


def read_back(column: str = "formatted") -> Column:
    """Array of (role, text) from a formatted conversation."""
    pieces = F.expr(f"filter(split({column}, '</turn>\\n'), x -> x <> '')")
    return F.transform(
        pieces,
        lambda x: F.struct(
            unescaped(F.regexp_extract(x, r"(?s)^### ([^:\\]*+(?:\\.[^:\\]*+)*+): ", 1)).alias("role"),
            unescaped(F.regexp_replace(x, r"(?s)^### [^:\\]*+(?:\\.[^:\\]*+)*+: ", "")).alias("text"),
        ),
    )


def masked(column: str = "formatted", spans: str = "loss_spans") -> Column:
    """The unescaped text under the loss mask, read from the formatted conversation."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(F.col(column), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def tree_of(conversations: DataFrame) -> DataFrame:
    """The tree of rows by turn: each replies to the one before; rows of one turn follow in order of role and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").alias("conv"), "turn", role.alias("role"), text.alias("text"))
    # A null id is one conversation too; joins below compare whole keys.
    rows = rows.withColumn("conv", F.struct(F.col("conv").isNull().alias("missing"), F.coalesce("conv", F.lit(0).cast(conversations.schema["conv_id"].dataType)).alias("id")))
    node = F.row_number().over(Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_last(), "role", "text")).cast("long")
    rows = rows.withColumn("node", node)
    return rows.select("conv", "node", (F.col("node") - 1).alias("parent"), "role", "text", F.lit(1.0).alias("score"))


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from the formatted text."""
    out = formatted(paths(tree_of(conversations))).withColumn("turns", read_back()).withColumn("loss", masked())
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.when(~F.col("conv.missing"), F.col("conv.id")).alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "path_score",
    )
