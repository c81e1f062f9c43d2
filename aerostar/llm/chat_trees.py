"""Chat formatting of reply trees: choose root-to-leaf paths, write each as one
conversation with a loss mask. DataFrame functions only.

Paths are enumerated by iterative self-joins that double their reach: after
round k each message knows its ancestor 2^k steps up, the number of steps and
the sum of scores over them, so a chain of n messages takes log2(n) joins of
narrow rows. Leaves are ranked in their conversation by the mean score of
their path; the chosen leaves collect their ancestors by the same jumps.

Format of a turn: ``### role:\\n`` text ``</turn>\\n``. Inside roles and texts
``&``, ``<`` and ``#`` are written as entities (and ``:`` and newline too in
roles), so no text can hold a control string, and reading reverses it. The
loss mask is the list of (start, length) in code points of the formatted
string that cover the assistant's texts.

Rows of a conversation meet only where its one formatted string is built; the
joins spread over (conversation, message).

Cases: null text or role is empty; null conversation id is one conversation.
Rows by turn (``chain``): ties of turn are ordered by role, then text; repeated
rows are turns of their own. Trees (``paths``): a message is what its id names,
so of rows that repeat an id the one with the least parent, role, text and score
(nulls first) is taken; a message whose parent is missing is a root. Messages
that no root-to-leaf path can hold are not in the result but in ``unplaced``, with
the reason: those without an id, and those whose replies lead into a cycle. An
empty table gives no rows. Columns beyond those named are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .staging import staged

LEARNT_ROLE = "assistant"
END = "</turn>\n"
#: Written form of characters in texts; the ampersand first.
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("#", "&num;"))
ROLE_ENTITIES = ENTITIES + ((":", "&colon;"), ("\n", "&nl;"))


def escaped(text: Column, entities=ENTITIES) -> Column:
    for plain, written in entities:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column, entities=ENTITIES) -> Column:
    for plain, written in reversed(entities):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def chain(conversations: DataFrame) -> DataFrame:
    """Rows by turn as a tree: each message replies to the one before it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select("conv_id", F.row_number().over(order).cast("long").alias("msg_id"),
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
                                ).withColumn("parent_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1)
                                ).withColumn("score", F.lit(0.0))


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))


def distinct_messages(messages: DataFrame) -> DataFrame:
    """One row per conversation and message id."""
    return (messages.where("msg_id is not null").groupBy("conv_id", "msg_id")
            .agg(F.min(F.struct("parent_id", "role", "text", "score")).alias("m")).select("conv_id", "msg_id", "m.*"))


def jumps(spark: SparkSession, messages: DataFrame) -> tuple[list[DataFrame], DataFrame, DataFrame]:
    """(reaching, paths, cyclic) of messages with distinct ids. reaching[k] holds
    the messages with an ancestor 2^k steps up: conv_id, msg_id, up, and the
    number of messages (steps) and sum of scores (total) from this one up to
    just below it. paths holds every message with the steps and total of its
    whole path to the root. A message leaves the rounds once its root is
    reached, so later rounds only carry the deep ones; one that is still on its
    way after as many steps as its conversation has messages runs in a cycle."""
    known = messages.select("conv_id", F.col("msg_id").alias("parent_id"), F.lit(True).alias("known"))
    now = (messages.alias("a").join(known.alias("b"), _same("a", "b") & (F.col("a.parent_id") == F.col("b.parent_id")), "left")
           .select("a.conv_id", "a.msg_id", F.when(F.col("b.known"), F.col("a.parent_id")).alias("up"),
                   F.lit(1).cast("long").alias("steps"), F.coalesce("a.score", F.lit(0.0)).alias("total")))
    now = staged(spark, now, "reply-jumps")
    longest = now.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    reaching, done = [], now.where("up is null")
    while 1 << len(reaching) <= longest and not now.where("up is not null").isEmpty():
        reaching.append(now.where("up is not null"))
        now = (reaching[-1].alias("a").join(reaching[-1].unionByName(done).alias("b"), _same("a", "b") & (F.col("a.up") == F.col("b.msg_id")))
               .select("a.conv_id", "a.msg_id", "b.up", (F.col("a.steps") + F.col("b.steps")).alias("steps"),
                       (F.col("a.total") + F.col("b.total")).alias("total")))
        now = staged(spark, now, "reply-jumps")
        done = done.unionByName(now.where("up is null"))
    return reaching, done, now.where("up is not null")


def unplaced(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """The rows that are on no path: conv_id, msg_id, role, text and reason
    (``no id`` or ``cycle``)."""
    _, _, cyclic = jumps(spark, distinct_messages(messages))
    bare = messages.where("msg_id is null").select("conv_id", "msg_id", "role", "text", F.lit("no id").alias("reason"))
    looped = (messages.alias("m").join(cyclic.alias("c"), _same("m", "c") & (F.col("m.msg_id") == F.col("c.msg_id")), "left_semi")
              .select("conv_id", "msg_id", "role", "text", F.lit("cycle").alias("reason")))
    return bare.unionByName(looped)


def paths(spark: SparkSession, messages: DataFrame, branches: int | None = None, distinct: bool = False) -> DataFrame:
    """Messages (conv_id, msg_id, parent_id, role, text, score) -> the messages
    of each chosen path: conv_id, leaf_id, branch (1 is the best), depth (1 is
    the root), role, text. branches: paths per conversation, all if None.
    distinct: the ids are known to be distinct and not null (as ``chain`` gives
    them), so no exchange is needed to make them so."""
    if not distinct:
        messages = staged(spark, distinct_messages(messages), "reply-distinct")
    reaching, whole, _ = jumps(spark, messages)
    parents = messages.select("conv_id", F.col("parent_id").alias("msg_id")).where("msg_id is not null").distinct()
    leaves = whole.alias("a").join(parents.alias("b"), _same("a", "b") & (F.col("a.msg_id") == F.col("b.msg_id")), "left_anti")
    rank = Window.partitionBy("conv_id").orderBy((F.col("total") / F.col("steps")).desc(), "msg_id")
    chosen = leaves.withColumn("branch", F.row_number().over(rank).cast("long"))
    if branches is not None:
        chosen = chosen.where(F.col("branch") <= branches)
    on = chosen.select("conv_id", F.col("msg_id").alias("leaf_id"), "branch", "msg_id")
    for jump in reaching:
        above = (on.alias("a").join(jump.alias("b"), _same("a", "b") & (F.col("a.msg_id") == F.col("b.msg_id")))
                 .select("a.conv_id", "a.leaf_id", "a.branch", F.col("b.up").alias("msg_id")))
        on = staged(spark, on.unionByName(above), "reply-paths")
    depth = whole.select("conv_id", "msg_id", F.col("steps").alias("depth"))
    return (on.alias("a").join(depth.alias("d"), _same("a", "d") & (F.col("a.msg_id") == F.col("d.msg_id")))
            .select("a.conv_id", "a.leaf_id", "a.branch", "a.msg_id", "d.depth").alias("a")
            .join(messages.alias("m"), _same("a", "m") & (F.col("a.msg_id") == F.col("m.msg_id")))
            .select("a.conv_id", "a.leaf_id", "a.branch", "a.depth", F.coalesce("m.role", F.lit("")).alias("role"),
                    F.coalesce("m.text", F.lit("")).alias("text")))


def format_paths(path_rows: DataFrame) -> DataFrame:
    """One row per path: conv_id, leaf_id, branch, formatted, loss_spans."""
    head = F.concat(F.lit("### "), escaped(F.col("role"), ROLE_ENTITIES), F.lit(":\n"))
    turn = F.struct("depth", head.alias("head"), escaped(F.col("text")).alias("body"), (F.col("role") == LEARNT_ROLE).alias("learnt"))
    sizes = F.transform("turns", lambda t: F.length(t.head) + F.length(t.body) + len(END))
    return (path_rows.groupBy("conv_id", "leaf_id", "branch").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
            .withColumn("formatted", F.array_join(F.transform("turns", lambda t: F.concat(t.head, t.body, F.lit(END))), ""))
            # one running sum over the turns: (position, spans so far)
            .withColumn("loss_spans", F.aggregate(
                "turns", F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
                lambda s, t: F.struct(
                    (s.at + F.length(t.head) + F.length(t.body) + len(END)).alias("at"),
                    F.when(t.learnt, F.concat(s.spans, F.array(F.struct((s.at + F.length(t.head)).alias("start"), F.length(t.body).alias("length")))))
                    .otherwise(s.spans).alias("spans")),
                lambda s: s.spans))
            .drop("turns"))


def read_turns(formatted: Column) -> Column:
    """Formatted string -> array of (role, text)."""
    pieces = F.split(formatted, END.replace("\n", "\\n"))
    turns = F.slice(pieces, 1, F.size(pieces) - 1)
    cut = lambda t: F.instr(t, ":\n")  # noqa: E731  the header's end: roles hold no newline
    return F.transform(turns, lambda t: F.struct(
        unescaped(F.substring(t, F.lit(5), cut(t) - 5), ROLE_ENTITIES).alias("role"),
        unescaped(F.substring(t, cut(t) + 2, F.length(t))).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask."""
    return F.transform(spans, lambda s: unescaped(F.substring(formatted, s.start, s.length)))
