"""Conversations from messages that quote each other, with DataFrame functions only.

A line that starts with `>` marks is quoted; the number of marks is its level. Lines are
normalised (white space collapsed, lower case) and hashed. Every message's own lines are
reduced to the earliest message of each scope (a mailbox, a forum, …) that wrote the line,
by partial sums, so a line that everybody writes is one row. Quoted lines are joined to
these originals, if the original is earlier than the quote. A message replies to the
message from which most characters of its least nested linked level come; the later one
wins a tie. Replies are followed to the first message by doubling: after k rounds every
message knows its ancestor 2^k steps up, so a chain of a thousand replies takes ten.

The result is in reply order within each conversation, and the texts have no quotes: only
the message's own lines are left, without blank lines at the start and the end.

A null text is a message without lines. A message with a null id or a null order links to
nothing and is linked by nothing; a null scope is one scope. Rows with one id are one
message: they share its links and keep their own texts. Messages of equal order do not
link to each other. An empty table gives an empty result. Only the named columns are
read, so further columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclelens.llm.native import let
from cyclelens.session import written

_MARKS = r"^((?:>[\x20\x09]?)+)"
_SPACE = r"[\x20\x09-\x0D]+"


def lines_of(text: Column) -> Column:
    """Array of (level, content) of a text's lines."""

    def line(raw: Column) -> Column:
        return let(F.regexp_extract(raw, _MARKS, 1), lambda marks: F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
            F.when(marks == "", raw).otherwise(F.substring(raw, F.length(marks) + 1, F.length(raw))).alias("content"),
        ))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), line)


def normalised(content: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(content, _SPACE, " ")))


def without_quotes(lines: Column) -> Column:
    """The unquoted lines as text, without blank lines at the start and the end."""
    own = F.filter(lines, lambda line: line["level"] == 0)
    text = F.array_join(F.transform(own, lambda line: line["content"]), "\n")
    return F.regexp_replace(F.regexp_replace(text, r"^(?:[\x20\x09-\x0D]*\n)+", ""), r"(?:\n[\x20\x09-\x0D]*)+\z", "")


def _links(lines: DataFrame) -> DataFrame:
    """`msg_id`, `parent` of the messages that reply to another one."""
    own = lines.where("level = 0").groupBy("scope", "passage").agg(
        F.min(F.struct("sent", "msg_id")).alias("origin")
    )
    own = written(own.select("scope", "passage", "origin.*").toDF("scope", "passage", "origin_sent", "origin"), "quote-origins")
    quoted = lines.where("level > 0").select("scope", "passage", "msg_id", "sent", "level", "weight")
    met = quoted.join(own, ["scope", "passage"]).where("origin_sent < sent")
    votes = met.groupBy("msg_id", "level", "origin").agg(
        F.sum("weight").alias("weight"), F.max("origin_sent").alias("origin_sent")
    )
    best = F.max(F.struct(-F.col("level"), "weight", "origin_sent", "origin"))
    return votes.groupBy("msg_id").agg(best.alias("best")).select("msg_id", F.col("best.origin").alias("parent"))


def _roots(links: DataFrame) -> DataFrame:
    """`msg_id`, `root` and `depth` of every message that replies to another one. Messages
    that have reached their root take no part in further rounds."""
    going = written(links.select("msg_id", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), "quote-steps")
    ended = None
    while True:
        every = going if ended is None else going.unionByName(ended)
        above = every.select(F.col("msg_id").alias("root"), F.col("root").alias("higher"), F.col("depth").alias("more"))
        met = written(going.join(above, "root", "left"), "quote-steps")
        arrived = met.where("higher is null").select("msg_id", "root", "depth")
        ended = arrived if ended is None else ended.unionByName(arrived)
        going = met.where("higher is not null").select(
            "msg_id", F.col("higher").alias("root"), (F.col("depth") + F.col("more")).alias("depth")
        )
        if going.isEmpty():
            return ended


def conversations(df: DataFrame, id_col: str, order_col: str, text_col: str, scope_col: str | None = None) -> DataFrame:
    """`conversation` (the id of its first message), `depth` (replies from it), `sent`,
    `msg_id`, `parent`, `text` without quotes and `n_quoted` (quoted lines), in reply order."""
    scope = F.coalesce(F.col(scope_col).cast("string"), F.lit("")) if scope_col else F.lit("")
    messages = written(df.select(
        F.col(id_col).alias("msg_id"), F.col(order_col).alias("sent"), scope.alias("scope"),
        lines_of(F.col(text_col).cast("string")).alias("lines"),
    ), "quote-texts")
    line = F.col("line")
    lines = messages.where("msg_id is not null and sent is not null").select(
        "msg_id", "sent", "scope", F.explode("lines").alias("line")
    ).select("msg_id", "sent", "scope", line["level"].alias("level"), normalised(line["content"]).alias("plain"))
    lines = written(lines.where("plain <> ''").select(
        "msg_id", "sent", "scope", "level", F.length("plain").cast("long").alias("weight"),
        F.unhex(F.md5("plain")).alias("passage"),
    ), "quote-lines")
    links = written(_links(lines), "quote-links")
    placed = links.join(_roots(links), "msg_id")
    clean = messages.select(
        "msg_id", "sent", without_quotes(F.col("lines")).alias("text"),
        F.size(F.filter("lines", lambda x: x["level"] > 0)).cast("long").alias("n_quoted"),
    )
    joined = written(clean.join(placed, "msg_id", "left").select(
        F.coalesce("root", "msg_id").alias("conversation"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        "sent", "msg_id", "parent", "text", "n_quoted",
    ), "quote-messages")
    return joined.orderBy("conversation", "depth", "sent", "msg_id")


def quote(text: Column, marks: str) -> Column:
    """A text as a mail program quotes it."""
    return F.concat(F.lit(marks), F.regexp_replace(text, "\n", "\n" + marks))


def as_mails(turns: DataFrame) -> DataFrame:
    """Turns (`conv_id`, `turn`, `text`) as mails: each quotes the turn before it and, one
    level deeper, the turn before that."""
    each = turns.groupBy("conv_id", "turn").agg(F.min("text").alias("said"))
    before = each.select("conv_id", (F.col("turn") + 1).alias("turn"), quote(F.col("said"), "> ").alias("quote"))
    deeper = each.select("conv_id", (F.col("turn") + 2).alias("turn"), quote(F.col("said"), "> > ").alias("deeper"))
    met = turns.join(before, ["conv_id", "turn"], "left").join(deeper, ["conv_id", "turn"], "left")
    return met.select(
        "conv_id", "turn", F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")).alias("msg_id"),
        F.concat_ws("\n", "deeper", "quote", "text").alias("text"),
    )
