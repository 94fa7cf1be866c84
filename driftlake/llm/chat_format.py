"""Chat formatting from event logs, by DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """No `<|` is left: every `<`, backslashes, `|` gets one more backslash."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def final_messages(events: DataFrame) -> DataFrame:
    """Fold a log of events (conv_id, message, seq, kind, role, text) into messages (conv_id, message, role, text).

    Of each message, in order of seq (then kind, role and text, so that ties have one order): `delta` appends its text,
    `edit` sets the text, `regenerate` empties it, `delete` removes the message unless something follows. The role is
    that of the last event that has one. Null texts are empty; unknown kinds and nulls of kind count as delta; events of null
    conv_id or message are those of one more conversation or message; rows that repeat are events of their own; an empty log has
    no messages. Other columns of the log are left out. Only one message's events meet in a row.
    """
    reset = F.col("kind").isin("edit", "regenerate", "delete")
    w = Window.partitionBy("conv_id", "message").orderBy("seq", "kind", "role", "text")
    marked = events.select("conv_id", "message", "seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    marked = marked.withColumn("epoch", F.sum(F.when(reset, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("at", F.row_number().over(w))
    last = Window.partitionBy("conv_id", "message")
    live = marked.withColumn("last", F.max("epoch").over(last)).withColumn("role", F.max(F.when(F.col("role").isNotNull(), F.struct("at", "role"))).over(last)["role"])
    live = live.where("epoch = last")
    folded = live.groupBy("conv_id", "message").agg(F.first("role").alias("role"), F.count_if(F.coalesce(F.col("kind") != "delete", F.lit(True))).alias("kept"), F.array_sort(F.collect_list(F.struct("at", F.when(F.col("kind").isin("regenerate", "delete"), "").otherwise(F.col("text")).alias("text")))).alias("texts"))
    return folded.where("kept > 0").select("conv_id", "message", F.coalesce("role", F.lit("")).alias("role"), F.array_join("texts.text", "").alias("text"))


def render(messages: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row for each conversation: formatted text and loss spans (code points, end exclusive) over `trained`'s texts.

    A turn is <|im_start|>, the role (percent-encoded), a line break, the escaped text, <|im_end|> and a line break; turns
    are in order of message."""
    turn = F.concat(F.lit(START), F.url_encode("role"), F.lit("\n"), escape(F.col("text")), F.lit(END + "\n"))
    each = messages.select("conv_id", F.struct("message", turn.alias("turn"), F.when(F.col("role") == trained, F.length(escape(F.col("text")))).alias("loss")).alias("m"))
    whole = each.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("m"))

    def step(acc: Column, m: Column) -> Column:
        stop = acc["at"] + F.length(m["turn"]) - len(END) - 1
        span = F.when(m["loss"].isNotNull(), F.array(F.struct((stop - m["loss"]).alias("start"), stop.alias("end")))).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
        return F.struct((acc["at"] + F.length(m["turn"])).alias("at"), F.concat(acc["spans"], span).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return whole.select("conv_id", F.array_join("m.turn", "").alias("formatted"), F.aggregate("m", begin, step)["spans"].alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns (role, text) and the trained texts again, from the formatted text and its loss spans."""
    turns = F.filter(F.split("formatted", r"<\|im_start\|>", -1), lambda t: t != "")

    def parsed(t: Column) -> Column:
        body = F.substring(t, F.lit(1), F.length(t) - len(END) - 1)
        cut = F.instr(body, "\n")
        return F.struct(F.url_decode(F.substring(body, F.lit(1), cut - 1)).alias("role"), unescape(F.substring(body, cut + 1, F.length(body))).alias("text"))

    texts = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return formatted.select("*", F.transform(turns, parsed).alias("turns"), texts.alias("trained"))
