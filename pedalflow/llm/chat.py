"""Chat formatting by event-sourced reconstruction (DataFrame functions only).

A log has one row per event: conv_id, turn, seq, kind, role, text.  ``message``
opens a message, ``delta`` appends to the turn's latest message, ``edit`` and
``regenerate`` replace what it held so far.  Events are folded per (conversation,
turn) in order of seq: a message's text is what follows its last replacing event.
An edit also withdraws the later turns that had been written before it.  The
final messages are rendered in order of turn.

The template marks each turn ``<|im_start|>role<|im_sep|>text<|im_end|>``.
Inside roles and texts a backslash goes into every control string of the usual
templates (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``, ``<<SYS>>``); one
backslash more where there are some already, so it can be taken out again.
``loss`` holds the code point spans of the assistants' escaped texts.

Only one message's events are gathered to fold it and only one conversation's
messages to render it, which is that conversation's output row.

Defined cases: a null text or role is empty, a null conv_id is a conversation of
its own, a null turn or seq comes first; events alike in seq are taken in order
of kind (message, regenerate, edit, delta), role and text; repeated ``message``
rows are messages of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, pick

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = r"(?=\||/?s>|/?INST\]|/?SYS>>)"
KINDS = ("message", "regenerate", "edit", "delta")


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[])(\\*)" + CONTROL, r"$1\\$2")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[])\\(\\*)" + CONTROL, "$1$2")


def fold(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, turn, pos, role, text."""
    e = pick(events, "conv_id", "turn", "seq", "kind", "role", "text")
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    one = F.struct("seq", rank.alias("kind"), "role", "text")
    slots = e.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list(one)).alias("log"))
    log = F.col("log")

    def message(begin: Column, after: Column) -> Column:
        def finish(own: Column) -> Column:
            resets = F.transform(own, lambda x, i: F.when((x.getField("kind") < 3) | (i == 0), i))

            def build(last: Column) -> Column:
                parts = F.transform(
                    F.slice(own, last + 1, F.size(own)), lambda x: F.coalesce(x.getField("text"), F.lit(""))
                )
                edits = F.filter(own, lambda x: x.getField("kind") == 2)
                return F.struct(
                    F.coalesce(F.get(F.filter(own, lambda x: x.getField("role").isNotNull()), F.lit(0)).getField("role"), F.lit("")).alias("role"),
                    F.array_join(parts, "").alias("text"),
                    F.get(own, last).getField("seq").alias("written"),
                    F.array_max(F.transform(edits, lambda x: x.getField("seq"))).alias("edited"),
                )

            return let(F.array_max(resets), build)

        return let(F.slice(log, begin + 1, after - begin), finish)

    def messages(begins: Column) -> Column:
        return F.transform(begins, lambda b, i: message(b, F.coalesce(F.get(begins, i + 1), F.size(log))))

    opens = F.filter(
        F.transform(log, lambda x, i: F.when((x.getField("kind") == 0) | (i == 0), i)), lambda i: i.isNotNull()
    )
    m = slots.select("conv_id", "turn", F.posexplode(let(opens, messages)).alias("pos", "m")).select(
        "conv_id", "turn", "pos", "m.*"
    )
    # an edit withdraws later turns written before it
    earlier = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("edit_before", F.max("edited").over(earlier))
    kept = F.col("edit_before").isNull() | F.col("written").isNull() | (F.col("written") > F.col("edit_before"))
    return m.filter(kept).select("conv_id", "turn", "pos", "role", "text")


def render(messages: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """conv_id, ``formatted`` and ``loss`` (spans of code points, end exclusive) of every conversation."""
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP))
    body = escape(F.col("text"))
    m = messages.select("conv_id", "turn", "pos", "role", head.alias("head"), body.alias("body"))
    before = Window.partitionBy("conv_id").orderBy("turn", "pos").rowsBetween(Window.unboundedPreceding, -1)
    piece = F.concat("head", "body", F.lit(END))
    m = m.withColumn("piece", piece).withColumn(
        "at", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0).cast("long"))
    )
    start = F.col("at") + F.length("head")
    span = F.when(F.col("role") == learn_from, F.struct(start.alias("start"), (start + F.length("body")).alias("stop")))
    g = m.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "turn", "pos", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(span)).alias("loss"),
    )
    return g.select("conv_id", F.array_join(F.col("pieces.piece"), "").alias("formatted"), "loss")


def read_back(formatted: Column) -> Column:
    """The turns of a rendered conversation as array of (role, text)."""
    pieces = F.split(formatted, r"<\|im_end\|>")

    def turn(p: Column) -> Column:
        inner = F.substring_index(p, START, -1)
        return F.struct(
            unescape(F.substring_index(inner, SEP, 1)).alias("role"),
            unescape(F.substring_index(inner, SEP, -1)).alias("text"),
        )

    return F.transform(F.filter(pieces, lambda p: p != ""), turn)


def digest(chats: DataFrame) -> DataFrame:
    """What the rendered conversations hold, read back from them."""

    def said(turns: Column) -> Column:
        lines = F.transform(turns, lambda t: F.concat(t.getField("role"), F.lit("\n"), t.getField("text"), F.lit("\n")))
        return F.struct(
            F.size(turns).cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256")
        )

    text = F.col("formatted")
    under = F.transform(
        "loss",
        lambda s: unescape(
            F.substring(text, (s.getField("start") + 1).cast("int"), (s.getField("stop") - s.getField("start")).cast("int"))
        ),
    )
    d = chats.withColumn("said", let(read_back(text), said)).withColumn("learned", F.array_join(under, ""))
    return d.select(
        "conv_id",
        "said.n_turns",
        "said.turns_sha256",
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length(text).cast("long").alias("formatted_chars"),
    )


def as_events(rows: DataFrame) -> DataFrame:
    """Plain conversation rows (conv_id, turn, role, text) as a log of messages."""
    return pick(rows, "conv_id", "turn", "role", "text").select(
        "conv_id", "turn", F.col("turn").alias("seq"), F.lit("message").alias("kind"), "role", "text"
    )
