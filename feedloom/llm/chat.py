"""Chat formatting from an event log, by DataFrame functions only.

``reconstruct`` folds a log of events into final messages; ``render`` writes each conversation as one string with a
loss mask; ``parse`` reads both back.

Events have ``conv_id, seq, message, role, kind, text``. ``delta`` appends its text to a message; ``edit`` replaces the
text so far; ``regenerate`` drops it, and later deltas form the new one. Within a message, the last edit or
regeneration therefore decides where its text begins, so a message folds from its own sorted events.

Defined results: a null text, role or kind is empty (an event of another kind is a delta); a null ``conv_id`` is a
conversation of its own; a null ``message`` or ``seq`` sorts first; events that tie in ``seq`` are ordered by kind and
text; repeated events count each time; no events give no conversations. Extra columns of the log are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, HEAD, CLOSE = "<s>", "[/ROLE]", "</s>"


def escape(text: Column) -> Column:
    """No control string survives: each of them starts with ``<`` or ``[``, which a backslash now follows."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), r"([<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\|\\(\\)", "$1$2")


def message_events(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text", delta_chars: int = 256) -> DataFrame:
    """The event log of a table with one row per message: what a server that streams would have written.

    Assistant texts arrive as a first draft that is regenerated, then as deltas of ``delta_chars`` characters; other
    texts arrive as a first draft that is edited. Rows of one conversation are numbered in the order of turn, role
    and text.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    ordered = (
        rows.select(F.col(conv_id).alias("conv_id"), F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), body.alias("text")).alias("m"))
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("ms"))
        .select("conv_id", F.posexplode("ms").alias("message", "m"))
        .select("conv_id", F.col("message").cast("long").alias("message"), F.col("m.role").alias("role"), F.col("m.text").alias("text"))
    )
    count = F.ceil(F.length("text") / F.lit(delta_chars)).cast("int")
    event = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("text"))
    draft = F.concat(F.lit("draft: "), F.substring("text", 1, 16))
    deltas = F.when(count > 0, F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % delta_chars), F.lit(0))).otherwise(F.array(F.lit("")))
    streamed = F.concat(F.array(event("delta", draft), event("regenerate", F.lit(""))),
                        F.transform(deltas, lambda x: event("delta", x)))
    edited = F.array(event("delta", draft), event("edit", F.col("text")))
    return (
        ordered.select("conv_id", "message", "role", F.posexplode(F.when(F.col("role") == "assistant", streamed).otherwise(edited)).alias("k", "e"))
        .select("conv_id", (F.col("message") * F.lit(1 << 31) + F.col("k")).alias("seq"), "message", "role", "e.kind", "e.text")
    )


def reconstruct(events: DataFrame) -> DataFrame:
    """``conv_id, message, role, text`` of the final messages."""
    kind, text = F.coalesce("kind", F.lit("delta")), F.coalesce("text", F.lit(""))
    folded = events.groupBy("conv_id", "message").agg(
        F.min_by("role", "seq").alias("first_role"), F.max("role").alias("any_role"),
        F.sort_array(F.collect_list(F.struct("seq", kind.alias("kind"), text.alias("text")))).alias("log"),
    )
    # The last reset is the last position whose kind is not a plain delta; 0 if there is none.
    last = F.aggregate(
        F.sequence(F.lit(1), F.size("log")), F.lit(1),
        lambda acc, i: F.when(F.element_at("log", i)["kind"].isin("edit", "regenerate"), i).otherwise(acc),
    )
    kept = F.slice("log", last, F.size("log") - last + 1)
    said = F.transform(kept, lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"]))
    return folded.select("conv_id", "message", F.coalesce("first_role", "any_role", F.lit("")).alias("role"), F.array_join(said, "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_mask``: the mask lists start (from 0) and length, in code points, of the escaped
    assistant texts."""
    turns = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("message", "role", "text"))).alias("turns"))
    head = lambda m: F.concat(F.lit(OPEN), escape(m["role"]), F.lit(HEAD))
    parts = F.transform("turns", lambda m: F.struct(m["role"].alias("role"), head(m).alias("head"), escape(m["text"]).alias("body")))
    parted = turns.select("conv_id", parts.alias("parts"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.length(p["head"])
        span = F.array(F.struct(begin.alias("start"), F.length(p["body"]).alias("length")))
        return F.struct(
            (begin + F.length(p["body"]) + F.lit(len(CLOSE))).alias("at"),
            F.when(p["role"] == "assistant", F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    return parted.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.aggregate("parts", start, step)["spans"].alias("loss_mask"),
    )


def parse(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns (role, text), loss_text, formatted`` read from the rendered string and its mask."""
    pieces = F.slice(F.split("formatted", F.lit("</s>")), 1, F.size(F.split("formatted", F.lit("</s>"))) - 1)
    turn = lambda p: F.struct(
        unescape(F.substr(F.substring_index(p, HEAD, 1), F.lit(len(OPEN) + 1))).alias("role"),
        unescape(F.substring_index(p, HEAD, -1)).alias("text"),
    )
    loss = F.transform("loss_mask", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["length"])))
    return formatted.select("conv_id", F.transform(pieces, turn).alias("turns"), F.array_join(loss, "").alias("loss_text"), "formatted")
