"""Operator 2: chat formatting by event-sourced reconstruction, with built-in functions only.

A log holds events ``conv_id, message, seq, kind, role, text``. Events of a conversation are
ordered by ``message`` (its place in the conversation) and ``seq``. Kinds:

``message``  a complete message; it never mixes with other events, and every such row is a turn.
``delta``    streamed text, appended to the message so far.
``edit``     replaces the text of the message.
``regenerate``  drops the text of the message and starts over with this text.

Defined cases: a null text is empty, a null role is ``unknown``, a null kind is ``message``; null
``message`` or ``seq`` come first. The role of a folded message is that of its last event
with a role. Rows without ``conv_id`` form one conversation with a null id. Ties are ordered by kind, role
and text, so repeated rows stay apart only as complete messages or deltas. Other columns are ignored.

Template: ``<s>role\\ntext</s>`` for each turn. Inside roles and texts a backslash goes after the
first character of each control string, and one more where there already are some, so no
control string is left and the change can be undone. In roles ``%`` and line breaks are
percent-coded, so the first line break ends the role. The loss mask covers the text of the
assistant's turns.

A conversation may hold most of a log. It is rendered in fragments of up to 64 message places, each in a task of
its own; the formatted conversation is its fragments in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings that texts may not contain.
CONTROL = r"/?s>|/?INST\]|/?SYS\]"
FIRST = r"[<\[]"
FRAGMENT_PLACES = 64
TURN_OPEN, TURN_CLOSE, LOSS_ROLE = "<s>", "</s>", "assistant"


def escaped(text: Column) -> Column:
    """``text`` without control strings."""
    return F.regexp_replace(text, rf"({FIRST})(\\*)(?={CONTROL})", r"$1\\$2")


def unescaped(text: Column) -> Column:
    """Undoes ``escaped``."""
    return F.regexp_replace(text, rf"({FIRST})\\(\\*)(?={CONTROL})", r"$1$2")


def _role_out(role: Column) -> Column:
    coded = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return escaped(coded)


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def message_events(conversations: DataFrame) -> DataFrame:
    """The log of a table of finished turns (``conv_id, turn, role, text``)."""
    return conversations.select(
        "conv_id", F.col("turn").alias("message"), F.col("turn").alias("seq"), F.lit("message").alias("kind"), "role", "text"
    )


def format_conversations(events: DataFrame) -> DataFrame:
    """Fragments ``conv_id, fragment, formatted, loss_spans`` of the rendered conversations.

    ``loss_spans`` are (start, length) in code points of ``formatted``, in order. The log
    crosses the network once: all that follows works within (conversation, fragment).
    """
    clean = events.select(
        "conv_id", F.floor(F.col("message") / FRAGMENT_PLACES).cast("long").alias("fragment"), "message", "seq",
        F.coalesce("kind", F.lit("message")).alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text"),
    ).repartition("conv_id", "fragment")
    one = F.struct("seq", "kind", "role", "text")
    logs = clean.groupBy("conv_id", "fragment", "message").agg(F.array_sort(F.collect_list(one)).alias("log"))
    whole = F.filter("log", lambda e: e["kind"] == "message")
    parts = F.filter("log", lambda e: e["kind"] != "message")
    last_reset = F.array_max(F.transform("parts", lambda e, i: F.when(e["kind"] != "delta", i).otherwise(-1)))
    live = F.slice("parts", F.greatest(last_reset, F.lit(0)) + 1, F.size("parts"))
    roles = F.filter(F.transform("parts", lambda e: e["role"]), lambda r: r.isNotNull())
    folded = F.struct(
        F.element_at(F.when(F.size(roles) > 0, roles), -1).alias("role"),
        F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text"),
    )
    turns = (
        logs.withColumn("parts", parts)
        .withColumn("turns", F.concat(
            F.transform(whole, lambda e: F.struct(e["role"].alias("role"), e["text"].alias("text"))),
            F.when(F.size("parts") > 0, F.array(folded)).otherwise(F.array().cast("array<struct<role:string,text:string>>")),
        ))
        .groupBy("conv_id", "fragment")
        .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("message", "turns"))), lambda m: m["turns"])).alias("turns"))
    )
    rendered = turns.withColumn("turns", F.transform("turns", _rendered))
    length = F.aggregate(
        "turns", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda a, t: F.struct(
            (a["at"] + F.length(t["text"]) + F.length(t["head"]) + len(TURN_CLOSE)).alias("at"),
            F.when(t["loss"], F.concat(a["spans"], F.array(F.struct((a["at"] + F.length(t["head"])).alias("start"), F.length(t["text"]).alias("length")))))
            .otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["text"], F.lit(TURN_CLOSE))), "")
    return rendered.select("conv_id", "fragment", text.alias("formatted"), length.alias("loss_spans"))


def _rendered(turn: Column) -> Column:
    role = F.coalesce(turn["role"], F.lit("unknown"))
    return F.struct(
        F.concat(F.lit(TURN_OPEN), _role_out(role), F.lit("\n")).alias("head"),
        escaped(turn["text"]).alias("text"), (role == LOSS_ROLE).alias("loss"),
    )


def read_back(fragments: DataFrame) -> DataFrame:
    """Turns (``role, text``) and the text under the loss mask, from the rendered fragments alone."""
    pieces = F.filter(F.split("formatted", TURN_CLOSE, -1), lambda p: p != "")
    turns = F.transform(pieces, lambda p: F.struct(
        _role_in(F.substring_index(F.substring(p, F.lit(len(TURN_OPEN) + 1), F.length(p)), "\n", 1)).alias("role"),
        unescaped(F.substring(p, F.instr(p, "\n") + 1, F.length(p))).alias("text"),
    ))
    loss = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return fragments.select("conv_id", "fragment", turns.alias("turns"), F.array_join(loss, "").alias("loss_text"), F.length("formatted").alias("n"))


def digests(fragments: DataFrame) -> DataFrame:
    """Per conversation: ``n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = read_back(fragments).select(
        "conv_id", F.struct("fragment", told.alias("told"), "loss_text").alias("part"), F.size("turns").alias("turns"), "n"
    )
    whole = parts.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("part")).alias("parts"), F.sum("turns").alias("n_turns"), F.sum("n").alias("formatted_chars")
    )
    loss = F.array_join(F.transform("parts", lambda p: p["loss_text"]), "")
    return whole.withColumn("loss", loss).select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.transform("parts", lambda p: p["told"]), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
