"""Chat formatting from an event log.

A chat service logs events, not messages: a message is opened, its text arrives
as deltas, may be replaced by an edit, or be thrown away and streamed again
(regenerate), or deleted. :func:`fold` sorts the events of each message by
sequence and folds them into its final text, :func:`render` joins a
conversation's messages into one training text, :func:`read_back` recovers the
turns and the loss mask from that text alone.

The template marks a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. Control
strings inside texts and roles are escaped reversibly: ``&``, ``<`` and ``[``
become ``&amp;``, ``&lt;`` and ``&#91;`` (and a line end in a role ``&#10;``), so
no escaped text holds ``<|``, ``</s>``, ``[INST]`` or ``[/INST]``.

Folding is distributed by (conversation, message), so a conversation of any
length is folded by many tasks; only the rendered text of a conversation, which
is one row of the result, is put together in one place.

Defined cases: NULL texts and roles are empty; a NULL turn sorts first; equal
turns are ordered by role, then text, and repeated rows are separate turns; a
NULL conversation id is a conversation of its own. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: Characters of a streamed delta when :func:`events_of` makes a log.
DELTA_CHARS = 400


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit("["), F.lit("&#91;"))


def unescape(c: Column) -> Column:
    c = F.replace(c, F.lit("&#91;"), F.lit("["))
    c = F.replace(c, F.lit("&lt;"), F.lit("<"))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("&#10;"))


def _unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&#10;"), F.lit("\n")))


def events_of(conversations: DataFrame) -> DataFrame:
    """The event log that a service streaming these turns would have written:
    (conv_id, message, turn, role, seq, kind, text).

    Every message streams in deltas. Every third turn is streamed twice with a
    regenerate between, every third is drafted and then edited.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.select(
        "conv_id", F.monotonically_increasing_id().alias("message"), "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"), text.alias("text"))

    def event(kind, c):
        return F.struct(F.lit(kind).alias("kind"), c.alias("text"))

    n = F.ceil(F.char_length("text") / F.lit(DELTA_CHARS)).cast("int")
    deltas = F.when(n > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
        lambda i: event("delta", F.substring(F.col("text"), i * DELTA_CHARS + 1,
                                             F.lit(DELTA_CHARS))))
    ).otherwise(F.array(event("delta", F.lit(""))))
    draft = F.array(event("delta", F.left(F.col("text"), F.lit(40))))
    log = (F.when(F.pmod("turn", F.lit(3)) == 1,
                  F.concat(draft, F.array(event("regenerate", F.lit(""))), deltas))
           .when(F.pmod("turn", F.lit(3)) == 2,
                 F.concat(draft, F.array(event("edit", F.col("text")))))
           .otherwise(deltas))
    return (rows.select("conv_id", "message", "turn", "role", F.posexplode(log).alias("seq", "e"))
            .select("conv_id", "message", "turn", "role", "seq", "e.kind", "e.text"))


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, role, text) of an event log.

    Events of a message are taken by (seq, kind, text), in whatever order they
    arrived. ``delta`` appends; ``edit`` replaces the text so far; ``regenerate``
    empties it; a message with a ``delete`` is gone.
    """
    per = (events.groupBy("conv_id", "message")
           .agg(F.array_sort(F.collect_list(F.struct("seq", "kind", "text"))).alias("log"),
                F.min("turn").alias("turn"), F.min("role").alias("role")))
    kinds = F.transform("log", lambda e: e["kind"])
    # All that counts is the last reset and the deltas after it.
    resets = F.array_contains(kinds, "edit") | F.array_contains(kinds, "regenerate")
    none = F.size("log") + 1
    edit_at = F.when(F.array_contains(kinds, "edit"),
                     none - F.array_position(F.reverse(kinds), "edit").cast("int")).otherwise(1)
    drop_at = F.when(F.array_contains(kinds, "regenerate"),
                     none - F.array_position(F.reverse(kinds), "regenerate").cast("int")).otherwise(1)
    last = F.when(resets, F.greatest(edit_at, drop_at)).otherwise(F.lit(1))
    live = F.filter(F.slice(F.col("log"), F.col("at"), F.size("log")),
                    lambda e: e["kind"].isin("delta", "edit"))
    return (per.where(~F.array_contains(kinds, "delete")).withColumn("at", last)
            .select("conv_id", "turn", "role",
                    F.array_join(F.transform(live, lambda e: F.coalesce(e["text"], F.lit(""))),
                                 "").alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted): a conversation's turns in one text."""
    turn = F.concat(F.lit(START), _escape_role(F.coalesce(F.col("role"), F.lit(""))), F.lit("\n"),
                    escape(F.coalesce(F.col("text"), F.lit(""))), F.lit(END))
    # Sorted by role and text as they were, not as escaped.
    return (messages.select("conv_id", F.struct("turn", "role", "text").alias("k"), turn.alias("t"))
            .groupBy("conv_id")
            .agg(F.array_sort(F.collect_list(F.struct("k", "t"))).alias("turns"))
            .select("conv_id", F.array_join(F.col("turns.t"), "").alias("formatted")))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, formatted) with turns an array of (role, text), from the
    formatted text alone."""
    pieces = F.split(F.col("formatted"), r"<\|im_start\|>")
    pieces = F.slice(pieces, F.lit(2), F.size(pieces))

    def turn(p):
        at = F.locate("\n", p)
        body = F.substring(p, at + 1, F.char_length(p) - at - len(END))
        return F.struct(_unescape_role(F.substring(p, F.lit(1), at - 1)).alias("role"),
                        unescape(body).alias("text"))

    return formatted.select("conv_id", F.transform(pieces, turn).alias("turns"), "formatted")


def summary(back: DataFrame) -> DataFrame:
    """The digest columns of what :func:`read_back` gives."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"),
                                                                t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"),
                                    lambda t: t["text"]), "")
    b = back.withColumn("said", said).withColumn("loss", loss)
    return b.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted) through the event log."""
    return render(fold(events_of(conversations.select("conv_id", "turn", "role", "text"))))
