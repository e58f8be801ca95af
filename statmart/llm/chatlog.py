r"""Event-sourced chat formatting, in DataFrame operations only.

A conversation log holds events (conv_id, message_id, seq, kind, attempt, role, text):

``start``       opens a message and names its role;
``delta``       appends text to one attempt at the message;
``regenerate``  opens a new attempt; the latest attempt counts;
``edit``        replaces the whole text; the latest edit after the attempt began counts.

``fold_events`` groups the events by message, sorts them by sequence and folds them
into the final text. ``render`` writes each conversation as one string in which a turn is

    ### Role: escaped text </turn> newline

with the role capitalised for the three usual ones. Inside roles and texts the escape
sign, ``<`` and ``#`` are written as ``\b``, ``\l`` and ``\h``, so no control string can
stand there; undoing the three replacements (``\b`` last) gives the text back, since
every escape sign in the output is the first half of one of the three. ``loss_spans``
mark the assistant's escaped texts inside their turns.

Messages are folded and escaped one by one; a conversation's final string is the only
thing that has to come together, in blocks of turns first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.llm.common import table

DELTA_CHARS, MOST_DELTAS = 512, 64
BLOCK_TURNS = 64
# Fixed values of the template.
HEAD, COLON, TAIL = "### ", ": ", " </turn>\n"
ROLE_NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
LOSS_ROLE = "assistant"
PROBE = "\\### Assistant: </turn> ok"


def escape(text: Column) -> Column:
    t = F.replace(text, F.lit("\\"), F.lit("\\b"))
    t = F.replace(t, F.lit("<"), F.lit("\\l"))
    return F.replace(t, F.lit("#"), F.lit("\\h"))


def unescape(text: Column) -> Column:
    t = F.replace(text, F.lit("\\h"), F.lit("#"))
    t = F.replace(t, F.lit("\\l"), F.lit("<"))
    return F.replace(t, F.lit("\\b"), F.lit("\\"))


def _shown(role: Column) -> Column:
    """Role in the output; a colon is escaped too, so the first ``: `` ends the role."""
    out = F.replace(escape(role), F.lit(":"), F.lit("\\c"))
    for name, shown in ROLE_NAMES.items():
        # the shown form must not collide with a role that is written that way itself
        out = F.when(role == name, F.lit(shown)).when(role == shown, F.lit("\\r" + shown)).otherwise(out)
    return out


def _role(shown: Column) -> Column:
    out = unescape(F.replace(shown, F.lit("\\c"), F.lit(":")))
    for name, s in ROLE_NAMES.items():
        out = F.when(shown == s, F.lit(name)).when(shown == "\\r" + s, F.lit(s)).otherwise(out)
    return out


def as_events(turns: DataFrame) -> DataFrame:
    """Event log of finished conversations (conv_id, turn, role, text).

    Every message is streamed in at most ``MOST_DELTAS`` deltas of ``DELTA_CHARS``
    characters or more. An assistant's message has a first attempt that is given up, a
    user's is opened with a draft and edited afterwards; so the log holds each kind of
    event. Equal rows are messages of their own: they are counted and numbered, never
    sorted as a group. Null roles and texts are empty.
    """
    base = (turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"))
            .groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .withColumn("message_id", F.struct("turn", "role", F.sha2("text", 256).alias("digest"), "copy")))

    def event(seq: int | Column, kind: str, attempt: int, text: Column | None = None) -> Column:
        return F.struct((F.lit(seq) if isinstance(seq, int) else seq).cast("long").alias("seq"),
                        F.lit(kind).alias("kind"), F.lit(attempt).alias("attempt"),
                        (F.lit(None) if text is None else text).cast("string").alias("text"))

    width = F.greatest(F.lit(DELTA_CHARS), F.ceil(F.length("text") / MOST_DELTAS).cast("int"))
    pieces = F.ceil(F.length("text") / width).cast("int")
    numbers = F.when(pieces > 0, F.sequence(F.lit(1), pieces)).otherwise(F.array().cast("array<int>"))
    deltas = F.transform(numbers, lambda i: event(
        i + 3, "delta", 1, F.substring(F.col("text"), (i - 1) * width + 1, width)))
    first = F.substring(F.col("text"), 1, 24)
    begun = F.array(event(0, "start", 0), event(1, "delta", 0, first), event(2, "regenerate", 1))
    plain = F.array(event(0, "start", 0), event(2, "regenerate", 1))
    edited = F.array(event(0, "start", 0), event(2, "regenerate", 1),
                     event(3, "delta", 1, F.concat(first, F.lit(" (draft)"))), event(4, "edit", 1, F.col("text")))
    events = (F.when(F.col("role") == "user", edited)
              .when(F.col("role") == LOSS_ROLE, F.concat(begun, deltas)).otherwise(F.concat(plain, deltas)))
    return (base.select("conv_id", "message_id", "role", F.explode(events).alias("e"))
            .select("conv_id", "message_id", "e.seq", "e.kind", "e.attempt",
                    F.when(F.col("e.kind") == "start", F.col("role")).alias("role"), "e.text"))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message_id, role, text) of an event log.

    The events of a message are folded in the order of ``seq``, equal numbers by kind,
    attempt, role and text. Null texts append nothing; a message that never starts has
    the empty role, one without text the empty text. An empty log has no messages.
    """
    def last(array: Column) -> Column:
        return F.get(array, F.size(array) - 1)

    return (events.groupBy("conv_id", "message_id")
            .agg(F.array_sort(F.collect_list(F.struct("seq", "kind", "attempt", "role", "text"))).alias("log"))
            .withColumn("latest", F.array_max(F.transform("log", lambda e: e["attempt"])))
            .withColumn("edit", last(F.filter("log", lambda e: (e["kind"] == "edit")
                                              & (e["attempt"] == F.col("latest")))))
            .withColumn("rest", F.filter("log", lambda e: (e["kind"] == "delta") & (e["attempt"] == F.col("latest"))
                                         & (F.col("edit").isNull() | (e["seq"] > F.col("edit.seq")))))
            .withColumn("named", last(F.filter("log", lambda e: e["role"].isNotNull())))
            .select("conv_id", "message_id", F.coalesce("named.role", F.lit("")).alias("role"),
                    F.concat(F.coalesce("edit.text", F.lit("")),
                             F.array_join(F.transform("rest", lambda e: e["text"]), "")).alias("text")))


def render(messages: DataFrame, block: int = BLOCK_TURNS) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans.

    Messages follow message_id, whose first field is the turn (null first). Blocks of
    ``block`` turns are joined first and the blocks afterwards, so a long conversation
    reaches its last task as few rows. A loss span is (turn number from 0, first code
    point in the turn's part of the string from 1, length).
    """
    head = F.concat(F.lit(HEAD), _shown(F.col("role")), F.lit(COLON))
    body = escape(F.col("text"))
    start = F.when(F.col("role") == LOSS_ROLE, F.length(head) + 1)  # null: no loss on this turn
    turn = F.col("message_id")["turn"]
    drawn = messages.select(
        "conv_id", F.when(turn.isNull(), F.lit(-(1 << 62))).otherwise(F.floor(turn / block)).alias("block"),
        F.struct("message_id", F.concat(head, body, F.lit(TAIL)).alias("drawn"), start.alias("start"),
                 F.length(body).alias("length")).alias("part"))
    blocks = (drawn.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("part")).alias("parts"))
              .select("conv_id", F.struct(
                  "block", F.array_join(F.transform("parts", lambda p: p["drawn"]), "").alias("drawn"),
                  F.transform("parts", lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length")))
                  .alias("marks")).alias("part")))
    marked = F.transform(F.flatten(F.transform("parts", lambda p: p["marks"])), lambda m, i: F.struct(
        i.alias("turn"), m["start"].alias("start"), m["length"].alias("length")))
    return (blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
            .select("conv_id", F.array_join(F.transform("parts", lambda p: p["drawn"]), "").alias("formatted"),
                    F.filter(marked, lambda m: m["start"].isNotNull()).alias("loss_spans")))


def parse(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns`` (role, text) and ``loss_text``, both read from the strings."""
    pieces = F.split("formatted", TAIL)

    def turn(t: Column) -> Column:
        colon = F.instr(t, F.lit(COLON))
        return F.struct(_role(F.substring(t, F.lit(len(HEAD) + 1), colon - len(HEAD) - 1)).alias("role"),
                        unescape(F.substring(t, colon + len(COLON), F.length(t))).alias("text"))

    return (formatted.select("conv_id", "formatted", "loss_spans").withColumn("pieces", F.slice(pieces, F.lit(1), F.size(pieces) - 1))
            .withColumn("turns", F.transform("pieces", turn))
            .withColumn("loss_text", F.array_join(F.transform("loss_spans", lambda s: unescape(
                F.substring(F.get(F.col("pieces"), s["turn"]), s["start"], s["length"]))), ""))
            .drop("pieces"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe conversation -7: log, fold, render, read back."""
    columns = ["conv_id", "turn", "role", "text"]
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    turns = table(spark, sf_dir, "conversations").select(*columns).unionByName(probe)
    back = parse(render(fold_events(as_events(turns))))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
