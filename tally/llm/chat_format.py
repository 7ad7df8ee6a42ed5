"""Chat formatting from conversation event logs (operator 4).

A conversation is a log of events (conv_id, seq, kind, msg, role, text):

* ``message``     starts message ``msg`` with a text
* ``delta``       appends a streamed piece to ``msg``
* ``edit``        replaces the text of ``msg``
* ``regenerate``  replaces the text of ``msg`` (further deltas append to it)
                  and takes back every later message that was complete before

The log is partitioned by conversation once; events are put in order of seq
(ties by kind, role, text) and folded with window functions: of every
message only the events from its last replacement on count.  The messages
are rendered with running offsets, so a conversation is gathered exactly
once, as the string it becomes (one conversation must fit in one row).

Template, one line per message (a space stands on the inner side of each
mark)::

    <<SYS>> text <</SYS>>      system
    [INST] text [/INST]        user
    <s> text </s>              assistant
    [ROLE] name [TEXT] text [/ROLE]    any other role

Inside texts and names a backslash becomes two, and a control string gets a
backslash after its first character, so no control string of a text
survives; removing one backslash before any character restores the text.
The loss mask is a list of (start, length) spans in code points over the
formatted string: the escaped assistant texts.

Defined results: null texts are empty, a null role is the empty name, a
null seq sorts first, null conv_id is a conversation of its own, repeated
rows are repeated events, an event without a known kind counts as
``message``, an empty log gives no rows, further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template's marks.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"),
         "assistant": ("<s>", "</s>")}
OTHER_OPEN, OTHER_TEXT, OTHER_CLOSE = "[ROLE]", "[TEXT]", "[/ROLE]"
_TURN = (r"(?s)(<<SYS>>|\[INST\]|<s>|\[ROLE\]) (.*?) "
         r"(?:<</SYS>>|\[/INST\]|</s>|\[/ROLE\])\n")


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    angle = F.regexp_replace(doubled, r"<(<SYS>>|</SYS>>|/?s>)", r"<\\$1")
    return F.regexp_replace(angle, r"\[(/?INST\]|/?ROLE\]|TEXT\])", r"[\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, msg, role, text."""
    e = events.select("conv_id", "seq", F.coalesce("kind", F.lit("message")).alias("kind"), "msg",
                      F.coalesce("role", F.lit("")).alias("role"),
                      F.coalesce("text", F.lit("")).alias("text")).repartition("conv_id")
    of_msg = Window.partitionBy("conv_id", "msg")
    placed = e.withColumn("_pos", F.row_number().over(of_msg.orderBy("seq", "kind", "role", "text")))
    replaced = F.when(F.col("kind") != "delta", F.col("_pos"))
    placed = placed.withColumn("_from", F.coalesce(F.max(replaced).over(of_msg), F.lit(0)))
    counts = F.col("_pos") >= F.col("_from")
    messages = placed.groupBy("conv_id", "msg").agg(
        F.min_by("role", "_pos").alias("role"),
        F.sort_array(F.collect_list(F.when(counts, F.struct("_pos", "text")))).alias("_parts"),
        F.max("seq").alias("_last"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("_again"))
    before = Window.partitionBy("conv_id").orderBy("msg").rowsBetween(Window.unboundedPreceding, -1)
    return messages.withColumn("_cut", F.max("_again").over(before)).where(
        "_cut is null or _last is null or _last >= _cut").select(
        "conv_id", "msg", "role", F.array_join(F.col("_parts.text"), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """conv_id, n_turns, formatted, loss_spans from final messages."""
    body = messages.select("conv_id", "msg", "role", escape(F.col("text")).alias("_body"),
                           escape(F.col("role")).alias("_name"))
    head, tail = F.concat(F.lit(f"{OTHER_OPEN} "), F.col("_name"), F.lit(f" {OTHER_TEXT} ")), F.lit(
        f" {OTHER_CLOSE}\n")
    for role, (a, b) in MARKS.items():
        mine = F.col("role") == role
        head = F.when(mine, F.lit(f"{a} ")).otherwise(head)
        tail = F.when(mine, F.lit(f" {b}\n")).otherwise(tail)
    turns = body.select("conv_id", "msg", "role", F.length(head).alias("_skip"),
                        F.length("_body").alias("_len"), F.concat(head, "_body", tail).alias("_turn"))
    before = Window.partitionBy("conv_id").orderBy("msg").rowsBetween(Window.unboundedPreceding, -1)
    at = turns.withColumn("_at", F.coalesce(F.sum(F.length("_turn")).over(before), F.lit(0)))
    span = F.when(F.col("role") == "assistant", F.struct(
        (F.col("_at") + F.col("_skip")).alias("start"), F.col("_len").cast("long").alias("length")))
    return at.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("msg", "_turn"))).alias("_turns"),
        F.sort_array(F.collect_list(span)).alias("loss_spans")).select(
        "conv_id", "n_turns", F.array_join(F.col("_turns._turn"), "").alias("formatted"), "loss_spans")


def format_chats(events: DataFrame) -> DataFrame:
    return render(fold(events))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    marks = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1))
    bodies = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2))
    name = {a: role for role, (a, _) in MARKS.items()}

    def turn(pair: Column) -> Column:
        mark, body = pair["0"], pair["1"]
        role = F.substring_index(body, f" {OTHER_TEXT} ", 1)
        text = F.substr(body, F.length(role) + F.lit(len(f" {OTHER_TEXT} ") + 1))
        for a, r in name.items():
            role = F.when(mark == a, F.lit(r)).otherwise(role)
            text = F.when(mark == a, body).otherwise(text)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.arrays_zip(marks.alias("0"), bodies.alias("1")), turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped and joined with nothing between."""
    return F.array_join(F.transform(
        spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))),
        "")


def message_log(conversations: DataFrame) -> DataFrame:
    """A table of whole messages (conv_id, turn, role, text) as an event log:
    one ``message`` event per row, in order of turn, then role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.repartition("conv_id").select(
        "conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"),
        F.row_number().over(order).alias("msg"), "role", "text")


def chat_digests(chats: DataFrame) -> DataFrame:
    """The digest columns of the contract, read back from the formatted strings."""
    turns = read_turns(F.col("formatted"))
    read = chats.select("conv_id", turns.alias("_turns"), "formatted",
                        read_loss(F.col("formatted"), F.col("loss_spans")).alias("_loss"))
    whole = F.array_join(F.transform("_turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
