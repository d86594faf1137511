"""Chat formatting from an event log (DataFrame and SQL functions only).

A log row is ``(conv_id, seq, kind, turn, role, text)`` with kinds

* ``message``     opens a message for ``turn`` with ``text``;
* ``delta``       appends ``text`` to the newest message of ``turn``;
* ``edit``        replaces the text of the newest message of ``turn`` (deltas
                  that follow append to the edited text);
* ``regenerate``  discards every earlier message of ``turn`` and of later
                  turns, then opens a fresh message for ``turn``.

``reconstruct`` deals the log by conversation, sorts it by sequence and folds it
into the final messages with window functions (which spill, so a conversation of
any length passes); ``render`` writes each conversation as one string with its
loss mask, ``parse`` reads it back. All three share one exchange on ``conv_id``.

Defined results: a null text or role counts as empty, a null kind as
``message``; equal ``seq`` are ordered by (kind, turn, role, text), and repeated
rows are separate events; a delta or edit without an open message opens one.
Empty logs give empty results. Other columns are ignored, whatever their names.

Template, per message: ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``. Inside texts
every ``<\\…\\|`` gets one more backslash, so no ``<|`` is left in a text and the
step is undone exactly; roles are percent-escaped (``%``, ``<``, line feed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    for plain, code in (("%", "%25"), ("<", "%3C"), ("\n", "%0A")):
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for plain, code in (("\n", "%0A"), ("<", "%3C"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def events_of_turns(turns: DataFrame) -> DataFrame:
    """A table of finished turns ``(conv_id, turn, role, text)`` as an event log."""
    return turns.select("conv_id", F.col("turn").alias("seq"), F.lit(MESSAGE).alias("kind"),
                        "turn", "role", "text")


def drafted(turns: DataFrame) -> DataFrame:
    """Finished turns as the log of how they came about: by place, a turn is streamed (a message and
    a delta), edited (a wrong draft, an edit that replaces it, a delta) or answered again (a
    discarded answer with a delta, then a regeneration). Folding the log gives the turns back.
    Turns are numbered by (turn, role, text), so turns of one number are messages of their own."""
    text = F.coalesce("text", F.lit(""))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    half = F.floor(F.length("text") / 2).cast("int")
    head, tail = F.substr("text", F.lit(1), half), F.substr("text", half + 1)

    def event(kind, said):
        return F.struct(F.lit(kind).alias("kind"), said.alias("text"))

    wrong = F.concat(F.lit("draft: "), F.reverse("text"))
    ways = (F.array(event(MESSAGE, head), event(DELTA, tail)),
            F.array(event(MESSAGE, wrong), event(DELTA, F.lit(" ...")), event(EDIT, head), event(DELTA, tail)),
            F.array(event(MESSAGE, wrong), event(DELTA, F.lit(" ...")), event(REGENERATE, F.col("text"))))
    way = F.when(F.col("place") % 3 == 0, ways[0]).when(F.col("place") % 3 == 1, ways[1]).otherwise(ways[2])
    rows = turns.select("conv_id", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"), place.alias("place"))
    return rows.select("conv_id", "place", "role", F.posexplode(way).alias("step", "e")).select(
        "conv_id", (F.col("place").cast("long") * 8 + F.col("step")).alias("seq"), F.col("e.kind").alias("kind"),
        F.col("place").alias("turn"), "role", F.col("e.text").alias("text"))


def reconstruct(events: DataFrame) -> DataFrame:
    """Fold an event log into ``(conv_id, position, role, text)`` messages."""
    conv = Window.partitionBy("conv_id")
    log = events.select(
        "conv_id", "seq", F.coalesce("kind", F.lit(MESSAGE)).alias("kind"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    log = log.withColumn("at", F.row_number().over(
        conv.orderBy("seq", "kind", "turn", "role", "text")))
    # newest opening event of the same turn; a stray delta opens its own message
    turn = Window.partitionBy("conv_id", "turn").orderBy("at")
    opens = F.col("kind").isin(MESSAGE, REGENERATE) | (F.row_number().over(turn) == 1)
    log = log.withColumn("opened", F.when(opens, F.col("at")))
    log = log.withColumn("message", F.last("opened", True).over(
        turn.rowsBetween(Window.unboundedPreceding, 0)))
    # lowest turn regenerated later on: messages of that turn and after are gone
    later = conv.orderBy("at").rowsBetween(1, Window.unboundedFollowing)
    log = log.withColumn("cut", F.min(F.when(F.col("kind") == REGENERATE, F.col("turn"))).over(later))
    live = F.col("cut").isNull() | F.coalesce(F.col("turn") < F.col("cut"), F.lit(False))
    folded = (log.where(live).groupBy("conv_id", "message")
              .agg(F.sort_array(F.collect_list(F.struct("at", "kind", "role", "text"))).alias("e")))
    last_edit = F.array_max(F.transform("e", lambda x: F.when(x["kind"] == EDIT, x["at"])
                                        .otherwise(F.lit(0))))
    text = F.array_join(F.transform(
        F.filter("e", lambda x: x["at"] >= last_edit), lambda x: x["text"]), "")
    return (folded.select("conv_id", "message", F.col("e")[0]["role"].alias("role"),
                          text.alias("text"))
            .withColumn("position", F.row_number().over(conv.orderBy("message")))
            .select("conv_id", "position", "role", "text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``(conv_id, formatted, loss_mask)``: one string per conversation and the
    spans (start, length in code points) of it that carry loss, in order."""
    order = Window.partitionBy("conv_id").orderBy("position")
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    rows = messages.select("conv_id", "position", "role", head.alias("head"),
                           escape_text(F.col("text")).alias("body"))
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    end = F.sum(F.length("piece")).over(order)
    span = F.when(F.col("role") == loss_role, F.struct(
        (end - F.length("piece") + F.length("head")).alias("start"),
        F.length("body").cast("long").alias("length")))
    rows = rows.select("conv_id", "position", "piece", span.alias("span"))
    whole = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("position", "piece", "span"))).alias("m"))
    return whole.select(
        "conv_id", F.array_join(F.transform("m", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(F.filter("m", lambda x: x["span"].isNotNull()),
                    lambda x: x["span"]).alias("loss_mask"))


def parse(formatted: Column) -> Column:
    """The turns of one rendered conversation as ``array<struct<role, text>>``."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda x: x != "")
    pieces = F.transform(pieces, lambda x: F.substr(x, F.lit(len(START) + 1)))
    return F.transform(pieces, lambda x: F.struct(
        unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
        unescape_text(F.substr(x, F.instr(x, "\n") + F.lit(1))).alias("text")))


def loss_text(formatted: Column, loss_mask: Column) -> Column:
    """All text under the mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(loss_mask, lambda s: unescape_text(
        F.substr(formatted, (s["start"] + F.lit(1)).cast("int"), s["length"].cast("int")))), "")


def digest(rendered: DataFrame) -> DataFrame:
    """Per conversation, read back from the rendered string: turn count and hash,
    length and hash of the text under the loss mask, length of the string."""
    turns = parse(F.col("formatted"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (rendered.withColumn("turns", turns)
            .withColumn("loss", loss_text(F.col("formatted"), F.col("loss_mask")))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(flat, 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))
