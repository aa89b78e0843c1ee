r"""Chat formatting from an event log, with DataFrame functions only.

An event is ``conv, turn, seq, kind, role, text``. Kinds:

* ``open`` starts a message: it clears the slot (conv, turn) and sets its role;
* ``delta`` appends its text to the slot;
* ``edit`` replaces the text of the slot;
* ``regenerate`` clears the text of the slot and removes every later turn opened so far.

Messages are folded per slot; a slot's events are sorted by ``seq``. Final messages are numbered by turn and
rendered in pieces of a fixed number of turns, so a long conversation is many rows until its digest.

Template: ``<s>`` and then, per message, ``[INST]role[/INST]text</s>``. A control string inside a role or a text
gets a backslash after its first character (one more if it has some already), which reading takes away
again, so a control string in the output is always a mark of the template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: Control strings of the template and their escaped forms: first character, backslashes, rest.
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"
DELTA_CHARS = 256
EVENTS = "conv bigint, turn bigint, seq bigint, kind string, role string, text string"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _latest_cut(events: DataFrame) -> DataFrame:
    """Per (conv, turn): the last ``regenerate`` of an earlier turn, over one row a turn, in blocks of turns."""
    block = F.floor(F.col("turn") / 1024)
    turns = events.groupBy("conv", "turn").agg(F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again"))
    turns = turns.withColumn("block", block)
    inside = Window.partitionBy("conv", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        turns.groupBy("conv", "block").agg(F.max("again").alias("again"))
        .select(F.col("conv").alias("c"), F.col("block").alias("b"), F.max("again").over(before).alias("earlier"))
    )
    joined = turns.withColumn("inside", F.max("again").over(inside)).join(
        blocks, F.col("conv").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b"))
    )
    return joined.select(
        F.col("conv").alias("c"), F.col("turn").alias("t"), F.greatest("inside", "earlier").alias("cut")
    )


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``conv, turn, role, text`` of an event log.

    Null kinds and unknown kinds are ignored, a null text adds nothing, a null role is the empty role, a
    message without ``open`` has the empty role. Events of one slot with equal ``seq`` apply in the order
    of kind, role, text. Null conversations and turns are groups of their own; an empty log has no messages.
    """
    known = events.where(F.col("kind").isin("open", "delta", "edit", "regenerate"))
    cuts = _latest_cut(known)
    alive = (
        known.join(cuts, F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")))
        .where(F.col("cut").isNull() | (F.col("seq") > F.col("cut")))
    )
    event = F.struct("seq", "kind", "role", "text")
    slot = alive.groupBy("conv", "turn").agg(F.array_sort(F.collect_list(event)).alias("log"))
    fresh = F.col("log.kind")
    # The last clearing event, counted from the end of the slot's log.
    back = F.array_position(F.transform(F.reverse(fresh), lambda k: k != "delta"), True)
    start = F.when(back > 0, F.size("log") - back + 1).otherwise(1)
    tail = F.slice("log", start.cast("int"), F.size("log"))
    opens = F.filter("log", lambda e: e["kind"] == "open")
    # A regenerate event's own text is not part of the message.
    text = F.array_join(F.transform(tail, lambda e: F.when(
        e["kind"].isin("regenerate"), F.lit("")).otherwise(F.coalesce(e["text"], F.lit("")))), "")
    return slot.select(
        "conv", "turn",
        F.coalesce(F.try_element_at(opens, F.lit(-1))["role"], F.lit("")).alias("role"),
        text.alias("text"),
    )


def render(messages: DataFrame, trained: str = "assistant", piece_turns: int = 64) -> DataFrame:
    """``conv, piece, formatted, loss_spans``: a conversation is its pieces in order.

    ``loss_spans`` lists the code-point ranges (start from 0, length) of a piece that count for the loss: the
    texts of the ``trained`` role. Messages are ordered by turn.
    """
    part = F.floor(F.col("turn") / piece_turns)
    body = F.struct(
        F.concat(F.lit("[INST]"), escape(F.col("role")), F.lit("[/INST]")).alias("head"),
        escape(F.col("text")).alias("body"), (F.col("role") == trained).alias("loss"),
    )
    first = Window.partitionBy("conv")
    pieces = (
        messages.groupBy("conv", part.alias("piece"))
        .agg(F.array_sort(F.collect_list(F.struct("turn", body.alias("m")))).alias("turns"))
        .withColumn("opening", F.min(F.coalesce("piece", F.lit(-(1 << 62)))).over(first)
                    == F.coalesce("piece", F.lit(-(1 << 62))))
    )
    lead = F.when(F.col("opening"), F.lit("<s>")).otherwise("")
    start = F.struct(F.char_length(lead).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc, t):
        begin = acc["at"] + F.char_length(t["m"]["head"])
        size = F.char_length(t["m"]["body"])
        span = F.struct(begin.alias("start"), size.alias("length"))
        return F.struct(
            (begin + size + 4).alias("at"),
            F.when(t["m"]["loss"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    return pieces.select(
        "conv", "piece",
        F.concat(lead, F.array_join(F.transform(
            "turns", lambda t: F.concat(t["m"]["head"], t["m"]["body"], F.lit("</s>"))), "")).alias("formatted"),
        F.aggregate("turns", start, step)["spans"].alias("loss_spans"),
    )


def parse(pieces: DataFrame) -> DataFrame:
    """Read rendered pieces back: ``conv, piece, turns`` (role, text), ``loss`` (texts) and ``chars``."""
    stripped = F.regexp_replace("formatted", "^<s>", "")
    marked = F.filter(F.split(stripped, "</s>"), lambda x: x != "")
    turns = F.transform(marked, lambda x: F.struct(
        unescape(F.substring_index(F.substring(x, 7, 1 << 30), "[/INST]", 1)).alias("role"),
        unescape(F.substring_index(x, "[/INST]", -1)).alias("text"),
    ))
    masked = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return pieces.select(
        "conv", "piece", turns.alias("turns"), masked.alias("loss"), F.char_length("formatted").alias("chars")
    )


def row_events(rows: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """The event log of a finished table ``conv_id, turn, role, text``: each row opens a message and streams
    its text in deltas.

    Rows are numbered by turn; rows that share conversation and turn follow in the order of role and text, and
    repeated rows each become a message. Null texts and roles are empty.
    """
    filled = rows.select(
        F.col("conv_id").alias("conv"), F.col("turn").alias("at"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    copies = filled.groupBy("conv", "at", "role", "text").agg(F.count("*").alias("copies"))
    earlier = Window.partitionBy("conv", "at").orderBy("role", "text").rowsBetween(Window.unboundedPreceding, -1)
    # The slot of a message is its place in the conversation, counted over one row a turn.
    turns = copies.groupBy("conv", "at").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("conv").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = turns.select(
        F.col("conv").alias("c"), F.col("at").alias("a"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    placed = (
        copies.withColumn("earlier", F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
        .join(offsets, F.col("conv").eqNullSafe(F.col("c")) & F.col("at").eqNullSafe(F.col("a")))
        .select("conv", "role", "text",
                F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy"),
                (F.col("offset") + F.col("earlier")).alias("base"))
        .withColumn("turn", F.col("base") + F.col("copy"))
    )
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.char_length("text") - 1, F.lit(0)) / delta_chars).cast("int")),
        lambda i: F.struct(
            F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"),
            F.substring(F.col("text"), i * delta_chars + 1, F.lit(delta_chars)).alias("text"),
        ),
    )
    opened = F.array(F.struct(F.lit("open").alias("kind"), F.col("role"), F.lit("").alias("text")))
    return placed.select("conv", "turn", F.posexplode(F.concat(opened, chunks)).alias("i", "e")).select(
        "conv", "turn", F.col("i").cast("bigint").alias("seq"), "e.kind", "e.role", "e.text"
    )


def summarise(parsed: DataFrame) -> DataFrame:
    """``conv_id`` with the counts and digests of each conversation, from what ``parse`` read back.

    Only here a conversation becomes one value, because a digest needs its whole text.
    """
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    per_piece = parsed.select(
        "conv", F.struct("piece", F.array_join(said, "").alias("said"), F.array_join("loss", "").alias("loss")).alias("p"),
        F.size("turns").alias("n"), "chars",
    )
    whole = per_piece.groupBy("conv").agg(
        F.sum("n").cast("bigint").alias("n_turns"), F.sum("chars").cast("bigint").alias("formatted_chars"),
        F.array_sort(F.collect_list("p")).alias("pieces"),
    )
    said, loss = F.array_join("pieces.said", ""), F.array_join("pieces.loss", "")
    return whole.select(
        F.col("conv").alias("conv_id"), "n_turns", F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op3_chat_format(spark, sf_dir):
    """Formats all conversations and the control-string case -1, and reads the output back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(spark.sql(
        "SELECT CAST(-1 AS BIGINT), turn, role, '</s>[INST] ok [/INST]' FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    ))
    return summarise(parse(render(fold(row_events(rows)))))


OP3_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), escaped AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) AS body,
    length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) AS head FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(6 + head + 7 + body + 4))::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""
