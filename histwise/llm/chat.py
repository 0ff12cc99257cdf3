"""Chat formatting of typed content parts, in DataFrame expressions.

A message's content is an array of parts: text, image, audio, document. A visitor (one
expression per type, applied in order) flattens it to one string: text is escaped, an
attachment becomes a placeholder ``<|type:n|>``, where n is its place in the message's
list of attachments. That list records type, reference and the number of tokens to which the
placeholder expands (``TOKENS_PER_UNIT`` times the part's units: tiles, seconds, pages).

Template: ``<|turn|>role<|says|>content<|done|>`` for each message. In roles and in each run of texts that
follow each other a backslash is doubled and ``<|`` becomes ``<\\|``, so no control string of the template can be
in a text, and removing the backslash in front of a character reverses both.

The loss mask is a list of spans (start, length in code points of the formatted text), one for
each assistant message. Starts come from running sums over a conversation's messages.

A conversation is one output row, whose text and digest need its messages in one place; nothing
else is gathered by conversation.

Inputs: null text is empty, a null role is the empty role, a null list of parts has no parts; a part of
unknown type counts as text; rows go by turn (null first; ties by role, then content); repeated
rows are turns of their own; rows with a null conv_id are one conversation; texts of any
length are kept whole; an empty table has no conversations; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, SAYS, DONE = "<|turn|>", "<|says|>", "<|done|>"
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}
PART = "struct<type: string, text: string, ref: string, units: int>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """The parts of a message that is a plain text."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units")))


def attached(parts: Column) -> Column:
    """The attachments among parts, in order: type, ref, n_tokens."""
    tokens = lambda p: F.coalesce(*[F.when(p["type"] == t, F.coalesce(p["units"], F.lit(1)) * n) for t, n in TOKENS_PER_UNIT.items()], F.lit(0))
    return F.transform(F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p["type"].isin(*TOKENS_PER_UNIT)),
                       lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), tokens(p).cast("long").alias("n_tokens")))


def flattened(parts: Column) -> Column:
    """The content string: texts and numbered placeholders, in order. Texts that follow each other are escaped
    as one, so that no control string can be put together from several."""
    state = F.struct(F.lit("").alias("s"), F.lit("").alias("run"), F.lit(0).alias("n"))

    def visit(seen: Column, part: Column) -> Column:
        is_file = F.coalesce(part["type"].isin(*TOKENS_PER_UNIT), F.lit(False))
        place = F.concat(seen["s"], escape(seen["run"]), F.lit("<|"), part["type"], F.lit(":"), seen["n"].cast("string"), F.lit("|>"))
        text = F.concat(seen["run"], F.coalesce(part["text"], F.lit("")))
        return F.struct(
            F.when(is_file, place).otherwise(seen["s"]).alias("s"), F.when(is_file, F.lit("")).otherwise(text).alias("run"),
            (seen["n"] + is_file.cast("int")).alias("n"))

    return F.aggregate(F.coalesce(parts, F.array().cast(f"array<{PART}>")), state, visit, lambda x: F.concat(x["s"], escape(x["run"])))


def format_chat(messages: DataFrame) -> DataFrame:
    """One row per conversation of ``messages`` (conv_id, turn, role, parts): conv_id, formatted,
    turns (start, loss_start, loss_length of each turn; loss_start null if not masked in) and
    attachments (turn index, type, ref, n_tokens)."""
    rows = messages.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), flattened(F.col("parts")).alias("content"), attached(F.col("parts")).alias("files"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SAYS))
    rows = rows.withColumn("head", head).withColumn("piece", F.concat("head", "content", F.lit(DONE)))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "content")
    start = F.coalesce(F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.select(
        "conv_id", F.row_number().over(order).alias("n"), start.alias("start"), "piece", "files",
        F.when(F.col("role") == "assistant", start + F.length("head")).alias("loss_start"), F.length("content").cast("long").alias("loss_length"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("n", "piece", "start", "loss_start", "loss_length", "files"))).alias("m"))
    return whole.select(
        "conv_id", F.array_join(F.transform("m", lambda t: t["piece"]), "").alias("formatted"),
        F.transform("m", lambda t: F.struct(t["start"].alias("start"), t["loss_start"].alias("loss_start"), t["loss_length"].alias("loss_length"))).alias("turns"),
        F.flatten(F.transform("m", lambda t: F.transform(t["files"], lambda f: F.struct((t["n"] - 1).alias("turn"), f["type"].alias("type"), f["ref"].alias("ref"), f["n_tokens"].alias("n_tokens"))))).alias("attachments"))


def turn_bodies(formatted: Column) -> Column:
    """What follows each turn mark."""
    cut = F.split(formatted, r"<\|turn\|>", -1)
    return F.slice(cut, 2, F.size(cut) - 1)


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text says, escapes removed."""
    return F.transform(turn_bodies(formatted), lambda p: F.struct(
        unescape(F.substring_index(p, SAYS, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(p, SAYS, -1), DONE, 1)).alias("text")))


def read_loss(formatted: Column, turns: Column) -> Column:
    """The texts under the loss mask, escapes removed. Each span is cut from its own turn's
    piece (start - turn start), so that reading is linear in the text."""
    pieces = F.transform(turn_bodies(formatted), lambda p: F.concat(F.lit(TURN), p))
    zipped = F.arrays_zip(pieces.alias("piece"), turns.alias("span"))
    under = F.filter(zipped, lambda z: z["span"]["loss_start"].isNotNull())
    return F.transform(under, lambda z: unescape(z["piece"].substr((z["span"]["loss_start"] - z["span"]["start"] + 1).cast("int"), z["span"]["loss_length"].cast("int"))))


def contract(conversations: DataFrame) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = conversations.sparkSession.sql(f"SELECT conv_id, turn, role, text FROM VALUES (-1L, 0L, 'user', '{said}'), (-1L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).unionByName(more)
    out = format_chat(rows.withColumn("parts", text_part(F.col("text"))))
    out = out.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), read_turns(F.col("formatted")).alias("t"),
                     F.array_join(read_loss(F.col("formatted"), F.col("turns")), "").alias("loss"))
    return out.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(F.array_join(F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


SQL = r"""
WITH c AS (SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
e AS (SELECT *, replace(replace(role, '\', '\\'), '<|', '<\|') AS r, replace(replace(text, '\', '\\'), '<|', '<\|') AS t FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, t)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, t) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|turn|>') + length(r) + length('<|says|>') + length(t) + length('<|done|>'))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
