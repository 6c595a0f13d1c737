"""Operator 10: multi-party perspective rotation for chat training.

For every participant of a dialogue the whole dialogue is rendered once, with
that participant as the assistant and all others as named users::

    <|im_start|>user name=NAME\\n...<|im_end|>\\n

Only the assistant's own texts, each with its end mark, are in the loss mask.
System messages keep their role in every rendering and are no participant.

A rendering is given as chunks of ``CHUNK`` consecutive messages, each with its
place in the whole, so that no dialogue has to fit a row or a task: messages
are numbered by a range partitioning, and places are sums over chunks, then
over groups of chunks.

Defined cases: messages are ordered by turn, then speaker, then text (nulls
first), so repeated turns and rows have a place each; a null text is rendered
empty; a null speaker is a user without a name and no participant; messages
with a null dialogue id are one dialogue; a dialogue without participants is
not rendered; an empty table gives no rows. Only the four named columns are
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import group_row_number
from .common import stored

CHUNK = 32
GROUP = 1024
SYSTEM = "system"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _some_value(kind: T.DataType) -> Column:
    """A value of a type: dialogues may be named by numbers, texts, times or flags."""
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    return F.lit("1970-01-01").cast(kind)


def numbered(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv, pos, speaker, content): messages with their place in their dialogue, stored."""
    rows = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                           F.col(speaker_col).cast("string").alias("speaker"),
                           F.col(text_col).cast("string").alias("text"))
    # joins are on the dialogue, so a null one gets a key of its own: the flag, and any value of the column's type
    some = _some_value(rows.schema["conv"].dataType)
    keyed = rows.withColumn("none", F.col("conv").isNull()).withColumn("conv", F.coalesce("conv", some))
    placed = group_row_number(keyed, ["none", "conv"], ["turn", "speaker", "text"], out="rn")
    return stored(placed.select("none", "conv", (F.col("rn") - 1).alias("pos"), "speaker",
                                F.coalesce("text", F.lit("")).alias("content")), "chat-messages")


def perspectives(messages: DataFrame) -> DataFrame:
    """(none, conv, assistant, pos, role, name, content, piece, masked): every message of :func:`numbered` once for
    every participant of its dialogue."""
    people = messages.filter(F.col("speaker").isNotNull() & (F.col("speaker") != SYSTEM)) \
        .select("none", "conv", F.col("speaker").alias("assistant")).distinct()
    own = F.coalesce(F.col("speaker") == F.col("assistant"), F.lit(False))
    role = F.when(own, "assistant").when(F.col("speaker") == SYSTEM, SYSTEM).otherwise("user")
    name = F.when(~own & (F.col("speaker") != SYSTEM), F.col("speaker"))
    head = F.concat(F.lit(OPEN), "role", F.coalesce(F.concat(F.lit(" name="), "name"), F.lit("")), F.lit("\n"))
    return messages.join(people, ["none", "conv"]).withColumn("role", role).withColumn("name", name) \
        .withColumn("piece", F.concat(head, "content", F.lit(CLOSE + "\n"))).withColumn("masked", own) \
        .drop("speaker")


def _places(chunks: DataFrame) -> DataFrame:
    """``chunks`` with ``start``: the length of all chunks before it. Sums within groups of chunks, then over groups."""
    keys = ["none", "conv", "assistant"]
    grouped = chunks.withColumn("group", F.floor(F.col("chunk") / GROUP))
    before = Window.partitionBy(*keys, "group").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    inner = grouped.withColumn("inside", F.coalesce(F.sum("length").over(before), F.lit(0)))
    earlier = Window.partitionBy(*keys).orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    totals = grouped.groupBy(*keys, "group").agg(F.sum("length").alias("whole")) \
        .withColumn("outside", F.coalesce(F.sum("whole").over(earlier), F.lit(0))).drop("whole")
    return inner.join(totals, [*keys, "group"]).withColumn("start", F.col("inside") + F.col("outside")) \
        .drop("group", "inside", "outside")


def rotate(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(conv_id, assistant, chunk, n_messages, start, text, masks): the chunks of every rendering in order.

    ``start`` is the chunk's place in the whole rendering and ``masks`` the [start, end) places of what the
    assistant says, end marks included, both in code points of the whole rendering.
    """
    rows = perspectives(numbered(messages, conv_col, turn_col, speaker_col, text_col))
    part = F.struct("pos", "piece", "masked", F.char_length("piece").alias("size"),
                    F.char_length("content").alias("said"))
    chunks = rows.groupBy("none", "conv", "assistant", F.floor(F.col("pos") / chunk).alias("chunk")) \
        .agg(F.array_sort(F.collect_list(part)).alias("parts"), F.sum(F.char_length("piece")).alias("length"))
    chunks = _places(stored(chunks, "chat-chunks"))
    tail = len(CLOSE) + 1
    # each part's end within the chunk; what is said ends before the line break and begins after the head
    ends = F.expr("transform(parts, (p, i) -> named_struct('masked', p.masked, 'said', p.said, 'stop', "
                  "aggregate(slice(parts, 1, i + 1), 0L, (a, q) -> a + q.size)))")
    masks = F.transform(F.filter(ends, lambda p: p["masked"]), lambda p: F.struct(
        (F.col("start") + p["stop"] - tail - p["said"]).alias("start"), (F.col("start") + p["stop"] - 1).alias("end")))
    return chunks.select(
        F.when(~F.col("none"), F.col("conv")).alias("conv_id"), "assistant", "chunk",
        F.size("parts").cast("bigint").alias("n_messages"), F.col("start").cast("bigint").alias("start"),
        F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("text"), masks.alias("masks"))


def op10_perspective_rotation(spark, sf_dir: str) -> DataFrame:
    """All ``conversations`` from the perspective of every participant; masks as text start:end, comma-joined."""
    out = rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    spans = F.transform("masks", lambda m: F.concat_ws(":", m["start"], m["end"]))
    return out.withColumn("masks", F.array_join(spans, ","))


OP10_SQL = r"""
WITH m AS (
  SELECT conv_id, role, coalesce(text, '') AS content, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos FROM conversations),
people AS (SELECT DISTINCT conv_id, role AS assistant FROM m WHERE role IS NOT NULL AND role <> 'system'),
pieces AS (
  SELECT m.conv_id, assistant, pos, content, coalesce(role = assistant, false) AS masked,
         '<|im_start|>' || CASE WHEN role = assistant THEN 'assistant' WHEN role = 'system' THEN 'system'
           WHEN role IS NULL THEN 'user' ELSE 'user name=' || role END || chr(10) || content || '<|im_end|>' || chr(10) AS piece
  FROM m JOIN people p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, sum(length(piece)) OVER (PARTITION BY conv_id, assistant ORDER BY pos) AS stop FROM pieces)
SELECT conv_id, assistant, pos // 32 AS chunk, count(*) AS n_messages, min(stop - length(piece))::BIGINT AS start,
       string_agg(piece, '' ORDER BY pos) AS text,
       coalesce(string_agg((stop - 11 - length(content))::BIGINT || ':' || (stop - 1)::BIGINT, ',' ORDER BY pos)
                FILTER (WHERE masked), '') AS masks
FROM placed GROUP BY conv_id, assistant, pos // 32
"""
