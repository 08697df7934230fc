"""Multi-party perspective rotation of dialogues, DataFrame functions only.

For every participant the dialogue is rendered with that speaker as ``assistant``, the other participants as named
users and context roles (``system``) as they are. Mask spans are the character ranges [start, end) of the rendered
chunk that a model of that speaker is trained on: the speaker's own words and the end mark behind them.

A dialogue is rendered in chunks of ``chunk_turns`` turn numbers, each a row, with its offset in the whole rendering. A
chunk with more than 16 different rows to a turn on average is dealt over parts by the hash of its rows, so
neither a dialogue of any length nor a turn of any number of rows meets in one row or task. Defined cases: a blank or null role is the participant
``unknown``; null text is empty; rows that agree in conversation, turn, role and text are one turn and ``n_rows``
counts them; different rows of one turn follow each other by role, then text; rows without a turn number come first,
in chunks by text hash; rows without a conversation id are dialogues of one turn each; a dialogue with context roles
only has no participant and no row; control marks inside texts are broken up. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.scratch import materialize

START, END = "<|im_start|>", "<|im_end|>"


def _turns(conversations: DataFrame, chunk_turns: int, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Distinct turns with their chunk; ``alone`` tells rows without a conversation apart."""
    role = F.trim(F.col(role_col))
    rows = conversations.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.when(F.length(role) > 0, role).otherwise("unknown").alias("speaker"),
        F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"<\|(?=im_(start|end)\|>)", "< |").alias("text"),
    )
    rows = rows.groupBy("conv_id", "turn", "speaker", "text").agg(F.count("*").alias("n_rows"))
    loose = F.lit(-1) - F.pmod(F.xxhash64("speaker", "text"), F.lit(1 << 16))
    chunk = F.when(F.col("turn").isNull(), loose).otherwise(F.floor(F.col("turn") / chunk_turns))
    alone = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "speaker", "text")).otherwise(F.lit(0))
    rows = rows.withColumn("chunk", chunk.cast("long")).withColumn("alone", alone)
    # parts of the few chunks that hold more rows than a chunk may
    most = chunk_turns * 16
    sizes = rows.groupBy(F.col("conv_id").alias("_conv"), F.col("alone").alias("_alone"), F.col("chunk").alias("_chunk")).count().where(F.col("count") > most)
    sizes = sizes.select("_conv", "_alone", "_chunk", F.ceil(F.col("count") / most).alias("parts"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("alone") == F.col("_alone")) & (F.col("chunk") == F.col("_chunk"))
    part = F.pmod(F.xxhash64("turn", "speaker", "text"), F.coalesce("parts", F.lit(1)))
    return rows.join(sizes, same, "left").withColumn("part", part).drop("_conv", "_alone", "_chunk", "parts")


def _segment(message: Column, perspective: Column, context_roles: tuple[str, ...]) -> Column:
    """header, body and whether the body is trained on."""
    speaker = message["speaker"]
    context = speaker.isin(*context_roles) if context_roles else F.lit(False)
    own = ~context & (speaker == perspective)
    head = F.when(context, speaker).when(own, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), speaker))
    return F.struct(F.concat(F.lit(START), head, F.lit("\n")).alias("head"), F.concat(message["text"], F.lit(END)).alias("body"), own.alias("own"))


def rotate_perspectives(
    conversations: DataFrame,
    context_roles: tuple[str, ...] = ("system",),
    chunk_turns: int = 256,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """conv_id, perspective, chunk, part, n_turns, n_rows, rendered, spans array<struct<start,end>>, chunk_offset."""
    turns = _turns(conversations, chunk_turns, id_col, turn_col, role_col, text_col)
    chunks = turns.groupBy("conv_id", "alone", "chunk", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "speaker", "text"))).alias("messages"),
        F.sum("n_rows").alias("n_rows"),
    )
    speakers = turns.select("conv_id", "alone", F.col("speaker").alias("perspective")).distinct()
    speakers = speakers.where(~F.col("perspective").isin(*context_roles)) if context_roles else speakers
    other = speakers.select(F.col("conv_id").alias("_conv"), F.col("alone").alias("_alone"), "perspective")
    both = chunks.join(other, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("alone") == F.col("_alone"))).drop("_conv", "_alone")

    parts = both.withColumn("parts", F.transform("messages", lambda m: _segment(m, F.col("perspective"), context_roles)))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "")

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.char_length(part["head"])
        end = start + F.char_length(part["body"])
        spans = F.when(part["own"], F.concat(state["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(state["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    spans = F.aggregate("parts", empty, step, lambda s: s["spans"])
    key = ["conv_id", "alone", "perspective", "chunk", "part"]
    rendered = materialize(parts.select(*key, F.size("messages").cast("long").alias("n_turns"), "n_rows", text.alias("rendered"), spans.alias("spans")))
    # offsets are summed over lengths alone; the texts meet them by a key that no dialogue makes hot
    before = Window.partitionBy("conv_id", "alone", "perspective").orderBy("chunk", "part").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.char_length("rendered").cast("long")).over(before), F.lit(0))
    offsets = rendered.select(*key, offset.alias("chunk_offset")).select(*[F.col(k).alias(f"_{k}") for k in key], "chunk_offset")
    both = rendered.join(offsets, F.expr(" AND ".join(f"{k} <=> _{k}" for k in key)))
    return both.select("conv_id", "perspective", "chunk", "part", "n_turns", "n_rows", "rendered", "spans", "chunk_offset")


def spans_text(spans: Column) -> Column:
    """``start-end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")


#: DuckDB SQL of the query op1_perspective_rotation.
ORACLE_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, CASE WHEN length(trim(role)) > 0 THEN trim(role) ELSE 'unknown' END AS speaker,
         regexp_replace(regexp_replace(coalesce(text, ''), '<\|im_start\|>', '< |im_start|>', 'g'), '<\|im_end\|>', '< |im_end|>', 'g') AS text,
         count(*) AS n_rows, CAST(floor(turn / 256) AS BIGINT) AS chunk
  FROM conversations GROUP BY ALL),
speakers AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'),
parts AS (
  SELECT t.conv_id, s.perspective, t.chunk, t.turn, t.speaker, t.text, t.n_rows, t.speaker = s.perspective AS own,
         '<|im_start|>' || CASE WHEN t.speaker = 'system' THEN 'system' WHEN t.speaker = s.perspective THEN 'assistant'
                                ELSE 'user name=' || t.speaker END || chr(10) AS head,
         t.text || '<|im_end|>' AS body
  FROM turns t JOIN speakers s USING (conv_id)),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
           PARTITION BY conv_id, perspective, chunk ORDER BY turn, speaker, text
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM parts),
chunks AS (
  SELECT conv_id, perspective, chunk, count(*) AS n_turns, CAST(sum(n_rows) AS BIGINT) AS n_rows,
         string_agg(head || body || chr(10), '' ORDER BY turn, speaker, text) AS rendered,
         coalesce(string_agg(CAST(CAST(place + length(head) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(place + length(head) + length(body) AS BIGINT) AS VARCHAR), ','
                  ORDER BY turn, speaker, text) FILTER (own), '') AS mask
  FROM placed GROUP BY conv_id, perspective, chunk)
-- no chunk of the tables is so full that it has a second part
SELECT conv_id, perspective, chunk, CAST(0 AS BIGINT) AS part, n_turns, n_rows, rendered, mask,
       CAST(coalesce(sum(length(rendered)) OVER (PARTITION BY conv_id, perspective ORDER BY chunk
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS chunk_offset
FROM chunks
"""
