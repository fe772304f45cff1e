"""Dialogues rendered once for every participant, with that speaker as the assistant.

The other speakers become users with names, system turns stay system turns,
and masks mark what the assistant says: its texts with the end marker behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.common import running_total, stretched

SYSTEM = "system"
NOBODY = "unknown"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
FORGED, HARMLESS = "<|im_", "<| im_"  # markers inside texts must not open or close turns
NAME = r"[^\p{L}\p{N}_.-]"
PIECE = 64  # turns rendered together


def _content(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit(FORGED), F.lit(HARMLESS))


def _head(role: Column, speaker: Column) -> Column:
    name = F.regexp_replace(F.coalesce(role, F.lit(NOBODY)), NAME, "_")
    who = F.when(role == speaker, F.lit("assistant")).when(role == SYSTEM, F.lit(SYSTEM)).otherwise(
        F.concat(F.lit("user name="), name))
    return F.concat(F.lit(OPEN), who, F.lit("\n"))


def in_pieces(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """(conv_id, piece, said): consecutive turns of each conversation, ``piece`` at a time.

    Turns go by turn, role and text, NULL first; equal rows follow each other.
    Their numbers come from running totals over ranges of the sorted rows, so a
    conversation of any length is spread over tasks and never gathered.
    """
    order = ["conv_id", "turn", "role", "text", "_row"]
    rows = turns.select("conv_id", "turn", "role", "text").withColumns(
        {"_row": F.monotonically_increasing_id(), "_one": F.lit(1)})
    placed = running_total(stretched(rows, order), ["conv_id"], "_stretch", order[1:], "_one", "_place")
    said = F.struct(F.col("_place"), F.col("role"), _content(F.col("text")).alias("content"))
    number = ((F.col("_place") - 1) / piece).cast("bigint")
    return placed.groupBy("conv_id", number.alias("piece")).agg(
        F.array_sort(F.collect_list(said)).alias("said"))  # at most ``piece`` turns


def perspectives(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """(conv_id, speaker, piece, n_turns, text, masks, masked_chars) for every participant.

    Participants are the roles of a conversation other than system and NULL.
    One row holds up to ``piece`` turns; the texts of a conversation's pieces in
    order are its dialogue as ``speaker`` speaks it. masks lists start:end of
    what the speaker says, in characters of the row's text, comma-joined, empty
    where the speaker is silent. Texts lose their power to open or close turns;
    NULL texts are empty; NULL roles are users called unknown; NULL conv_ids
    are one conversation; repeated rows are said repeatedly. Conversations
    without participants, and empty tables, give no rows. Other columns of
    ``turns`` are not looked at.
    """
    speakers = turns.where(F.col("role") != SYSTEM).select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")).distinct()
    rows = in_pieces(turns, piece)
    asked = rows.join(speakers, rows["conv_id"].eqNullSafe(speakers["_conv"])).drop("_conv")
    told = asked.select("conv_id", "speaker", "piece", F.transform("said", lambda t: F.struct(
        _head(t["role"], F.col("speaker")).alias("head"), F.concat(t["content"], F.lit(CLOSE)).alias("body"),
        F.coalesce(t["role"] == F.col("speaker"), F.lit(False)).alias("own"))).alias("parts"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"), F.lit(0).alias("chars"))

    def step(done: Column, part: Column) -> Column:
        begin = done["at"] + F.length(part["head"])
        end = begin + F.length(part["body"])
        span = F.concat_ws(":", begin.cast("string"), end.cast("string"))
        return F.struct(
            (end + 1).alias("at"),
            F.when(part["own"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"),
            (done["chars"] + F.when(part["own"], end - begin).otherwise(0)).alias("chars"))

    whole = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "")
    return told.select("conv_id", "speaker", "piece", F.size("parts").cast("bigint").alias("n_turns"),
                       whole.alias("text"), F.aggregate("parts", start, step).alias("m")).select(
        "conv_id", "speaker", "piece", "n_turns", "text", F.array_join("m.spans", ",").alias("masks"),
        F.col("m.chars").cast("bigint").alias("masked_chars"))


SQL = f"""
WITH t AS (SELECT conv_id, role, replace(coalesce(text, ''), '{FORGED}', '{HARMLESS}') AS content,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
           FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE role <> '{SYSTEM}'),
p AS (SELECT t.conv_id, speaker, place, (place - 1) // {PIECE} AS piece, content || '{CLOSE}' AS body,
             coalesce(role = speaker, false) AS own,
             '{OPEN}' || CASE WHEN role = speaker THEN 'assistant' WHEN role = '{SYSTEM}' THEN '{SYSTEM}'
               ELSE 'user name=' || regexp_replace(coalesce(role, '{NOBODY}'), '{NAME}', '_', 'g') END || chr(10) AS head
      FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, speaker, piece ORDER BY place) AS past FROM p)
SELECT conv_id, speaker, piece, count(*) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY place) AS text,
       coalesce(string_agg((past - 1 - length(body)) || ':' || (past - 1), ',' ORDER BY place) FILTER (own), '') AS masks,
       CAST(coalesce(sum(length(body)) FILTER (own), 0) AS BIGINT) AS masked_chars
FROM o GROUP BY conv_id, speaker, piece
"""
