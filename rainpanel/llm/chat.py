"""Perspective rotation: a dialogue rendered once for every participant, with loss masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainpanel.llm.common import bind

OPEN, CLOSE, END = "<|im_start|>", "<|im_end|>", "\n"
SYSTEM = "system"
NAMELESS = "unknown"
#: Turns of one rendered piece. Longer dialogues continue in further pieces.
CHUNK_TURNS = 256


def speaker_of(role: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(role), F.lit("")), F.lit(NAMELESS))


def rotate_perspectives(conversations: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """One row for each conversation, participant and piece: the dialogue as that participant sees it.

    The chosen speaker is ``assistant``; every other speaker is ``user name=<role>``; ``system``
    turns stay what they are, as nobody's perspective. ``rendered`` is the text of the piece and
    ``mask`` lists [start, end) spans of code points that carry loss: the assistant's words with
    their closing mark. ``chunk`` is the turn number divided by ``chunk_turns``, so a conversation
    of any length is dealt out over several groups, none of which holds more than its own turns;
    ``start`` is where the piece begins in the whole rendering.

    Turns go by number, then speaker, then text. Repeated rows are rendered each time. NULL turns
    come first, in a chunk of their own (-1); a NULL or blank role is ``unknown``; a NULL text is
    empty; NULL conversation ids form one conversation. A conversation of system turns only gives no
    row, as does an empty table. Other columns are not carried.
    """
    turns = conversations.select(
        "conv_id", F.coalesce(F.floor(F.col("turn") / chunk_turns), F.lit(-1)).cast("long").alias("chunk"), "turn",
        speaker_of(F.col("role")).alias("speaker"), F.coalesce("text", F.lit("")).alias("content"))
    chunks = turns.groupBy("conv_id", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("turn", "speaker", "content"))).alias("turns"))
    speakers = (
        turns.filter(F.col("speaker") != SYSTEM).groupBy("conv_id").agg(F.collect_set("speaker").alias("speakers"))
        .select(F.col("conv_id").alias("of_conv"), "speakers"))
    seen = (
        chunks.join(speakers, F.col("conv_id").eqNullSafe(F.col("of_conv")))
        .select("conv_id", "chunk", "turns", F.explode("speakers").alias("participant")))
    rendered = seen.select(
        "conv_id", "participant", "chunk", F.size("turns").alias("n_turns"),
        F.transform("turns", lambda t: _segment(t, F.col("participant"))).alias("segments"))
    pieces = rendered.select(
        "conv_id", "participant", "chunk", "n_turns",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("rendered"),
        _spans(F.col("segments")).alias("mask"))
    lengths = pieces.select(
        "conv_id", "participant", "chunk", F.length("rendered").cast("long").alias("chars"))
    return _with_start(pieces, lengths)


def _segment(turn: Column, participant: Column) -> Column:
    own = turn["speaker"] == participant
    label = F.when(own, "assistant").when(turn["speaker"] == SYSTEM, SYSTEM).otherwise(
        F.concat(F.lit("user name="), turn["speaker"]))
    return bind(F.concat(F.lit(OPEN), label, F.lit(END)), lambda head: F.struct(
        F.concat(head, turn["content"], F.lit(CLOSE + END)).alias("text"),
        F.length(head).alias("head"),
        (F.length(turn["content"]) + F.lit(len(CLOSE))).alias("body"), own.alias("own")))


def _spans(segments: Column) -> Column:
    """Fold the segments' lengths into spans of the assistant's words."""
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))

    def step(acc: Column, s: Column) -> Column:
        begin = acc["at"] + s["head"]
        span = F.array(F.struct(begin.alias("start"), (begin + s["body"]).alias("end")))
        return F.struct(
            (begin + s["body"] + F.lit(len(END))).alias("at"),
            F.when(s["own"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(segments, start, step, lambda acc: acc["spans"])


def _with_start(pieces: DataFrame, lengths: DataFrame) -> DataFrame:
    """The characters before each piece: pieces of one dialogue are few, so their lengths are summed as an array."""
    summed = lengths.groupBy("conv_id", "participant").agg(
        F.collect_list(F.struct("chunk", "chars")).alias("parts")).select(
        F.col("conv_id").alias("c"), F.col("participant").alias("p"), "parts")
    before = F.aggregate(
        F.filter("parts", lambda x: x["chunk"] < F.col("chunk")), F.lit(0).cast("long"), lambda a, x: a + x["chars"])
    return pieces.join(summed, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("participant") == F.col("p"))).select(
        "conv_id", "participant", "chunk", "n_turns", before.alias("start"), "rendered", "mask")


def perspectives_query(conversations: DataFrame) -> DataFrame:
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws("-", m["start"], m["end"])), ",")
    return rotate_perspectives(conversations).select(
        "conv_id", "participant", "chunk", F.col("n_turns").cast("long"), "start", "rendered",
        spans.alias("mask_spans"))


def perspectives_sql() -> str:
    return f"""
    WITH turns AS (
      SELECT conv_id, coalesce(CAST(floor(turn / {CHUNK_TURNS}) AS BIGINT), -1) AS chunk, turn,
        coalesce(nullif(trim(role), ''), '{NAMELESS}') AS speaker, coalesce(text, '') AS content
      FROM conversations),
    people AS (SELECT DISTINCT conv_id, speaker AS participant FROM turns WHERE speaker <> '{SYSTEM}'),
    seen AS (
      SELECT t.*, participant, speaker = participant AS own,
        '{OPEN}' || CASE WHEN speaker = participant THEN 'assistant' WHEN speaker = '{SYSTEM}' THEN '{SYSTEM}'
          ELSE 'user name=' || speaker END || chr(10) AS head
      FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
    placed AS (
      SELECT *, length(head) + length(content) + {len(CLOSE) + len(END)} AS size,
        coalesce(sum(length(head) + length(content) + {len(CLOSE) + len(END)}) OVER (
          PARTITION BY conv_id, participant, chunk ORDER BY turn NULLS FIRST, speaker, content
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
      FROM seen),
    pieces AS (
      SELECT conv_id, participant, chunk, count(*) AS n_turns, sum(size) AS chars,
        string_agg(head || content || '{CLOSE}' || chr(10), '' ORDER BY turn NULLS FIRST, speaker, content) AS rendered,
        coalesce(string_agg(CASE WHEN own THEN
          CAST(CAST(begins AS BIGINT) + length(head) AS VARCHAR) || '-' ||
          CAST(CAST(begins AS BIGINT) + length(head) + length(content) + {len(CLOSE)} AS VARCHAR) END,
          ',' ORDER BY turn NULLS FIRST, speaker, content), '') AS mask_spans
      FROM placed GROUP BY conv_id, participant, chunk)
    SELECT conv_id, participant, chunk, CAST(n_turns AS BIGINT) AS n_turns,
      CAST(coalesce(sum(chars) OVER (PARTITION BY conv_id, participant ORDER BY chunk
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start, rendered, mask_spans
    FROM pieces"""
