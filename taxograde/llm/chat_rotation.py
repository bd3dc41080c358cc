"""Operator 9: chat formatting by rotating the perspective over the participants.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and the others as named users; the mask lists the spans
(code points, end exclusive) that are to be learned: the speaker's own turns
with their end marker. Turns of the role ``system`` are context: rendered as
system in every perspective, never a perspective of their own.

Built from DataFrame functions only. A conversation is cut into chunks of ``CHUNK``
turn numbers and a chunk into parts of at most ``PART_TURNS`` turns, so that a
conversation of any length is never sorted or collected in one task: a long one
gives several consecutive parts per participant, and no turn is left out. Every
part is rendered for every participant of the conversation, also where they do not
speak in it, and begins with the system turn in force: the last one before the part.

Nulls and edges: a null text is an empty turn, a null or empty role the speaker
``unknown``; rows of one (conv_id, turn) are all kept, ordered by role and text;
null turns come first; null conv_id is a conversation of its own. A conversation
of system turns only has no perspective and gives no row. ``<|`` in texts and
names is rendered ``< |``, so that no text can forge a marker. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table

PART_TURNS = 256
#: Turns of this many consecutive turn numbers are numbered by one window group.
CHUNK = 4096
SYSTEM = "system"


def _numbered(rows: DataFrame) -> DataFrame:
    """``chunk`` by turn number, ``i`` the place in the chunk, ``piece`` of at most PART_TURNS turns."""
    order = [F.col("turn").asc_nulls_first(), "name", "text"]
    chunk = F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(2 ** 60)))
    rows = rows.withColumn("chunk", chunk.cast("long"))
    inside = Window.partitionBy("conv_id", "chunk").orderBy(*order)
    rows = rows.withColumn("i", F.row_number().over(inside) - 1)
    return rows.withColumn("piece", F.floor(F.col("i") / PART_TURNS))


def rotate(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` -> (conv_id, first_turn, perspective, n_turns, rendered, mask)."""
    def safe(c):
        return F.replace(c, F.lit("<|"), F.lit("< |"))
    role = F.coalesce(F.nullif(F.trim("role"), F.lit("")), F.lit("unknown"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                safe(role).alias("name"), safe(F.coalesce("text", F.lit(""))).alias("text"))
    rows = _numbered(rows)
    spoken = rows.where(F.col("name") != SYSTEM)
    speakers = spoken.select(F.col("conv_id").alias("of"), F.col("name").alias("perspective")).distinct()
    # the system turn in force: the last one before the row in its chunk, or else that of the chunks before
    system = F.when(F.col("name") == SYSTEM, F.struct("turn", "text"))
    earlier = Window.partitionBy("conv_id", "chunk").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (rows.groupBy("conv_id", "chunk").agg(F.max(system).alias("sys"))
              .select(F.col("conv_id").alias("of"), F.col("chunk").alias("of_chunk"), F.last("sys", ignorenulls=True).over(before).alias("held")))
    turns = (rows.withColumn("force", F.last(system, ignorenulls=True).over(earlier)).groupBy("conv_id", "chunk", "piece")
             .agg(F.array_sort(F.collect_list(F.struct("i", "turn", "name", "text"))).alias("turns"), F.min_by("force", "i").alias("force")))
    turns = (turns.join(chunks, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("of_chunk")))
             .withColumn("force", F.coalesce("force", "held")).drop("of", "of_chunk", "held"))
    turns = turns.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")

    def head(t):
        return (F.when(t["name"] == SYSTEM, "<|im_start|>system\n")
                .when(t["name"] == F.col("perspective"), "<|im_start|>assistant\n")
                .otherwise(F.concat(F.lit("<|im_start|>user name="), t["name"], F.lit("\n"))))
    pieces = F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), F.concat(t["text"], F.lit("<|im_end|>")).alias("body"),
        ((t["name"] == F.col("perspective")) & (t["name"] != SYSTEM)).alias("own")))
    context = F.array(F.struct(F.lit("<|im_start|>system\n").alias("head"),
                               F.concat(F.col("force.text"), F.lit("<|im_end|>")).alias("body"), F.lit(False).alias("own")))
    turns = turns.withColumn("pieces", F.when(F.col("force").isNull(), pieces).otherwise(F.concat(context, pieces)))
    # running offset and the spans of the speaker's own turns, in one pass over the turns
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc, p):
        begin = acc["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        own = F.array(F.concat_ws(":", begin, end))
        return F.struct((end + 1).alias("at"), F.when(p["own"], F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))
    spans = F.aggregate("pieces", start, step)["spans"]
    return turns.select(
        "conv_id", F.col("turns")[0]["turn"].alias("first_turn"), "perspective", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("rendered"),
        F.array_join(spans, ",").alias("mask"))


def op9_perspective_rotation(spark, sf_dir: str) -> DataFrame:
    """Every conversation from the perspective of each of its participants."""
    return rotate(table(spark, sf_dir, "conversations"))


ORACLE = """
WITH rows_ AS (
  SELECT conv_id, turn, replace(coalesce(nullif(trim(role), ''), 'unknown'), '<|', '< |') AS name,
         replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations),
numbered AS (
  SELECT *, coalesce(cast(floor(turn / 4096.0) AS BIGINT), -1152921504606846976) AS chunk FROM rows_),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, chunk ORDER BY turn NULLS FIRST, name, text) - 1 AS i FROM numbered),
parts AS (SELECT *, i // 256 AS piece FROM placed),
speakers AS (SELECT DISTINCT conv_id, name AS perspective FROM parts WHERE name <> 'system'),
forced AS (
  SELECT *, last_value(CASE WHEN name = 'system' THEN text END IGNORE NULLS) OVER (
      PARTITION BY conv_id ORDER BY chunk, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS force FROM parts),
turns AS (
  SELECT p.conv_id, p.chunk, p.piece, s.perspective, p.i, p.turn,
         CASE WHEN p.i % 256 = 0 AND p.force IS NOT NULL THEN '<|im_start|>system' || chr(10) || p.force || '<|im_end|>' || chr(10)
              ELSE '' END AS context,
         CASE WHEN p.name = 'system' THEN '<|im_start|>system' || chr(10)
              WHEN p.name = s.perspective THEN '<|im_start|>assistant' || chr(10)
              ELSE '<|im_start|>user name=' || p.name || chr(10) END AS head,
         p.text || '<|im_end|>' AS body, p.name = s.perspective AS own
  FROM forced p JOIN speakers s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
offsets AS (
  SELECT *, coalesce(sum(length(context) + length(head) + length(body) + 1) OVER (
      PARTITION BY conv_id, chunk, piece, perspective ORDER BY i
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(context) AS pos
  FROM turns)
SELECT conv_id, arg_min(turn, i) AS first_turn, perspective, count(*) AS n_turns,
       string_agg(context || head || body || chr(10), '' ORDER BY i) AS rendered,
       coalesce(string_agg(CASE WHEN own THEN (pos + length(head)) || ':' || (pos + length(head) + length(body)) END, ',' ORDER BY i), '') AS mask
FROM offsets GROUP BY conv_id, chunk, piece, perspective
"""
