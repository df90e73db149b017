"""Chat formatting: one rendering of a dialogue per participant, with that speaker as the assistant.

A dialogue with *k* speakers gives *k* training views: in each, the speaker's own turns become ``assistant``
turns, whose text and end marker are trained on, and everybody else's become named ``user`` turns.  ``system``
turns are instructions, not a participant, and stay as they are in every view.

A view is a table of segments, one row a turn, so a dialogue of any length stays spread over tasks.  The view's text is
its segments by ``position`` (from 0, a total order: turn, speaker, text); ``start`` is where a segment begins in that
text, and ``mask_start``/``mask_end`` is the span of the segment that is trained on (0 to 0: nothing), all in characters.
``assemble`` joins the segments to one text a view, for dialogues that fit a task.

Turns are sorted by ranges and written once, so a long dialogue lies in many sorted chunks; positions and starts are
running sums inside a chunk plus the sums of the chunks before it, one row a chunk.  The speakers are written first, so
Spark sees their size and can split a hot dialogue in the join.

Defined results: a null text renders as empty; a null or blank role speaks as ``unknown``, a participant like any other;
rows with a null conv_id form one dialogue; a dialogue of system turns only has no view; repeated rows are turns of
their own; a null turn number comes first; ``<|`` in texts and ``<|``, ``|>`` in names are written ``< |``, ``| >``, and
line breaks in names as spaces, so that neither can pass for a marker; an empty table gives no views; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docvault.llm.common import partitions_for, stage_table, table

SYSTEM = "system"
UNKNOWN = "unknown"
END = "<|end|>"


def _escaped(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def _name(c: Column) -> Column:
    return F.translate(F.replace(_escaped(c), F.lit("|>"), F.lit("| >")), "\n\r", "  ")


def _sorted(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, speaker, text, chunk, at``: the turns, written in chunks of one order."""
    role = F.trim(F.coalesce(F.col("role"), F.lit("")))
    t = turns.select("conv_id", "turn", F.when(role == "", F.lit(UNKNOWN)).otherwise(role).alias("speaker"),
                     F.coalesce(F.col("text"), F.lit("")).alias("text"))
    order = ["conv_id", "turn", "speaker", "text"]
    t = t.withColumn("_tie", F.monotonically_increasing_id())  # equal rows may lie in different chunks
    t = t.repartitionByRange(partitions_for(turns), *order, "_tie").sortWithinPartitions(*order, "_tie")
    return stage_table(t.drop("_tie").withColumn("chunk", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "turns")


def views(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` → ``conv_id, perspective, position, start, turn, speaker, role, segment, mask_start,
    mask_end``."""
    t = _sorted(turns)
    speakers = t.where(F.col("speaker") != SYSTEM).groupBy("conv_id", "speaker").agg(F.lit(1).alias("one"))
    speakers = stage_table(speakers, "speakers").select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective"))
    v = t.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    own, system = F.col("speaker") == F.col("perspective"), F.col("speaker") == SYSTEM
    v = v.withColumn("role", F.when(system, SYSTEM).when(own, "assistant").otherwise("user"))
    head = F.when(F.col("role") == "user", F.concat(F.lit("<|user name="), _name(F.col("speaker")), F.lit("|>\n")))
    head = head.otherwise(F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n")))
    v = v.withColumn("_head", head).withColumn("_body", F.concat(_escaped(F.col("text")), F.lit(END)))
    trained = F.col("role") == "assistant"
    v = v.select(
        "conv_id", "perspective", "turn", "speaker", "role", "chunk", "at", F.concat("_head", "_body", F.lit("\n")).alias("segment"),
        F.when(trained, F.char_length("_head")).otherwise(0).cast("long").alias("mask_start"),
        F.when(trained, F.char_length("_head") + F.char_length("_body")).otherwise(0).cast("long").alias("mask_end"))
    v = stage_table(v.withColumn("_chars", F.char_length("segment").cast("long")), "segments")

    chunks = v.groupBy("conv_id", "perspective", "chunk").agg(F.count("*").alias("n"), F.sum("_chars").alias("c"))
    before = Window.partitionBy("conv_id", "perspective").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(F.col("conv_id").alias("_conv"), F.col("perspective").alias("_view"), F.col("chunk").alias("_chunk"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("_c"))
    within = Window.partitionBy("conv_id", "perspective", "chunk").orderBy("at")
    v = v.withColumn("_place", F.row_number().over(within) - 1).withColumn("_start", F.sum("_chars").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_chars"))
    v = v.join(chunks, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("perspective") == F.col("_view")) & (F.col("chunk") == F.col("_chunk")))
    return v.select("conv_id", "perspective", (F.col("_n") + F.col("_place")).alias("position"), (F.col("_c") + F.col("_start")).alias("start"),
                    "turn", "speaker", "role", "segment", "mask_start", "mask_end")


def assemble(segments: DataFrame) -> DataFrame:
    """The rows of ``views`` → ``conv_id, perspective, text, spans``: whole texts with the trained spans in them."""
    trained = F.when(F.col("mask_end") > 0, F.struct((F.col("start") + F.col("mask_start")).alias("begin"), (F.col("start") + F.col("mask_end")).alias("end")))
    parts = F.array_sort(F.collect_list(F.struct("position", "segment")))
    return segments.groupBy("conv_id", "perspective").agg(
        F.array_join(F.transform(parts, lambda p: p["segment"]), "").alias("text"), F.array_sort(F.collect_list(trained)).alias("spans"))


def query(spark, sf_dir):
    """op6: every view of every conversation."""
    return views(table(spark, sf_dir, "conversations"))


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown' ELSE trim(role) END AS speaker,
         coalesce(text, '') AS text, replace(coalesce(text, ''), '<|', '< |') || '<|end|>' AS body
  FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
v AS (
  SELECT t.*, perspective,
         CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (
  SELECT *, CASE WHEN role = 'user'
                 THEN '<|user name=' || translate(replace(replace(speaker, '<|', '< |'), '|>', '| >'), chr(10) || chr(13), '  ') || '|>' || chr(10)
                 ELSE '<|' || role || '|>' || chr(10) END AS head
  FROM v),
s AS (SELECT *, head || body || chr(10) AS segment FROM h)
SELECT conv_id, perspective, row_number() OVER w - 1 AS position,
       CAST(sum(length(segment)) OVER w - length(segment) AS BIGINT) AS start,
       turn, speaker, role, segment,
       CASE WHEN role = 'assistant' THEN CAST(length(head) AS BIGINT) ELSE 0 END AS mask_start,
       CASE WHEN role = 'assistant' THEN CAST(length(head) + length(body) AS BIGINT) ELSE 0 END AS mask_end
FROM s
WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text ROWS UNBOUNDED PRECEDING)
"""
