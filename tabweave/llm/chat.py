"""Multi-party perspective rotation of dialogues.

For every participant of a conversation the dialogue is rendered with that speaker as assistant, the
others as named users and context roles (system) as they are, with the spans to train on: the contents
and closing tokens of the assistant's turns, in code points. Only DataFrame functions run on the data.

Long dialogues are rendered in parts: a turn belongs to the part in which its rendering starts, so no
row grows beyond `part_chars` plus one turn. The order is by turn, then role and text, nulls first.

No conversation has to fit into a task: its turns are dealt out in stretches of `step` turn numbers (turns
without a number by role and the start of the text), each is numbered and measured by itself, and what comes
before a stretch is summed from its counts and lengths by role. Only those sums of a conversation, and turns
of one number, meet in one task.

Edge cases: null roles are a participant with an empty name; null texts are empty turns; null
conversation ids are one conversation; repeated turns are repeated in the rendering; conversations of
context roles alone have no perspective; text that looks like a control token is broken up with a
space; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabweave.llm.common import table

OPEN, CLOSE, CONTEXT, PART_CHARS, STEP = "<|im_start|>", "<|im_end|>\n", ("system",), 1 << 20, 512


def _head(context: tuple[str, ...]) -> Column:
    """How a turn of `role` begins as seen by `speaker`."""
    other = F.when(F.col("role").isin(*context), F.lit(OPEN)).otherwise(F.lit(f"{OPEN}user name="))
    return F.when(F.col("role") == F.col("speaker"), F.lit(f"{OPEN}assistant\n")).otherwise(F.concat(other, "role", F.lit("\n")))


def _before(said: DataFrame, context: tuple[str, ...]) -> DataFrame:
    """For each stretch and speaker, how many turns (__n) and rendered characters (__at) of the dialogue come before."""
    by_role = said.groupBy(F.struct("conv_id").alias("__conv"), "__stretch", "role").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    speakers = by_role.where(~F.col("role").isin(*context)).select("__conv", F.col("role").alias("speaker")).distinct()
    rendered = F.col("chars") + F.col("n") * (F.length(_head(context)) + len(CLOSE))
    sums = by_role.join(speakers, "__conv").groupBy("__conv", "speaker", "__stretch").agg(F.sum("n").alias("n"), F.sum(rendered).alias("chars"))
    earlier = Window.partitionBy("__conv", "speaker").orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("__stretch", "speaker", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__n"), F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("__at"))


def perspectives(turns: DataFrame, context: tuple[str, ...] = CONTEXT, part_chars: int = PART_CHARS, step: int = STEP) -> DataFrame:
    """One row for each turn and perspective: conv_id, speaker, position, part, rendered, trained, first, end (of the trained span in its part)."""
    loose = F.col("turn").isNull()
    stretch = F.struct("conv_id", F.floor(F.col("turn") / step).alias("nth"), F.when(loose, F.col("role")).alias("role"), F.when(loose, F.substring("text", 1, 2)).alias("text"))
    said = turns.select(stretch.alias("__stretch"), "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"), F.col("role").alias("__role"), F.col("text").alias("__text"))
    seen = said.join(_before(said, context), "__stretch").withColumn("head", _head(context))
    seen = seen.withColumns({"head": F.length("head"), "rendered": F.concat("head", "text", F.lit(CLOSE)), "trained": F.col("role") == F.col("speaker")})
    order = Window.partitionBy("__stretch", "speaker").orderBy(F.col("turn").asc_nulls_first(), F.col("__role").asc_nulls_first(), F.col("__text").asc_nulls_first())
    seen = seen.withColumns({"position": F.col("__n") + F.row_number().over(order) - 1, "at": F.col("__at") + F.coalesce(F.sum(F.length("rendered")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    seen = seen.withColumn("part", F.floor(F.col("at") / part_chars).cast("int"))
    start = F.col("at") - F.min("at").over(Window.partitionBy("conv_id", "speaker", "part"))
    return seen.select("conv_id", "speaker", "position", "part", "rendered", "trained", (start + F.col("head")).alias("first"), (start + F.length("rendered") - 1).alias("end"))


def rotated(turns: DataFrame, context: tuple[str, ...] = CONTEXT, part_chars: int = PART_CHARS, step: int = STEP) -> DataFrame:
    """One row for each conversation, perspective and part: conv_id, speaker, part, n_turns, n_trained, dialogue, spans ([first, end) of what is trained on, "first:end", comma-joined)."""
    rows = perspectives(turns, context, part_chars, step)
    whole = rows.groupBy("conv_id", "speaker", "part").agg(F.count("*").alias("n_turns"), F.count_if("trained").alias("n_trained"), F.array_sort(F.collect_list(F.struct("position", "rendered", "trained", "first", "end"))).alias("all"))
    spans = F.array_join(F.transform(F.filter("all", lambda t: t["trained"]), lambda t: F.concat(t["first"].cast("string"), F.lit(":"), t["end"].cast("string"))), ",")
    return whole.select("conv_id", "speaker", "part", "n_turns", "n_trained", F.array_join(F.transform("all", lambda t: t["rendered"]), "").alias("dialogue"), spans.alias("spans"))


def op9_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotated(table(spark, sf_dir, "conversations"))


OP9_SQL = """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, replace(coalesce(text, ''), '<|', '< |') AS text, role AS r0, text AS t0 FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM c WHERE role <> 'system'),
h AS (SELECT c.*, s.speaker, role = s.speaker AS trained, CASE WHEN role = s.speaker THEN '<|im_start|>assistant' WHEN role = 'system' THEN '<|im_start|>system' ELSE '<|im_start|>user name=' || role END || chr(10) AS head FROM c JOIN s ON c.conv_id IS NOT DISTINCT FROM s.conv_id),
m AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS rendered FROM h),
o AS (SELECT *, row_number() OVER w AS pos, coalesce(sum(length(rendered)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begun FROM m WINDOW w AS (PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)),
p AS (SELECT *, CAST(floor(begun / 1048576) AS INTEGER) AS part FROM o),
q AS (SELECT *, begun - min(begun) OVER (PARTITION BY conv_id, speaker, part) AS start FROM p)
SELECT conv_id, speaker, part, count(*) AS n_turns, count(*) FILTER (trained) AS n_trained, string_agg(rendered, '' ORDER BY pos) AS dialogue,
       coalesce(string_agg(CAST(start + length(head) AS BIGINT) || ':' || CAST(start + length(rendered) - 1 AS BIGINT), ',' ORDER BY pos) FILTER (trained), '') AS spans
FROM q GROUP BY conv_id, speaker, part
"""
