"""Multi-party dialogues from every participant's perspective.

For each participant (each role but ``system``) the whole dialogue is rendered once with that
speaker as the assistant and all others as named users. The mask names the characters to
train on: the text and end mark of the assistant's own turns. Dialogues are rendered in
pieces of ``PIECE`` turn numbers, so one endless dialogue is no one task's work; pieces in
order, joined, are the dialogue.

Defined results: a null text is empty; a null role is the speaker ``unknown``; a null turn comes
first, in the first piece; turns of one number are ordered by role and text, repeated rows
are repeated turns; a null conversation is one of its own; markers inside texts and names
are broken by a blank; a dialogue of system turns only has no perspective and no rows; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PIECE = 512
BEGIN, END = "<|im_start|>", "<|im_end|>"


def perspectives(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """``conv_id``, ``perspective``, ``piece``, ``n_turns``, ``rendered`` and ``mask``
    (``start:end`` of each trained span, end exclusive, joined by commas)."""
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    given = turns.select(
        F.col("conv_id"), F.col("turn"),
        F.coalesce(F.floor(F.col("turn") / piece), F.lit(0)).cast("long").alias("piece"),
        safe(F.coalesce("role", F.lit("unknown"))).alias("role"), safe(F.coalesce("text", F.lit(""))).alias("text"),
    )
    speakers = given.where("role <> 'system'").select(F.col("conv_id").alias("c"), F.col("role").alias("perspective")).distinct()
    own = F.col("role") == F.col("perspective")
    head = F.concat(
        F.lit(BEGIN),
        F.when(own, "assistant").when(F.col("role") == "system", "system").otherwise(F.concat(F.lit("user name="), F.col("role"))),
        F.lit("\n"),
    )
    by = Window.partitionBy("conv_id", "perspective", "piece").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = (
        given.join(speakers, F.col("conv_id").eqNullSafe(F.col("c")))
        .withColumns({"head": head, "own": own}).withColumn("part", F.concat("head", "text", F.lit(END + "\n")))
        .withColumns({
            "rank": F.row_number().over(by),
            "begin": F.coalesce(F.sum(F.length("part")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        })
    )
    span = F.concat_ws(":", F.col("begin") + F.length("head"), F.col("begin") + F.length("part") - 1)
    parts = F.array_sort(F.collect_list(F.struct("rank", "part")))
    spans = F.array_sort(F.collect_list(F.when(F.col("own"), F.struct("rank", span.alias("span")))))
    return rows.groupBy("conv_id", "perspective", "piece").agg(
        F.count("*").alias("n_turns"), F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("rendered"),
        F.array_join(F.transform(spans, lambda s: s["span"]), ",").alias("mask"),
    )


ORACLE = f"""
with given as (
  select conv_id, turn, coalesce(cast(floor(turn / {PIECE}.0) as bigint), 0) as piece,
    replace(coalesce(role, 'unknown'), '<|', '< |') as role, replace(coalesce(text, ''), '<|', '< |') as text
  from conversations
), speakers as (select distinct conv_id as c, role as perspective from given where role <> 'system'),
headed as (
  select *, '{BEGIN}' || case when role = perspective then 'assistant' when role = 'system' then 'system' else 'user name=' || role end || chr(10) as head
  from given join speakers on conv_id is not distinct from c
), parts as (select *, head || text || '{END}' || chr(10) as part from headed),
placed as (
  select *, row_number() over w as rank, coalesce(sum(length(part)) over (w rows between unbounded preceding and 1 preceding), 0) as begin_
  from parts window w as (partition by conv_id, perspective, piece order by turn asc nulls first, role, text)
)
select conv_id, perspective, piece, count(*) as n_turns, string_agg(part, '' order by rank) as rendered,
  string_agg(case when role = perspective then cast(begin_ + length(head) as varchar) || ':' || cast(begin_ + length(part) - 1 as varchar) end, ',' order by rank) as mask
from placed group by conv_id, perspective, piece
"""
