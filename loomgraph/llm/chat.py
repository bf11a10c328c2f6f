"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered with that
participant as the assistant and the others as named users, and the spans that
a model would be trained on are given as a mask.  A long dialogue comes in
consecutive pieces, whose texts joined in order are the dialogue and whose
masks count from its beginning, so that no row holds an unbounded dialogue
unless `whole` joins the pieces.  DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions.arrays import walk

#: Turns in one piece of a dialogue.
PART_TURNS = 256


def rotate(conversations: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", instruction: str = "system", part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, part, participant, n_turns, n_target, start, rendered, mask.

    Every role but `instruction` is a participant.  A turn is rendered as
    `<|assistant|>` (the participant's own), `<|user name|>` or `<|system|>`,
    a line break, the text and `<|end|>` with a line break; `<|` inside a text
    or role becomes `< |`.  mask lists start:end (code points of the dialogue,
    end exclusive) of the participant's texts with their `<|end|>`, joined by
    commas; `start` is where the piece begins in the dialogue.

    Turns are ordered by (turn, role, text), nulls first; repeated rows stay.
    Part k holds the turns numbered from k * part_turns on; turns without a
    number are part null, which comes first.  A null or blank role is
    `unknown`, a null text empty, and a null id one conversation.  A
    conversation of instructions alone has no rows.
    """
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    said = conversations.select(
        F.col(f"`{id}`").alias("conv_id"),
        F.floor(F.col(f"`{turn}`") / part_turns).cast("long").alias("part"),
        F.col(f"`{turn}`").alias("turn"),
        safe(F.coalesce(F.nullif(F.trim(F.col(f"`{role}`")), F.lit("")), F.lit("unknown"))).alias("role"),
        safe(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("text"),
    )
    parts = said.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("numbered"), F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text"))).alias("turns"))
    speakers = said.where(F.col("role") != instruction).select(F.col("conv_id").alias("own_id"), F.col("role").alias("participant")).distinct()
    views = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("own_id")))
    target = lambda t: t["role"] == F.col("participant")
    head = lambda t: F.when(t["role"] == instruction, "<|system|>\n").when(target(t), "<|assistant|>\n").otherwise(F.concat(F.lit("<|user "), t["role"], F.lit("|>\n")))
    turns = F.transform("turns", lambda t: F.struct(target(t).alias("target"), head(t).alias("head"), F.concat(t["text"], F.lit("<|end|>")).alias("body")))
    # where each turn's body starts and ends in its piece; appending copies, so a piece's turns are walked in runs of a root of them
    length = lambda t: F.length(t["head"]) + F.length(t["body"]) + 1
    step = lambda at, t: (at + length(t), F.array(at + length(t)))
    views = views.select("conv_id", "part", "participant", turns.alias("turns"))
    views = views.select("conv_id", "part", "participant", "turns", walk("turns", F.lit(0), "int", step).alias("ends"))
    size = F.coalesce(F.element_at("ends", -1), F.lit(0)).cast("long")
    before = Window.partitionBy("conv_id", "participant").orderBy(F.asc_nulls_first("part")).rowsBetween(Window.unboundedPreceding, -1)
    views = views.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0).cast("long")))
    span = lambda x: F.concat_ws(":", (F.col("start") + x["end"] - 1 - F.length(x["turn"]["body"])).cast("string"), (F.col("start") + x["end"] - 1).cast("string"))
    said = F.filter(F.arrays_zip(F.col("turns").alias("turn"), F.col("ends").alias("end")), lambda x: x["turn"]["target"])
    return views.select(
        "conv_id",
        "part",
        "participant",
        F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("turns", lambda t: t["target"])).cast("long").alias("n_target"),
        "start",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit("\n"))), "").alias("rendered"),
        F.array_join(F.transform(said, span), ",").alias("mask"),
    )


def whole(rotated: DataFrame) -> DataFrame:
    """conv_id, participant, n_turns, n_target, rendered and mask of each whole dialogue, from its pieces; one row must hold it."""
    pieces = F.array_sort(F.collect_list(F.struct("start", "rendered", "mask")))
    joined = rotated.groupBy("conv_id", "participant").agg(F.sum("n_turns").alias("n_turns"), F.sum("n_target").alias("n_target"), pieces.alias("p"))
    text, mask = F.array_join(F.transform("p", lambda x: x["rendered"]), ""), F.array_join(F.filter(F.transform("p", lambda x: x["mask"]), lambda m: m != ""), ",")
    return joined.select("conv_id", "participant", "n_turns", "n_target", text.alias("rendered"), mask.alias("mask"))


def op10_chat_rotation(spark, sf_dir):
    return rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP10_SQL = r"""
with said as (
  select conv_id, (turn // 256)::bigint as part, turn,
    replace(coalesce(nullif(trim(role), ''), 'unknown'), '<|', '< |') as role, replace(coalesce(text, ''), '<|', '< |') as text
  from conversations),
views as (
  select s.conv_id, s.part, p.participant, s.turn, s.role, s.text, s.role = p.participant as target,
    case when s.role = 'system' then '<|system|>' || chr(10) when s.role = p.participant then '<|assistant|>' || chr(10) else '<|user ' || s.role || '|>' || chr(10) end as head,
    s.text || '<|end|>' as body
  from said s join (select distinct conv_id, role as participant from said where role <> 'system') p on s.conv_id = p.conv_id),
placed as (
  select *, (sum(length(head) + length(body) + 1) over (partition by conv_id, participant order by turn, role, text rows unbounded preceding))::bigint - length(body) - 1 as body_at
  from views)
select conv_id, part, participant, count(*) as n_turns, count(*) filter (where target) as n_target, min(body_at - length(head)) as start,
  string_agg(head || body || chr(10), '' order by turn, role, text) as rendered,
  coalesce(string_agg(body_at::varchar || ':' || (body_at + length(body))::varchar, ',' order by body_at) filter (where target), '') as mask
from placed group by conv_id, part, participant
"""
