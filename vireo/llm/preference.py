"""Preference pairs for a chat model: one prompt, two masked completions.

``format_pairs`` is column arithmetic over two arrays of turns; nothing but
the gathering of a conversation's own turns is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template: a role line, the text, an end mark.
OPEN, AFTER_ROLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def collect_turns(conversations: DataFrame, name: str = "turns") -> DataFrame:
    """(conv_id, turns array<struct<turn, role, text>>) in order of turn, then role, then text.

    One row is one conversation, the unit that is rendered.  Rows without a
    conv_id belong to no conversation and take no part; null roles and texts
    are empty; repeated rows are repeated turns; null turns come first.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (conversations.filter(F.col("conv_id").isNotNull()).groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(turn)).alias(name)))


def _same(a: Column, b: Column) -> Column:
    return (a["role"] == b["role"]) & (a["text"] == b["text"])


def common_prefix(chosen: Column, rejected: Column) -> Column:
    """Number of leading turns with equal role and text (turn numbers are not compared)."""
    m = F.least(F.size(chosen), F.size(rejected))
    differs = F.filter(F.sequence(F.lit(1), F.greatest(m, F.lit(1))),
                       lambda i: (i <= m) & ~_same(F.get(chosen, i - 1), F.get(rejected, i - 1)))
    return F.coalesce(F.array_min(differs) - 1, m)


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(AFTER_ROLE), t["text"], F.lit(CLOSE))), "")


def spans(turns: Column, trained_role: str) -> Column:
    """[start, end) character ranges of ``render(turns)`` that count in the loss: text and end mark of the trained role."""
    extra = len(OPEN) + len(AFTER_ROLE)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.lit(extra) + F.length(t["role"])
        end = start + F.length(t["text"]) + F.lit(len(CLOSE))
        one = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == trained_role, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(turns, zero, step, lambda acc: acc["out"])


def format_pairs(df: DataFrame, chosen: str = "chosen", rejected: str = "rejected", trained_role: str = "assistant") -> DataFrame:
    """``df`` with prompt, prompt_turns, and text and loss spans of both completions.

    The prompt is the longest common prefix of turns, rendered once; the
    completions are the rest.  If one side is a prefix of the other (or both
    are equal), its completion is empty.  A null side has no turns.  Columns
    added: prompt_turns, prompt, chosen_text, chosen_spans, rejected_text,
    rejected_spans (replacing columns of these names); the two input arrays are
    dropped and other columns kept.
    """
    turns = "array<struct<turn:bigint,role:string,text:string>>"
    sides = {s: F.coalesce(F.col(s), F.array().cast(turns)) for s in (chosen, rejected)}
    df = df.withColumns(sides).withColumn("prompt_turns", common_prefix(F.col(chosen), F.col(rejected)))
    rest = {s: F.slice(F.col(s), F.col("prompt_turns") + 1, F.greatest(F.size(F.col(s)), F.lit(1))) for s in (chosen, rejected)}
    prompt = F.slice(F.col(chosen), F.lit(1), F.col("prompt_turns"))
    return df.withColumns({
        "prompt": render(prompt),
        "chosen_text": render(rest[chosen]), "chosen_spans": spans(rest[chosen], trained_role),
        "rejected_text": render(rest[rejected]), "rejected_spans": spans(rest[rejected], trained_role),
    }).drop(chosen, rejected)


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected): a conversation against itself ending in its neighbour's last turn.

    The neighbour of conversation 2k is 2k+1 and the other way round, so each
    conversation meets one other whatever its first turn is.  Without a
    neighbour the rejected side has no last turn.
    """
    convs = collect_turns(conversations, "chosen")
    last = convs.select((F.col("conv_id").bitwiseXOR(F.lit(1))).alias("conv_id"), F.array(F.element_at("chosen", -1)).alias("reply"))
    kept = F.slice(F.col("chosen"), F.lit(1), F.size("chosen") - 1)
    empty = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    return convs.join(last, "conv_id", "left").select("conv_id", "chosen", F.concat(kept, F.coalesce("reply", empty)).alias("rejected"))


def spliced_tails(conversations: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected): a conversation of n turns against its first turns followed by its neighbour's turns from there on.

    The number of turns kept, 0 to n, is the length of the first turn's text
    modulo n + 1, so that sides part at any turn and go on for several.
    Neighbours are those of :func:`swapped_replies`; without one the rejected
    side ends at the cut.
    """
    convs = collect_turns(conversations, "chosen")
    other = convs.select((F.col("conv_id").bitwiseXOR(F.lit(1))).alias("conv_id"), F.col("chosen").alias("other"))
    empty = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    cut = F.length(F.get(F.col("chosen"), F.lit(0))["text"]) % (F.size("chosen") + 1)
    tail = F.slice(F.coalesce("other", empty), cut + 1, F.greatest(F.size(F.coalesce("other", empty)), F.lit(1)))
    return convs.join(other, "conv_id", "left").select("conv_id", "chosen", F.concat(F.slice(F.col("chosen"), F.lit(1), cut), tail).alias("rejected"))
