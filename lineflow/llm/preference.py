"""Preference formatting: paired conversations become one prompt and two masked completions.

The longest common prefix of turns of chosen and rejected is rendered once, as prompt;
the rest of each is its completion, with a mask of one digit per code point: 1 for the
text and end mark of assistant turns, which training counts, 0 for everything else. Only
DataFrame functions are used.

Results in odd cases: a null role or text is an empty one; a conversation without a
partner has a null on the other side and an empty prompt; if one conversation is the
prefix of the other its completion is empty; equal conversations have two empty
completions; no conversations give no rows; columns of the pairs that have the name of a
result are left out, others stay whatever their name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where a turn begins and ends.
HEAD, TAIL = "<|{}|>\n", "<|end|>\n"
TRAINED = "assistant"


def _head(turn: Column) -> Column:
    before, after = HEAD.split("{}")
    return F.concat(F.lit(before), F.coalesce(turn["role"], F.lit("")), F.lit(after))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(TAIL))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def mask(turns: Column) -> Column:
    digit = lambda t: F.when(t["role"] == TRAINED, "1").otherwise("0")
    return F.array_join(F.transform(turns, lambda t: F.concat(F.repeat(F.lit("0"), F.length(_head(t))), F.repeat(digit(t), F.length(_body(t))))), "")


def common_turns(chosen: Column, rejected: Column) -> Column:
    """How many leading turns are equal in role and text."""
    same = F.zip_with(chosen, rejected, lambda a, b: a.eqNullSafe(b))
    return F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, F.size(same)).cast("int")


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """pairs with two columns array<struct<role, text>> -> the other columns and prompt, n_prompt_turns, and completion and mask of each side."""
    results = ["prompt", "n_prompt_turns", "chosen", "chosen_mask", "rejected", "rejected_mask"]
    others = F.struct(F.lit(0), *(F.col(f"`{c}`") for c in pairs.columns if c not in (chosen, rejected, *results)))
    ready = pairs.select(others.alias("others"), F.col(f"`{chosen}`").alias("c"), F.col(f"`{rejected}`").alias("r"))
    both = F.col("c").isNotNull() & F.col("r").isNotNull()
    ready = ready.withColumn("n", F.when(both, common_turns(F.col("c"), F.col("r"))).otherwise(0))
    rest = lambda c: F.slice(c, F.col("n") + 1, F.greatest(F.size(c), F.lit(1)))
    found = [F.coalesce(render(F.slice("c", F.lit(1), F.col("n"))), F.lit("")), F.col("n"), render(rest("c")), mask(rest("c")), render(rest("r")), mask(rest("r"))]
    kept = [F.col("others").getField(c).alias(c) for c in pairs.columns if c not in (chosen, rejected, *results)]
    return ready.select(*kept, *(f.alias(name) for f, name in zip(found, results)))


def adjacent_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) rows -> pairs of conversations 2k (chosen) and 2k + 1 (rejected).

    Rows without a conv_id are left out; repeated rows are turns like any others; turns
    are in order of turn, role and text, nulls first.
    """
    rows = turns.where("conv_id is not null").select("conv_id", "turn", "role", "text")
    side = lambda k: F.collect_list(F.when(F.expr("pmod(conv_id, 2)") == k, F.struct(F.coalesce("turn", F.lit(-(1 << 62))).alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))))
    plain = lambda c: F.when(F.size(c) > 0, F.transform(F.array_sort(c), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    grouped = rows.groupBy(F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id")).agg(side(0).alias("c"), side(1).alias("r"))
    return grouped.select("pair_id", plain("c").alias("chosen"), plain("r").alias("rejected"))
