"""Preference pairs of conversations: the common turns once as prompt, what follows on either side as masked completions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _sided(turns: DataFrame, side: str, id_col: str) -> DataFrame:
    """(conv_id, the turns in order) of each conversation; a conversation is one record and so one row."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias(side))


def opened(role: str) -> str:
    return f"concat('<|', {role}, '|>\\n')"


def rendered(turns: str) -> str:
    """SQL for the text of an array of turns: each a line with its role, then what it says, then a line end."""
    return f"array_join(transform({turns}, x -> concat({opened('x.role')}, x.text, '\\n')), '')"


def masked(turns: str) -> str:
    """SQL for the spans of rendered(turns) that the assistant says and a model learns: (first character, end) of each."""
    step = f"length({opened('x.role')})"
    return (
        f"aggregate({turns}, named_struct('at', 0L, 'spans', cast(array() as array<struct<first: bigint, end: bigint>>)), (acc, x) -> named_struct("
        f"'at', acc.at + {step} + length(x.text) + 1, "
        f"'spans', if(x.role = 'assistant', array_append(acc.spans, named_struct('first', acc.at + {step}, 'end', acc.at + {step} + length(x.text) + 1)), acc.spans)), acc -> acc.spans)"
    )


def format_preferences(chosen: DataFrame, rejected: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation in both tables of (id, turn, role, text): conv_id, n_prefix, prompt, chosen, chosen_mask, rejected, rejected_mask.

    n_prefix counts the leading turns that have equal role and text on both sides; they are rendered once, as the prompt. A mask
    lists (first, end) character spans of its completion, one per assistant turn, line end included. Turns go by number, then
    role and text, so repeated rows and equal numbers are in a fixed order; NULL role and text are empty. Turns without
    conversation id belong to none and give no row; an empty side gives no rows. Built-in functions only; one shuffle per side.
    """
    pairs = _sided(chosen, "good", id_col).join(_sided(rejected, "bad", id_col), "conv_id")
    equal = "transform(arrays_zip(good, bad), p -> p.good.role <=> p.bad.role AND p.good.text <=> p.bad.text)"
    pairs = pairs.withColumn("same", F.expr(f"array_position({equal}, false)"))
    pairs = pairs.withColumn("n_prefix", F.expr("if(same = 0, least(size(good), size(bad)), same - 1)").cast("long"))
    rest = {side: f"slice({side}, cast(n_prefix as int) + 1, greatest(size({side}) - cast(n_prefix as int), 0))" for side in ("good", "bad")}
    return pairs.select(
        "conv_id",
        "n_prefix",
        F.expr(rendered("slice(good, 1, cast(n_prefix as int))")).alias("prompt"),
        F.expr(rendered(rest["good"])).alias("chosen"),
        F.expr(masked(rest["good"])).alias("chosen_mask"),
        F.expr(rendered(rest["bad"])).alias("rejected"),
        F.expr(masked(rest["bad"])).alias("rejected_mask"),
    )


def swapped_replies(turns: DataFrame) -> DataFrame:
    """Rejected versions of conversations: the last assistant turn says what that of the neighbour says (ids 2k and 2k + 1).

    A reply to another prompt is the plain weak answer where no judgments exist. A conversation without assistant turn or with
    a neighbour that has none stays as it is. The last turn is the greatest by number, then text.
    """
    said = turns.filter("role = 'assistant' AND conv_id IS NOT NULL").groupBy("conv_id").agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last"))
    other = said.select(F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("conv_id"), F.col("last.text").alias("reply"))
    swap = said.join(other, "conv_id").select("conv_id", F.col("last.turn").alias("last_turn"), F.col("last.text").alias("last_text"), "reply")
    last = (F.col("role") == "assistant") & F.col("turn").eqNullSafe(F.col("last_turn")) & (F.coalesce("text", F.lit("")) == F.col("last_text"))
    return turns.join(swap, "conv_id", "left").select("conv_id", "turn", "role", F.when(last, F.col("reply")).otherwise(F.col("text")).alias("text"))
