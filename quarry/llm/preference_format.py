"""Preference formatting: chosen and rejected conversations as one prompt and two masked completions.

The longest common prefix of turns (role and text) of both conversations is rendered once, as the prompt; what
follows in each is its completion.  The mask of a completion lists the character spans that carry loss: the
text of the assistant's turns with its closing mark.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written

#: Marks around a turn; an opening ``<|`` inside a role or text is written ``<\|``.
OPEN, BETWEEN, CLOSE = "<|", "|>\n", "<|end|>\n"


def conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv, turns)``: each conversation's turns ``(role, text)`` in order of turn number, equal numbers by
    role and text, a null number first.  Turns without a conversation id belong to none; exactly repeated
    rows count once; a null role is ``unknown``, a null text empty."""
    clean = lambda c: F.replace(c, F.lit("<|"), F.lit("<\\|"))
    rows = (turns.where(F.col(conv_col).isNotNull())
            .select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                    clean(F.coalesce(F.col(role_col), F.lit("unknown"))).alias("role"), clean(F.coalesce(F.col(text_col), F.lit(""))).alias("text")).distinct())
    return (rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
            .select("conv", F.expr("transform(t, x -> named_struct('role', x.role, 'text', x.text))").alias("turns")))


def _rendered(turns: str) -> str:
    """SQL for the rendered pieces of an array of turns."""
    return f"transform({turns}, x -> concat('{OPEN}', x.role, '{BETWEEN}', x.text, '{CLOSE}'))".replace("\n", "\\n")


def _mask(turns: str) -> str:
    """SQL for ``start-end`` of the assistant turns' text and closing mark in the rendered turns, comma-joined."""
    head, tail = len(OPEN) + len(BETWEEN), len(CLOSE)
    return (f"aggregate({turns}, named_struct('at', 0L, 'out', ''), (s, x) -> named_struct("
            f"'at', s.at + length(x.role) + length(x.text) + {head + tail}, "
            f"'out', if(x.role = 'assistant', concat(s.out, if(s.out = '', '', ','), s.at + length(x.role) + {head}, '-', "
            f"s.at + length(x.role) + length(x.text) + {head + tail}), s.out)), s -> s.out)")


def format_pairs(pairs: DataFrame, chosen: str = "chosen_turns", rejected: str = "rejected_turns") -> DataFrame:
    """The pairs with ``prompt_turns``, ``prompt``, ``chosen``, ``rejected``, ``chosen_mask`` and
    ``rejected_mask`` in place of the two arrays of turns.

    Equal conversations have empty completions; without a common first turn the prompt is empty; a
    conversation that is a prefix of the other has an empty completion."""
    n = F.expr(f"coalesce(array_position(transform(zip_with({chosen}, {rejected}, (x, y) -> x <=> y), z -> if(z, 1, 0)), 0), 0)")
    least = F.least(F.size(chosen), F.size(rejected))
    diff = n.cast("int")          # zip_with pads the shorter one with nulls, so the first difference is found there too
    common = F.when(diff == 0, least).otherwise(diff - 1)
    rest = pairs.withColumn("prompt_turns", common)
    rest = rest.withColumn("_c", F.expr(f"slice({chosen}, prompt_turns + 1, size({chosen}))")).withColumn("_r", F.expr(f"slice({rejected}, prompt_turns + 1, size({rejected}))"))
    return (rest.withColumn("prompt", F.expr(f"array_join({_rendered(f'slice({chosen}, 1, prompt_turns)')}, '')"))
            .withColumn("chosen", F.expr(f"array_join({_rendered('_c')}, '')")).withColumn("rejected", F.expr(f"array_join({_rendered('_r')}, '')"))
            .withColumn("chosen_mask", F.expr(_mask("_c"))).withColumn("rejected_mask", F.expr(_mask("_r")))
            .drop("_c", "_r", chosen, rejected))


def shared_opening_pairs(convs: DataFrame) -> DataFrame:
    """Conversations with one first turn: the least id is chosen, each other one rejected against it."""
    opened = convs.withColumn("opening", F.xxhash64(F.expr("turns[0].role"), F.expr("turns[0].text")))
    leaders = opened.groupBy("opening").agg(F.min("conv").alias("conv"), F.max("conv").alias("top")).where("conv != top").select("opening", "conv")
    leaders = written(leaders.join(convs, "conv").select("opening", F.col("conv").alias("lead"), F.col("turns").alias("lead_turns")), "leaders")
    return (opened.join(leaders, "opening").where("conv != lead and turns[0] = lead_turns[0]")
            .select(F.lit("opening").alias("kind"), F.col("lead").alias("chosen_id"), F.col("conv").alias("rejected_id"),
                    F.col("lead_turns").alias("chosen_turns"), F.col("turns").alias("rejected_turns")))


def stale_answer_pairs(convs: DataFrame) -> DataFrame:
    """Conversations with two or more answers: as they are up to the last answer (chosen), and with that answer
    replaced by the first one (rejected)."""
    last = "array_max(filter(transform(turns, (x, i) -> if(x.role = 'assistant', i + 1, null)), i -> i is not null))"
    first = "filter(turns, x -> x.role = 'assistant')[0]"
    cut = convs.where(F.expr("size(filter(turns, x -> x.role = 'assistant')) > 1")).withColumn("last", F.expr(last))
    return cut.select(F.lit("stale").alias("kind"), F.col("conv").alias("chosen_id"), F.col("conv").alias("rejected_id"),
                      F.expr("slice(turns, 1, last)").alias("chosen_turns"),
                      F.expr(f"concat(slice(turns, 1, last - 1), array({first}))").alias("rejected_turns"))


def preference_pairs(turns: DataFrame, **columns: str) -> DataFrame:
    """Both kinds of pairs of a table of turns, formatted (see the functions above for each rule)."""
    convs = written(conversations(turns, **columns), "conversations")
    return format_pairs(shared_opening_pairs(convs).union(stale_answer_pairs(convs)))
