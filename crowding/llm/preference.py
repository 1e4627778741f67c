"""Preference formatting: one prompt, two completions, and their loss masks.

A pair holds two conversations as arrays of (role, text) turns. Their longest
common prefix of turns is rendered once as the prompt; what follows in each is
its completion. Masks are spans of the completions' assistant texts, counted
in code points of prompt + completion. Everything is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<|", "|>\n", "\n<|end|>\n"
TRAINED_ROLE = "assistant"

TURNS = "array<struct<role:string,text:string>>"


def conversations(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per conversation: conv, turns in ascending (turn, role, text).

    A conversation is one record, so its turns meet in one row. Null roles and
    texts become empty; a null turn number sorts first; rows with a null
    conversation id belong to none and are left out; repeated rows stay
    repeated turns.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    turn_row = F.struct(
        F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text")
    )
    ordered = F.array_sort(F.collect_list(turn_row))
    return (
        turns.where(F.col(conv).isNotNull())
        .groupBy(F.col(conv).alias("conv"))
        .agg(F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    )


def common_turns(a: Column, b: Column) -> Column:
    """How many turns the two arrays share from the start."""
    n = F.least(F.size(a), F.size(b))
    differ = F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (i > n) | ~F.get(a, i - 1).eqNullSafe(F.get(b, i - 1)),
    )
    return F.when(n == 0, F.lit(0)).otherwise(F.coalesce(F.get(differ, F.lit(0)) - 1, n)).cast("int")


def render(turns: Column) -> Column:
    """The turns' text, each as <|role|> newline text newline <|end|> newline."""
    one = F.transform(
        turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))
    )
    return F.array_join(one, "")


def loss_spans(turns: Column, offset: Column) -> Column:
    """(start, length) of each trained text, when ``turns`` begin at ``offset``."""
    start = F.struct(
        offset.cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"),
    )

    def step(acc: Column, t: Column) -> Column:
        head = acc["at"] + F.length(t["role"]) + len(OPEN) + len(MIDDLE)
        size = F.length(t["text"]).cast("long")
        span = F.struct(head.cast("long").alias("start"), size.alias("length"))
        spans = F.when(t["role"] == TRAINED_ROLE, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((head + size + len(CLOSE)).cast("long").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def preference_format(pairs: DataFrame, pair: str, chosen: str, rejected: str) -> DataFrame:
    """Format pairs of turn arrays.

    Returns pair_id, n_common, prompt, chosen, rejected (the completions),
    chosen_loss and rejected_loss (arrays of start, length in prompt +
    completion; everything else is masked). A null conversation counts as
    empty. Equal conversations share all turns, so both completions are empty.
    One row comes out for each row that goes in; other columns are not read.
    """
    none = F.array().cast(TURNS)
    a, b = "_a", "_b"
    base = pairs.select(
        F.col(pair).alias("pair_id"), F.coalesce(chosen, none).alias(a), F.coalesce(rejected, none).alias(b)
    ).select("*", common_turns(F.col(a), F.col(b)).alias("n_common"))
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c), F.lit(1)))
    cut = base.select(
        "pair_id",
        "n_common",
        render(F.slice(a, 1, F.col("n_common"))).alias("prompt"),
        rest(a).alias(a),
        rest(b).alias(b),
    )
    at = F.length("prompt")
    return cut.select(
        "pair_id",
        "n_common",
        "prompt",
        render(F.col(a)).alias("chosen"),
        render(F.col(b)).alias("rejected"),
        loss_spans(F.col(a), at).alias("chosen_loss"),
        loss_spans(F.col(b), at).alias("rejected_loss"),
    )


def swapped_answer_pairs(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Preference pairs from plain conversations: conv, chosen, rejected.

    Chosen is the conversation itself. Rejected is the same with its last
    assistant text replaced by the last assistant text of its partner, the
    conversation whose id differs in the lowest bit; a partner that is missing
    or never answers gives an empty text. Without an assistant turn, both are
    the whole conversation.
    """
    whole = conversations(turns, conv, turn, role, text)
    n = F.size("turns")
    place = F.array_max(
        F.transform("turns", lambda t, i: F.when(t["role"] == TRAINED_ROLE, i + 1).otherwise(0))
    )
    own = whole.select("conv", "turns", place.alias("place"))
    other = own.where(F.col("place") > 0).select(
        F.col("conv").bitwiseXOR(F.lit(1)).alias("conv"),
        F.get("turns", F.col("place") - 1)["text"].alias("other"),
    )
    answer = F.struct(F.lit(TRAINED_ROLE).alias("role"), F.coalesce("other", F.lit("")).alias("text"))
    swapped = F.concat(
        F.slice("turns", 1, F.greatest(F.col("place") - 1, F.lit(0))),
        F.array(answer),
        F.slice("turns", F.col("place") + 1, F.greatest(n, F.lit(1))),
    )
    return own.join(other, "conv", "left").select(
        "conv",
        F.col("turns").alias("chosen"),
        F.when(F.col("place") > 0, swapped).otherwise(F.col("turns")).alias("rejected"),
    )
