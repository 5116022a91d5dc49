"""Chat formatting: preference pairs with one prompt and two masked completions.

For each pair of a chosen and a rejected conversation, the longest common prefix of turns is
rendered once, as the prompt; what follows on each side is a completion.  A completion comes with
the character ranges to train on, those the assistant speaks; the rest is masked.

Turns of a conversation are gathered into one array, which is what a training example is; prefix,
rendering and masks are higher-order functions on the two arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASSISTANT = "assistant"
END = "<|end|>"


def _head(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def _tail() -> Column:
    return F.lit(f"{END}\n")


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t.role), t.text, _tail())), "")


def trained(turns: Column) -> Column:
    """Character ranges [start, end) of the rendered turns that the assistant speaks: its text and
    the end mark."""
    start = F.struct(F.lit(0).alias("at"),
                     F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc.at + F.length(_head(t.role))
        stop = begin + F.length(t.text) + F.lit(len(END))
        span = F.array(F.struct(begin.alias("start"), stop.alias("end")))
        return F.struct((stop + 1).alias("at"),
                        F.when(t.role == ASSISTANT, F.concat(acc.spans, span)).otherwise(acc.spans)
                        .alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc.spans)


def _gathered(turns: DataFrame, pair_col: str, name: str) -> DataFrame:
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    return (turns.groupBy(F.col(pair_col).alias("pair_id"))
            .agg(F.sort_array(F.collect_list(turn)).alias(name)))


def preference_pairs(spark: SparkSession, chosen: DataFrame, rejected: DataFrame,
                     pair_col: str = "pair_id") -> DataFrame:
    """One row a pair that both tables have: pair_id, n_prompt_turns, prompt, chosen, chosen_train,
    rejected, rejected_train, usable.

    Both tables hold turns: the pair, turn (order in the conversation), role, text.  Turns are equal
    if role and text are; null roles and texts count as empty.  Turns of equal number are ordered by
    role and text; a null turn number comes first.  The prefix is whole turns, so a completion is
    empty if its side is a prefix of the other.  ``usable``: both completions have text to train on.
    A null pair is dropped, as is a pair that is in one table alone.  Empty tables give no rows.
    Other columns are ignored.
    """
    both = _gathered(chosen.filter(F.col(pair_col).isNotNull()), pair_col, "c").join(
        _gathered(rejected.filter(F.col(pair_col).isNotNull()), pair_col, "r"), "pair_id")
    shorter = F.least(F.size("c"), F.size("r"))
    here = lambda side, i: F.element_at(F.col(side), i)
    differ = F.filter(F.sequence(F.lit(1), shorter),
                      lambda i: (here("c", i).role != here("r", i).role)
                      | (here("c", i).text != here("r", i).text))
    both = both.withColumn("n", F.when(F.size(differ) > 0, F.element_at(differ, 1) - 1)
                           .otherwise(shorter))
    rest = lambda side: F.slice(side, F.col("n") + 1, F.size(side))
    return (both.withColumns({"c_rest": rest("c"), "r_rest": rest("r")})
            .select("pair_id", F.col("n").alias("n_prompt_turns"),
                    render(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
                    render(F.col("c_rest")).alias("chosen"),
                    trained(F.col("c_rest")).alias("chosen_train"),
                    render(F.col("r_rest")).alias("rejected"),
                    trained(F.col("r_rest")).alias("rejected_train"))
            .withColumn("usable", (F.size("chosen_train") > 0) & (F.size("rejected_train") > 0)))


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """A rejected side for a table that has none: each conversation with the text of its last
    assistant turn replaced by that of its neighbour's (the id with the last bit flipped); without
    a neighbour, or an assistant turn there, by an empty text.

    Returns conv_id, turn, role, text; other columns are ignored.  Rows of a null conv_id stay."""
    conversations = conversations.select("conv_id", "turn", "role", "text")
    last = (conversations.filter(F.col("role") == ASSISTANT).groupBy("conv_id")
            .agg(F.max(F.struct("turn", "text")).alias("last")))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"),
                        F.col("last.text").alias("reply"))
    swap = (last.join(other, "conv_id", "left")
            .select("conv_id", F.col("last.turn").alias("last_turn"),
                    F.coalesce("reply", F.lit("")).alias("reply")))
    hit = (F.col("turn") == F.col("last_turn")) & (F.col("role") == ASSISTANT)
    return (conversations.join(swap, "conv_id", "left")
            .select("conv_id", "turn", "role", F.when(hit, F.col("reply")).otherwise(F.col("text"))
                    .alias("text")))
