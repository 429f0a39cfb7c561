"""Turns, pairs, chat and instruction prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.templates import history_entry, system_prompt
from textloom.functions.text import word_count
from textloom.operators.ordering import running_total

TURNS_PER_BLOCK = 10_000


def turn_pairs(turns: DataFrame, measure: Column | None = None) -> DataFrame:
    """User turn and the assistant turn right after it, one row per pair.

    `turn` is the message position, so both messages of a pair meet on
    `(conv_id, pair_turn)`: one shuffle, no window, and a long conversation
    is spread over all tasks.  A leading assistant greeting meets no user turn.
    `measure` of both turns is added up as `tokens`; it is taken before the
    shuffle, so a job that needs only the lengths moves no text.
    """
    is_user = F.col("role") == "user"
    spoken = turns.filter(F.col("role").isin("user", "assistant"))
    keyed = spoken.withColumn("pair_turn", F.when(is_user, F.col("turn")).otherwise(F.col("turn") - 1))
    sides = [
        F.max(F.when(is_user, F.col("text"))).alias("question"),
        F.max(F.when(~is_user, F.col("text"))).alias("answer"),
        F.count_if(is_user).alias("__q"),
        F.count_if(~is_user).alias("__a"),
    ]
    if measure is not None:
        keyed = keyed.withColumn("__tokens", measure.cast("bigint"))
        sides.append(F.sum("__tokens").alias("tokens"))
    pairs = keyed.groupBy("conv_id", "pair_turn").agg(*sides)
    return pairs.filter("__q > 0 AND __a > 0").drop("__q", "__a")


def instruction_rows(turns: DataFrame) -> DataFrame:
    """`instruction, input, output` per pair; the input is the conversation's system text or ''."""
    system = turns.filter("role = 'system'").select("conv_id", F.col("text").alias("__system"))
    return (
        turn_pairs(turns)
        .join(system, "conv_id", "left")
        .select(
            "conv_id",
            "pair_turn",
            F.col("question").alias("instruction"),
            F.coalesce("__system", F.lit("")).alias("input"),
            F.col("answer").alias("output"),
        )
    )


def within_budget(pairs: DataFrame, budget: int | Column, block: int = TURNS_PER_BLOCK) -> DataFrame:
    """Of `(conv_id, pair_turn, tokens, ...)`, the newest pairs whose tokens, added up from the newest back, stay within the budget.

    Every pair has at least one token, so the running sum only grows and the
    kept pairs are exactly those before the first excess.
    """
    budget = F.lit(budget) if isinstance(budget, int) else budget
    summed = running_total(
        pairs,
        group=["conv_id"],
        order=[F.desc("pair_turn")],
        block=-F.floor(F.col("pair_turn") / block),
        value=F.col("tokens"),
        out="used_tokens",
        inclusive=True,
    )
    return summed.filter(F.col("used_tokens") <= budget)


def budgeted_prompt(turns: DataFrame, system: str, context: int, generation: int) -> DataFrame:
    """System text, as much recent history as fits, and the open user turn.

    The open turn is a conversation's last message when the user wrote it.
    A pair's tokens are those of its two rendered turns.
    What is collected per conversation is bounded by the budget.
    """
    last = turns.groupBy("conv_id").agg(F.max_by(F.struct("turn", "role", "text"), "turn").alias("m"))
    open_turns = last.filter("m.role = 'user'").select("conv_id", F.col("m.text").alias("instruction"))
    fixed = word_count(F.lit(system_prompt(system, "", "")))
    asked = open_turns.withColumn("room", F.lit(context - generation) - fixed - word_count(F.col("instruction")))
    entry = F.concat(history_entry(F.lit("User"), F.col("question")), history_entry(F.lit("Assistant"), F.col("answer")))
    measure = word_count(history_entry(F.initcap("role"), F.col("text")))
    pairs = turn_pairs(turns, measure).join(asked.select("conv_id", "room"), "conv_id").withColumn("entry", entry)
    kept = within_budget(pairs, F.col("room"))
    history = kept.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pair_turn", "entry"))).alias("h"))
    joined = asked.join(history, "conv_id", "left")
    text = F.coalesce(F.array_join(F.transform("h", lambda x: x["entry"]), ""), F.lit(""))
    head, middle, tail = system_prompt(system, "\x00", "\x01").replace("\x01", "\x00").split("\x00")
    return joined.select(
        "conv_id", F.concat(F.lit(head), text, F.lit(middle), "instruction", F.lit(tail)).alias("prompt")
    )


def history_messages(pairs: DataFrame) -> DataFrame:
    """Alternating user/assistant messages of `(conv_id, pair_turn, question, answer)`, empty ones dropped."""
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.lit("user").alias("role"), F.col("question").alias("content")),
        F.struct(F.lit(1).alias("side"), F.lit("assistant").alias("role"), F.col("answer").alias("content")),
    )
    rows = pairs.select("conv_id", "pair_turn", F.explode(sides).alias("m"))
    messages = rows.select("conv_id", (F.col("pair_turn") + F.col("m.side")).alias("turn"), "m.role", "m.content")
    return messages.filter("content IS NOT NULL AND content <> ''")


def preference_pairs(answers: DataFrame, key: str | Sequence[str], strong: str, weak: str) -> DataFrame:
    """Chosen and rejected answers of one prompt, by the model that wrote them.

    `answers` is `(key, prompt, model, answer)` with one answer per model; the
    key is one column or several.
    """
    keys = [key] if isinstance(key, str) else list(key)
    side = lambda model: F.max(F.when(F.col("model") == model, F.col("answer")))
    pairs = answers.filter(F.col("model").isin(strong, weak)).groupBy(*keys, "prompt").agg(
        side(strong).alias("chosen"), side(weak).alias("rejected")
    )
    return pairs.filter("chosen IS NOT NULL AND rejected IS NOT NULL")


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep exactly these columns; a missing one is an error."""
    from textloom.sources.readers import require_columns

    return require_columns(df, columns).select(*columns)


def one_shot(asked: DataFrame, key: str, prompt: str, answer: str, out: str) -> DataFrame:
    """Add `out`: another item's prompt with its answer, then the row's own prompt.

    The example is the item with the smallest key; that item itself gets the
    second smallest. A single item has no example and stands alone.
    """
    first = [*asked.orderBy(key).limit(2).select(key, F.concat_ws(" ", prompt, answer).alias("t")).collect(), None, None]  # two rows
    of_others, of_first = (F.lit(row.t if row else "") for row in first[:2])
    shown = of_others if first[0] is None else F.when(F.col(key) == first[0][key], of_first).otherwise(of_others)
    return asked.withColumn(out, F.concat(shown, prompt))
