"""Analytics over conversations (conv_id, turn, role, text)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Stop word and turn limits of the two chat teams, log patterns.
STOP_WORD = "STOP"
MAX_TURNS = 15
ANALYST_MAX_TURNS = 10
FENCE = "```"
EXIT_CODE_PATTERN = r"exit code: (\d+)"
PROMPT_TOKENS_PATTERN = r"prompt_tokens=(\d+)"
COMPLETION_TOKENS_PATTERN = r"completion_tokens=(\d+)"


def stop_turn(messages: DataFrame, word: str = STOP_WORD) -> DataFrame:
    """First turn whose text contains the stop word (case-sensitive); null when none does."""
    hit = F.when(F.col("text").contains(word), F.col("turn"))
    return messages.groupBy("conv_id").agg(F.min(hit).alias("stop_turn"))


def truncate_conversation(messages: DataFrame, max_turns: int = MAX_TURNS, word: str = STOP_WORD) -> DataFrame:
    """Turns up to the stop word or the turn limit, with the reason the conversation ended."""
    hit = F.when(F.col("text").contains(word), F.col("turn"))
    ends = messages.groupBy("conv_id").agg(F.min(hit).alias("stop_turn"), F.max("turn").alias("last_turn"))
    stopped = F.coalesce(F.col("stop_turn") < max_turns, F.lit(False))
    reason = (
        F.when(stopped, F.lit("stop word"))
        .when(F.col("last_turn") >= max_turns, F.lit("max turns"))
        .otherwise(F.lit("end"))
    )
    last = F.when(stopped, F.col("stop_turn")).otherwise(F.lit(max_turns - 1))
    return (
        messages.join(ends.select("conv_id", last.alias("last"), reason.alias("reason")), "conv_id")
        .filter(F.col("turn") <= F.col("last")).drop("last")
    )


def code_blocks(messages: DataFrame) -> DataFrame:
    """Fenced blocks, one row each, with language and body."""
    fenced = rf"(?s){FENCE}(\w*)\n(.*?){FENCE}"
    blocks = messages.select(
        "conv_id", "turn", F.posexplode(F.regexp_extract_all("text", F.lit(fenced), F.lit(0))).alias("block", "whole")
    )
    return blocks.select(
        "conv_id", "turn", "block",
        F.regexp_extract("whole", fenced, 1).alias("language"),
        F.regexp_extract("whole", fenced, 2).alias("body"),
    )


def executor_outcomes(messages: DataFrame) -> DataFrame:
    """Every exit code that a message reports, numbered from 0 as ``note``; numbers too large for an int are left out."""
    notes = messages.select("conv_id", "turn", F.posexplode(F.regexp_extract_all("text", F.lit(EXIT_CODE_PATTERN), F.lit(1))).alias("note", "code"))
    code = F.col("code").try_cast("int")
    return notes.select("conv_id", "turn", "note", code.alias("exit_code")).filter(F.col("exit_code").isNotNull()).withColumn(
        "success", F.col("exit_code") == 0
    )


def token_usage(messages: DataFrame) -> DataFrame:
    """Prompt and completion tokens per conversation and speaker, from all usage notes of all texts."""

    def tokens(pattern: str):
        notes = F.regexp_extract_all("text", F.lit(pattern), F.lit(1))
        all_notes = F.aggregate(notes, F.lit(0).cast("bigint"), lambda total, n: total + F.coalesce(n.try_cast("bigint"), F.lit(0)))
        return F.coalesce(F.sum(all_notes), F.lit(0))

    return messages.groupBy("conv_id", "role").agg(
        tokens(PROMPT_TOKENS_PATTERN).alias("prompt_tokens"),
        tokens(COMPLETION_TOKENS_PATTERN).alias("completion_tokens"),
    )


def role_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy("role").agg(F.count("*").alias("n"))
