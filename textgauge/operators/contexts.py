"""Retrieved chunks as context, and prompts with and without it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import grounded_prompt


def stuffed_context(ranked: DataFrame, q_id: str, text: str = "chunk_text") -> DataFrame:
    """The retrieved chunks of each question as one text, in rank order, a blank line between.

    A group holds the top k only, so it stays small.
    """
    parts = F.array_sort(F.collect_list(F.struct("rank", text)))
    return ranked.groupBy(q_id).agg(
        F.array_join(F.transform(parts, lambda part: part[text]), "\n\n").alias("context")
    )


def grounded(questions: DataFrame, contexts: DataFrame, q_id: str, question: str) -> DataFrame:
    """Questions with their context and prompt; without any chunk the context is empty."""
    return questions.join(contexts, q_id, "left").select(
        q_id,
        F.lit("grounded").alias("mode"),
        F.coalesce("context", F.lit("")).alias("context"),
        grounded_prompt(F.coalesce("context", F.lit("")), F.col(question)).alias("prompt"),
    )


def ungrounded(questions: DataFrame, q_id: str, question: str) -> DataFrame:
    return questions.select(
        q_id,
        F.lit("ungrounded").alias("mode"),
        F.lit(None).cast("string").alias("context"),
        F.col(question).alias("prompt"),
    )


def both_modes(questions: DataFrame, contexts: DataFrame, q_id: str, question: str) -> DataFrame:
    return grounded(questions, contexts, q_id, question).unionByName(
        ungrounded(questions, q_id, question)
    )
