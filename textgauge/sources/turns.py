"""Evaluation sets out of a conversation table (conv_id, turn, role, text)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def references_of(turns: DataFrame, role: str = "user") -> DataFrame:
    """All turns of a role as references of their conversation, ordered by turn."""
    return turns.filter(F.col("role") == role).select(
        F.col("conv_id").alias("item_id"), F.col("turn").alias("ref_no"), F.col("text").alias("reference")
    )


# Item ids are conversation * TURNS + turn.
TURNS = 1_000_000


def hypotheses_of(turns: DataFrame, role: str = "assistant") -> DataFrame:
    """Every turn of a role as the hypothesis of an item of its own, with its conversation."""
    return turns.filter(F.col("role") == role).select(
        (F.col("conv_id") * TURNS + F.col("turn")).alias("item_id"), "conv_id", F.col("text").alias("hypothesis")
    )


def stand_in_runs(turns: DataFrame, role: str = "assistant") -> DataFrame:
    """The same as two models, by turn, on two datasets, by conversation; `pair_no` is what both models have."""
    turn = F.expr(f"item_id % {TURNS} div 2")
    return hypotheses_of(turns, role).select(
        F.when(turn % 2 == 0, "model_0").otherwise("model_1").alias("model"),
        F.when(F.col("conv_id") % 2 == 0, "even").otherwise("odd").alias("dataset"),
        "item_id",
        "conv_id",
        F.expr(f"item_id % {TURNS} div 4").alias("pair_no"),
        "hypothesis",
    )


def unmatched_turns(turns: DataFrame, hypothesis: str = "assistant", reference: str = "user") -> DataFrame:
    """Turns of either role whose conversation has none of the other, which no pair shows."""
    def side(own: str, other: str) -> DataFrame:
        has = turns.filter(F.col("role") == other).select("conv_id")
        return turns.filter(F.col("role") == own).join(has, "conv_id", "left_anti").select("conv_id", "turn", "role")

    return side(hypothesis, reference).unionByName(side(reference, hypothesis))
