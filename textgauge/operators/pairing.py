"""Which hypothesis meets which reference, and coverage between tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .numbering import block_of, block_starts, index_in_group

REFERENCES_PER_BLOCK = 1024
# Characters that one task scores; those of a text count once for every pair it is in.
CHARACTERS_PER_TASK = 32 << 20


def explode_references(items: DataFrame, references: str = "reference_captions") -> DataFrame:
    """One row per reference of an item that holds them as an array, with its slot number."""
    kept = [c for c in items.columns if c != references]
    return items.select(*kept, F.posexplode(references).alias("slot", "reference")).withColumn(
        "slot", F.col("slot").cast("bigint")
    )


def number_slots(references: DataFrame) -> DataFrame:
    """Slot 0, 1, ... of each reference in its item, in order of `ref_no`."""
    return index_in_group(references, ["item_id"], "ref_no", "slot", REFERENCES_PER_BLOCK)


def scoring_tasks(hypotheses: DataFrame, references: DataFrame, group: str, per_task: int = CHARACTERS_PER_TASK) -> int:
    """Into how many tasks the pairs are dealt: at least one per core, and one for each `per_task` characters in pairs.

    The bytes of the references say little of the work to come, as each meets all hypotheses of its
    item. So texts are counted once per item, and the products summed; only numbers are shuffled.
    """
    texts = references.groupBy(group).agg(
        F.count("*").alias("_refs"), F.sum(F.length("reference").cast("double")).alias("_ref_chars")
    )
    made = hypotheses.groupBy(group).agg(
        F.count("*").alias("_hyps"), F.sum(F.length("hypothesis").cast("double")).alias("_hyp_chars")
    )
    work = texts.join(made, group).agg(F.sum(F.expr("_refs * _hyp_chars + _hyps * _ref_chars"))).first()[0] or 0.0
    return max(hypotheses.sparkSession.sparkContext.defaultParallelism, math.ceil(work / per_task))


def pair_references(
    hypotheses: DataFrame,
    references: DataFrame,
    slots: bool = False,
    width: int = REFERENCES_PER_BLOCK,
    group: str = "item_id",
    tasks: int | None = None,
) -> DataFrame:
    """Every reference with the hypotheses of its item (one per run), joined on the item.

    `hypotheses` has item_id, hypothesis and any run columns; `references` has item_id, an integer
    ref_no and reference. If several items share their references, `group` is the column of
    `hypotheses` that holds what the references call item_id. References are cut into blocks by ref_no and a hypothesis is repeated
    only for the blocks its item really has: a usual item has one, an item with a third of all
    references has very many, spread over the cluster. References are shuffled once, by
    (item, block); that also balances the scoring that follows. With `slots`, the slot number of
    each reference is added from the same block table.
    """
    blocked = references.withColumn("_block", block_of("ref_no", width))
    if group != "item_id":
        blocked = blocked.withColumnRenamed("item_id", group)
    blocks = block_starts(blocked, [group]) if slots else (
        blocked.select(group, "_block").distinct()
    )
    # Both sides are dealt alike, so whichever Spark may broadcast, the other one has these tasks. The block comes
    # first, as Spark would take an exchange by the same columns in the other order, which it may merge, for this one.
    tasks = tasks or scoring_tasks(hypotheses, blocked, group)
    spread = hypotheses.join(blocks, group).repartition(tasks, "_block", group)
    placed = blocked.repartition(tasks, "_block", group)
    if slots:
        inside = Window.partitionBy(group, "_block").orderBy("ref_no")
        placed = placed.withColumn("_inside", F.row_number().over(inside) - 1)
    pairs = placed.join(spread, [group, "_block"])
    if slots:
        pairs = pairs.withColumn("slot", F.col("_start") + F.col("_inside"))
    return pairs.drop("_block", "_start", "_inside", *([group] if group != "item_id" else []))


def blocked_references(references: DataFrame, size: int = 1000) -> DataFrame:
    """References as arrays in slot order, in blocks of `size` per item.

    A usual item has just block 0. Nothing is left out of a larger one; it has further blocks,
    so no row grows with the size of a group.
    """
    slot_text = F.struct("slot", "reference")
    return (
        references.withColumn("block", block_of("slot", size))
        .groupBy("item_id", "block")
        .agg(F.array_sort(F.collect_list(slot_text)).alias("_refs"))
        .select("item_id", "block", F.col("_refs.reference").alias("reference_captions"))
    )


def pair_by_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right, key)


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of either table with flags that tell which of them has the key."""
    a = left.select(key).distinct().withColumn("in_left", F.lit(True))
    b = right.select(key).distinct().withColumn("in_right", F.lit(True))
    return a.join(b, key, "full_outer").select(
        key,
        F.coalesce("in_left", F.lit(False)).alias("in_left"),
        F.coalesce("in_right", F.lit(False)).alias("in_right"),
    )


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of the left table whose key the right table lacks."""
    return left.join(right.select(key), key, "left_anti")
