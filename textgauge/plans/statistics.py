"""Run summaries out of stored statistics, so that changed items do not have the rest scored again.

The items of a run are cut into blocks of ids. A block's statistics are the sums from which BLEU and all means follow:
they add up over blocks. A change of items is a new version of the blocks that hold them, scored alone; the summary adds up the
newest version of every block. Equal to scoring all items again, but for the order of floating-point sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import scores
from . import evaluation

BLOCK = 1 << 16

_COUNTS = [
    "hyp_len", "closest_ref", "shortest_ref", *[f"den_{kind}_{n}" for n in scores.ORDERS for kind in ("first", "again")],
    *[f"num_{n}" for n in scores.ORDERS], "items",
]


def with_block(rows: DataFrame, width: int = BLOCK) -> DataFrame:
    return rows.withColumn("item_block", F.expr(f"item_id div {width}"))


def changed_blocks(items: DataFrame, width: int = BLOCK) -> DataFrame:
    """item_block of the items (item_id) that were added, replaced or removed."""
    return with_block(items.select("item_id"), width).select("item_block").distinct()


def block_counts(pairs: DataFrame, how: evaluation.Definition, runs: list[str], width: int = BLOCK) -> DataFrame:
    """runs, item_block and the sums for BLEU."""
    counts = evaluation.bleu_counts(with_block(pairs, width), how, [*runs, "item_block"])
    return counts.select(*runs, "item_block", *_COUNTS)


def block_sums(pairs: DataFrame, how: evaluation.Definition, runs: list[str], width: int = BLOCK) -> DataFrame:
    """runs, item_block, slot, first item, n and sums of the scores; slot is null where means are taken over items."""
    scored = evaluation.score_pairs(pairs, how)
    if not how.by_slot:
        scored = scores.item_means(scored, [*runs, "item_id"], evaluation.METRICS).withColumn("slot", F.lit(None).cast("bigint"))
    return with_block(scored, width).groupBy(*runs, "item_block", "slot").agg(
        F.min("item_id").alias("first_item"), F.count("*").alias("n"), *[F.sum(m).alias(m) for m in evaluation.METRICS]
    )


def write_statistics(
    pairs: DataFrame, how: evaluation.Definition, runs: list[str], path: str, version: int,
    blocks: DataFrame | None = None, width: int = BLOCK,
) -> None:
    """A version of the statistics of the blocks that `pairs` holds, whole; `blocks` names those that a later version replaces.

    A block that has lost all of its items is stored as named and without sums, so that older sums do not count.
    """
    for name, made in (("counts", block_counts(pairs, how, runs, width)), ("sums", block_sums(pairs, how, runs, width))):
        made.write.mode("errorifexists").parquet(f"{path}/{name}/version={version}")
    replaced = blocks if blocks is not None else with_block(pairs.select("item_id"), width).select("item_block").distinct()
    replaced.select(F.col("item_block").cast("bigint")).write.mode("errorifexists").parquet(f"{path}/blocks/version={version}")


def _newest(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Rows of the newest version of each block; only block numbers and versions are compared."""
    last = spark.read.parquet(f"{path}/blocks").groupBy("item_block").agg(F.max("version").alias("version"))
    return spark.read.parquet(f"{path}/{name}").join(last, ["item_block", "version"], "left_semi")


def summary_of_statistics(spark: SparkSession, path: str, how: evaluation.Definition, runs: list[str]) -> DataFrame:
    """runs, bleu, rouge1, rouge2, meteor and metric_def, as `evaluation.run_summary` has them."""
    counts = _newest(spark, path, "counts").groupBy(*runs).agg(*[F.sum(c).alias(c) for c in _COUNTS])
    slots = _newest(spark, path, "sums").groupBy(*runs, "slot").agg(
        F.min("first_item").alias("first_item"),
        F.sum("n").alias("n"),
        *[F.sum(m).alias(m) for m in evaluation.METRICS],
    )
    # A slot counts if the run's first item has it.
    lowest = F.min("first_item").over(Window.partitionBy(*runs))
    used = slots.withColumn("lowest", lowest).filter("first_item = lowest")
    means = used.groupBy(*runs).agg(*[F.avg(F.col(m) / F.col("n")).alias(m) for m in evaluation.METRICS])
    return counts.select(*runs, how.bleu_score().alias("bleu")).join(means, runs).withColumn("metric_def", F.lit(how.name))
