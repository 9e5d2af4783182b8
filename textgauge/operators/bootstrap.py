"""Bootstrap means and intervals by Poisson weights.

A replicate draws every item a Poisson(1) number of times, which for many items is drawing them with
replacement. The number is a function of the item and the replicate, read off an MD5 digest, so results repeat
on any cluster, all metrics and all runs draw alike, and differences between runs can be taken pair by
pair. Weighted sums of all replicates are made in one aggregate with a combine before the shuffle: a run with a
third of all rows sends one row per task and replicate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPLICATES, CONFIDENCE = 1000, 0.95

# A digest of 32 hexadecimal digits gives this many weights of 16 bits.
_PER_DIGEST = 8


def poisson_steps(bits: int = 16) -> list[int]:
    """The least uniform integers at which a Poisson(1) variable is 1, 2, 3, ... as far as the bits tell."""
    steps, total, k = [], 0.0, 0
    while True:
        total += math.exp(-1) / math.factorial(k)
        step = round(total * (1 << bits))
        if step >= 1 << bits:
            return steps
        steps.append(step)
        k += 1


def _weight(digest: Column, at: int) -> Column:
    # Four digits in lower case are in the order of the numbers that they write.
    digits = F.substring(digest, 1 + 4 * at, 4)
    return sum(((digits >= f"{step:04x}").cast("int") for step in poisson_steps()), F.lit(0))


def draws(rows: DataFrame, unit: Column, replicates: int = REPLICATES) -> DataFrame:
    """Every row once for each replicate that draws its unit, with the columns replicate and weight."""
    blocks = F.sequence(F.lit(0), F.lit((replicates - 1) // _PER_DIGEST))
    digests = rows.withColumn("_block", F.explode(blocks)).withColumn(
        "_digest", F.md5(F.concat_ws(":", unit, F.col("_block")).cast("binary"))
    )
    drawn = F.array(
        *[
            F.struct(
                (F.col("_block") * _PER_DIGEST + at).alias("replicate"), _weight(F.col("_digest"), at).alias("weight")
            )
            for at in range(_PER_DIGEST)
        ]
    )
    found = digests.withColumn("_draw", F.explode(drawn)).drop("_block", "_digest")
    return found.select(*rows.columns, "_draw.*").filter((F.col("weight") > 0) & (F.col("replicate") < replicates))


def replicate_means(
    rows: DataFrame, keys: list[str], unit: Column, metrics: list[str], replicates: int = REPLICATES
) -> DataFrame:
    """keys, replicate and the mean of each metric over the draws of a replicate.

    Nulls do not count. A replicate that draws no row of a key is left out, which happens for a few rows only.
    """
    weighted = draws(rows, unit, replicates)
    counted = [F.sum(F.when(F.col(m).isNotNull(), F.col("weight"))).alias(f"_n_{m}") for m in metrics]
    sums = [F.sum(F.col(m) * F.col("weight")).alias(f"_s_{m}") for m in metrics]
    means = [(F.col(f"_s_{m}") / F.col(f"_n_{m}")).alias(m) for m in metrics]
    return weighted.groupBy(*keys, "replicate").agg(*counted, *sums).select(*keys, "replicate", *means)


def intervals(
    means: DataFrame, keys: list[str], metrics: list[str], confidence: float = CONFIDENCE
) -> DataFrame:
    """keys, metric, low, mid and high: the median and the interval of the replicates' means."""
    tail = (1 - confidence) / 2
    long = means.unpivot([*keys, "replicate"], metrics, "metric", "value")
    points = F.percentile("value", F.array(F.lit(tail), F.lit(0.5), F.lit(1 - tail)))
    return (
        long.groupBy(*keys, "metric")
        .agg(points.alias("p"))
        .select(*keys, "metric", F.col("p")[0].alias("low"), F.col("p")[1].alias("mid"), F.col("p")[2].alias("high"))
    )


def bootstrap_means(
    rows: DataFrame,
    keys: list[str],
    unit: Column,
    metrics: list[str],
    replicates: int = REPLICATES,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """keys, metric, low, mid, high of the mean of each metric; `unit` names what is drawn."""
    return intervals(replicate_means(rows, keys, unit, metrics, replicates), keys, metrics, confidence)


def bootstrap_slot_means(
    scored: DataFrame, runs: list[str], drawn: list[str], plain: list[str], replicates: int = REPLICATES
) -> DataFrame:
    """Per run the mean over the slots of the first item: of the median of replicates for `drawn`, of plain means for `plain`.

    This is the recomputed definition with the medians of the original. A slot belongs to the first item exactly
    if the lowest item id of the slot is the lowest of the run.
    """
    key = [*runs, "slot"]
    mids = bootstrap_means(scored, key, F.col("item_id").cast("string"), drawn, replicates)
    mids = mids.groupBy(*key).pivot("metric", drawn).agg(F.first("mid"))
    slots = scored.groupBy(*key).agg(F.min("item_id").alias("_first"), *[F.avg(m).alias(m) for m in plain])
    first = slots.groupBy(*runs).agg(F.min("_first").alias("_first"))
    # One row per run.
    used = slots.join(F.broadcast(first), [*runs, "_first"]).drop("_first")
    return (
        used.join(mids, key)
        .groupBy(*runs)
        .agg(F.count("*").alias("slots"), *[F.avg(m).alias(m) for m in [*drawn, *plain]])
    )


def margins(
    compared: DataFrame,
    keys: list[str],
    unit: Column,
    metrics: list[str],
    replicates: int = REPLICATES,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """keys, metric, low, mid, high of the mean difference a - b over paired items (columns m_a and m_b).

    Both sides of a pair are drawn together, so what makes an item hard for both models cancels out.
    """
    differences = [(F.col(f"{m}_a") - F.col(f"{m}_b")).alias(m) for m in metrics]
    rows = compared.select(*keys, unit.alias("_unit"), *differences)
    return bootstrap_means(rows, keys, F.col("_unit"), metrics, replicates, confidence)
