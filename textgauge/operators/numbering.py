"""Dense numbers and batch numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row below


def dense_index(df: DataFrame, *order: str, name: str = "row_id") -> DataFrame:
    """0, 1, 2, ... over the whole table in the given order.

    The rows are sorted across partitions; each then needs only the row count of the partitions
    before its own. The sorted rows go through a checkpoint, so that counting and numbering see
    the same partitions even if an executor is lost in between. Select the columns you need first:
    they are all written once. End the order with a unique column, so that many equal keys
    still spread over partitions.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_place", _ROW_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    # One row per partition, so its size is bounded by the number of tasks.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1))
        .drop("_part", "_start", "_place")
    )


def batch_number(row_id: str, size: int) -> Column:
    """Number of the fixed-size batch a dense row id falls into."""
    return block_of(row_id, size)


def block_of(counter: str, width: int) -> Column:
    return F.expr(f"{counter} div {width}")


def block_starts(blocked: DataFrame, keys: list[str]) -> DataFrame:
    """Per group and _block the number of rows in earlier blocks, as _start."""
    counts = blocked.groupBy(*keys, "_block").agg(F.count("*").alias("_rows"))
    before = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.select(
        *keys, "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )


def index_in_group(
    df: DataFrame, keys: list[str], counter: str, name: str, width: int = 4096
) -> DataFrame:
    """0, 1, 2, ... within each group, by an integer counter column unique in the group.

    A group is cut into blocks of `width` counter values, so that a group with a third of all rows
    spreads over many tasks. A block's rows are numbered locally; its start is the row count of
    the earlier blocks, summed over the much smaller table of block counts.
    """
    blocked = df.withColumn("_block", block_of(counter, width))
    inside = Window.partitionBy(*keys, "_block").orderBy(counter)
    return (
        blocked.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(block_starts(blocked, keys), [*keys, "_block"])
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_block", "_start", "_inside")
    )
