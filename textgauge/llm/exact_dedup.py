"""Exact duplicates by a tree of merges over digest runs, in DataFrame functions only.

Every task writes the digests of its documents as one run. In each round up to FAN_IN runs, five binomial rounds
in one, exchange their rows by digest and become one run. Spark merges them as it does any sorted aggregate: each task
sorts the digests it holds and hands on one row for each, the other side sorts what it gets, and equal neighbours
become one row with the best document so far and the size of the group. (An exchange keeps no order, so runs are sorted again
on the other side; rounds of two runs would only add exchanges.) The last round knows every group; the
answer goes back down the same tree, run by run, so no key in any round or join stands for more rows
than one task has read or FAN_IN runs have handed up.

Texts are equal if they are identical without the characters [\\x20\\x09-\\x0D]. A digest is SHA-256,
verified by the length and a second hash of the text, all three compared at every level. The row with
most code points in its original text stays, then the smallest doc_id (null last), then the first in
reading order, so exactly one row of a group stays even if rows repeat. Null text counts as empty;
all empty texts are one group. An empty table gives an empty table. Other columns are ignored, but for
those named in `carry`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.llm.common import stored

FAN_IN = 32

_DIGEST = ["sha", "n_norm", "second"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def digest_runs(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One run per task: digest, place in the run and what decides who stays."""
    text = F.coalesce(F.col("text"), F.lit(""))
    norm = docs.select(
        F.col("doc_id").cast("long"), *carry, F.length(text).alias("n_chars"), normalised(F.col("text")).alias("norm")
    )
    rows = norm.select(
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row_no"),
        "doc_id",
        "n_chars",
        F.unhex(F.sha2("norm", 256)).alias("sha"),
        F.length("norm").alias("n_norm"),
        F.xxhash64("norm").alias("second"),
        *carry,
    )
    return stored(rows, "digest-runs")


def merge_level(rows: DataFrame, group: Column) -> DataFrame:
    """The runs of each group merged: one row per digest with its best row and its size."""
    return rows.groupBy(group.alias("group"), *_DIGEST).agg(F.min("best").alias("best"), F.sum("size").alias("size"))


def exact_dedup(docs: DataFrame, carry: tuple[str, ...] = (), fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and the carried columns, for every row."""
    runs = digest_runs(docs, carry)
    last = runs.agg(F.max("run")).first()[0] or 0
    best = F.struct(
        (-F.col("n_chars")).alias("fewer"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no"
    ).alias("best")
    first = runs.select("run", *_DIGEST, best, F.lit(1).cast("long").alias("size"))
    levels = [stored(merge_level(first, F.col("run")), "level-0")]
    while last > 0:
        last //= fan_in
        parent = F.floor(F.col("group") / fan_in).cast("int")
        levels.append(stored(merge_level(levels[-1], parent), f"level-{len(levels)}"))
    known = levels.pop().select("group", *_DIGEST, F.col("best").alias("keep"), F.col("size").alias("total"))
    while levels:
        above = known.withColumnRenamed("group", "parent")
        below = levels.pop().withColumn("parent", F.floor(F.col("group") / fan_in).cast("int"))
        known = below.join(above, ["parent", *_DIGEST]).select("group", *_DIGEST, "keep", "total")
    return runs.join(known.withColumnRenamed("group", "run"), ["run", *_DIGEST]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("total").alias("group_size"),
        (F.col("keep.row_no") == F.col("row_no")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        *carry,
    )
