"""Batches of texts of like length under a token budget, for models that pad every batch to its longest text.

Lengths fall into classes that grow by a tenth, so at most a tenth of a batch is padding, but for rounding below ten
tokens. A batch holds rows of one class, as many as the budget takes at the class's longest. Rows are numbered inside
their class block by block, so a class with a third of all rows is spread over tasks, and nothing is sorted by length.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .apply_model import Predict, _kept_model
from .numbering import index_in_group

TOKENS = 16_384  # fixed value: tokens of a batch, padding included
LONGEST = 1 << 20  # texts of more tokens share the last class


def class_ends() -> list[int]:
    """The longest text of each class: 1, 2, ... 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 22, ..."""
    ends = [1]
    while ends[-1] < LONGEST:
        ends.append(max(ends[-1] + 1, ends[-1] * 11 // 10))
    return ends


def length_class(length: Column) -> Column:
    """The number of the class of a length; an empty text is as long as one token."""

    def among(ends: list[int], first: int) -> Column:
        """Bisection as nested cases: the number of the first end that is not under the length."""
        if len(ends) == 1:
            return F.lit(first).cast("long")
        half = len(ends) // 2
        return F.when(length <= ends[half - 1], among(ends[:half], first)).otherwise(among(ends[half:], first + half))

    return among(class_ends(), 0)


def padded_batches(df: DataFrame, key: str, length: str, tokens: int = TOKENS, width: int = 4096) -> DataFrame:
    """`df` with length_class, batch (its number in the class) and padded_to, the longest of its batch's class.

    `key` is an integer column, unique in `df`, by which batches are filled; `width` values of it are numbered together. A text
    over the budget is a batch of its own.
    """
    classes = df.withColumn("length_class", length_class(F.col(length)))
    ends = F.array(*map(F.lit, class_ends()))
    numbered = index_in_group(classes, ["length_class"], key, "_place", width)
    end = F.get(ends, F.col("length_class").cast("int"))
    rows = F.greatest(F.lit(1), F.floor(F.lit(tokens) / end)).cast("long")
    return numbered.withColumns({"batch": F.floor(F.col("_place") / rows), "padded_to": end.cast("long")}).drop("_place")


def padding_share(batched: DataFrame, length: str) -> DataFrame:
    """rows, batches and padding: the share of all tokens that are padding if each batch is padded to its longest text."""
    per_batch = batched.groupBy("length_class", "batch").agg(
        F.count("*").alias("n"), F.max(length).alias("longest"), F.sum(length).alias("used")
    )
    total = F.sum(F.col("n") * F.col("longest"))
    return per_batch.agg(
        F.sum("n").alias("rows"), F.count("*").alias("batches"), (1 - F.sum("used") / total).alias("padding")
    )


def apply_padded(
    batched: DataFrame, load: Callable[[], Predict], keys: list[str], inputs: list[str], output: str, name: str | None = None
) -> DataFrame:
    """Keys plus the model's output for every row; the model is called once for each batch of `padded_batches`.

    A group is one batch, bounded by the token budget. Keys never reach the model; join or sort by them for the old order.
    """
    made_fields = StructType.fromDDL(output)
    schema = StructType(batched.select(*keys).schema.fields + made_fields.fields)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        predict = load() if name is None else _kept_model(name, load)
        answer = pd.DataFrame(predict(frame[inputs].reset_index(drop=True)))
        if len(answer) != len(frame):
            raise ValueError(f"the model returned {len(answer)} rows for {len(frame)}")
        answer.columns = made_fields.names
        return pd.concat([frame[keys].reset_index(drop=True), answer.reset_index(drop=True)], axis=1)

    kept = [*keys, *[c for c in inputs if c not in keys]]
    return batched.select("length_class", "batch", *kept).groupBy("length_class", "batch").applyInPandas(run, schema)
