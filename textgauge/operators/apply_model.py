"""A caller's model applied to a table in batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

Predict = Callable[[pd.DataFrame], "pd.Series | pd.DataFrame"]

_LOADED: dict[str, Predict] = {}  # models kept in a worker process between tasks


def _kept_model(name: str, load: Callable[[], Predict]) -> Predict:
    # At module level, so that a worker finds its own dictionary and not a pickled copy.
    if name not in _LOADED:
        _LOADED[name] = load()
    return _LOADED[name]


def apply_model(
    df: DataFrame,
    load: Callable[[], Predict],
    keys: list[str],
    inputs: list[str],
    output: str,
    batch_size: int = 10,
    name: str | None = None,
) -> DataFrame:
    """Keys plus the model's output for every row.

    `load` runs once per task, or once per Python worker if the model has a `name`, and returns the function to call on frames of at most `batch_size`
    rows with the input columns; that returns a series or frame in the same row order. `output` is
    the DDL of its columns. Keys never reach the model, they stay beside its output. Batches are cut
    from what arrives at once, so spark.sql.execution.arrow.maxRecordsPerBatch bounds them too.
    """
    made_fields = StructType.fromDDL(output)
    schema = StructType(df.select(*keys).schema.fields + made_fields.fields)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load() if name is None else _kept_model(name, load)
        for frame in frames:
            given = frame[inputs]
            made = []
            for at in range(0, len(frame), batch_size):
                batch = given.iloc[at : at + batch_size]
                answer = pd.DataFrame(predict(batch))
                if len(answer) != len(batch):
                    raise ValueError(f"the model returned {len(answer)} rows for {len(batch)}")
                answer.columns = made_fields.names
                made.append(answer)
            if made:
                yield pd.concat([frame[keys], pd.concat(made, ignore_index=True)], axis=1)

    return df.select(*keys, *[c for c in inputs if c not in keys]).mapInPandas(run, schema)
