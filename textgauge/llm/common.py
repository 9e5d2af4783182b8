"""What the operators share: stored tables, row ids and text out of Arrow columns."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from textgauge.session import scratch_path

ROW = "__row"

# Bytes of text that a task turns into Python objects at once.
SLICE_BYTES = 4 << 20


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """`df` written to a new folder of the shared directory and read back, which cuts its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_name(df: DataFrame) -> str:
    """A name for row ids that no column of `df` has."""
    name = ROW
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def with_row_id(df: DataFrame, name: str = ROW) -> DataFrame:
    """`df` with a column naming the file and the place each row is read from.

    The id is the same whenever the row is read again. A frame that is no plain file scan is
    stored first.
    """
    try:
        place = df.metadataColumn("_metadata")
        return df.select("*", F.struct(place["file_path"], place["row_index"]).alias(name))
    except AnalysisException:
        return with_row_id(stored(df, "rows"), name)


def without_rows(df: DataFrame, gone: DataFrame, name: str = ROW) -> DataFrame:
    """The rows of `df` (with row ids) whose id is not in `gone`, ids removed."""
    return df.join(gone.select(name), name, "left_anti").drop(name)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[list[str]]:
    """The texts of a column in order, null as empty, up to `most` bytes at a time, or one text."""
    texts = texts.cast(pa.large_string())
    at = 0
    sizes = pa.compute.binary_length(texts).fill_null(0).to_pylist()
    while at < len(sizes):
        end, taken = at, 0
        while end < len(sizes) and (end == at or taken + sizes[end] <= most):
            taken += sizes[end]
            end += 1
        yield [t or "" for t in texts.slice(at, end - at).to_pylist()]
        at = end


def give_back() -> None:
    """Hand memory that is free inside this process back to the system, as a worker outlives its tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # no glibc
        pass
