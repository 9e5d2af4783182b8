"""Token ids in Parquet: list columns with dictionary and delta encoding, sorted, with page indexes.

A table of tokens has one row per document, in ascending doc_id order over its files:

* shard int: number of the file, in doc_id order
* doc_id long
* shard_start long: ids of the documents before it in the same shard
* n_tokens long
* tokens array<int>

doc_id and shard_start are delta encoded, tokens use a dictionary per row group with delta as the
fall-back. Small row groups and pages with column and offset indexes let a reader fetch the tokens
of a few documents, or the metadata of all, without the rest.

Null text counts as empty. A null doc_id sorts first. Rows with the same doc_id keep one row each,
ordered by the hash of their text. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textgauge.llm.encode import encoder

ROW_GROUP_BYTES, PAGE_BYTES = 16 << 20, 64 << 10

_SCHEMA = "shard int, doc_id long, shard_start long, n_tokens long, tokens array<int>"
_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("doc_id", pa.int64()),
        ("shard_start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("tokens", pa.list_(pa.int32())),
    ]
)


def with_tokens(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """The rows of a table of tokens; documents are sorted before they are encoded."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, ids, sizes in encoder(vocabulary).encode_slices(batch.column("text")):
                ends = np.cumsum(sizes)
                sizes = sizes + 1
                offsets = np.append(0, np.cumsum(sizes))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(sizes), shard, dtype=np.int32)),
                        batch.column("doc_id").slice(at, len(sizes)),
                        pa.array(start + offsets[:-1]),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(
                            pa.array(offsets.astype(np.int32)),
                            pa.array(np.insert(ids, ends, np.uint32(end_id)).view("<i4")),
                        ),
                    ],
                    schema=_ARROW,
                )
                start += int(offsets[-1])
        encoder(vocabulary).release()

    placed = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"))
    ordered = placed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return ordered.drop("tie").mapInArrow(encode, _SCHEMA)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0) -> None:
    """Encodes documents (doc_id, text) into token files at `path`."""
    with_tokens(docs, vocabulary, end_id).write.options(
        **{
            "compression": "zstd",
            "parquet.writer.version": "PARQUET_2_0",
            "parquet.block.size": str(ROW_GROUP_BYTES),
            "parquet.page.size": str(PAGE_BYTES),
            "parquet.enable.dictionary": "true",
            "parquet.enable.dictionary#doc_id": "false",
            "parquet.enable.dictionary#shard_start": "false",
        }
    ).parquet(path)


def read_tokens(docs_path: str, spark) -> DataFrame:
    """The token table at a path; select or filter columns to read only those."""
    return spark.read.schema(_SCHEMA).parquet(docs_path)


def shard_offsets(tokens: DataFrame) -> DataFrame:
    """shard, shard_offset: ids in the shards before it. Reads two metadata columns; one row per file."""
    totals = tokens.groupBy("shard").agg(F.max(F.col("shard_start") + F.col("n_tokens")).alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("shard_offset"))


def token_digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start over all documents, n_tokens and the crc32 of the ids, from a token table."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            offsets = lists.offsets.to_numpy().tolist()
            values = memoryview(lists.values.to_numpy().astype("<u4", copy=False)).cast("B")
            crc = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:])]
            columns = [batch.column(c) for c in ("shard", "doc_id", "shard_start", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(crc, pa.int64())],
                names=["shard", "doc_id", "shard_start", "n_tokens", "ids_crc32"],
            )

    digests = tokens.mapInArrow(
        digest, "shard int, doc_id long, shard_start long, n_tokens long, ids_crc32 long"
    )
    return digests.join(shard_offsets(tokens), "shard").select(
        "doc_id", (F.col("shard_offset") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32"
    )
