"""Readers: caption files, run documents, file lists, pages and templates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import page_text
from . import json_arrays

CAPTION_FIELDS = "image_name STRING, generated_caption STRING, prompt STRING"
SUMMARY_FIELDS = "corpus_bleu DOUBLE, average_rouge1 DOUBLE, average_rouge2 DOUBLE, average_meteor DOUBLE"
ITEM_FIELDS = (
    "image_id BIGINT, generated_caption STRING, reference_captions ARRAY<STRING>, "
    "rouge1 DOUBLE, rouge2 DOUBLE, meteor DOUBLE"
)


def _elements(spark: SparkSession, path: str, fields: str, member: str | None = None) -> DataFrame:
    """file and the fields of every element of the files' arrays; a large file is read by many tasks."""
    rows = json_arrays.elements(spark, path, member)
    return rows.select("file", F.from_json("element", fields).alias("r")).select("file", "r.*")


def drop_header(rows: DataFrame) -> DataFrame:
    """The header is the row with a prompt, wherever it stands."""
    return rows.filter(F.col("prompt").isNull()).drop("prompt")


def header_of(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("prompt").isNotNull()).select("file", "prompt")


def attach_header(rows: DataFrame) -> DataFrame:
    """Each caption row with the prompt of its file; joined, so any number of files will do."""
    return drop_header(rows).join(header_of(rows), "file", "left")


def read_caption_files(spark: SparkSession, path: str) -> DataFrame:
    """Caption files (JSON arrays with a header element) as (file, image_name, caption, prompt)."""
    return attach_header(_elements(spark, path, CAPTION_FIELDS))


def read_caption_rows(spark: SparkSession, path: str) -> DataFrame:
    """Captions written by `write_captions`, one JSON object per line."""
    return spark.read.schema(CAPTION_FIELDS).json(path)


def unnest_items(documents: DataFrame) -> DataFrame:
    """One row per element of `results`, its fields as columns beside those of the document."""
    kept = [c for c in documents.columns if c != "results"]
    return documents.select(*kept, F.explode("results").alias("r")).select(*kept, "r.*")


def read_run_items(spark: SparkSession, path: str) -> DataFrame:
    """The items of stored run documents, one row each; a document may be one file of any size."""
    return _elements(spark, path, ITEM_FIELDS, "results")


def read_run_summaries(spark: SparkSession, path: str) -> DataFrame:
    """The scores of stored run documents, without a look at their items."""
    documents = json_arrays.outer_documents(spark, path, "results")
    return documents.select("file", F.from_json("document", SUMMARY_FIELDS).alias("r")).select("file", "r.*")


def list_files(spark: SparkSession, folder: str, pattern: str = "*.jpg") -> DataFrame:
    """Paths of the files in a folder that match, in path order; no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path")
        .orderBy("path")
    )


def read_template(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("ID INT, Answer INT").csv(path, header=True)


def pages_as_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of an HTML page table."""
    return pages.select("page_id", "url", page_text(F.col("html")).alias("text"))
