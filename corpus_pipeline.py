"""A corpus pipeline: each stage reads what the one before kept, as Parquet, and applies one operator.

All stages but the last return the columns of documents. A stage tells rows apart by their place in
the files it reads, so rows with equal or null ids are judged one by one. Null texts count as empty. Further columns of
any name are kept, but for those that an operator gives back itself.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.llm import exact_dedup, language, packing, rules, simhash
from textgauge.llm.common import row_name, stored, with_row_id, without_rows

SEQUENCE_TOKENS = 2048


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near a centroid of a language stay; centroids are learned from those with a lang."""
    row = row_name(docs)
    rows = with_row_id(docs, row)
    model = language.learn(docs, held_out=F.lit(False))
    return without_rows(rows, language.identify(rows, model, carry=(row,)).filter("rejected"), row)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and are no outliers of their language and source stay."""
    row = row_name(docs)
    rows = with_row_id(docs, row)
    return without_rows(rows, rules.quality_rules(rows, carry=(row,)).filter("not kept"), row)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    row = row_name(docs)
    rows = with_row_id(docs, row)
    groups = exact_dedup.exact_dedup(rows, carry=(row,))
    return without_rows(rows, groups.filter("not kept"), row)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    row = row_name(docs)
    rows = with_row_id(docs, row)
    groups = simhash.simhash_groups(rows, shingle=3, radius=3, carry=(row,))
    return without_rows(rows, simhash.redundant(groups, row), row)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the kept documents with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE_TOKENS)


STAGES = [
    ("language_id", keep_known_languages),
    ("quality_rules", keep_good_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack_sequences),
]

# Learned stages, fingerprints and token ids have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on the documents of a folder, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
