"""Writers: run tables, captions, chunk stores and filled templates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def write_run_items(items: DataFrame, path: str) -> None:
    """Items of any number of runs, a folder per model and dataset, one JSON object per line."""
    items.write.mode("errorifexists").partitionBy("model", "dataset").json(path)


def write_by_split(rows: DataFrame, path: str, split: str, *order: str) -> None:
    """A table with a folder per value of `split`, sorted inside its files, so that a reader opens only what it wants.

    Rows are dealt by split and order, so a split with a third of all rows becomes many files.
    """
    dealt = rows.repartitionByRange(split, *order).sortWithinPartitions(split, *order)
    dealt.write.mode("errorifexists").partitionBy(split).parquet(path)


def write_captions(captions: DataFrame, path: str) -> None:
    """Captions with the prompt that made them as a column instead of a header element."""
    captions.select("image_name", "generated_caption", "prompt").write.mode("errorifexists").json(path)


def write_caption_files(captions: DataFrame, path: str, prompt: str, per_file: int = 100) -> None:
    """Caption files in the original shape: a JSON array whose first element holds the prompt.

    `captions` needs row_id, dense from 0. Each file holds `per_file` captions and its own header, so
    no file or task grows with the table; a file is one row while it is made, so take fewer for long texts.
    """
    fields = "struct(string(null) as prompt, image_name, generated_caption)"
    header = F.struct(
        F.lit(prompt).alias("prompt"),
        F.lit(None).cast("string").alias("image_name"),
        F.lit(None).cast("string").alias("generated_caption"),
    )
    rows = captions.groupBy(F.expr(f"row_id div {per_file}").alias("file")).agg(
        F.array_sort(F.expr(f"collect_list(struct(row_id, {fields} as item))")).alias("rows")
    )
    documents = rows.select(
        F.to_json(F.concat(F.array(header), F.col("rows.item"))).alias("value")
    )
    documents.write.mode("errorifexists").option("maxRecordsPerFile", 1).text(path)


def write_run_documents(nested: DataFrame, path: str) -> None:
    """Run documents as `blocked_results` makes them, one JSON object per line."""
    nested.write.mode("errorifexists").json(path)


def write_run_document_files(items: DataFrame, summary: DataFrame, path: str, fields: list[str]) -> None:
    """Run documents in the original shape: one object per run, with its scores and all items in `results`.

    A document is one file, so one task writes it, line by line; `items` needs row_id, dense within its run.
    For large runs prefer `write_run_documents`.
    """
    run = ["model", "dataset"]
    scores = [c for c in summary.columns if c not in run]
    # The object of scores without its last brace, then the items, then the end.
    opening = F.concat(F.regexp_replace(F.to_json(F.struct(*scores)), r"\}$", ""), F.lit(', "results": ['))
    lines = summary.select(*run, F.lit(0).alias("part"), F.lit(0).cast("long").alias("row_id"), opening.alias("value"))
    item = F.concat(F.when(F.col("row_id") == 0, "").otherwise(","), F.to_json(F.struct(*fields)))
    lines = lines.unionByName(items.select(*run, F.lit(1).alias("part"), "row_id", item.alias("value")))
    lines = lines.unionByName(summary.select(*run, F.lit(2).alias("part"), F.lit(0).cast("long").alias("row_id"), F.lit("]}").alias("value")))
    ordered = lines.repartition(*run).sortWithinPartitions(*run, "part", "row_id")
    ordered.select(*run, "value").write.mode("errorifexists").partitionBy(*run).text(path)


def append_summary(summary: DataFrame, path: str, version: int) -> None:
    """A new version of run summaries; earlier versions stay, so nothing is read and replaced at once."""
    summary.write.mode("errorifexists").parquet(f"{path}/version={version}")


def read_summaries(spark: SparkSession, path: str, runs: list[str]) -> DataFrame:
    """The newest stored summary of each run."""
    stored = spark.read.parquet(path)
    values = [c for c in stored.columns if c not in runs]
    newest = F.max_by(F.struct(*values), "version").alias("s")
    return stored.groupBy(*runs).agg(newest).select(*runs, "s.*")


def with_chunk_id(chunks: DataFrame, text: str = "chunk_text") -> DataFrame:
    """One row per distinct chunk text, keyed by its hash, so storing twice adds nothing.

    Distinct on the text itself is a hash aggregate that drops copies before the shuffle; by the
    hash it would have to sort whole texts.
    """
    distinct = chunks.select(F.col(text).alias("chunk_text")).distinct()
    return distinct.select(F.sha2("chunk_text", 256).alias("chunk_id"), "chunk_text")


def add_to_chunk_store(store: DataFrame, path: str) -> None:
    """Adds the chunks that the store at `path` does not have yet; what it has stays as it is."""
    try:
        known = store.sparkSession.read.parquet(path).select("chunk_id")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = None  # no store yet
    new = store if known is None else store.join(known, "chunk_id", "left_anti")
    new.write.mode("append").option("compression", "zstd").parquet(path)


def fill_template(template: DataFrame, answers: DataFrame) -> DataFrame:
    """The template with answers put in; its own value stays where there is none."""
    given = answers.select("ID", F.col("Answer").alias("_given"))
    return template.join(given, "ID", "left").select(
        "ID", F.coalesce("_given", "Answer").alias("Answer")
    )


def write_template(filled: DataFrame, path: str) -> None:
    filled.write.mode("errorifexists").csv(path, header=True)
