"""Every operator as a query over the given tables, by operator id."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import replace

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import prompts as pr
from ..functions import text as tx
from ..functions import vectors as ve
from ..functions.multiset import align_last
from ..functions.stem import porter, rouge_stems
from ..operators import bootstrap, chunks, indexed, nearest, numbering, padded, pairing, runs, scores
from ..operators.apply_model import apply_model
from ..operators.contexts import grounded, ungrounded
from ..session import scratch_path, spread
from ..sources import captions, sinks, synsets
from ..sources.turns import TURNS, hypotheses_of, references_of, stand_in_runs, unmatched_turns
from . import captioning, evaluation, retrieval, statistics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN = runs.RUN
ALL_METRICS = ["bleu", *evaluation.METRICS]
# Item ids hold a conversation and a turn, so blocks of them are this wide.
ITEM_BLOCK = 4096 * TURNS
MODELS = ("model_0", "model_1")
DATASETS = ["even", "odd"]
# The definitions without stems: built-in expressions only, and the form SQL can check.
PLAIN_FIRST = replace(evaluation.FIRST_RUN, stem_rouge=False, stem_meteor=False)
PLAIN_AGAIN = replace(evaluation.RECOMPUTED, stem_meteor=False)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """For work that is heavy per row: a table of few splits, such as one small file, on all cores."""
    return spread(table(spark, sf_dir, name))


def r6(column: str | Column) -> Column:
    """Six decimals. Rounding to twelve first lifts values that sit on a half but for float noise."""
    return F.round(F.round(column, 12), 6)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


# -- evaluation sets --------------------------------------------------------------------------


def eval_pairs(spark: SparkSession, sf_dir: str, slots: bool = False) -> DataFrame:
    """Every assistant turn against all user turns of its conversation."""
    turns = table(spark, sf_dir, "conversations")
    return pairing.pair_references(hypotheses_of(turns), references_of(turns), slots, group="conv_id")


def run_pairs(spark: SparkSession, sf_dir: str, slots: bool = False) -> DataFrame:
    """The same for two stand-in models on two stand-in datasets."""
    turns = table(spark, sf_dir, "conversations")
    made = stand_in_runs(turns).drop("pair_no")
    return pairing.pair_references(made, references_of(turns), slots, group="conv_id")


def with_words(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns(
        {
            "hyp_tokens": tx.whitespace_tokens(F.lower("hypothesis")),
            "ref_tokens": tx.whitespace_tokens(F.lower("reference")),
        }
    )


def with_alnum(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns(
        {
            "hyp_tokens": tx.alnum_tokens(F.col("hypothesis")),
            "ref_tokens": tx.alnum_tokens(F.col("reference")),
        }
    )


def run_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per run and item the means over its references, first-run definition."""
    return evaluation.item_scores(run_pairs(spark, sf_dir), PLAIN_FIRST, RUN)


def run_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, dataset, metric, value) of the four runs."""
    summary = evaluation.run_summary(run_pairs(spark, sf_dir), PLAIN_FIRST, RUN)
    return runs.long_scores(summary.drop("metric_def"), ALL_METRICS)


# -- sources and sinks ------------------------------------------------------------------------


@query
def s1_captioned_dataset(spark, sf_dir):
    slots = pairing.number_slots(references_of(table(spark, sf_dir, "conversations")))
    return pairing.blocked_references(slots).select(
        "item_id",
        "block",
        F.size("reference_captions").cast("bigint").alias("n_references"),
        F.array_join("reference_captions", " || ").alias("reference_captions"),
    )


@query
def s2_caption_files(spark, sf_dir):
    """Files with a header element, written from the documents and read back (also F1 and J4)."""
    path = scratch_path(spark, "caption-files")
    made = numbering.dense_index(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    sinks.write_caption_files(
        made.select(
            "row_id",
            pr.numbered_name(F.col("doc_id")).alias("image_name"),
            F.col("text").alias("generated_caption"),
        ),
        path,
        "<|user|><|image_1|>Caption the image in one sentence.<|end|><|assistant|>",
    )
    return captions.read_caption_files(spark, path).drop("file")


@query
def s3_run_documents(spark, sf_dir):
    """Nested run documents, written and unnested again (also P13)."""
    path = scratch_path(spark, "run-documents")
    numbered = numbering.index_in_group(run_items(spark, sf_dir), RUN, "item_id", "row_id", ITEM_BLOCK)
    nested = runs.blocked_results(numbered, 100, ["item_id", *evaluation.METRICS])
    sinks.write_run_documents(nested, path)
    items = captions.unnest_items(spark.read.schema(nested.schema).json(path))
    return rounded(items.select(*RUN, "item_id", *evaluation.METRICS), *evaluation.METRICS)


@query
def s3_nested_documents(spark, sf_dir):
    """One nested document and file per run, its texts included, written and read by splits."""
    path = scratch_path(spark, "nested-documents")
    pairs = run_pairs(spark, sf_dir)
    texts = pairs.select(*RUN, "item_id", "hypothesis").distinct()
    scored = evaluation.item_scores(pairs, PLAIN_FIRST, RUN).join(texts, [*RUN, "item_id"])
    numbered = numbering.index_in_group(scored, RUN, "item_id", "row_id", ITEM_BLOCK).select(
        *RUN, "row_id", F.col("item_id").alias("image_id"), F.col("hypothesis").alias("generated_caption"), *evaluation.METRICS
    )
    summary = evaluation.corpus_bleu(pairs, PLAIN_FIRST, RUN).withColumnRenamed("bleu", "corpus_bleu")
    sinks.write_run_document_files(numbered, summary, path, ["image_id", "generated_caption", *evaluation.METRICS])
    items = captions.read_run_items(spark, path)
    # One row per document.
    read = items.join(F.broadcast(captions.read_run_summaries(spark, path).select("file", "corpus_bleu")), "file")
    named = [F.regexp_extract("file", f"{name}=([^/]*)", 1).alias(name) for name in RUN]
    shown = read.select(*named, "image_id", "generated_caption", "corpus_bleu", *evaluation.METRICS)
    return rounded(shown, "corpus_bleu", *evaluation.METRICS)


@query
def s4_sorted_files(spark, sf_dir):
    files = table(spark, sf_dir, "pages").select("page_id", pr.url_path(F.col("url")).alias("path"))
    return numbering.dense_index(files.filter(F.col("path").endswith(".html")), "path", "page_id")


@query
def s5_page_text(spark, sf_dir):
    return captions.pages_as_text(spread_table(spark, sf_dir, "pages"))


@query
def k1_run_items(spark, sf_dir):
    path = scratch_path(spark, "run-items")
    items = run_items(spark, sf_dir)
    sinks.write_run_items(items, path)
    return rounded(spark.read.schema(items.schema).json(path), *evaluation.METRICS)


@query
def k1_run_summary(spark, sf_dir):
    """The summary table beside the items, written and read back."""
    path = scratch_path(spark, "run-summary")
    sinks.append_summary(evaluation.run_summary(run_pairs(spark, sf_dir), PLAIN_FIRST, RUN), path, 1)
    return rounded(sinks.read_summaries(spark, path, RUN).select(*RUN, *ALL_METRICS), *ALL_METRICS)


@query
def k3_recomputed_from_store(spark, sf_dir):
    """Runs stored with captions and references and a first summary; read, scored again, stored as version 2."""
    items, summaries = scratch_path(spark, "full-items"), scratch_path(spark, "full-summaries")
    pairs = run_pairs(spark, sf_dir, slots=True)
    full = evaluation.stored_items(pairs, RUN)
    sinks.write_run_items(full, items)
    sinks.append_summary(evaluation.run_summary(pairs, PLAIN_FIRST, RUN), summaries, 1)
    again = evaluation.pairs_of_stored(spark.read.schema(full.schema).json(items))
    sinks.append_summary(evaluation.run_summary(again, PLAIN_AGAIN, RUN), summaries, 2)
    newest = sinks.read_summaries(spark, summaries, RUN)
    return rounded(newest, *ALL_METRICS).select(
        *RUN, *ALL_METRICS, "metric_def", F.col("version").cast("bigint").alias("version")
    )


@query
def k3_merged_statistics(spark, sf_dir):
    """Summaries out of stored statistics after items were added and replaced; only their blocks are scored again."""
    turns = table(spark, sf_dir, "conversations")
    made, refs, width = stand_in_runs(turns).drop("pair_no"), references_of(turns), 16 * TURNS
    # At first, of the first 500 conversations one in seven is not there yet, and one in eleven has other answers.
    other = F.when(F.expr("conv_id < 500 and conv_id % 11 = 1"), F.upper("hypothesis")).otherwise(F.col("hypothesis"))
    early = made.filter("conv_id >= 500 or conv_id % 7 > 0").withColumn("hypothesis", other)
    changed = statistics.changed_blocks(made.filter("conv_id < 500 and (conv_id % 7 = 0 or conv_id % 11 = 1)"), width)
    late = statistics.with_block(made, width).join(changed, "item_block", "left_semi").drop("item_block")
    found = []
    for how in (PLAIN_FIRST, PLAIN_AGAIN):
        path = scratch_path(spark, "statistics")
        for version, (rows, blocks) in enumerate(((early, None), (late, changed)), 1):
            pairs = pairing.pair_references(rows, refs, how.by_slot, group="conv_id")
            statistics.write_statistics(pairs, how, RUN, path, version, blocks, width)
        found.append(statistics.summary_of_statistics(spark, path, how, RUN))
    return rounded(found[0].unionByName(found[1]), *ALL_METRICS)


@query
def k2_captions_with_prompt(spark, sf_dir):
    path = scratch_path(spark, "captions")
    made = table(spark, sf_dir, "benchmark").select(
        pr.numbered_name(F.col("item_id")).alias("image_name"),
        F.col("text").alias("generated_caption"),
        pr.chat_prompt(F.lit(pr.CAPTION_INSTRUCTION)).alias("prompt"),
    )
    sinks.write_captions(made, path)
    return captions.read_caption_rows(spark, path)


@query
def k3_newest_summary(spark, sf_dir):
    path = scratch_path(spark, "summaries")
    pairs = run_pairs(spark, sf_dir, slots=True)
    for version, how in enumerate((PLAIN_FIRST, PLAIN_AGAIN), 1):
        summary = evaluation.run_summary(pairs, how, RUN)
        sinks.append_summary(summary, path, version)
    newest = sinks.read_summaries(spark, path, RUN)
    return rounded(newest, "bleu", *evaluation.METRICS).select(
        *RUN, "bleu", *evaluation.METRICS, "metric_def", F.col("version").cast("bigint").alias("version")
    )


@query
def k4_chunk_store(spark, sf_dir):
    """A store filled in two goes; the second adds what the first did not have."""
    path = scratch_path(spark, "chunks")
    documents = spread_table(spark, sf_dir, "documents")
    for batch in (documents.filter("doc_id % 2 = 0"), documents):
        sinks.add_to_chunk_store(retrieval.chunk_store(batch), path)
    stored = spark.read.parquet(path)
    return stored.select(
        "chunk_id",
        F.length("chunk_text").cast("bigint").alias("n_chars"),
        r6(ve.norm(F.col("embedding"))).alias("length"),
    )


@query
def k5_filled_template(spark, sf_dir):
    path = scratch_path(spark, "template")
    template = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("int").alias("ID"), F.lit(10).alias("Answer")
    )
    answers = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("int").alias("ID"), F.col("quality").alias("Answer")
    )
    sinks.write_template(sinks.fill_template(template, answers), path)
    return captions.read_template(spark, path)


# -- projections ------------------------------------------------------------------------------


@query
def p1_row_id(spark, sf_dir):
    return numbering.dense_index(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query
def p2_normalised(spark, sf_dir):
    return spread_table(spark, sf_dir, "documents").select("doc_id", tx.normalise(F.col("text")).alias("text"))


def _token_row(tokens: Column) -> list[Column]:
    return [
        F.size(tokens).cast("bigint").alias("n_tokens"),
        F.array_join(tokens, "|").alias("tokens"),
    ]


@query
def p3_whitespace_tokens(spark, sf_dir):
    tokens = tx.whitespace_tokens(F.col("text"))
    return spread_table(spark, sf_dir, "documents").select("doc_id", *_token_row(tokens))


@query
def p4_rouge_tokens(spark, sf_dir):
    tokens = tx.alnum_tokens(F.col("text"))
    return spread_table(spark, sf_dir, "documents").select("doc_id", *_token_row(tokens))


@query
def p4_rouge_stems(spark, sf_dir):
    stems = rouge_stems(tx.alnum_tokens(F.col("text")))
    return spread_table(spark, sf_dir, "documents").select("doc_id", stems.alias("stems")).select(
        "doc_id", *_token_row(F.col("stems"))
    )


@query
def p5_chat_prompt(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", "role", pr.chat_prompt(F.col("text")).alias("prompt"))


@query
def p6_style_prompt(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(
        "item_id", pr.style_prompt(F.col("text")).alias("prompt")
    )


@query
def p7_base_name(spark, sf_dir):
    name = pr.base_name(pr.url_path(F.col("url")))
    return table(spark, sf_dir, "pages").select("page_id", name.alias("name"))


@query
def p8_output_name(spark, sf_dir):
    path = pr.url_path(F.col("url"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        pr.output_name(F.lit("results/styled"), path, "_styled.png").alias("styled"),
        pr.output_name(F.lit("results/drawn"), path, "_diff3.jpg", hidden=True).alias("drawn"),
    )


@query
def p9_grounded_prompt(spark, sf_dir):
    asked, store = _questions(spark, sf_dir), _written_store(spark, sf_dir)
    return grounded(asked, retrieval.contexts(asked, store), "item_id", "text")


@query
def p10_ungrounded_prompt(spark, sf_dir):
    return ungrounded(_questions(spark, sf_dir), "item_id", "text")


@query
def p11_completion_text(spark, sf_dir):
    """Completions that echo the prompt and hold a second answer tag."""
    turns = table(spark, sf_dir, "conversations")
    prompt = pr.chat_prompt(F.lit(pr.CAPTION_INSTRUCTION))
    raw = F.concat(prompt, F.col("text"), F.lit(pr.ASSISTANT_TAG), F.col("text"), F.lit(pr.END_TAG))
    return turns.select("conv_id", "turn", tx.completion_text(raw, prompt).alias("completion"))


@query
def p12_four_decimals(spark, sf_dir):
    items = run_items(spark, sf_dir)
    return items.select(
        *RUN, "item_id", *[tx.four_decimals(m).alias(m) for m in evaluation.METRICS]
    )


# -- filters ----------------------------------------------------------------------------------


@query
def f2_by_extension(spark, sf_dir):
    files = table(spark, sf_dir, "pages").select("page_id", pr.url_path(F.col("url")).alias("path"))
    return files.filter(F.col("path").endswith(".html"))


@query
def f3_split(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter("lang = 'en'").select("doc_id", "lang", "n_chars")


def _split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, with their language as the split, laid out by split."""
    path = scratch_path(spark, "splits")
    sinks.write_by_split(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), path, "lang", "doc_id")
    return spark.read.parquet(path)


@query
def f3_pruned_split(spark, sf_dir):
    """One split of a table laid out by split: no file of another one is opened."""
    return _split_table(spark, sf_dir).filter("lang = 'en'").select("doc_id", "lang", "n_chars")


@query
def f3_pruned_by_table(spark, sf_dir):
    """The splits that a table names, here languages with a document of over 20,000 characters; pruned at run time."""
    splits = _split_table(spark, sf_dir)
    path = scratch_path(spark, "wanted-splits")
    sizes = table(spark, sf_dir, "documents").groupBy("lang").agg(F.max("n_chars").alias("longest"))
    sizes.write.parquet(path)
    # One row per split.
    wanted = spark.read.parquet(path).filter("longest > 20000").select("lang")
    return splits.join(F.broadcast(wanted), "lang").select("doc_id", "lang", "n_chars")


@query
def f4_no_empty_tokens(spark, sf_dir):
    pieces = F.split(F.col("text"), f"[{tx.WHITESPACE_CLASS}]")
    kept = F.size(F.filter(pieces, lambda w: w != "")).cast("bigint")
    return spread_table(spark, sf_dir, "documents").select(
        "doc_id", kept.alias("kept"), (F.size(pieces) - kept).alias("dropped")
    )


# -- joins ------------------------------------------------------------------------------------


@query
def j1_image_prompts(spark, sf_dir):
    images = table(spark, sf_dir, "pages").select(
        pr.numbered_name(F.col("page_id")).alias("image_name"), "url"
    )
    described = table(spark, sf_dir, "documents").select(
        pr.numbered_name(F.col("doc_id")).alias("image_name"),
        pr.style_prompt(F.col("text")).alias("prompt"),
    )
    return pairing.pair_by_key(images, described, "image_name")


@query
def j1_by_position(spark, sf_dir):
    images = numbering.dense_index(table(spark, sf_dir, "pages").select("url", "page_id"), "url", "page_id")
    described = numbering.dense_index(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return pairing.pair_by_key(images, described, "row_id").select(
        "row_id", "url", pr.style_prompt(F.col("text")).alias("prompt")
    )


@query
def j2_pairs(spark, sf_dir):
    return eval_pairs(spark, sf_dir).select("item_id", "ref_no", "hypothesis", "reference")


@query
def j2_unmatched(spark, sf_dir):
    """The turns that no pair shows, of either role."""
    return unmatched_turns(table(spark, sf_dir, "conversations"))


def _stand_in_captioner():
    """Takes the place of a caption model: a mark before the whole text, and the number of words."""

    def predict(batch: pd.DataFrame) -> pd.DataFrame:
        words = batch["text"].str.findall(r"[A-Za-z0-9]+").str.len()
        return pd.DataFrame({"caption": "caption: " + batch["text"], "words": words})

    return predict


@query
def j3_model_with_key(spark, sf_dir):
    return apply_model(
        spread_table(spark, sf_dir, "documents"),
        _stand_in_captioner,
        keys=["doc_id"],
        inputs=["text"],
        output="caption STRING, words BIGINT",
    )


@query
def j5_reference_slots(spark, sf_dir):
    size = 1000
    slots = pairing.number_slots(references_of(table(spark, sf_dir, "conversations")))
    arrays = pairing.blocked_references(slots, size)
    return pairing.explode_references(arrays).select(
        "item_id", (F.col("block") * size + F.col("slot")).alias("slot"), "reference"
    )


@query
def j6_nearest_chunks(spark, sf_dir):
    found = retrieval.retrieve(_questions(spark, sf_dir), _store(spark, sf_dir))
    return rounded(found, "distance")


@query
def j7_clipped_counts(spark, sf_dir):
    items = scores.bleu_items(with_words(eval_pairs(spark, sf_dir)), [])
    return items.filter("n > 0").groupBy("item_id", F.col("n").cast("bigint").alias("n")).agg(
        F.count("*").alias("grams"), F.sum("clipped").alias("clipped")
    )


@query
def j8_word_alignment(spark, sf_dir):
    pairs = with_words(eval_pairs(spark, sf_dir))
    links = F.expr(align_last("hyp_tokens", "ref_tokens"))
    return pairs.select("item_id", "ref_no", F.explode(links).alias("link")).select(
        "item_id",
        "ref_no",
        F.col("link.l").cast("bigint").alias("hyp_at"),
        F.col("link.r").cast("bigint").alias("ref_at"),
    )


@query
def j9_richer_but_lower(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    items = run_items(spark, sf_dir).join(stand_in_runs(turns), [*RUN, "item_id"])
    metrics = ["rouge2", "meteor"]
    compared = runs.compare_models(items, *MODELS, metrics, ["dataset", "conv_id", "pair_no"])
    found = runs.richer_but_lower(compared, metrics)
    return rounded(
        found.drop("hypothesis_a", "hypothesis_b"), "rouge2_a", "meteor_a", "rouge2_b", "meteor_b"
    )


@query
def j10_coverage(spark, sf_dir):
    return pairing.coverage(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query
def j10_missing_keys(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return pairing.missing_keys(documents.select("doc_id", "lang"), labels, "doc_id")


# -- aggregations -----------------------------------------------------------------------------


@query
def a1_corpus_bleu_first_run(spark, sf_dir):
    bleu = evaluation.corpus_bleu(run_pairs(spark, sf_dir), PLAIN_FIRST, RUN)
    return rounded(bleu, "bleu")


@query
def a2_corpus_bleu_recomputed(spark, sf_dir):
    bleu = evaluation.corpus_bleu(run_pairs(spark, sf_dir), PLAIN_AGAIN, RUN)
    return rounded(bleu, "bleu")


@query
def a2_bleu_13a(spark, sf_dir):
    """The recomputed BLEU with 13a tokens on texts that keep their punctuation."""
    how = replace(PLAIN_AGAIN, normalised=False)
    return rounded(evaluation.corpus_bleu(run_pairs(spark, sf_dir), how, RUN), "bleu")


@query
def a2_tokens_13a(spark, sf_dir):
    """13a tokens of whole documents."""
    return spread_table(spark, sf_dir, "documents").select("doc_id", *_token_row(tx.tokens_13a(F.col("text"))))


@query
def a1_a2_bleu_counts(spark, sf_dir):
    return scores.bleu_counts(with_words(eval_pairs(spark, sf_dir)), [])


@query
def a3_rouge_pairs(spark, sf_dir):
    pairs = scores.rouge(with_alnum(eval_pairs(spark, sf_dir)))
    return rounded(pairs.select("item_id", "ref_no", "rouge1", "rouge2"), "rouge1", "rouge2")


@query
def a3_rouge_stemmed(spark, sf_dir):
    pairs = eval_pairs(spark, sf_dir).withColumns(
        {
            "hyp_tokens": rouge_stems(tx.alnum_tokens(F.col("hypothesis"))),
            "ref_tokens": rouge_stems(tx.alnum_tokens(F.col("reference"))),
        }
    )
    return rounded(
        scores.rouge(pairs).select("item_id", "ref_no", "rouge1", "rouge2"), "rouge1", "rouge2"
    )


@query
def a3_bootstrap_intervals(spark, sf_dir):
    """Median and interval of the mean scores of each run, over draws of its items."""
    found = bootstrap.bootstrap_means(
        run_items(spark, sf_dir), RUN, F.col("item_id").cast("string"), evaluation.METRICS
    )
    return rounded(found, "low", "mid", "high")


@query
def a4_item_means(spark, sf_dir):
    return rounded(run_items(spark, sf_dir), *evaluation.METRICS)


@query
def a5_meteor_exact(spark, sf_dir):
    pairs = scores.meteor(with_words(eval_pairs(spark, sf_dir)), stems=False)
    return rounded(pairs.select("item_id", "ref_no", "meteor"), "meteor")


@query
def a5_meteor_stemmed(spark, sf_dir):
    pairs = scores.meteor(with_words(eval_pairs(spark, sf_dir)))
    return rounded(pairs.select("item_id", "ref_no", "meteor_matches", "meteor"), "meteor")


# Words that may stand for each other, a small table for the third stage of METEOR.
SYNONYMS = [("the", "a", "an"), ("of", "in", "on", "at"), ("is", "are", "was", "be"), ("that", "this", "it"), ("and", "or")]


@query
def a5_meteor_synonyms(spark, sf_dir):
    """All three stages; synonyms are looked up by stem, and words of a class stand for each other."""
    pairs = [(porter(a), porter(b)) for group in SYNONYMS for a in group for b in group if a != b]
    synonyms = spark.createDataFrame(pairs, "word string, synonym string")
    keys = ["item_id", "ref_no"]
    scored = scores.meteor(with_words(eval_pairs(spark, sf_dir)), synonyms=synonyms, keys=keys)
    return rounded(scored.select(*keys, "meteor_matches", "meteor_chunks", "meteor"), "meteor")


def _letter_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synonym sets for lack of a real table: words of the conversations with the same letters, as a data file and read again."""
    words = table(spark, sf_dir, "conversations").select(F.explode(tx.whitespace_tokens(F.lower("text"))).alias("word"))
    words = words.distinct().filter(F.col("word").rlike("^[a-z]+$"))
    letters = F.array_join(F.array_sort(F.array_distinct(F.split("word", ""))), "")
    offset = F.conv(F.substring(F.md5(letters.cast("binary")), 1, 8), 16, 10)
    path = scratch_path(spark, "synsets")
    words.select(F.concat_ws(" ", offset, F.lit("00 n 01"), "word", F.lit("0 000 | by letters")).alias("value")).write.text(path)
    return synsets.read_synsets(spark, path)


@query
def a5_meteor_senses(spark, sf_dir):
    """All three stages, with synonym sets out of a data file."""
    keys = ["item_id", "ref_no"]
    turns = table(spark, sf_dir, "conversations")
    # Each text is cut into words before it meets others, and pairs, handed to Python whole, go without it.
    hyps, refs = (
        side.withColumn(words, tx.whitespace_tokens(F.lower(text)))
        for side, words, text in (
            (hypotheses_of(turns), "hyp_tokens", "hypothesis"), (references_of(turns), "ref_tokens", "reference")
        )
    )
    pairs = pairing.pair_references(hyps, refs, group="conv_id").select(*keys, "hyp_tokens", "ref_tokens")
    scored = scores.meteor(pairs, keys=keys, senses=_letter_sets(spark, sf_dir))
    return rounded(scored.select(*keys, "meteor_matches", "meteor_chunks", "meteor"), "meteor")


@query
def a6_macro_means(spark, sf_dir):
    means = scores.run_means(run_items(spark, sf_dir), RUN, evaluation.METRICS)
    return rounded(means, *evaluation.METRICS)


@query
def a7_slot_means(spark, sf_dir):
    scored = evaluation.score_pairs(run_pairs(spark, sf_dir, slots=True), PLAIN_AGAIN)
    return rounded(scores.slot_means(scored, RUN, evaluation.METRICS), *evaluation.METRICS)


@query
def a7_bootstrap_slots(spark, sf_dir):
    """Slot means with the medians of a bootstrap for ROUGE, as the recomputation defines them."""
    made = evaluation.score_pairs(run_pairs(spark, sf_dir, slots=True), PLAIN_AGAIN)
    # Draws and plain means each read the scores, so they are written once in place of worked out twice.
    path = scratch_path(spark, "pair-scores")
    made.write.parquet(path)
    scored = spread(spark.read.schema(made.schema).parquet(path))
    found = bootstrap.bootstrap_slot_means(scored, RUN, ["rouge1", "rouge2"], ["meteor"], replicates=200)
    return rounded(found, *evaluation.METRICS)


@query
def a7_short_items(spark, sf_dir):
    return scores.short_items(run_pairs(spark, sf_dir), RUN)


@query
def a8_cross_tab(spark, sf_dir):
    wide = runs.cross_tab(run_scores(spark, sf_dir), DATASETS, ALL_METRICS)
    return rounded(wide, *[c for c in wide.columns if c != "model"])


@query
def a9_best_models(spark, sf_dir):
    return rounded(runs.best_models(run_scores(spark, sf_dir)), "best_value", "margin")


@query
def a9_margin_intervals(spark, sf_dir):
    """How far one model leads the other on the same items, with an interval from paired draws."""
    items = run_items(spark, sf_dir).join(stand_in_runs(table(spark, sf_dir, "conversations")), [*RUN, "item_id"])
    compared = runs.compare_models(items, *MODELS, evaluation.METRICS, ["dataset", "conv_id", "pair_no"])
    unit = F.concat_ws("-", "conv_id", "pair_no")
    return rounded(bootstrap.margins(compared, ["dataset"], unit, evaluation.METRICS), "low", "mid", "high")


@query
def a10_dataset_means(spark, sf_dir):
    return rounded(runs.dataset_means(run_scores(spark, sf_dir)), "mean_value")


@query
def a11_item_batches(spark, sf_dir):
    items = rounded(run_items(spark, sf_dir), *evaluation.METRICS)
    numbered = numbering.index_in_group(items, RUN, "item_id", "row_id", ITEM_BLOCK)
    nested = runs.blocked_results(numbered, 10, ["item_id", *evaluation.METRICS])
    ids = F.transform("results", lambda r: r["item_id"].cast("string"))
    return nested.select(
        *RUN,
        "batch",
        F.size("results").cast("bigint").alias("n_items"),
        F.array_join(ids, ",").alias("item_ids"),
        r6(F.aggregate("results", F.lit(0.0), lambda t, r: t + r["rouge1"])).alias("rouge1_sum"),
    )


@query
def a12_context(spark, sf_dir):
    return retrieval.contexts(_questions(spark, sf_dir), _written_store(spark, sf_dir))


@query
def a13_stale_summaries(spark, sf_dir):
    items = run_items(spark, sf_dir)
    again = evaluation.score_pairs(run_pairs(spark, sf_dir, slots=True), PLAIN_AGAIN)
    summary = evaluation.summarise(again, PLAIN_AGAIN, RUN)
    checked = runs.stale_summaries(summary, items, evaluation.METRICS)
    return rounded(checked, "stored", "actual")


@query
def evaluation_first_run(spark, sf_dir):
    """The whole first-run flow with stems."""
    summary = evaluation.run_summary(run_pairs(spark, sf_dir), evaluation.FIRST_RUN, RUN)
    return rounded(summary, "bleu", *evaluation.METRICS)


@query
def evaluation_recomputed(spark, sf_dir):
    """The whole recomputation with stems in METEOR."""
    pairs = run_pairs(spark, sf_dir, slots=True)
    return rounded(evaluation.run_summary(pairs, evaluation.RECOMPUTED, RUN), "bleu", *evaluation.METRICS)


# -- numbering, order, top-k ------------------------------------------------------------------


@query
def w1_row_number(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("lang", "doc_id")
    return numbering.index_in_group(documents, ["lang"], "doc_id", "row_id")


@query
def w2_batches(spark, sf_dir):
    ids = numbering.dense_index(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    return ids.select(
        "doc_id",
        numbering.batch_number("row_id", 10).alias("batch_of_10"),
        numbering.batch_number("row_id", 4).alias("batch_of_4"),
    )


@query
def w3_meteor_chunks(spark, sf_dir):
    pairs = scores.meteor(with_words(eval_pairs(spark, sf_dir)), stems=False)
    return pairs.select("item_id", "ref_no", "meteor_matches", "meteor_chunks")


@query
def w4_rank(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    found = nearest.nearest(asked, vectors, "query_id", "embedding", "vec_id", "embedding", k=10)
    return rounded(found, "distance")


@query
def o1_sorted_pages(spark, sf_dir):
    return numbering.dense_index(table(spark, sf_dir, "pages").select("url", "page_id"), "url", "page_id")


@query
def o2_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    found = nearest.nearest(asked, vectors, "query_id", "embedding", "vec_id", "embedding")
    return rounded(found, "distance").select("query_id", "vec_id", "distance")


@query
def o2_bounded_top_k(spark, sf_dir):
    """The same rows, found with bounds from trained cells."""
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    trained = indexed.train(vectors, "vec_id", "embedding")
    found = indexed.nearest_bounded(asked, vectors, trained, "query_id", "embedding", "vec_id", "embedding")
    return rounded(found, "distance").select("query_id", "vec_id", "distance")


@query
def o3_reference_order(spark, sf_dir):
    slots = pairing.number_slots(references_of(table(spark, sf_dir, "conversations")))
    return slots.select("item_id", "ref_no", "slot")


# -- set operations ---------------------------------------------------------------------------


@query
def u1_both_modes(spark, sf_dir):
    return retrieval.prompts(_questions(spark, sf_dir), _written_store(spark, sf_dir))


@query
def u2_runs(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    items = hypotheses_of(turns), hypotheses_of(turns, "user")
    labelled = [
        (model, dataset, made.filter(F.col("conv_id") % 2 == rest))
        for model, made in zip(("assistant", "user"), items)
        for dataset, rest in zip(DATASETS, (0, 1))
    ]
    return runs.union_runs(*labelled).select(*RUN, "item_id", "hypothesis")


# -- chunks -----------------------------------------------------------------------------------


@query
def c1_recursive_chunks(spark, sf_dir):
    return chunks.recursive_chunks(spread_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def c2_page_then_chunks(spark, sf_dir):
    pages = captions.pages_as_text(spread_table(spark, sf_dir, "pages")).select("page_id", "text")
    return chunks.page_then_chunks(pages)


@query
def c3_stride_chunks(spark, sf_dir):
    return chunks.stride_chunks(spread_table(spark, sf_dir, "documents").select("doc_id", "text"))


# -- models and vectors -----------------------------------------------------------------------


def _stand_in_images():
    """Takes the place of an image model that echoes its prompt."""

    def predict(batch: pd.DataFrame) -> pd.Series:
        return batch["prompt"] + "A page of " + batch["content"].str.len().astype(str) + " characters.<|end|>"

    return predict


@query
def caption_flow(spark, sf_dir):
    """Pages captioned by a model, captions made style prompts, outputs named by both rules."""
    pages = spread_table(spark, sf_dir, "pages")
    images = pages.select(
        pr.numbered_name(F.col("page_id")).alias("image_name"), F.col("url").alias("path"), F.col("html").alias("content")
    )
    made = captioning.caption_images(images, _stand_in_images, pr.CAPTION_INSTRUCTION)
    jobs = captioning.styling_jobs(images, made, "results/styled", "_styled.png")
    drawn = pr.output_name(F.lit("results/drawn"), F.col("image_name"), "_diff3.jpg", hidden=True)
    return jobs.select("image_name", "path", "prompt", F.col("output").alias("styled"), drawn.alias("drawn"))


def _page_store(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Chunks of pages with their vectors, filled in two goes, and where each chunk comes from."""
    pages = spread_table(spark, sf_dir, "pages")
    store, links = scratch_path(spark, "page-store"), scratch_path(spark, "page-links")
    for batch in (pages.filter("page_id % 2 = 0"), pages.filter("page_id % 2 <> 0")):
        found = retrieval.page_chunks(batch)
        sinks.add_to_chunk_store(retrieval.embed(sinks.with_chunk_id(found), "chunk_text"), store)
        retrieval.chunk_links(found, "page_id").write.mode("append").parquet(links)
    return spark.read.parquet(store), spark.read.parquet(links)


@query
def rag_sources(spark, sf_dir):
    """Where the chunks retrieved for each question come from: pages cut into sections and chunks."""
    store, links = _page_store(spark, sf_dir)
    found = retrieval.retrieve(_questions(spark, sf_dir), store.select("chunk_id", "embedding"))
    return rounded(retrieval.with_sources(found, links), "distance")


@query
def rag_answers(spark, sf_dir):
    """Answers of a stand-in model to both prompts of each question, over the chunks of pages."""
    store, _ = _page_store(spark, sf_dir)
    asked = retrieval.prompts(_questions(spark, sf_dir), store)
    return retrieval.answers(asked, lambda: lambda batch: "answer to: " + batch["prompt"])


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark")


def _store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.chunk_store(spread_table(spark, sf_dir, "documents"))


def _written_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store as a table, for flows that read vectors first and the retrieved texts later."""
    path = scratch_path(spark, "store")
    sinks.add_to_chunk_store(_store(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def m1_model_batches(spark, sf_dir):
    return apply_model(
        spread_table(spark, sf_dir, "conversations"),
        _stand_in_captioner,
        keys=["conv_id", "turn"],
        inputs=["text"],
        output="caption STRING, words BIGINT",
        batch_size=4,
    )


def _with_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.size(tx.whitespace_tokens(F.col("text"))).cast("long")
    return spread_table(spark, sf_dir, "documents").select("doc_id", "text", words.alias("n_tokens"))


@query
def w2_padded_batches(spark, sf_dir):
    """Batches of documents of like length under a token budget."""
    batched = padded.padded_batches(_with_length(spark, sf_dir).drop("text"), "doc_id", "n_tokens")
    return batched.select("doc_id", "n_tokens", "length_class", "batch", "padded_to")


@query
def w2_padding_share(spark, sf_dir):
    """How much of all batches is padding."""
    batched = padded.padded_batches(_with_length(spark, sf_dir).drop("text"), "doc_id", "n_tokens")
    return rounded(padded.padding_share(batched, "n_tokens"), "padding")


@query
def m1_padded_batches(spark, sf_dir):
    """A stand-in model that says to how many tokens its batch was padded, keys beside it."""
    batched = padded.padded_batches(_with_length(spark, sf_dir), "doc_id", "n_tokens")
    return padded.apply_padded(batched, _stand_in_padder, ["doc_id", "n_tokens"], ["text"], "longest BIGINT, rows BIGINT")


def _stand_in_padder():
    def predict(batch: pd.DataFrame) -> pd.DataFrame:
        sizes = batch["text"].fillna("").str.split().str.len()
        return pd.DataFrame({"longest": [int(sizes.max())] * len(batch), "rows": [len(batch)] * len(batch)})

    return predict


@query
def m2_hashed_embedding(spark, sf_dir):
    made = retrieval.embed(spread_table(spark, sf_dir, "documents"), "text")
    # The outer form: for the inner one Spark filters on size(embedding) first and so computes
    # the embedding twice more.
    return made.select("doc_id", F.posexplode_outer("embedding").alias("bucket", "weight")).select(
        "doc_id", F.col("bucket").cast("bigint").alias("bucket"), r6("weight").alias("weight")
    )


@query
def m3_squared_l2(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    after = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    distance = ve.squared_l2(F.col("embedding"), F.col("next"))
    return vectors.join(after, "vec_id").select("vec_id", r6(distance).alias("distance"))


@query
def m4_cosine(spark, sf_dir):
    pairs = retrieval.embed(eval_pairs(spark, sf_dir), "hypothesis", "hyp_vec")
    pairs = retrieval.embed(pairs, "reference", "ref_vec")
    similarity = ve.cosine(F.col("hyp_vec"), F.col("ref_vec"))
    return pairs.select("item_id", "ref_no", r6(similarity).alias("cosine"))


@query
def m5_approximate_nearest(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    found = nearest.nearest_by_cells(asked, vectors, "query_id", "embedding", "vec_id", "embedding")
    return rounded(found, "distance")


def _chunk_questions(store: DataFrame) -> DataFrame:
    """One stored chunk in twenty as a question of its own."""
    asked = store.filter(F.pmod(F.crc32("chunk_id"), F.lit(20)) == 0)
    return asked.select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("question"))


def _chunk_index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, indexed.Trained]:
    """The chunk store as a table, its quantised index as another one, in the order of cells, and what was trained."""
    store = _written_store(spark, sf_dir).select("chunk_id", "embedding")
    trained = indexed.train(store, "chunk_id", "embedding")
    made, path = scratch_path(spark, "chunk-codes"), scratch_path(spark, "chunk-index")
    # Written first, as the sample that ranges are taken from would work out all codes once more.
    indexed.build(store, "chunk_id", "embedding", trained).write.option("compression", "zstd").parquet(made)
    ordered = spark.read.parquet(made).repartitionByRange("cell", "chunk_id").sortWithinPartitions("cell", "chunk_id")
    ordered.write.option("compression", "zstd").parquet(path)
    return store, spark.read.parquet(path), trained


_CHUNK_NAMES = ("query_id", "question", "chunk_id", "embedding")


@query
def m5_quantised_chunks(spark, sf_dir):
    """Nearest chunks through the quantised index, measured again with their vectors."""
    store, index, trained = _chunk_index(spark, sf_dir)
    found = indexed.nearest_by_codes(_chunk_questions(store), store, index, trained, *_CHUNK_NAMES)
    return rounded(found, "distance")


@query
def m5_quantised_recall(spark, sf_dir):
    """Recall of the quantised index against the exact search, and the share of pairs it looks at."""
    store, index, trained = _chunk_index(spark, sf_dir)
    asked = _chunk_questions(store)
    found = indexed.nearest_by_codes(asked, store, index, trained, *_CHUNK_NAMES)
    measured = nearest.recall(found, nearest.nearest(asked, store, *_CHUNK_NAMES), "query_id", "chunk_id")
    share = indexed.probed_share(asked, index, trained, "query_id", "question")
    return rounded(measured.withColumn("share", F.lit(share)), "recall", "share")


@query
def m5_recall(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    names = ("query_id", "embedding", "vec_id", "embedding")
    exact = nearest.nearest(asked, vectors, *names)
    rows = []
    for probes in (16, nearest.PROBES):
        found = nearest.nearest_by_cells(asked, vectors, *names, probes=probes)
        rows.append(nearest.recall(found, exact, "query_id", "vec_id").withColumn("probes", F.lit(probes)))
        share = nearest.compared_share(asked, vectors, *names, probes=probes)
        rows.append(share.withColumn("probes", F.lit(probes)))
    figures = ["exact_rows", "recall", "pairs_compared", "share"]
    table_of = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return rounded(table_of.groupBy("probes").agg(*[F.max(c).alias(c) for c in figures]), "recall", "share")
