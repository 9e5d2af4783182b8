"""The two metric definitions, from pairs of texts to run summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import overlap
from ..functions.stem import rouge_stems
from ..functions.text import alnum_tokens, normalise, whitespace_tokens, word_tokens
from ..operators import scores
from ..operators.pairing import explode_references

METRICS = ["rouge1", "rouge2", "meteor"]


@dataclass(frozen=True)
class Definition:
    """How text becomes tokens and how pair scores are averaged.

    Without `stem_meteor` all matches of a pair come from one pass through `functions/overlap.py`; its stem and synonym stages
    are expressions over token arrays. `bleu_13a` cuts the words of BLEU by the 13a rules, which matters where punctuation is kept.
    """

    name: str
    normalised: bool
    stem_rouge: bool
    stem_meteor: bool
    by_slot: bool
    bleu_13a: bool = False

    def clean(self, pairs: DataFrame) -> DataFrame:
        """Both texts as the definition wants them, worked out once for all metrics."""
        if not self.normalised:
            return pairs
        return pairs.withColumns({c: normalise(F.col(c)) for c in ("hypothesis", "reference")})

    def texts(self) -> tuple[Column, Column]:
        """Both texts as `overlap` takes them: it cuts punctuation, Spark lowers."""
        return tuple(F.lower(c) if self.normalised else F.col(c) for c in ("hypothesis", "reference"))

    def cut(self):
        return overlap.without_punctuation if self.normalised else None

    def bleu_score(self) -> Column:
        return scores.bleu_recomputed() if self.by_slot else scores.bleu_first_run()


FIRST_RUN = Definition("first_run", normalised=False, stem_rouge=True, stem_meteor=True, by_slot=False)
RECOMPUTED = Definition("recomputed", normalised=True, stem_rouge=False, stem_meteor=True, by_slot=True, bleu_13a=True)


def score_pairs(pairs: DataFrame, how: Definition, synonyms: DataFrame | None = None) -> DataFrame:
    """rouge1, rouge2 and meteor for each pair; `pairs` has slot if means are taken by slot."""
    kept = [c for c in pairs.columns if c not in ("hypothesis", "reference")]
    if synonyms is None and not how.stem_meteor:
        grams = overlap.alnum_stems_of if how.stem_rouge else overlap.alnum_of
        words = overlap.words_of if how.normalised else str.split
        matched = overlap.pair_matches(F.lower("hypothesis"), F.lower("reference"), grams, words, how.cut())
        return scores.matched_scores(pairs.select(*kept, matched.alias("_m")), "_m").select(*kept, *METRICS)

    def rouge_tokens(column: str) -> Column:
        tokens = alnum_tokens(F.col(column))
        return rouge_stems(tokens) if how.stem_rouge else tokens

    def words(column: str) -> Column:
        return word_tokens(F.col(column)) if how.normalised else whitespace_tokens(F.lower(column))

    tokens = how.clean(pairs).withColumns(
        {
            "_hyp_grams": rouge_tokens("hypothesis"),
            "_ref_grams": rouge_tokens("reference"),
            "_hyp_words": words("hypothesis"),
            "_ref_words": words("reference"),
        }
    ).drop("hypothesis", "reference")
    scored = scores.rouge(tokens, "_hyp_grams", "_ref_grams").drop("_hyp_grams", "_ref_grams")
    scored = scores.meteor(
        scored, "_hyp_words", "_ref_words", how.stem_meteor, synonyms, keys=kept
    )
    return scored.select(*kept, *METRICS)


def bleu_counts(pairs: DataFrame, how: Definition, runs: list[str]) -> DataFrame:
    """One row per run with every sum that BLEU needs."""
    words = overlap.words_13a_of if how.bleu_13a else str.split
    matched = overlap.gram_matches(*how.texts(), words, how.cut())
    return scores.matched_bleu_counts(pairs.select(*runs, "item_id", matched.alias("_m")), runs, "_m")


def corpus_bleu(pairs: DataFrame, how: Definition, runs: list[str]) -> DataFrame:
    return bleu_counts(pairs, how, runs).select(*runs, how.bleu_score().alias("bleu"))


def summarise(scored: DataFrame, how: Definition, runs: list[str]) -> DataFrame:
    """Run means of pair scores under the definition's rule of averaging."""
    if how.by_slot:
        return scores.slot_means(scored, runs, METRICS).drop("slots")
    items = scores.item_means(scored, [*runs, "item_id"], METRICS)
    return scores.run_means(items, runs, METRICS)


def item_scores(
    pairs: DataFrame, how: Definition, runs: list[str], synonyms: DataFrame | None = None
) -> DataFrame:
    """rouge1, rouge2 and meteor of each item: the means over its references."""
    return scores.item_means(score_pairs(pairs, how, synonyms), [*runs, "item_id"], METRICS)


def pairs_of_items(items: DataFrame) -> DataFrame:
    """Pairs of items that carry their references as an array; nothing is shuffled for it.

    `items` has item_id, hypothesis, reference_captions and any run columns.
    """
    return explode_references(items)


def stored_items(pairs: DataFrame, runs: list[str], size: int = 1000) -> DataFrame:
    """Items as run documents hold them: image_id, generated_caption and reference_captions.

    References come in blocks of `size` per item, in slot order, so that no row grows with an item.
    """
    slot_text = F.struct("slot", "reference")
    return (
        pairs.withColumn("block", F.expr(f"slot div {size}"))
        .groupBy(*runs, F.col("item_id").alias("image_id"), "block")
        .agg(F.first("hypothesis").alias("generated_caption"), F.array_sort(F.collect_list(slot_text)).alias("_refs"))
        .select(*runs, "image_id", "block", "generated_caption", F.col("_refs.reference").alias("reference_captions"))
    )


def pairs_of_stored(items: DataFrame, size: int = 1000) -> DataFrame:
    """Pairs with slots out of `stored_items`, without a shuffle."""
    kept = [c for c in items.columns if c not in ("image_id", "block", "generated_caption", "reference_captions")]
    slots = F.posexplode("reference_captions").alias("at", "reference")
    return items.select(*kept, "image_id", "block", "generated_caption", slots).select(
        *kept,
        F.col("image_id").alias("item_id"),
        (F.col("block") * size + F.col("at")).alias("slot"),
        F.col("generated_caption").alias("hypothesis"),
        "reference",
    )


def run_summary(
    pairs: DataFrame, how: Definition, runs: list[str], synonyms: DataFrame | None = None
) -> DataFrame:
    """One row per run: bleu, rouge1, rouge2, meteor and the name of the definition.

    `runs` names the columns that tell runs apart; give a single run a constant one.
    """
    if not runs:
        raise ValueError("name at least one run column")
    means = summarise(score_pairs(pairs, how, synonyms), how, runs)
    # True for every pair: it keeps the slot, so both branches have the same columns and share the exchange of texts.
    texts = pairs.filter("slot >= 0") if how.by_slot else pairs
    return (
        corpus_bleu(texts, how, runs)
        .join(means, runs)
        .withColumn("metric_def", F.lit(how.name))
    )
