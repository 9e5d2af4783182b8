"""BLEU counts and scores, ROUGE, METEOR, and their averages.

`pairs` frames have one row per hypothesis and reference: item_id, any run columns, and the token
arrays named by the caller. Everything within a pair is computed in its own row; only counts and
scores are shuffled.
"""

from __future__ import annotations

import functools
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.multiset import align_last, chunk_count, free_places, let, shared_counts
from ..functions.overlap import sense_matches
from ..functions.stem import stem_tokens
from ..functions.text import ngrams
from ..session import scratch_path

ORDERS = (1, 2, 3, 4)
# Smoothing of a zero BLEU numerator, and the METEOR parameters.
EPSILON = 0.1
ALPHA, BETA, GAMMA = 0.9, 3.0, 0.5


# -- ROUGE ------------------------------------------------------------------------------------


def rouge_f(hyp: str, ref: str, n: int) -> Column:
    """F-measure of the n-grams two token columns share; an empty side counts as one gram."""
    shared = let("h", ngrams(hyp, n), let("r", ngrams(ref, n), shared_counts("h", "r")))
    overlap = f"aggregate({shared}, 0, (total, gram) -> total + gram.shared)"
    grams = " + ".join(f"greatest(size({side}) - {n - 1}, 1)" for side in (hyp, ref))
    return F.expr(f"2d * {overlap} / ({grams})")


def rouge(pairs: DataFrame, hyp: str = "hyp_tokens", ref: str = "ref_tokens") -> DataFrame:
    return pairs.withColumns(
        {f"rouge{n}": rouge_f(hyp, ref, n) for n in (1, 2)}
    )


# -- METEOR -----------------------------------------------------------------------------------


def meteor_score(matches: Column, chunks: Column, hyp_size: Column, ref_size: Column) -> Column:
    precision, recall = matches / hyp_size, matches / ref_size
    mean = precision * recall / (ALPHA * precision + (1 - ALPHA) * recall)
    penalty = GAMMA * F.pow(chunks / matches, F.lit(BETA))
    return F.when(matches > 0, (1 - penalty) * mean).otherwise(F.lit(0.0))


def _add_stem_links(pairs: DataFrame, hyp: str, ref: str) -> DataFrame:
    """Second stage: words still free, matched by their stems under the same rule."""
    stemmed = pairs.withColumns(
        {"_hyp_stems": stem_tokens(F.col(hyp)), "_ref_stems": stem_tokens(F.col(ref))}
    )
    more = align_last(
        "_hyp_stems",
        "_ref_stems",
        free_places("size(_hyp_stems)", "_links", "l"),
        free_places("size(_ref_stems)", "_links", "r"),
    )
    return stemmed.withColumn("_links", F.expr(f"concat(_links, {more})"))


def _add_synonym_links(pairs: DataFrame, synonyms: DataFrame, keys: list[str]) -> DataFrame:
    """Third stage: free hypothesis words, last first, take the last free reference word that is
    a synonym. `synonyms` has word and synonym; words are looked up by stem, as after stage two.

    Only (pair, place, word) leaves the row for the lookup. The word table has one row per word, so
    Spark broadcasts it while small and otherwise splits the frequent words of the other side.
    """
    free = free_places("size(_hyp_stems)", "_links", "l")
    looked_up = f"transform({free}, at -> struct(at as l, get(_hyp_stems, at) as word))"
    words = pairs.select(*keys, F.expr(f"inline({looked_up})"))
    sets = synonyms.groupBy("word").agg(F.collect_set("synonym").alias("synonyms"))
    options = (
        words.join(sets, "word")
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("l", "synonyms")), asc=False).alias("_options"))
    )
    left_over = free_places("size(_ref_stems)", "links", "r")
    fitting = f"filter({left_over}, at -> array_contains(option.synonyms, get(_ref_stems, at)))"
    taken = let(
        "fits",
        fitting,
        "case when size(fits) > 0 "
        "then array_append(links, struct(option.l as l, array_max(fits) as r)) else links end",
    )
    return pairs.join(options, keys, "left").withColumn(
        "_links",
        F.expr(
            "case when _options is null then _links "
            f"else aggregate(_options, _links, (links, option) -> {taken}) end"
        ),
    )


# Words of the pairs that are matched together, and pieces of that size for a task.
WORDS_PER_PIECE, PIECES_PER_TASK = 1 << 20, 4


def _senses_of(words: DataFrame, senses: DataFrame, forms) -> DataFrame:
    """word, stem, and the senses of the stem as a word of a hypothesis, under its forms, and of a reference, as it is."""
    stemmed = words.select("word", F.get(stem_tokens(F.array("word")), F.lit(0)).alias("stem"))
    as_hyp = F.transform((forms or F.array)(F.col("stem")), lambda form: F.struct(F.lit(True).alias("of_hyp"), form.alias("form")))
    as_ref = F.array(F.struct(F.lit(False).alias("of_hyp"), F.col("stem").alias("form")))
    names = senses.select(F.col("word").alias("form"), F.col("sense").cast("string").alias("sense"))
    found = stemmed.select("word", "stem", F.inline(F.concat(as_hyp, as_ref))).join(names, "form", "left")
    return found.groupBy("word", "stem").agg(
        F.collect_set(F.when(F.col("of_hyp"), F.col("sense"))).alias("hyp_senses"),
        F.collect_set(F.when(~F.col("of_hyp"), F.col("sense"))).alias("ref_senses"),
    )


def _matched_by_senses(pairs: DataFrame, hyp: str, ref: str, senses: DataFrame, keys: list[str], forms) -> DataFrame:
    """All three stages by synonym sets: free hypothesis words, last first, take the last free reference word that
    shares a sense. `senses` has word and sense.

    Hypothesis words are looked up under `forms` of their stem, reference words as they are. Pairs are dealt into
    pieces of a bounded number of words, and each distinct word goes once to the pieces it is in, with its stem and senses; both are
    found once per distinct word of all pairs. Sets stay rows, so their size does not matter. A pair with a null key has
    the first two stages only.
    """
    spark = pairs.sparkSession
    none = F.array().cast("array<string>")
    # The size of the pieces need not be exact: every 64th pair says it.
    some = pairs.filter(F.pmod(F.xxhash64(*keys), F.lit(64)) == 0).agg(
        64 * F.sum(F.size(F.coalesce(hyp, none)) + F.size(F.coalesce(ref, none)))
    )
    pieces = max(spark.sparkContext.defaultParallelism * PIECES_PER_TASK, math.ceil((some.first()[0] or 0) / WORDS_PER_PIECE))
    tasks = math.ceil(pieces / PIECES_PER_TASK)
    looked_up = functools.reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    dealt = pairs.withColumns(
        {"_looked_up": looked_up, "_piece": F.pmod(F.xxhash64(*keys, hyp, ref), F.lit(pieces))}
    )

    words = F.array_distinct(F.concat(F.coalesce(hyp, none), F.coalesce(ref, none)))
    found = dealt.select("_piece", F.explode(words).alias("word")).distinct()
    # Read twice, so written once in place of cut out of the pairs again.
    path = scratch_path(spark, "words")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    known = found.join(_senses_of(found.select("word").distinct(), senses, forms), "word")

    def match(rows: pa.Table, known: pa.Table) -> pa.Table:
        lists = [rows[side].combine_chunks() for side in (hyp, ref)]
        counts = sense_matches(*lists, rows["_looked_up"].to_numpy().astype(bool), known)
        for name, column in zip(("meteor_matches", "meteor_chunks"), counts):
            rows = rows.append_column(name, column)
        return rows.drop_columns(["_looked_up", "_piece"])

    schema = StructType([*pairs.schema, *(StructField(c, LongType()) for c in ("meteor_matches", "meteor_chunks"))])
    pieces_of = [side.repartition(tasks, "_piece").groupBy("_piece") for side in (dealt, known)]
    return pieces_of[0].cogroup(pieces_of[1]).applyInArrow(match, schema)


def meteor(
    pairs: DataFrame,
    hyp: str = "hyp_tokens",
    ref: str = "ref_tokens",
    stems: bool = True,
    synonyms: DataFrame | None = None,
    keys: list[str] | None = None,
    senses: DataFrame | None = None,
    forms=None,
) -> DataFrame:
    """Adds meteor_matches, meteor_chunks and meteor.

    Stages: exact words, then stems, then synonyms if a table (word, synonym) or a table of synonym sets
    (word, sense) is given; `forms` is a function of a word column to an array of words to look up, such as
    `base_forms`. The synonym stage needs `keys`, the columns that tell pairs apart.
    """
    kept = pairs.columns
    if (synonyms is not None or senses is not None) and not (stems and keys):
        raise ValueError("the synonym stage follows the stem stage and needs the pair keys")
    if synonyms is None and senses is not None:
        out = _matched_by_senses(pairs, hyp, ref, senses, keys, forms)
    else:
        out = pairs.withColumn("_links", F.expr(align_last(hyp, ref)))
        if stems:
            out = _add_stem_links(out, hyp, ref)
        if synonyms is not None:
            out = _add_synonym_links(out, synonyms, keys)
        out = out.withColumns(
            {
                "meteor_matches": F.size("_links").cast("bigint"),
                "meteor_chunks": F.expr(chunk_count("_links")).cast("bigint"),
            }
        )
    score = meteor_score(
        F.col("meteor_matches"), F.col("meteor_chunks"), F.size(hyp), F.size(ref)
    )
    return out.select(*kept, "meteor_matches", "meteor_chunks", score.alias("meteor"))


def matched_scores(pairs: DataFrame, matched: str) -> DataFrame:
    """Adds rouge1, rouge2 and meteor to pairs with a column as `overlap.pair_matches` makes it."""

    def rouge_of(n: int) -> Column:
        grams = " + ".join(f"greatest({matched}.{side}_grams - {n - 1}, 1)" for side in ("hyp", "ref"))
        # As in `rouge_f`, a pair without a text has no words, which is null, and no longer grams, which is 0.
        shared = f"coalesce({matched}.shared{n}, 0)" if n > 1 else f"{matched}.shared{n}"
        return F.expr(f"2d * {shared} / ({grams})")

    found = [F.col(f"{matched}.{c}") for c in ("matches", "chunks", "hyp_words", "ref_words")]
    return pairs.withColumns({"rouge1": rouge_of(1), "rouge2": rouge_of(2), "meteor": meteor_score(*found)})


# -- corpus BLEU ------------------------------------------------------------------------------


def matched_grams(hyp: str, ref: str) -> str:
    """SQL text: array<struct<n, gram, shared>> of two token columns, for n = 1..4.

    Without a shared n-gram there is no shared longer one, so the next order is not looked at.
    """

    def from_order(n: int) -> str:
        found = let("h", ngrams(hyp, n), let("r", ngrams(ref, n), shared_counts("h", "r")))
        matches = f"transform({found}, g -> struct({n} as n, g.key as gram, g.shared as shared))"
        if n == ORDERS[-1]:
            return matches
        return let(
            f"m{n}",
            matches,
            f"case when size(m{n}) > 0 then concat(m{n}, {from_order(n + 1)}) else m{n} end",
        )

    return from_order(1)


def bleu_items(
    pairs: DataFrame, runs: list[str], hyp: str = "hyp_tokens", ref: str = "ref_tokens"
) -> DataFrame:
    """Per item and gram the clipped count: the most a single reference shares with the hypothesis.

    Each pair also sends one row with n = 0 for the lengths, so one aggregate serves both. The
    reference closest in length is kept as one number, 2 * |difference| + (1 if longer).
    """
    lengths = pairs.selectExpr(
        *runs, "item_id", f"bigint(size({hyp})) as hyp_len", f"bigint(size({ref})) as ref_len",
        f"{matched_grams(hyp, ref)} as grams",
    )
    return _clipped(lengths, runs)


def _clipped(lengths: DataFrame, runs: list[str]) -> DataFrame:
    """`bleu_items` out of pairs with hyp_len, ref_len and grams; a pair without a text has no row."""
    grams = "case when hyp_len + ref_len >= 0 then concat(array(struct(0 as n, '' as gram, 0 as shared)), grams) end"
    return (
        lengths.selectExpr(
            *runs,
            "item_id",
            "hyp_len",
            "ref_len",
            "2 * abs(ref_len - hyp_len) + if(ref_len > hyp_len, 1, 0) as closeness",
            f"inline({grams})",
        )
        .groupBy(*runs, "item_id", "n", "gram")
        .agg(
            F.max("shared").cast("bigint").alias("clipped"),
            F.max("hyp_len").alias("hyp_len"),
            F.min("ref_len").alias("shortest_ref"),
            F.min("closeness").alias("closeness"),
        )
    )


def bleu_counts(
    pairs: DataFrame, runs: list[str], hyp: str = "hyp_tokens", ref: str = "ref_tokens"
) -> DataFrame:
    """One row per run with every sum the two BLEU definitions need."""
    return _sums_of_items(bleu_items(pairs, runs, hyp, ref), runs)


def matched_bleu_counts(pairs: DataFrame, runs: list[str], matched: str) -> DataFrame:
    """The same out of pairs with a column as `overlap.gram_matches` makes it."""
    return _sums_of_items(_clipped(pairs.select(*runs, "item_id", f"{matched}.*"), runs), runs)


def _sums_of_items(items: DataFrame, runs: list[str]) -> DataFrame:
    step = "closeness div 2"
    sums = {
        "hyp_len": "hyp_len",
        "closest_ref": f"hyp_len + if(closeness % 2 = 1, {step}, -({step}))",
        "shortest_ref": "shortest_ref",
    }
    for n in ORDERS:
        sums[f"den_first_{n}"] = f"greatest(hyp_len - {n - 1}, 1)"
        sums[f"den_again_{n}"] = f"greatest(hyp_len - {n - 1}, 0)"
    aggregates = [f"sum({value}) filter (where n = 0) as {name}" for name, value in sums.items()]
    aggregates += [f"sum(if(n = {n}, clipped, 0)) as num_{n}" for n in ORDERS]
    aggregates.append("count_if(n = 0) as items")
    return items.groupBy(*runs).agg(*[F.expr(text) for text in aggregates])


def _bleu(denominator: str, reference: str, numerator: str, zero: str) -> Column:
    logs = " + ".join(
        f"ln({numerator.format(n=n)} / nullif({denominator}_{n}, 0))" for n in ORDERS
    )
    brevity = f"if(hyp_len > {reference}, 1d, exp(1 - {reference} / nullif(hyp_len, 0)))"
    return F.expr(f"if({zero}, 0d, {brevity} * exp(({logs}) / {len(ORDERS)}))")


def bleu_first_run() -> Column:
    """Corpus BLEU over `bleu_counts`: closest reference length, zero numerators become 0.1."""
    smoothed = f"if(num_{{n}} = 0, {EPSILON}d, num_{{n}})"
    return _bleu("den_first", "closest_ref", smoothed, "num_1 = 0")


def bleu_recomputed() -> Column:
    """Corpus BLEU over `bleu_counts`: shortest reference length, no smoothing."""
    return _bleu("den_again", "shortest_ref", "num_{n}", "least(num_1, num_2, num_3, num_4) = 0")


# -- averages ---------------------------------------------------------------------------------


def item_means(scored: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Mean over the references of each item."""
    return scored.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in metrics])


def run_means(items: DataFrame, runs: list[str], metrics: list[str]) -> DataFrame:
    """Mean over items of scores already averaged per item."""
    return items.groupBy(*runs).agg(*[F.avg(m).alias(m) for m in metrics])


def slot_means(scored: DataFrame, runs: list[str], metrics: list[str]) -> DataFrame:
    """Mean over items for each reference slot, then over the slots the first item has.

    A slot belongs to the first item exactly if the lowest item id found in the slot is the lowest
    of the run, so the slot count needs no pass of its own over the pairs.
    """
    slots = scored.groupBy(*runs, "slot").agg(
        F.min("item_id").alias("_first"), *[F.avg(m).alias(m) for m in metrics]
    )
    lowest = F.min("_first").over(Window.partitionBy(*runs))
    return slots.withColumn("_lowest", lowest).filter("_first = _lowest").groupBy(*runs).agg(
        F.count("*").alias("slots"), *[F.avg(m).alias(m) for m in metrics]
    )


def short_items(scored: DataFrame, runs: list[str]) -> DataFrame:
    """Items with fewer references than the first item of their run: they miss some slots."""
    sizes = scored.groupBy(*runs, "item_id").agg(F.count("*").alias("references"))
    first = sizes.groupBy(*runs).agg(F.min_by("references", "item_id").alias("slots"))
    # One row per run; items with a third of all rows in one run are not moved for it.
    first = F.broadcast(first.select("*", F.lit(0).alias("_run")))
    return sizes.select("*", F.lit(0).alias("_run")).join(first, ["_run", *runs]).filter("references < slots").drop("_run")

