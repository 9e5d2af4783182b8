"""Matches of whole batches against the expressions on one pair, and tokens against those of Spark."""

import random
from dataclasses import replace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textgauge.functions import overlap
from textgauge.functions import text as tx
from textgauge.operators import scores
from textgauge.plans import evaluation

PARTS = [
    "cannot", "Can not", "gimme", "can'not", "cannots", "écannot", "cannot́", "ácannot", "cannoté", "cannot²", "_gonna", "gonna_", "cannot’s",
    "́cannot", "“wanna”", "gotta«lemme»", "CANNOT", "ſ", "K", "İ", "ΑΣ", "ΑΣ.", "a-b", "1,000.5", "x,y", "5-", "-\n", "&quot;", "<skipped>",
    "[a]", "~", "\x1c", "　", " ", "​", "\xa0", "\n", "\t", "é", "漢", "\U0001f600", "don't", "!!", "a", "the", "the", " ", "  ", ".", ",", "'",
]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(14))) for _ in range(n)]


def test_tokens_are_those_of_the_expressions(spark):
    rows = spark.createDataFrame([(t,) for t in [*PARTS, *texts(1500, 1)]], "t string")
    clean = tx.normalise(F.col("t"))
    found = rows.select(
        F.lower("t").alias("low"), "t", tx.whitespace_tokens(F.col("t")).alias("split"), tx.alnum_tokens(F.col("t")).alias("alnum"),
        tx.word_tokens(clean).alias("words"), tx.tokens_13a(F.col("t")).alias("t13a"), tx.tokens_13a(clean).alias("clean13a"),
        tx.alnum_tokens(clean).alias("clean_alnum"), tx.word_tokens(F.col("t")).alias("raw_words"),
    ).collect()
    for r in found:
        bare = overlap.without_punctuation(r.low)
        assert r.split == r.t.split() and r.alnum == overlap.alnum_of(r.low) and r.words == overlap.words_of(bare), r
        assert r.raw_words == overlap.words_of(r.t) and r.t13a == overlap.words_13a_of(r.t), r
        assert r.clean13a == overlap.words_13a_of(bare) and r.clean_alnum == overlap.alnum_of(bare), r


@pytest.mark.parametrize("slice_bytes", [300, 1 << 20])
@pytest.mark.parametrize("how", [replace(evaluation.FIRST_RUN, stem_meteor=False, stem_rouge=False), replace(evaluation.RECOMPUTED, stem_meteor=False)])
def test_batches_score_as_single_pairs(spark, monkeypatch, how, slice_bytes):
    made = [*texts(60, 2), "", None, "a a b a b", "b a b a a"]
    rng = random.Random(4)
    rows = [(i, i % 7, rng.choice(made), rng.choice(made)) for i in range(400)]
    pairs = spark.createDataFrame(rows, "ref_no long, item_id long, hypothesis string, reference string").withColumn("run", F.lit("x"))
    cleaned = how.clean(pairs)
    words = (lambda c: tx.word_tokens(F.col(c))) if how.normalised else (lambda c: tx.whitespace_tokens(F.lower(c)))
    bleu_words = tx.tokens_13a if how.bleu_13a else tx.whitespace_tokens
    tokens = cleaned.select(
        "run", "item_id", "ref_no", tx.alnum_tokens(F.col("hypothesis")).alias("hg"), tx.alnum_tokens(F.col("reference")).alias("rg"),
        words("hypothesis").alias("hw"), words("reference").alias("rw"),
        bleu_words(F.col("hypothesis")).alias("hyp_tokens"), bleu_words(F.col("reference")).alias("ref_tokens"),
    )
    wanted = scores.meteor(scores.rouge(tokens, "hg", "rg"), "hw", "rw", stems=False).select("ref_no", *evaluation.METRICS)
    wanted_bleu = scores.bleu_counts(tokens, ["run", "item_id"]).collect()
    # Workers start with the sizes of this process only if the function brings them along.
    monkeypatch.setattr(overlap, "SLICE_BYTES", slice_bytes)
    plain = [r.asDict() for r in pairs.orderBy("ref_no").select(F.lower("hypothesis").alias("h"), F.lower("reference").alias("r")).collect()]
    sides = [pa.array([r[c] for r in plain], pa.string()) for c in "hr"]
    cut = how.cut()
    by_hand = overlap._by_slices(
        lambda a, b: overlap._pair_matches(a, b, cut, overlap.alnum_of, overlap.words_of if how.normalised else str.split), *sides, None
    ).to_pylist()
    scored = evaluation.score_pairs(pairs.drop("run"), how).select("ref_no", *evaluation.METRICS)
    assert scored.orderBy("ref_no").collect() == wanted.orderBy("ref_no").collect()
    matches = scores.meteor(tokens, "hw", "rw", stems=False).orderBy("ref_no").select("meteor_matches", "meteor_chunks").collect()
    assert [(m["matches"] or 0, m["chunks"] or 0) for m in by_hand] == [tuple(m) for m in matches]
    assert sorted(evaluation.bleu_counts(pairs, how, ["run", "item_id"]).collect()) == sorted(wanted_bleu)


def test_a_text_of_many_pairs_is_cut_once(monkeypatch):
    seen = []
    hyps = pa.array([f"h {i} a" for i in range(30)] * 40)
    refs = pa.array([f"r {i // 30} a" for i in range(1200)])
    found = overlap._pair_matches(hyps, refs, lambda t: seen.append(t) or t, str.split, str.split).to_pylist()
    assert len(seen) == 30 + 40 and len(found) == 1200
    # A pair shares "a", and the number if it is the same.
    assert {m["matches"] for m in found} == {1, 2}


def test_no_pairs(spark):
    empty = spark.createDataFrame([], "item_id long, hypothesis string, reference string, run string")
    how = replace(evaluation.FIRST_RUN, stem_meteor=False)
    assert evaluation.score_pairs(empty, how).count() == 0 and evaluation.bleu_counts(empty, how, ["run"]).count() == 0
