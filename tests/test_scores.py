import random

import pytest
from conftest import DATA
from formulas import bleu, meteor, rouge
from pyspark.sql import functions as F

from textgauge.functions import multiset, overlap
from textgauge.functions.stem import porter
from textgauge.operators import scores
from textgauge.operators.pairing import pair_references
from textgauge.plans.catalog import with_alnum
from textgauge.sources.synsets import DETACHMENTS, base_forms, read_synsets
from textgauge.sources.turns import hypotheses_of, references_of, stand_in_runs, unmatched_turns

EDGE_CASES = [
    ("", "the cat sat"), ("the cat", ""), ("", ""), ("a", "a"), ("a b", "c d"),
    ("the the the the the the the", "the cat is on the mat"),
    ("a b c d e", "a b c d e"), ("e d c b a", "a b c d e"), ("a a b b", "b b a a"),
    ("été à la plage", "à la plage en été"), ("x a x b x", "a x b x a x b"),
    ("cats running fast", "cat runs faster cats"),
]


def random_cases(count, seed):
    rng = random.Random(seed)
    words = ["the", "cat", "cats", "sat", "sitting", "on", "mat", "big", "large"]
    text = lambda most: " ".join(rng.choice(words) for _ in range(rng.randint(0, most)))
    return [(text(12), text(14)) for _ in range(count)]


def pair_frame(spark, cases):
    rows = [(i, h.split(), r.split()) for i, (h, r) in enumerate(cases)]
    return spark.createDataFrame(rows, "item_id int, hyp_tokens array<string>, ref_tokens array<string>")


CASES = EDGE_CASES + random_cases(120, 3)


@pytest.mark.parametrize("limit", [multiset.SCAN_LIMIT, 0])
def test_rouge_and_alignment_match_formula(spark, monkeypatch, limit):
    # Limit 0 forces the sorted way, which long rows with many common keys take.
    monkeypatch.setattr(multiset, "SCAN_LIMIT", limit)
    df = scores.meteor(scores.rouge(pair_frame(spark, CASES)), stems=False)
    for row in df.collect():
        for n in (1, 2):
            assert row[f"rouge{n}"] == pytest.approx(rouge(row.hyp_tokens, row.ref_tokens, n))
        m, chunks, score = meteor(row.hyp_tokens, row.ref_tokens)
        assert (row.meteor_matches, row.meteor_chunks) == (m, chunks)
        assert row.meteor == pytest.approx(score)


def test_meteor_stems_and_synonyms_match_greedy(spark):
    synonyms = {"big": {"larg", "cat"}, "larg": {"big"}, "sat": {"mat", "on"}, "the": {"on", "big"}}
    table = spark.createDataFrame([(w, s) for w, ss in synonyms.items() for s in ss], "word string, synonym string")
    pairs = pair_frame(spark, CASES)
    stemmed = scores.meteor(pairs).collect()
    full = scores.meteor(pairs, synonyms=table, keys=["item_id"]).collect()
    assert len(full) == len(stemmed) == len(CASES)
    for row in stemmed:
        m, chunks, score = meteor(row.hyp_tokens, row.ref_tokens, porter)
        assert (row.meteor_matches, row.meteor_chunks) == (m, chunks)
        assert row.meteor == pytest.approx(score)
    for row in full:
        m, chunks, score = meteor(row.hyp_tokens, row.ref_tokens, porter, synonyms)
        assert (row.meteor_matches, row.meteor_chunks) == (m, chunks), row
        assert row.meteor == pytest.approx(score)
    assert sum(r.meteor_matches for r in full) > sum(r.meteor_matches for r in stemmed)


def test_meteor_by_synonym_sets_matches_greedy(spark):
    """Words in several sets, sets of many words, and look-up under base forms."""
    sets = {"1": ["big", "larg", "on"], "2": ["big", "cat", "mat"], "3": ["sat", "on", "the"], "4": [f"w{i}" for i in range(3000)] + ["dog"], "5": ["run", "the"]}
    table = spark.createDataFrame([(w, s) for s, words in sets.items() for w in words], "word string, sense string")
    cases = [*CASES, ("runs w7 w8 big", "the dog w9 mat w10"), ("running", "the"), ("", "the")]
    pairs = pair_frame(spark, cases)
    for forms, expand in ((None, lambda w: [w]), (base_forms, lambda w: [w, *(w[: -len(e)] + b for e, b in DETACHMENTS if w.endswith(e) and len(w) > len(e))])):
        of = {}
        for word in {porter(w) for hyp, ref in cases for w in (*hyp.split(), *ref.split())}:
            senses = {s for s, words in sets.items() if set(expand(word)) & set(words)}
            of[word] = {w for s in senses for w in sets[s]}
        for row in scores.meteor(pairs, keys=["item_id"], senses=table, forms=forms).collect():
            m, chunks, score = meteor(row.hyp_tokens, row.ref_tokens, porter, of)
            assert (row.meteor_matches, row.meteor_chunks) == (m, chunks), row
            assert row.meteor == pytest.approx(score)


def test_pairs_with_one_key_are_scored_each_on_its_own(spark):
    """Senses are looked up by word, so pairs that share a key, or whose key or text is null, do not mix."""
    table = spark.createDataFrame([("big", "1"), ("larg", "1"), ("on", "2"), ("the", "2")], "word string, sense string")
    cases = [(1, "on big", "the larg"), (1, "x y", "the larg"), (1, "big", "cat"), (None, "big", "larg"), (2, None, "a"), (3, "big big on", "larg z larg")]
    rows = [(key, h and h.split(), r.split()) for key, h, r in cases]
    pairs = spark.createDataFrame(rows, "item_id int, hyp_tokens array<string>, ref_tokens array<string>")
    got = scores.meteor(pairs, keys=["item_id"], senses=table)
    found = [(r.item_id, r.hyp_tokens and " ".join(r.hyp_tokens), r.meteor_matches, r.meteor_chunks) for r in got.collect()]
    assert sorted(found, key=str) == sorted(
        [(1, "on big", 2, 1), (1, "x y", 0, 0), (1, "big", 0, 0), (None, "big", 0, 0), (2, None, 0, 0), (3, "big big on", 2, 2)], key=str
    )
    assert got.columns == [*pairs.columns, "meteor_matches", "meteor_chunks", "meteor"]


def test_meteor_by_synonym_sets_does_not_depend_on_pieces(spark, monkeypatch):
    table = spark.createDataFrame([("big", "1"), ("larg", "1"), ("cat", "1"), ("on", "2"), ("the", "2")], "word string, sense string")
    pairs = pair_frame(spark, CASES)
    whole = sorted(map(str, scores.meteor(pairs, keys=["item_id"], senses=table).collect()))
    monkeypatch.setattr(scores, "WORDS_PER_PIECE", 2)
    monkeypatch.setattr(overlap, "SLICE_WORDS", 5)
    assert sorted(map(str, scores.meteor(pairs, keys=["item_id"], senses=table).collect())) == whole
    empty = scores.meteor(pairs, keys=["item_id"], senses=table.limit(0)).collect()
    stemmed = {r.item_id: (r.meteor_matches, r.meteor_chunks) for r in scores.meteor(pairs).collect()}
    assert {r.item_id: (r.meteor_matches, r.meteor_chunks) for r in empty} == stemmed


def test_synset_file(spark, tmp_path):
    (tmp_path / "data.noun").write_text(
        "  1 licence text of the file\n"
        "00001740 03 n 02 entity 0 Living_thing 0 003 ~ 00001930 n 0000 | that which is\n"
        "00002137 03 n 0b abstraction 0 abstract 1 c 0 d 0 e 0 f 0 g 0 h 0 i 0 j 0 k 0 001 @ 00001740 n 0000 | x\n"
        "00002137 03 n 01 late 0 000 | the same set goes on\n"
    )
    (tmp_path / "data.adj").write_text("00001740 00 a 01 Able(p) 0 005 = 05207437 n 0000 | able\n")
    got = sorted(map(tuple, read_synsets(spark, str(tmp_path)).collect()))
    assert got == sorted(
        [("entity", "n-00001740"), ("able", "a-00001740"), ("late", "n-00002137")]
        + [(w, "n-00002137") for w in ("abstraction", "abstract", *"cdefghijk")]
    )


def test_base_forms(spark):
    words = spark.createDataFrame([("dogs",), ("churches",), ("ed",), ("men",), ("flies",), ("",)], "w string")
    got = {r[0]: set(r[1]) for r in words.select("w", base_forms(F.col("w"))).collect()}
    assert got["dogs"] == {"dogs", "dog"} and got["ed"] == {"ed"} and got[""] == {""}
    assert {"church", "churche"} <= got["churches"] and "fly" in got["flies"] and got["men"] == {"men"}


def bleu_items(cases, sizes):
    """Group cases into items with 1, 2 or 3 references."""
    items, at = [], 0
    for size in sizes:
        group = cases[at : at + size]
        items.append((group[0][0].split(), [r.split() for _, r in group]))
        at += size
    return items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bleu_matches_formula(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 3) for _ in range(30)]
    items = bleu_items(random_cases(90, seed) + EDGE_CASES, sizes)
    rows = [(i, h, r) for i, (h, refs) in enumerate(items) for r in refs]
    df = spark.createDataFrame(rows, "item_id int, hyp_tokens array<string>, ref_tokens array<string>")
    row = scores.bleu_counts(df, []).select(
        scores.bleu_first_run().alias("first"), scores.bleu_recomputed().alias("again")
    ).first()
    assert row["first"] == pytest.approx(bleu(items, True))
    assert row["again"] == pytest.approx(bleu(items, False))


@pytest.mark.parametrize("hyps", ["", "a b", "q"])
def test_bleu_without_any_long_match(spark, hyps):
    items = [(hyps.split(), [["a", "c"], ["b"]])]
    rows = [(0, h, r) for h, refs in items for r in refs]
    df = spark.createDataFrame(rows, "item_id int, hyp_tokens array<string>, ref_tokens array<string>")
    row = scores.bleu_counts(df, []).select(
        scores.bleu_first_run().alias("first"), scores.bleu_recomputed().alias("again")
    ).first()
    assert row["first"] == pytest.approx(bleu(items, True) if hyps else 0.0)
    assert row["again"] == 0.0


# Counts and scores measured independently on the driver tables.
GOLDEN = {
    ("user", "assistant"): dict(
        num=[1197, 80, 1, 0], first=[2991, 2893, 2795, 2698], again=[2991, 2893, 2795, 2697],
        refs=(11004, 10973), bleu=(0.000238868, 0.0), items=(0.101215, 0.004020),
        slots=(0.100391, 0.003923),
    ),
    ("assistant", "user"): dict(
        num=[2117, 138, 7, 3], first=[15919, 15821, 15723, 15625],
        again=[15919, 15821, 15723, 15625], refs=(4509, 2003), bleu=(0.003155575, 0.003155575),
        items=(0.112395, 0.004736), slots=(0.110281, 0.005227),
    ),
}


def first_turns(turns, role):
    return turns.filter(F.col("role") == role).groupBy(F.col("conv_id").alias("item_id")).agg(
        F.min_by("text", "turn").alias("hypothesis")
    )


def test_every_turn_is_a_hypothesis(spark):
    turns = spark.read.parquet(f"{DATA}/sf0.01/conversations.parquet")
    said = turns.filter("role = 'assistant'").count()
    assert hypotheses_of(turns).count() == stand_in_runs(turns).count() == said
    pairs = pair_references(hypotheses_of(turns), references_of(turns), group="conv_id")
    asked = turns.filter("role = 'user'").groupBy("conv_id").count()
    expected = turns.filter("role = 'assistant'").join(asked, "conv_id").agg(F.sum("count")).first()[0]
    assert pairs.count() == expected
    paired = pairs.select("item_id").distinct().count()
    assert paired + unmatched_turns(turns).filter("role = 'assistant'").count() == said


@pytest.mark.parametrize("roles", GOLDEN)
def test_golden_numbers(spark, roles):
    want = GOLDEN[roles]
    turns = spark.read.parquet(f"{DATA}/sf0.01/conversations.parquet")
    pairs = with_alnum(
        pair_references(first_turns(turns, roles[0]), references_of(turns, roles[1]), slots=True)
    ).cache()
    row = scores.bleu_counts(pairs, []).withColumns(
        {"first": scores.bleu_first_run(), "again": scores.bleu_recomputed()}
    ).first()
    assert [row[f"num_{n}"] for n in (1, 2, 3, 4)] == want["num"]
    assert [row[f"den_first_{n}"] for n in (1, 2, 3, 4)] == want["first"]
    assert [row[f"den_again_{n}"] for n in (1, 2, 3, 4)] == want["again"]
    assert (row["closest_ref"], row["shortest_ref"]) == want["refs"]
    assert (row["first"], row["again"]) == pytest.approx(want["bleu"], abs=1e-9)
    scored = scores.rouge(pairs)
    metrics = ["rouge1", "rouge2"]
    macro = scores.run_means(scores.item_means(scored, ["item_id"], metrics), [], metrics).first()
    assert tuple(macro) == pytest.approx(want["items"], abs=1e-6)
    by_slot = scores.slot_means(scored, [], metrics).first()
    assert by_slot["slots"] == 2
    assert (by_slot["rouge1"], by_slot["rouge2"]) == pytest.approx(want["slots"], abs=1e-6)
    if roles[0] == "assistant":
        exact = scores.meteor(pairs, stems=False)
        # The mean over all pairs was recorded to five decimals.
        assert round(exact.agg(F.avg("meteor")).first()[0], 5) == 0.10862
        items = scores.item_means(exact, ["item_id"], ["meteor"])
        assert scores.run_means(items, [], ["meteor"]).first()[0] == pytest.approx(0.108862, abs=1e-6)
    pairs.unpersist()


def test_slot_means_on_ragged_items(spark):
    rows = [("a", 1, 0, 0.2), ("a", 1, 1, 0.4), ("a", 2, 0, 0.6), ("a", 3, 0, 0.1), ("a", 3, 1, 0.2), ("a", 3, 2, 0.9)]
    df = spark.createDataFrame(rows, "model string, item_id bigint, slot bigint, rouge1 double")
    row = scores.slot_means(df, ["model"], ["rouge1"]).first()
    assert row.slots == 2  # slot 2 exists only beyond the first item's references
    assert row.rouge1 == pytest.approx(((0.2 + 0.6 + 0.1) / 3 + (0.4 + 0.2) / 2) / 2)
    assert [tuple(r) for r in scores.short_items(df, ["model"]).select("item_id", "references", "slots").collect()] == [(2, 1, 2)]
    assert scores.short_items(df, []).count() == 1
