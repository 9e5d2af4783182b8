"""Language identification and the quality classifier: held-out accuracy, and awkward rows."""

import numpy as np
import pytest
from conftest import DATA
from llm_cases import AWKWARD, documents  # noqa: F401
from pyspark.sql import functions as F

from textgauge.llm import language, quality, queries

SF = f"{DATA}/sf0.1"


def test_grams_of_each_text_alone():
    texts = ["", "Abc d", "12 !", "ñandú über", "a", "word " * 500, "x-y\x00z"]
    together = language.gram_counts(texts)
    for text, counts in zip(texts, together):
        assert (language.gram_counts([text])[0] == counts).all()
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        # A word of n letters has n + 1 bigrams and n trigrams with its two ends.
        assert counts.sum() == sum(2 * len(w) + 1 for w in words)


def test_language_held_out(spark):
    found = queries.op5_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").toPandas()
    held = found[found.held_out]
    assert len(held) > 2000 and (held.lang == held.lang_pred).mean() > 0.98
    assert found.score.between(0, 1).all() and found.rejected.mean() < 0.01


def test_far_texts_are_rejected(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    model = language.learn(docs, F.lit(False))
    texts = [(1, "Съешь же ещё этих мягких французских булок, да выпей чаю. " * 5), (2, "漢字" * 50), (3, docs.first().text)]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert got[1].rejected and got[2].rejected and not got[3].rejected


def test_mislabelled_rows_do_not_open_a_language(spark):
    """Two in a hundred texts of a language are of another script: they are rejected though they were learned from."""
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("aeilnorst"), n)) for n in rng.integers(2, 9, 300)]
    strange = ["".join(rng.choice(list("абвгдежз"), n)) for n in rng.integers(2, 9, 300)]
    rows = [(i, " ".join(rng.choice(strange if i % 50 == 0 else words, 80)), "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.identify(docs, language.learn(docs, F.lit(False))).collect()
    assert all(r.rejected for r in got if r.doc_id % 50 == 0)
    assert np.mean([r.rejected for r in got if r.doc_id % 50]) < 0.01


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_language_awkward(spark, documents, rows):  # noqa: F811
    docs = documents(rows, extra=("label", "lang_pred"))
    got = language.identify(docs, language.learn(docs, F.lit(False))).collect()
    assert len(got) == len(rows)
    unknown = [r for r in got if r.lang_pred == "und"]
    assert len(unknown) == sum(not any(c.isalpha() for c in t or "") for _, t in rows)
    assert all(r.score == 0 and r.rejected for r in unknown)


def _slow_vector(text, idf):
    """Weights of hashed bigrams and trigrams, gram by gram."""
    counts, mask = {}, 0xFFFFFFFF
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    for word in words:
        codes = [0, *map(ord, word), 0]
        for a, b in zip(codes, codes[1:]):
            h = ((a * 0x9E3779B1 + b * 0x85EBCA77) & mask) ^ 0x5BD1E995
            counts[(h * 0x9E3779B1 & mask) >> 20] = counts.get((h * 0x9E3779B1 & mask) >> 20, 0) + 1
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            h = ((a * 0x9E3779B1 + b * 0x85EBCA77) & mask) * 0xC2B2AE3D + c * 0x27D4EB2F & mask
            counts[(h * 0x9E3779B1 & mask) >> 20] = counts.get((h * 0x9E3779B1 & mask) >> 20, 0) + 1
    weights = {p: np.log1p(n) * float(idf[p]) for p, n in counts.items()}
    norm = max(sum(w * w for w in weights.values()) ** 0.5, 1e-9)
    return {p: w / norm for p, w in weights.items()}


def test_predictions_gram_by_gram(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").unionByName(
        spark.createDataFrame([(10**6, "Съешь ещё французских булок"), (10**6 + 1, "12 !"), (10**6 + 2, None)], "doc_id long, text string"),
        allowMissingColumns=True,
    )
    model = language.learn(docs, F.lit(False))
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    for r in docs.collect():
        vector = _slow_vector(r.text, model["idf"])
        if not vector:
            assert got[r.doc_id].lang_pred == "und" and got[r.doc_id].score == 0
            continue
        cosines = [sum(w * float(point[p]) for p, w in vector.items()) for point in model["points"]]
        best = int(np.argmax(cosines))
        assert got[r.doc_id].score == pytest.approx(min(1, max(0, cosines[best])), abs=1e-4)
        if sorted(cosines)[-1] - sorted(cosines)[-2] > 1e-4:
            assert got[r.doc_id].lang_pred == model["labels"][best]
        if abs(1 - cosines[best] - model["reach"][best]) > 1e-4:
            assert got[r.doc_id].rejected == (1 - cosines[best] > model["reach"][best])


def test_thousands_of_languages(spark):
    docs = spark.range(6000).selectExpr(
        "id as doc_id", "concat(repeat(concat(md5(string(id % 5000)), ' '), 3), translate(md5(string(id % 5000)), '0123456789', 'ghijklmnop')) as text",
        "concat('l', id % 5000) as lang",
    )
    model = language.learn(docs, F.lit(False))
    assert len(set(model["labels"])) == 5000
    some = docs.filter("doc_id % 100 = 0")
    wrong = language.identify(some, model).join(some, "doc_id").filter("lang != lang_pred").count()
    assert wrong == 0


def test_one_id_for_all_rows(spark):
    """The sample of a language is as large as it should be, whatever ids repeat."""
    for doc_id in (34, 35):
        docs = spark.range(5000).selectExpr(f"{doc_id}L as doc_id", "concat('some words ', if(id < 4000, '', string(md5(string(id))))) as text", "'en' as lang")
        rows = language._sampled(language.with_row_id(docs))
        assert rows.count() == 5000 and rows.filter("sampled").count() == language.SAMPLE
        assert language.identify(docs, language.learn(docs, F.lit(False))).filter("lang_pred = 'en'").count() == 5000


def test_nothing_to_learn_from(spark, documents):  # noqa: F811
    docs = documents([(1, "some words", None, "s")])
    assert [r.lang_pred for r in language.identify(docs, language.learn(docs, F.lit(False))).collect()] == ["und"]


def test_each_distance_is_worked_out_once(spark, documents, monkeypatch):  # noqa: F811
    """A second call of the same function would need one more Python worker for each task."""
    plans, store = {}, language.stored

    def noted(df, name, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, name, **options)

    monkeypatch.setattr(language, "stored", noted)
    rows = [(i, f"some words of a text {'abc' * (i % 7)}", "en", "s") for i in range(40)]
    rows += [(90 + i, f"{i} 12 !", lang, "s") for i in range(3) for lang in ("en", "xx")]
    model = language.learn(documents(rows), F.lit(False))
    assert plans["own-distances"].count("ArrowEvalPython") == 1
    # Texts without letters have no distance, and a language of nothing else is none.
    far = language.own_distances(model, ["en"] * 40, [r[1] for r in rows[:40]])
    reach = np.median(far) + language.DEVIATIONS * max(1.4826 * np.median(np.abs(far - np.median(far))), language.LEAST_DEVIATION)
    assert set(model["labels"]) == {"en"} and model["reach"] == pytest.approx(min(reach, language.FARTHEST), abs=0.05)


def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = queries.op4_quality_classifier(spark, SF).join(labels, "doc_id").toPandas()
    held = found[found.held_out]
    assert len(held) > 500 and (held.predicted == held.quality).mean() > 0.98
    assert (found.predicted == (found.score >= 0.3)).all() and found.score.between(0, 1).all()


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert ((quality.score(model, x) > 0.5) == y).mean() > 0.95
    assert {0, 1} in [{i, j} for i, j, _ in model["pairs"]]


def test_trees_split_where_it_helps():
    assert quality._tree(np.array([-4.0, -4, 4, 4]), np.ones(4), 2).tolist() == pytest.approx([-8 / 3] * 2 + [8 / 3] * 2)


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_quality_awkward(spark, documents, rows):  # noqa: F811
    table = quality.with_features(documents(rows, extra=("x", "y", "score")))
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (None, 1), (99, 1), (5, None)], "doc_id long, quality int")
    for known in (labels, labels.filter("quality = 1"), labels.filter("false")):
        model = quality.learn(table, quality.labelled(known, F.lit(False)))
        got = quality.scored(table, model).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)


def test_sample_of_labels_is_exact(spark):
    labels = spark.range(50_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    assert quality.labelled(labels, F.lit(False), 2000).count() == 2000
    assert quality.labelled(labels.limit(1500), F.lit(False), 2000).count() == 1500


def test_one_id_for_all_labels_and_rows(spark):
    """Neither is its label lost nor are 3,000 rows multiplied by 5,000 labels."""
    labels = spark.range(5000).select(F.lit(34).alias("doc_id"), (F.col("id") % 5 > 0).cast("int").alias("quality"))
    known = quality.labelled(labels, F.lit(False), 100)
    assert sorted((r.y, r.weight) for r in known.collect()) == [(0, 1000.0), (1, 4000.0)]
    rows = quality.with_features(spark.range(3000).selectExpr("34L as doc_id", "concat('word ', id % 7) as text"))
    model = quality.learn(rows, known, 200)
    assert abs(quality.scored(rows, model).first().score - 0.8) < 0.02


def _slow_score(model, x):
    """The sum of one entry of every table, cell by cell."""
    cell = [sum(v >= edge for edge in edges) for v, edges in zip(x, model["edges"])]
    total = model["start"] + sum(t[c] for t, c in zip(model["tables"], cell))
    total += sum(table[cell[i], cell[j]] for i, j, table in model["pairs"])
    return 1 / (1 + np.exp(-total))


def test_scores_are_sums_of_table_entries(spark):
    rows = quality.with_features(spark.read.parquet(f"{DATA}/sf0.001/documents.parquet"))
    labels = spark.read.parquet(f"{DATA}/sf0.001/labels.parquet")
    model = quality.learn(rows, quality.labelled(labels, F.lit(False)))
    got = {r.doc_id: r.score for r in quality.scored(rows, model).collect()}
    assert len(model["pairs"]) == quality.PAIRS
    for r in rows.collect():
        assert got[r.doc_id] == pytest.approx(_slow_score(model, r.x), abs=1e-12)


def test_weights_count_as_repeats():
    rng = np.random.default_rng(5)
    # Few values, so that both have the same bins.
    x, y = rng.integers(0, 6, (300, 3)).astype(float), (rng.random(300) > 0.4).astype(float)
    weight = rng.integers(1, 4, 300).astype(float)
    once, repeated = quality.fit(x, y, weight), quality.fit(np.repeat(x, weight.astype(int), axis=0), np.repeat(y, weight.astype(int)))
    assert once["start"] == pytest.approx(repeated["start"])
    assert abs(quality.score(once, x) - quality.score(repeated, x)).max() < 1e-6
