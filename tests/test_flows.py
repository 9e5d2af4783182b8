"""The whole flows on small inputs, with stand-in models."""

import pandas as pd
import pytest
from formulas import bleu, meteor, rouge
from pyspark.sql import functions as F

from textgauge.functions.stem import porter
from textgauge.operators.contexts import ungrounded
from textgauge.plans import captioning, evaluation, retrieval

ITEMS = [
    ("m", 1, "a cat sits on the mat", ["the cat sat on a mat", "A cat is sitting on the mat."]),
    ("m", 2, "two dogs running in the park", ["dogs run in a park", "Two dogs, running!"]),
    ("m", 3, "nothing alike", ["wholly other words", "not the same"]),
]


def frame(spark):
    return spark.createDataFrame(
        ITEMS, "model string, item_id bigint, hypothesis string, reference_captions array<string>"
    )


def mean(values):
    values = list(values)
    return sum(values) / len(values)


def test_first_run_summary(spark):
    row = evaluation.run_summary(
        evaluation.pairs_of_items(frame(spark)), evaluation.FIRST_RUN, ["model"]
    ).first()
    tokens = [(h.split(), [r.split() for r in refs]) for _, _, h, refs in ITEMS]

    def stems(text):
        import re

        return [porter(w) if len(w) > 3 else w for w in re.findall("[a-z0-9]+", text.lower())]

    assert row.bleu == pytest.approx(bleu(tokens, True))
    for n, got in ((1, row.rouge1), (2, row.rouge2)):
        want = mean(mean(rouge(stems(h), stems(r), n) for r in refs) for _, _, h, refs in ITEMS)
        assert got == pytest.approx(want)
    want = mean(
        mean(meteor(h.lower().split(), r.lower().split(), porter)[2] for r in refs)
        for _, _, h, refs in ITEMS
    )
    assert row.meteor == pytest.approx(want)
    assert row.metric_def == "first_run"
    with pytest.raises(ValueError, match="run column"):
        evaluation.run_summary(evaluation.pairs_of_items(frame(spark)), evaluation.FIRST_RUN, [])


def test_recomputed_summary(spark):
    import string

    def clean(text):
        return text.lower().translate(str.maketrans("", "", string.punctuation))

    row = evaluation.run_summary(
        evaluation.pairs_of_items(frame(spark)), evaluation.RECOMPUTED, ["model"]
    ).first()
    items = [(clean(h).split(), [clean(r).split() for r in refs]) for _, _, h, refs in ITEMS]
    assert row.bleu == pytest.approx(bleu(items, False))
    assert row.rouge1 == pytest.approx(
        mean(mean(rouge(h, refs[slot], 1) for h, refs in items) for slot in (0, 1))
    )
    assert row.meteor == pytest.approx(
        mean(mean(meteor(h, refs[slot], porter)[2] for h, refs in items) for slot in (0, 1))
    )


def test_images_to_jobs(spark, tmp_path):
    for number in range(1, 24):
        (tmp_path / f"{number:06d}.jpg").write_bytes(b"x" * number)
    (tmp_path / "notes.txt").write_text("no image")

    def load():
        def predict(batch: pd.DataFrame) -> pd.Series:
            assert len(batch) <= 10
            return batch["prompt"] + "size " + batch["content"].str.len().astype(str) + "<|end|>"

        return predict

    images = captioning.read_images(spark, str(tmp_path))
    captions = captioning.caption_images(images, load, "Caption the image in one sentence.")
    rows = {r.image_name: r for r in captions.collect()}
    assert len(rows) == 23 and rows["000007.jpg"].generated_caption == "size 7"
    assert rows["000007.jpg"].prompt.endswith("<|assistant|>")
    jobs = {r.image_name: r for r in captioning.styling_jobs(images, captions, "out").collect()}
    assert jobs["000009.jpg"].path.endswith("000009.jpg")
    assert jobs["000009.jpg"].prompt.endswith(":\n\nsize 9")
    assert jobs["000009.jpg"].output == "out/000009_styled.png"
    assert captioning.drawing_jobs(captions, "out").filter("output = 'out/000023_diff3.jpg'").count() == 1


def test_questions_to_answers(spark):
    documents = spark.createDataFrame(
        [(1, "the cat sat on the mat " * 30), (2, "ships sail the wide sea " * 30), (3, "the cat sat on the mat " * 30)],
        "doc_id bigint, text string",
    )
    questions = spark.createDataFrame([(1, "ships sea"), (2, "cat mat")], "item_id bigint, text string")
    store = retrieval.chunk_store(documents)
    assert store.count() < 6  # the copy adds no chunk
    asked = retrieval.prompts(questions, store, k=1).cache()
    by_key = {(r.item_id, r["mode"]): r for r in asked.collect()}
    assert "ships sail" in by_key[1, "grounded"].prompt and "cat" not in by_key[1, "grounded"].context
    assert by_key[2, "ungrounded"].prompt == "cat mat" and by_key[2, "ungrounded"].context is None
    made = retrieval.answers(asked, lambda: lambda batch: batch["prompt"].str.len().astype(str)).collect()
    assert len(made) == 4 and all(r.answer == str(len(by_key[r.item_id, r["mode"]].prompt)) for r in made)
    assert ungrounded(questions, "item_id", "text").filter(F.col("context").isNull()).count() == 2
