import json
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from textgauge.operators import runs
from textgauge.operators.apply_model import apply_model
from textgauge.session import scratch_path
from textgauge.sources import captions, sinks

HEADER = "<|user|><|image_1|>Describe.<|end|><|assistant|>"


def caption_file(path, count, prompt):
    rows = [{"image_name": f"{i:06d}.jpg", "generated_caption": f"caption {i}"} for i in range(1, count + 1)]
    path.write_text(json.dumps([{"prompt": prompt}, *rows], indent=2))


def test_caption_files_with_headers(spark, tmp_path):
    caption_file(tmp_path / "a.json", 5, HEADER)
    caption_file(tmp_path / "b.json", 4, "other")
    rows = captions.read_caption_files(spark, str(tmp_path)).collect()
    assert len(rows) == 9
    assert {(r.file.rsplit("/", 1)[1], r.prompt) for r in rows} == {("a.json", HEADER), ("b.json", "other")}
    assert all(r.image_name and r.generated_caption for r in rows)
    out = scratch_path(spark, "captions")
    sinks.write_captions(captions.read_caption_files(spark, str(tmp_path)), out)
    assert captions.read_caption_rows(spark, out).count() == 9


def test_run_document(spark, tmp_path):
    items = [
        {"image_id": i, "generated_caption": f"g{i}", "reference_captions": [f"r{i}{j}" for j in range(n)],
         "rouge1": 0.1 * i, "rouge2": 0.0, "meteor": 0.2}
        for i, n in enumerate((2, 1, 3))
    ]
    doc = {"corpus_bleu": 0.3, "average_rouge1": 0.1, "average_rouge2": 0.0, "average_meteor": 0.2, "results": items}
    (tmp_path / "run.json").write_text(json.dumps(doc, indent=2))
    rows = captions.read_run_items(spark, str(tmp_path)).select("image_id", "reference_captions", "generated_caption").collect()
    assert sorted((r.image_id, len(r.reference_captions)) for r in rows) == [(0, 2), (1, 1), (2, 3)]
    assert captions.read_run_summaries(spark, str(tmp_path)).first().corpus_bleu == 0.3


def test_file_list_is_sorted_and_reads_no_content(spark, tmp_path):
    for name in ("b.jpg", "a.jpg", "c.png", "d.JPG"):
        (tmp_path / name).write_bytes(b"x")
    files = captions.list_files(spark, str(tmp_path))
    assert [r.path.rsplit("/", 1)[1] for r in files.collect()] == ["a.jpg", "b.jpg"]
    assert "content" not in files.schema.names


def test_template_with_crlf(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes(b"ID,Answer\r\n" + b"".join(b"%d,10\r\n" % i for i in range(5)))
    template = captions.read_template(spark, str(tmp_path / "t.csv"))
    answers = spark.createDataFrame([(1, 7), (3, 0), (99, 5)], "ID int, Answer int")
    out = scratch_path(spark, "filled")
    sinks.write_template(sinks.fill_template(template, answers), out)
    assert sorted(map(tuple, captions.read_template(spark, out).collect())) == [
        (0, 10), (1, 7), (2, 10), (3, 0), (4, 10),
    ]


def test_summary_versions(spark):
    path = scratch_path(spark, "summary")
    first = spark.createDataFrame([("m", "d", 0.1), ("n", "d", 0.2)], "model string, dataset string, rouge1 double")
    sinks.append_summary(first, path, 1)
    sinks.append_summary(first.filter("model = 'm'").withColumn("rouge1", F.lit(0.5)), path, 2)
    got = {r.model: (r.rouge1, r.version) for r in sinks.read_summaries(spark, path, runs.RUN).collect()}
    assert got == {"m": (0.5, 2), "n": (0.2, 1)}
    with pytest.raises(Exception, match="already exists"):
        sinks.append_summary(first, path, 1)


def test_storing_chunks_twice_adds_nothing(spark):
    chunks = spark.createDataFrame([("a",), ("b",), ("a",)], "chunk_text string")
    assert sinks.with_chunk_id(chunks).count() == 2
    assert sinks.with_chunk_id(chunks.union(chunks)).count() == 2


def test_run_items_are_pruned_by_run(spark):
    items = spark.createDataFrame([("m", "d1", 1, 0.1), ("m", "d2", 2, 0.2)], "model string, dataset string, item_id bigint, rouge1 double")
    path = scratch_path(spark, "items")
    sinks.write_run_items(items, path)
    read = spark.read.schema(items.schema).json(path).filter("dataset = 'd2'")
    assert [r.item_id for r in read.collect()] == [2]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset" in plan


# Published quality scores of two models on two datasets, used here as input rows only.
SCORES = {
    ("A", "coco"): (0.3237, 0.4023, 0.1594, 0.2776), ("A", "flickr"): (0.2398, 0.3206, 0.1091, 0.2033),
    ("B", "coco"): (0.2560, 0.3971, 0.1517, 0.3325), ("B", "flickr"): (0.2658, 0.3636, 0.1400, 0.3043),
}
METRICS = ["bleu", "rouge1", "rouge2", "meteor"]


@pytest.fixture(scope="module")
def published(spark):
    rows = [(*key, *values) for key, values in SCORES.items()]
    wide = spark.createDataFrame(rows, "model string, dataset string, bleu double, rouge1 double, rouge2 double, meteor double")
    return runs.long_scores(wide, METRICS)


def test_cross_tab(published):
    table = {r.model: r for r in runs.cross_tab(published, ["coco", "flickr"], METRICS).collect()}
    assert table["A"].coco_bleu == 0.3237 and table["B"].flickr_meteor == 0.3043


def test_best_models(published):
    best = {(r.dataset, r.metric): (r.best_model, round(r.margin, 4)) for r in runs.best_models(published).collect()}
    assert {k for k, v in best.items() if v[0] == "B"} == {("coco", "meteor"), *(("flickr", m) for m in METRICS)}
    assert best["coco", "bleu"] == ("A", 0.0677)


def test_dataset_means(published):
    means = {(r.dataset, r.metric): r.mean_value for r in runs.dataset_means(published).collect()}
    assert means["coco", "bleu"] == pytest.approx(0.28985) and means["flickr", "bleu"] == pytest.approx(0.2528)


def test_compare_and_richer_but_lower(spark):
    rows = [
        ("a", "d", 1, "short", 0.5, 0.5), ("b", "d", 1, "much longer", 0.1, 0.2),
        ("a", "d", 2, "short", 0.5, 0.1), ("b", "d", 2, "much longer", 0.1, 0.2),
        ("a", "d", 3, "a long one here", 0.1, 0.1), ("b", "d", 3, "short", 0.2, 0.2),
    ]
    items = spark.createDataFrame(rows, "model string, dataset string, item_id int, hypothesis string, rouge2 double, meteor double")
    compared = runs.compare_models(items, "a", "b", ["rouge2", "meteor"])
    found = runs.richer_but_lower(compared, ["rouge2", "meteor"])
    assert sorted((r.item_id, r.richer) for r in found.collect()) == [(1, "b"), (3, "a")]


def test_stale_summary_is_flagged(spark):
    items = spark.createDataFrame([("m", "d", 1, 0.2), ("m", "d", 2, 0.4), ("n", "d", 1, 0.5)], "model string, dataset string, item_id int, rouge1 double")
    summary = spark.createDataFrame([("m", "d", 0.3), ("n", "d", 0.9)], "model string, dataset string, rouge1 double")
    flags = {r.model: r.stale for r in runs.stale_summaries(summary, items, ["rouge1"]).collect()}
    assert flags == {"m": False, "n": True}


def test_blocked_results_keep_every_item(spark):
    rows = [("m", "d", i, f"c{i}") for i in range(23)]
    items = spark.createDataFrame(rows, "model string, dataset string, row_id bigint, generated_caption string")
    nested = runs.blocked_results(items, 10, ["generated_caption"]).collect()
    assert sorted((r.batch, len(r.results)) for r in nested) == [(0, 10), (1, 10), (2, 3)]
    assert sorted(x.generated_caption for r in nested for x in r.results) == sorted(r[3] for r in rows)


def test_model_gets_batches_and_keys_stay(spark):
    df = spark.range(47).selectExpr("id as k", "cast(id as string) as text").repartition(3)

    def load():
        def predict(batch):
            assert list(batch.columns) == ["text"] and len(batch) <= 10
            return pd.DataFrame({"n": batch["text"].str.len(), "size": len(batch)})

        return predict

    out = apply_model(df, load, ["k"], ["text"], "n INT, size INT").collect()
    assert sorted((r.k, r.n) for r in out) == [(i, len(str(i))) for i in range(47)]

    def load_with_mark():
        mark = uuid.uuid4().hex
        return lambda batch: pd.Series([mark] * len(batch))

    many = spark.range(64).selectExpr("id as k", "'x' as text").repartition(64)
    marks = apply_model(many, load_with_mark, ["k"], ["text"], "mark STRING", name="marked").collect()
    assert len(marks) == 64 and len({r.mark for r in marks}) <= 16  # loads per worker, not per task
    bad = apply_model(df, lambda: lambda b: pd.Series(["x"] * (len(b) + 1)), ["k"], ["text"], "y STRING")
    with pytest.raises(Exception, match="returned"):
        bad.collect()
