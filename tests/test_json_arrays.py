import json
import random

import duckdb
import pyarrow as pa
import pytest

from textgauge.sources import captions, json_arrays

AWKWARD = [
    {"prompt": "h}{"}, {"a": "x}, {\"y\": [1]}", "b": ["]", "[", "\\", "\\\"", "\\\\}"]}, "plain, }{ string", 17, None, True, [], {},
    [[1, {"c": "}"}], "é漢\U0001f600}"], {"d": {"e": {"f": ["{", "}"] * 5}}}, "", "\"", "}" * 50, {"results": [1, 2]},
]


@pytest.fixture
def small_splits(spark):
    def at(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield at
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def read(spark, path, **options):
    rows = json_arrays.elements(spark, str(path), **options).collect()
    return [json.loads(r.element) for r in sorted(rows, key=lambda r: (r.file, r.block, r.no))]


def values(rng, depth=0):
    kind = rng.randrange(9 if depth < 4 else 5)
    if kind < 3:
        return "".join(rng.choice(['"', "\\", "}", "{", "[", "]", ",", "a", "é", "\n", " "]) for _ in range(rng.randrange(12)))
    if kind < 5:
        return rng.choice([None, True, 0, -1.5, 10**12])
    if kind < 7:
        return [values(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {str(values(rng, 9)): values(rng, depth + 1) for _ in range(rng.randrange(4))}


@pytest.mark.parametrize(("size", "indent"), [(9, None), (64, 2), (1 << 20, None)])
def test_elements_over_split_ends(spark, tmp_path, small_splits, size, indent):
    small_splits(size)
    (tmp_path / "a.json").write_text(json.dumps(AWKWARD, indent=indent, ensure_ascii=False))
    (tmp_path / "b.json").write_text("\n[ ]\n")
    assert read(spark, tmp_path) == AWKWARD


@pytest.mark.parametrize("end", ["}", ","])
def test_random_documents(spark, tmp_path, small_splits, end):
    small_splits(120)
    rng = random.Random(3)
    expected = []
    for i in range(6):
        doc = [values(rng) for _ in range(rng.randrange(30))]
        expected += doc
        (tmp_path / f"{i:02}.json").write_text(json.dumps(doc, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5))
    assert read(spark, tmp_path, end=end) == expected


@pytest.mark.parametrize("size", [19, 200])
def test_array_in_a_member(spark, tmp_path, small_splits, size):
    small_splits(size)
    doc = {"before": [1, {"results": [9]}], "bleu": 0.5, "results": AWKWARD, "x": {"results": [3, "}"]}, "after": ["a", "b"], "n": "]"}
    (tmp_path / "a.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"other": [1, 2, 3]}))
    assert read(spark, tmp_path, field="results") == AWKWARD
    outer = {r.file[-6:]: json.loads(r.document) for r in json_arrays.outer_documents(spark, str(tmp_path), "results").collect()}
    assert outer == {"a.json": {**doc, "results": []}, "b.json": {"other": [1, 2, 3]}}


def test_no_array(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    (tmp_path / "b.json").write_text('{"a": [1, 2]}')
    assert read(spark, tmp_path) == [] and read(spark, tmp_path, field="b") == []


def test_large_document_over_many_tasks(spark, tmp_path, small_splits):
    """One file of 6 MB in about 90 tasks, against another reader of JSON."""
    rng = random.Random(8)
    rows = [{"image_name": f"{i:06}.jpg", "generated_caption": str(values(rng, 9)) * 30 + str(i)} for i in range(18_000)]
    path = tmp_path / "large.json"
    path.write_text(json.dumps([{"prompt": "p}"}, *rows]))
    small_splits(64 << 10)
    assert json_arrays.pieces(spark, str(path)).rdd.getNumPartitions() > 60
    got = sorted((r.image_name, r.generated_caption) for r in captions.read_caption_files(spark, str(path)).collect())
    other = duckdb.execute(
        f"SELECT image_name, generated_caption FROM read_json('{path}', columns={{image_name: 'VARCHAR', "
        "generated_caption: 'VARCHAR', prompt: 'VARCHAR'}, maximum_object_size=100000000) WHERE prompt IS NULL ORDER BY 1"
    ).fetchall()
    assert got == other and len(got) == 18_000


def test_texts_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(AWKWARD))
    plan = json_arrays.elements(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    # Exchanges of one row per split, and of the parts of elements that cross splits.
    assert all("file" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert "SortMergeJoin" not in plan and "Generate" not in plan


def test_a_batch_is_looked_at_in_slices(monkeypatch):
    """However much text a batch holds, only a slice of it becomes Python objects at once, with the same elements."""
    texts = json.dumps([{"a": "x}\\" + "é" * 90, "n": i} for i in range(400)], ensure_ascii=False).split("}")[:-1]
    n = len(texts)
    columns = {"split": [7] * n, "file": ["f"] * n, "block": [0] * n, "inside": [False] * n, "depth": [0] * n, "tag": [""] * n, "value": texts}
    batch = pa.RecordBatch.from_pydict(columns)

    def cut():
        return [r for part in json_arrays._cut("}", 0, "[")(iter([batch])) for r in part.to_pylist()]

    whole, states = cut(), [r.to_pylist() for r in json_arrays._summaries("}")(iter([batch]))]
    monkeypatch.setattr(json_arrays, "_SLICE_BYTES", 2000)
    assert max(len(data) for *_, data in json_arrays._runs(iter([batch]), "}")) < 2000 + 400
    assert cut() == whole and sum(r["kind"] == "element" for r in whole) == 399
    assert [r.to_pylist() for r in json_arrays._summaries("}")(iter([batch]))] == states
