import hashlib
import re

import corpus_pipeline
from conftest import DATA
from llm_cases import AWKWARD, documents  # noqa: F401
from pyspark.sql import functions as F
from test_simhash import slow_components, slow_print
from textgauge.llm import language, rules
from textgauge.llm.common import stored

SF = f"{DATA}/sf0.01"
STAGES = dict(corpus_pipeline.STAGES)


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], SF), name))
        if name != "best_fit_packing":
            assert kept[-1].columns == columns
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    gone = {r.doc_id for r in language.identify(docs, language.learn(docs, F.lit(False))).filter("rejected").collect()}
    assert ids[1] == ids[0] - gone
    assert ids[2] == ids[1] - {r.doc_id for r in rules.quality_rules(kept[1]).filter("not kept").collect()}
    seen = {}
    for r in sorted(kept[2].collect(), key=lambda r: (-len(r.text), r.doc_id)):
        seen.setdefault(hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", r.text).encode()).digest(), r.doc_id)
    assert ids[3] == set(seen.values())
    prints = [(r.doc_id, slow_print(r.text, 3)) for r in kept[3].select("doc_id", "text").collect()]
    assert ids[4] == set(slow_components(prints).values()) and ids[5] == ids[4]
    whole = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length", "ids_crc32").collect()
    assert sorted(whole) == sorted(kept[5].select("doc_id", "piece", "length", "ids_crc32").collect())


def test_rows_are_told_apart_without_ids(spark, documents):  # noqa: F811
    rows = [*AWKWARD, (1, "plain words and more words"), (None, "a b c d"), (None, "a b c d"), (None, "e f g h")]
    docs = documents(rows, extra=("kept", "component_id", "run"))
    once = STAGES["exact_dedup"](spark, docs, "").collect()
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in once]
    assert sorted(texts) == sorted({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows})
    near = STAGES["simhash_near_dedup"](spark, docs, "")
    assert near.columns == docs.columns
    assert sorted(r.text for r in near.filter("doc_id IS NULL AND text IS NOT NULL").collect()) == ["a b c d", "e f g h", "no id at all"]


def test_columns_named_like_row_ids(spark, documents):  # noqa: F811
    """A table with columns that the stages use themselves goes through all of them, and keeps these columns."""
    rows = [(i, " ".join(f"word{(i * 7 + j) % 50} is here" for j in range(40)), "en", "s") for i in range(40)]
    docs = documents(rows, extra=("__row", "__ROW_", "x", "salt", "sampled", "label"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, ""), name)
        assert after.columns == docs.columns and 0 < after.count() <= docs.count()
        assert all(r["__row"] == r["__ROW_"] == str(r.doc_id) for r in after.collect())
        docs = after


def test_empty(spark, documents):  # noqa: F811
    docs = documents([])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0
