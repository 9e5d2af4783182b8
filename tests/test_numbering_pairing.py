import random

from pyspark.sql import functions as F

from textgauge.operators import numbering, pairing


def test_dense_index_over_partitions(spark):
    values = random.Random(1).sample(range(10_000), 3000)
    df = spark.createDataFrame([(v, f"k{v:05d}") for v in values], "v int, k string").repartition(7)
    for order in ("v", "k"):
        rows = numbering.dense_index(df, order).orderBy("row_id").collect()
        assert [r.row_id for r in rows] == list(range(3000))
        assert [r.v for r in rows] == sorted(values)


def test_index_in_group_with_a_hot_group(spark):
    hot = [("hot", t) for t in range(0, 5000, 2)]
    rows = hot + [(f"g{i}", t) for i in range(50) for t in (3, 9, 4096)]
    df = spark.createDataFrame(rows, "g string, t bigint").repartition(6)
    got = {(r.g, r.t): r.i for r in numbering.index_in_group(df, ["g"], "t", "i", width=64).collect()}
    assert len(got) == len(rows)
    assert all(got["hot", t] == t // 2 for t in range(0, 5000, 2))
    assert all((got[f"g{i}", 3], got[f"g{i}", 9], got[f"g{i}", 4096]) == (0, 1, 2) for i in range(50))


def test_pairs_of_a_hot_item_spread_over_blocks(spark):
    refs = [(1, t, f"r{t}") for t in range(0, 3000, 3)] + [(i, t, "x") for i in range(2, 60) for t in (1, 5)]
    hyps = [(m, i, f"{m}-{i}") for m in "ab" for i in range(1, 70)]
    references = spark.createDataFrame(refs, "item_id bigint, ref_no bigint, reference string")
    hypotheses = spark.createDataFrame(hyps, "model string, item_id bigint, hypothesis string")
    pairs = pairing.pair_references(hypotheses, references, slots=True, width=32)
    rows = pairs.collect()
    assert len(rows) == 2 * len(refs)
    assert all(r.hypothesis == f"{r.model}-{r.item_id}" for r in rows)
    assert {(r.slot, r.ref_no) for r in rows if r.item_id == 1} == {(t // 3, t) for t in range(0, 3000, 3)}
    assert {(r.slot, r.ref_no) for r in rows if r.item_id == 5} == {(0, 1), (1, 5)}
    plain = pairing.pair_references(hypotheses, references, width=32)
    assert plain.count() == len(rows) and "slot" not in plain.columns


def test_scoring_tasks_grow_with_the_characters_in_pairs(spark):
    refs = [(1, t, "r" * 10) for t in range(20)] + [(2, 0, "rr"), (3, 0, "no hypothesis")]
    hyps = [(1, "h" * 7)] * 3 + [(2, "h"), (4, "no reference")]
    references = spark.createDataFrame(refs, "item_id bigint, ref_no bigint, reference string")
    hypotheses = spark.createDataFrame(hyps, "item_id bigint, hypothesis string")
    characters = 3 * 20 * (10 + 7) + 3
    assert pairing.scoring_tasks(hypotheses, references, "item_id", 1) == characters
    assert pairing.scoring_tasks(hypotheses, references, "item_id", 10) == -(-characters // 10)
    cores = spark.sparkContext.defaultParallelism
    assert pairing.scoring_tasks(hypotheses, references, "item_id") == cores
    assert pairing.scoring_tasks(hypotheses.limit(0), references, "item_id") == cores
    dealt = pairing.pair_references(hypotheses, references, tasks=9)
    assert dealt.count() == 61 and dealt.rdd.getNumPartitions() == 9


def test_blocked_references_and_back(spark):
    refs = [(1, t, f"r{t}") for t in range(25)] + [(2, 7, "only")]
    references = spark.createDataFrame(refs, "item_id bigint, ref_no bigint, reference string")
    blocked = pairing.blocked_references(pairing.number_slots(references), size=10)
    sizes = {(r.item_id, r.block): len(r.reference_captions) for r in blocked.collect()}
    assert sizes == {(1, 0): 10, (1, 1): 10, (1, 2): 5, (2, 0): 1}
    back = pairing.explode_references(blocked).withColumn("slot", F.col("block") * 10 + F.col("slot"))
    assert {(r.item_id, r.slot, r.reference) for r in back.collect()} == {
        *((1, t, f"r{t}") for t in range(25)), (2, 0, "only"),
    }


def test_coverage_reports_what_position_pairing_hides(spark):
    images = spark.createDataFrame([(f"{i:06d}.jpg",) for i in range(1, 6)], "image_name string")
    described = spark.createDataFrame(
        [(f"{i:06d}.jpg", f"caption {i}") for i in (1, 2, 4, 5)], "image_name string, caption string"
    )
    by_key = pairing.pair_by_key(images, described, "image_name").collect()
    assert all(r.caption == f"caption {int(r.image_name[:6])}" for r in by_key)
    a, b = numbering.dense_index(images, "image_name"), numbering.dense_index(described, "image_name")
    by_place = a.join(b.drop("image_name"), "row_id").collect()
    assert any(r.caption != f"caption {int(r.image_name[:6])}" for r in by_place)
    flags = {r.image_name: (r.in_left, r.in_right) for r in pairing.coverage(images, described, "image_name").collect()}
    assert flags["000003.jpg"] == (True, False) and sum(v == (True, True) for v in flags.values()) == 4
    assert [r.image_name for r in pairing.missing_keys(images, described, "image_name").collect()] == ["000003.jpg"]
