import random

import pytest

from textgauge.operators.pairing import pair_references
from textgauge.plans import catalog, evaluation, statistics
from textgauge.session import scratch_path

RUN = ["model", "dataset"]
HOW = {"first": catalog.PLAIN_FIRST, "again": catalog.PLAIN_AGAIN}


def tables(spark, items, rng):
    say = lambda: " ".join(rng.choice(["a", "b", "c", "d", "e f", "g."]) for _ in range(rng.randrange(1, 9)))
    hyps = [(m, "d", i, say()) for i in items for m in ("m", "n")]
    refs = [(i, t, say()) for i in range(200) for t in range(1 + i % 4)]
    return (
        spark.createDataFrame(hyps, "model string, dataset string, item_id bigint, hypothesis string"),
        spark.createDataFrame(refs, "item_id bigint, ref_no bigint, reference string"),
    )


@pytest.mark.parametrize("name", HOW)
def test_added_replaced_and_removed_items(spark, name):
    how, path = HOW[name], scratch_path(spark, "statistics")
    hyps, refs = tables(spark, range(120), random.Random(1))
    statistics.write_statistics(pair_references(hyps, refs, True), how, RUN, path, 1, width=10)
    other, _ = tables(spark, range(200), random.Random(2))
    # Items 40 to 44 are replaced, 130 to 139 added, 70 to 79 and item 0 removed.
    now = hyps.filter("item_id NOT BETWEEN 40 AND 44 AND item_id NOT BETWEEN 70 AND 79 AND item_id > 0").unionByName(
        other.filter("item_id BETWEEN 40 AND 44 OR item_id BETWEEN 130 AND 139")
    )
    changed = statistics.changed_blocks(spark.range(200).toDF("item_id").filter("item_id IN (0, 42) OR item_id BETWEEN 70 AND 79 OR item_id BETWEEN 130 AND 139"), 10)
    assert changed.count() == 4
    late = statistics.with_block(now, 10).join(changed, "item_block", "left_semi").drop("item_block")
    assert late.count() < 0.3 * now.count()
    statistics.write_statistics(pair_references(late, refs, True), how, RUN, path, 2, changed, width=10)
    got = {r.model: r for r in statistics.summary_of_statistics(spark, path, how, RUN).collect()}
    expected = {r.model: r for r in evaluation.run_summary(pair_references(now, refs, True), how, RUN).collect()}
    assert set(got) == {"m", "n"}
    for model, r in expected.items():
        for metric in ("bleu", "rouge1", "rouge2", "meteor"):
            assert got[model][metric] == pytest.approx(r[metric], abs=1e-12)
        assert got[model].metric_def == how.name
