import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from llm_cases import AWKWARD, documents  # noqa: F401

from textgauge.llm.exact_dedup import digest_runs, exact_dedup, merge_level


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        sha = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()
        groups[sha].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    return {sha: (min(g)[3], len(g)) for sha, g in groups.items()}


@pytest.mark.parametrize("fan_in", [2, 3, 32])
def test_groups(spark, documents, fan_in):
    rows = AWKWARD + [(100 + i, f"copy {i % 4}\n" + " " * (i % 3)) for i in range(60)]
    docs = documents(rows, extra=("keep_id", "run", "sha", "norm")).repartition(9)
    got = exact_dedup(docs, fan_in=fan_in).collect()
    expected = brute(rows)
    assert len(got) == len(rows)
    assert {r.text_sha256: (r.keep_id, r.group_size) for r in got} == expected
    assert sorted(r.text_sha256 for r in got if r.kept) == sorted(expected)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_repeated_rows_leave_one(spark, documents):
    got = exact_dedup(documents([(1, "a b")] * 5).repartition(3)).collect()
    assert [r.kept for r in got].count(True) == 1 and {r.group_size for r in got} == {5}


def test_empty(spark, documents):
    assert exact_dedup(documents([])).count() == 0


def test_runs_are_merged_in_order_of_digests(spark, documents):
    """Both sides of a round's exchange sort digests and merge equal neighbours; there is no hash table of all digests."""
    runs = digest_runs(documents(AWKWARD)).withColumn("best", F.struct("doc_id", "row_no")).withColumn("size", F.lit(1))
    plan = merge_level(runs, F.col("run"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortAggregate") == 2 and "HashAggregate" not in plan and plan.count("Exchange") == 1


def test_no_python_in_the_plan(spark, documents):
    plan = exact_dedup(documents(AWKWARD))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
