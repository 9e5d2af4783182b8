import random

import pytest
from pyspark.sql import functions as F

from textgauge.functions import text as tx
from textgauge.operators import padded
from textgauge.plans import catalog
from textgauge.session import scratch_path
from textgauge.sources import sinks


@pytest.fixture(scope="module")
def batched(spark):
    rng = random.Random(6)
    lengths = [int(rng.lognormvariate(4, 1.2)) for _ in range(3000)] + [77] * 1500 + [0, 1, 50_000, 3_000_000]
    rows = [(i * 3, n) for i, n in enumerate(lengths)]
    return padded.padded_batches(spark.createDataFrame(rows, "id long, n long").repartition(4), "id", "n", tokens=4096).cache(), rows


def test_every_row_is_in_one_batch_under_the_budget(batched):
    df, rows = batched
    got = df.collect()
    assert sorted((r.id, r.n) for r in got) == rows
    groups = {}
    for r in got:
        groups.setdefault((r.length_class, r.batch), []).append(r)
        assert r.n <= r.padded_to or r.n > padded.LONGEST
    for members in groups.values():
        assert len(members) == 1 or len(members) * max(r.n for r in members) <= 4096
    # Batches of a class are full but for the last, and filled by id.
    for name in {c for c, _ in groups}:
        sizes = [len(groups[c, b]) for c, b in sorted(groups) if c == name]
        assert len(set(sizes[:-1])) <= 1 and sizes[-1] <= sizes[0]


def test_padding_is_bounded(batched):
    df, rows = batched
    share = padded.padding_share(df, "n").first()
    assert share.rows == len(rows) and 0 < share.padding < 0.1


def test_classes_grow_by_a_tenth(spark):
    ends = padded.class_ends()
    assert ends[:12] == list(range(1, 13)) and ends[-1] >= padded.LONGEST
    assert all(b <= max(a + 1, 1.1 * a) for a, b in zip(ends, ends[1:]))
    lengths = spark.createDataFrame([(n,) for n in (0, 1, 2, 20, 21, 22, 23)], "n long")
    assert [r[0] for r in lengths.select(padded.length_class(F.col("n"))).collect()] == [0, 0, 1, 19, 20, 20, 21]


def test_a_common_length_is_spread_over_tasks(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 500).otherwise(9).alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = padded.padded_batches(df, "id", "n", width=512).filter("n = 9").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(hot) == 4 and max(r["count"] for r in hot) < 8000


def test_model_sees_whole_batches(spark, batched):
    df, rows = batched

    def load():
        return lambda frame: frame["n"].max() - frame["n"]

    got = padded.apply_padded(df.filter("n < 5000"), load, ["id"], ["n"], "short_by long").collect()
    assert sorted(r.id for r in got) == [i for i, n in rows if n < 5000]
    assert all(r.short_by >= 0 for r in got)


def test_only_wanted_splits_are_opened(spark):
    df = catalog.f3_pruned_split(spark, "/root/testdata/sf0.001")
    assert "PartitionFilters: [isnotnull(lang" in df._jdf.queryExecution().executedPlan().toString()
    by_table = catalog.f3_pruned_by_table(spark, "/root/testdata/sf0.001")
    assert "dynamicpruning" in by_table._jdf.queryExecution().executedPlan().toString()


def test_a_large_split_is_many_sorted_files(spark):
    path = scratch_path(spark, "splits")
    rows = spark.range(8000).select("id", F.when(F.col("id") % 3 > 0, "train").otherwise("test").alias("split"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_by_split(rows, path, "split", "id")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(path).groupBy("split", F.col("_metadata.file_path").alias("f")).agg(F.min("id"), F.max("id"), F.count("*")).collect()
    train = sorted((r[2], r[3]) for r in files if r.split == "train")
    assert len(train) >= 2 and all(a[1] < b[0] for a, b in zip(train, train[1:])) and sum(r[4] for r in files) == 8000


@pytest.mark.parametrize(
    "text,tokens",
    [
        ("Hello, world.", "Hello , world ."),
        ("It's 3.5 or 1,000 (about) x-y 3-4 -5.", "It's 3.5 or 1,000 ( about ) x-y 3 - 4 -5 ."),
        ("a&amp;b &quot;c&quot; &lt;d&gt; <skipped>e", 'a & b " c " < d > e'),
        ("cut-\nword\nnext", "cutword next"),
        ("1. .5 5, ,6 a.b,c", "1 . . 5 5 , , 6 a . b , c"),
        ("$9.99! [x]{y}~`z`", "$ 9.99 ! [ x ] { y } ~ ` z `"),
        ("", ""),
    ],
)
def test_13a_tokens(spark, text, tokens):
    got = spark.createDataFrame([(text,)], "t string").select(tx.tokens_13a(F.col("t"))).first()[0]
    assert " ".join(got) == tokens
