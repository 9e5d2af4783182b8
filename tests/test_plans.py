"""What the plans must and must not contain."""

import pytest
from conftest import DATA
from pyspark.sql import functions as F

import __spark_entry__ as entry
from textgauge.plans import catalog

SF = f"{DATA}/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as for sides too large to broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


LAZY = sorted(
    set(entry.queries())
    - {  # these run jobs before they return
        "k1_run_items", "k1_run_summary", "k2_captions_with_prompt", "k3_recomputed_from_store", "k3_newest_summary", "k4_chunk_store",
        "k5_filled_template", "s2_caption_files", "s3_run_documents", "u1_both_modes", "a12_context",
        "p9_grounded_prompt", "rag_answers", "rag_sources",
    }
)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join(spark, name, no_broadcast):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_two_columns_and_filters(spark):
    df = catalog.f3_split(spark, SF)
    scan = [line for line in plan_of(df).splitlines() if "FileScan" in line][0]
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in scan
    assert "ReadSchema: struct<doc_id:bigint,lang:string,n_chars:bigint>" in scan


def test_top_k_is_cut_before_the_shuffle(spark):
    plan = plan_of(catalog.o2_top_k(spark, SF))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_grams_never_leave_the_row_uncounted(spark, no_broadcast):
    """Between the join of texts and the scores lies one shuffle of matched grams, already reduced."""
    plan = plan_of(catalog.a1_corpus_bleu_first_run(spark, SF))
    by_gram = [i for i, line in enumerate(plan.splitlines()) if "hashpartitioning(model" in line and "gram" in line]
    assert len(by_gram) == 1
    assert "partial_max(shared" in plan.splitlines()[by_gram[0] + 1]


def test_pair_scores_need_no_shuffle_of_their_own(spark, no_broadcast):
    plan = plan_of(catalog.a3_rouge_pairs(spark, SF))
    above_join = plan.split("SortMergeJoin")[0]
    assert "Exchange" not in above_join


def test_recomputation_moves_reference_texts_once(spark, no_broadcast):
    df = catalog.evaluation_recomputed(spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    texts = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line]
    # One exchange of references and one of hypotheses, both used again.
    assert sum("ReusedExchange" in line for line in texts) == 2 and len(texts) == 4


@pytest.mark.parametrize("slots", [False, True])
def test_scoring_has_a_task_per_core(spark, slots):
    """Neither a broadcast of one side nor merging by bytes leaves the scoring to fewer tasks."""
    pairs = catalog.run_pairs(spark, SF, slots)
    used = pairs.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(used) >= spark.sparkContext.defaultParallelism


def test_joined_texts_are_not_dealt_again(spark, no_broadcast):
    plan = plan_of(catalog.a3_rouge_pairs(spark, SF))
    assert plan.count("REPARTITION_BY_NUM") == 2 and plan.count("Exchange hashpartitioning(_block") == 2


def test_hot_item_is_not_one_task(spark, no_broadcast):
    """A third of all references on one item: its pairs must come from several partitions."""
    refs = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 0, id) as item_id", "id as ref_no", "concat('a b c ', id) as reference"
    )
    hyps = spark.range(30_000).selectExpr("id as item_id", "concat('b c d ', id) as hypothesis")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = catalog.pairing.pair_references(hyps, refs)
        hot = pairs.filter("item_id = 0").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in hot) == 10_000
    assert len(hot) == 4 and max(r["count"] for r in hot) < 5_000


def test_queries_leave_session_settings_alone(spark):
    before = {k: v for k, v in spark.sparkContext.getConf().getAll()}
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    catalog.a1_corpus_bleu_first_run(spark, SF).collect()
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions
    assert {k: v for k, v in spark.sparkContext.getConf().getAll()} == before
