import hashlib
import random

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from textgauge.operators import bootstrap
from textgauge.plans import catalog


def weights(unit, replicates):
    """The same weights one by one."""
    out = []
    for r in range(replicates):
        digest = hashlib.md5(f"{unit}:{r // 8}".encode()).hexdigest()
        u = int(digest[4 * (r % 8) : 4 * (r % 8) + 4], 16)
        out.append(sum(u >= step for step in bootstrap.poisson_steps()))
    return np.array(out)


def brute(rows, replicates, quantiles=(0.025, 0.5, 0.975)):
    drawn = np.array([weights(unit, replicates) for unit, _ in rows])
    total = drawn.sum(axis=0)
    means = (drawn * np.array([x for _, x in rows])[:, None]).sum(axis=0)[total > 0] / total[total > 0]
    return np.quantile(means, quantiles)


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(4)
    rows = [(run, i, rng.random() * (1 + (run == "b"))) for run in "ab" for i in range(80)] + [("tiny", 1, 0.5)]
    return rows, spark.createDataFrame(rows, "run string, item_id long, x double").repartition(5)


def test_steps_are_the_poisson_distribution():
    steps = np.array(bootstrap.poisson_steps()) / 65536
    assert abs(steps[0] - np.exp(-1)) < 1e-5 and (np.diff(steps) > 0).all() and len(steps) == 8


def test_weights_are_poisson():
    w = np.concatenate([weights(i, 200) for i in range(300)])
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03


def test_intervals_as_one_by_one(scores):
    rows, df = scores
    got = {r.run: (r.low, r.mid, r.high) for r in bootstrap.bootstrap_means(df, ["run"], F.col("item_id"), ["x"], 203).collect()}
    for run in ("a", "b", "tiny"):
        assert np.allclose(got[run], brute([(i, x) for r, i, x in rows if r == run], 203))
    again = bootstrap.bootstrap_means(df.repartition(2), ["run"], F.col("item_id"), ["x"], 203).collect()
    assert {r.run: round(r.mid, 12) for r in again} == {run: round(v[1], 12) for run, v in got.items()}


def test_interval_of_a_normal_mean(spark):
    rng = np.random.default_rng(2)
    values = rng.normal(5, 2, 400)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i long, x double")
    r = bootstrap.bootstrap_means(df, [], F.col("i"), ["x"]).first()
    error = values.std() / 20
    assert abs(r.mid - values.mean()) < 0.1 * error
    assert abs((r.high - r.low) / (2 * 1.96 * error) - 1) < 0.15


def test_nulls_do_not_count(spark):
    df = spark.createDataFrame([(i, float(i) if i % 2 else None) for i in range(60)], "i long, x double")
    got = bootstrap.bootstrap_means(df, [], F.col("i"), ["x"], 100).first()
    assert np.allclose((got.low, got.mid, got.high), brute([(i, i) for i in range(60) if i % 2], 100))


def test_paired_margins_are_narrower(spark):
    rng = np.random.default_rng(3)
    hard = rng.normal(0, 1, 300)
    rows = [(i, float(h + 0.1 + 0.01 * rng.normal()), float(h)) for i, h in enumerate(hard)]
    df = spark.createDataFrame(rows, "i long, x_a double, x_b double")
    r = bootstrap.margins(df, [], F.col("i"), ["x"]).first()
    assert 0.09 < r.low < r.mid < r.high < 0.11


def test_slot_means(spark):
    rows = [("m", item, slot, item * 0.01 + slot, 1.0 * slot) for item in range(20) for slot in range(3 if item else 2)]
    df = spark.createDataFrame(rows, "run string, item_id long, slot long, x double, y double")
    r = bootstrap.bootstrap_slot_means(df, ["run"], ["x"], ["y"], 101).first()
    mids = [brute([(i, i * 0.01 + s) for i in range(20)], 101)[1] for s in (0, 1)]
    assert (r.slots, r.y) == (2, 0.5) and np.isclose(r.x, np.mean(mids))


def test_one_aggregate_with_a_combine(scores):
    _, df = scores
    plan = bootstrap.replicate_means(df, ["run"], F.col("item_id"), ["x"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan and "Python" not in plan


def test_empty(spark):
    df = spark.createDataFrame([], "run string, item_id long, x double")
    assert bootstrap.bootstrap_means(df, ["run"], F.col("item_id"), ["x"]).count() == 0


def test_weights_are_read_off_the_digest_as_numbers(spark):
    """Digits compared as text give the weights of the numbers, at the ends of every step too."""
    edges = sorted({max(0, step + d) for step in bootstrap.poisson_steps() for d in (-1, 0)} | {0, (1 << 16) - 1})
    rows = spark.createDataFrame([(f"{u:04x}" * 8, u) for u in edges], "digest string, u int")
    weights = bootstrap._weight(F.col("digest"), 7)
    assert "conv" not in str(weights)
    for r in rows.select("u", weights.alias("w")).collect():
        assert r.w == sum(r.u >= step for step in bootstrap.poisson_steps())


def test_pairs_are_scored_once_for_draws_and_means(spark):
    plan = catalog.a7_bootstrap_slots(spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "conversations" not in plan and plan.count("pair-scores") > 0
