"""Tables over runs (model x dataset): long scores, cross-tabs, comparisons and guards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RUN = ["model", "dataset"]


def union_runs(*runs: tuple[str, str, DataFrame]) -> DataFrame:
    """Item tables of several runs as one, labelled with model and dataset."""
    labelled = [
        items.withColumns({"model": F.lit(model), "dataset": F.lit(dataset)})
        for model, dataset, items in runs
    ]
    return reduce(DataFrame.unionByName, labelled)


def long_scores(summary: DataFrame, metrics: list[str]) -> DataFrame:
    """One row per model, dataset and metric."""
    return summary.unpivot(RUN, metrics, "metric", "value")


def cross_tab(scores: DataFrame, datasets: list[str], metrics: list[str]) -> DataFrame:
    """A row per model and a column per dataset and metric."""
    names = [f"{d}_{m}" for d in datasets for m in metrics]
    return (
        scores.withColumn("cell", F.concat_ws("_", "dataset", "metric"))
        .groupBy("model")
        .pivot("cell", names)
        .agg(F.first("value"))
    )


def best_models(scores: DataFrame) -> DataFrame:
    """The best model per dataset and metric and its lead over the second; ties go to the first name.

    A single model has no lead.
    """
    place = F.row_number().over(Window.partitionBy("dataset", "metric").orderBy(F.col("value").desc(), "model"))
    best = scores.withColumn("_place", place).filter("_place <= 2")
    return (
        best.groupBy("dataset", "metric")
        .agg(
            F.max("value").alias("best_value"),
            F.when(F.count("*") > 1, F.max("value") - F.min("value")).alias("margin"),
            F.min_by("model", F.struct(-F.col("value"), F.col("model"))).alias("best_model"),
        )
        .select("dataset", "metric", "best_model", "best_value", "margin")
    )


def dataset_means(scores: DataFrame) -> DataFrame:
    return scores.groupBy("dataset", "metric").agg(F.avg("value").alias("mean_value"))


def compare_models(
    items: DataFrame, model_a: str, model_b: str, metrics: list[str], keys: list[str] | None = None
) -> DataFrame:
    """Both models' hypothesis and scores side by side on the same item."""
    keys = keys or ["dataset", "item_id"]

    def side(model: str, tag: str) -> DataFrame:
        values = [F.col(c).alias(f"{c}_{tag}") for c in ["hypothesis", *metrics]]
        return items.filter(F.col("model") == model).select(*keys, *values)

    return side(model_a, "a").join(side(model_b, "b"), keys)


def richer_but_lower(compared: DataFrame, metrics: list[str]) -> DataFrame:
    """Items where the longer hypothesis scores lower on every given metric."""

    def case(longer: str, shorter: str):
        test = F.length(f"hypothesis_{longer}") > F.length(f"hypothesis_{shorter}")
        for metric in metrics:
            test = test & (F.col(f"{metric}_{longer}") < F.col(f"{metric}_{shorter}"))
        return test

    return compared.filter(case("a", "b") | case("b", "a")).withColumn(
        "richer", F.when(case("a", "b"), "a").otherwise("b")
    )


def stale_summaries(
    summary: DataFrame, items: DataFrame, metrics: list[str], epsilon: float = 1e-9
) -> DataFrame:
    """Stored summary values beside the means of the stored items, flagged where they differ."""
    actual = long_scores(items.groupBy(*RUN).agg(*[F.avg(m).alias(m) for m in metrics]), metrics)
    stored = long_scores(summary.select(*RUN, *metrics), metrics)
    return stored.withColumnRenamed("value", "stored").join(
        actual.withColumnRenamed("value", "actual"), [*RUN, "metric"]
    ).withColumn("stale", F.abs(F.col("stored") - F.col("actual")) > epsilon)


def blocked_results(items: DataFrame, size: int, fields: list[str]) -> DataFrame:
    """Items as nested lists of at most `size` per row, in item order: (run, batch, results).

    `items` needs row_id, dense within its run. One list per run would put a whole run in one
    row; with batches nothing is left out and no row grows with the run.
    """
    record = F.struct("row_id", *fields)
    return (
        items.withColumn("batch", F.expr(f"row_id div {size}"))
        .groupBy(*RUN, "batch")
        .agg(F.array_sort(F.collect_list(record)).alias("results"))
    )
