"""Quality classifier: a generalised additive model with pairwise interactions.

Each text gives FEATURES; each feature is cut into at most BINS bins at quantiles of the training sample.
Boosting goes round the features in turn: a shallow tree on the bins of one feature is fitted to the
gradient of the logistic loss, and a small part of it is added to the feature's table. Then the pairs
of features whose joint bins explain most of what is left get tables of their own in the same way. A score is
the sum of one entry of every table, so scoring is binning and addition over whole columns.

The model is fitted on at most SAMPLE rows: of the different labels (id and quality) those with the SAMPLE smallest hashes,
and of the rows with such an id again as many, if ids repeat. All
documents are scored. Ids, labels, languages and sources are never inputs of a score.

Null texts count as empty and are scored like any other. A label given more than once weighs
that much; labels that are null, or of no document, are left out. Rows with a null doc_id are scored but not
learned from. With labels of fewer than two kinds every score is their share, 0.5 without any. Repeated rows
score alike. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgauge.llm.common import give_back, slices
from textgauge.llm.rules import repeated_words

SAMPLE, BINS, ROUNDS, RATE, PAIRS, PAIR_ROUNDS = 20_000, 32, 150, 0.15, 6, 60

FEATURES = [
    "log_words", "word_bytes", "upper", "symbols", "exclamations", "digits", "punctuation", "not_ascii",
    "distinct_words", "same_as_last", "commonest", "repeated_windows", "same_lines", "line_words",
]

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))


def features(text: str) -> tuple[float, ...]:
    """The FEATURES of a text; all are finite, also for an empty one."""
    data = text.encode()
    words = data.split()
    n, size = max(1, len(words)), max(1, len(data))
    letters = max(1, size - len(data.translate(None, _UPPER + _LOWER)))
    of = lambda kind: len(data) - len(data.translate(None, kind))
    lines = [line for line in data.split(b"\n") if line.strip()]
    seen = Counter(words)
    return (
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        of(_UPPER) / letters,
        of(b"#*$%&|<>") / n,
        of(b"!") / n,
        of(b"0123456789") / size,
        of(b".,;:?'\"()-") / n,
        of(bytes(range(128, 256))) / size,
        np.log1p(len(seen)) / np.log1p(n),
        sum(map(bytes.__eq__, words, words[1:])) / n,
        max(seen.values(), default=0) / n,
        repeated_words(words) / n,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))),
    )


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _features(texts: pa.Array) -> pa.Array:
    rows = [features(t) for some in slices(texts) for t in some]
    give_back()
    return pa.array(rows, pa.list_(pa.float64()))


def with_features(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), _features("text").alias("x"))


def labelled(labels: DataFrame, held_out: Column, sample: int = SAMPLE) -> DataFrame:
    """doc_id, y and weight (how often it is given) of `sample` labels to learn from, at most."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("y"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out)
    given = known.groupBy("doc_id", "y").agg(F.count("*").cast("double").alias("weight"))
    return given.orderBy(F.xxhash64("doc_id", "y"), "doc_id", "y").limit(sample)


def bins_of(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)], axis=1)


def _tree(gradient: np.ndarray, hessian: np.ndarray, leaves: int = 4) -> np.ndarray:
    """The values of a tree with a few leaves over ordered bins, split where it gains most."""
    spans, value = [(0, len(gradient))], np.zeros(len(gradient))
    worth = lambda g, h: g * g / (h + 1.0)
    while len(spans) < leaves:
        best = (1e-9, None, None)
        for a, b in spans:
            g, h = np.cumsum(gradient[a:b]), np.cumsum(hessian[a:b])
            gain = worth(g[:-1], h[:-1]) + worth(g[-1] - g[:-1], h[-1] - h[:-1]) - worth(g[-1], h[-1])
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), (a, b), a + 1 + int(gain.argmax()))
        if best[1] is None:
            break
        spans.remove(best[1])
        spans += [(best[1][0], best[2]), (best[2], best[1][1])]
    for a, b in spans:
        value[a:b] = gradient[a:b].sum() / (hessian[a:b].sum() + 1.0)
    return value


def _grid_tree(gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, float]:
    """The best single cut of both axes into four leaves, and its gain."""
    total = lambda m: np.pad(m.cumsum(axis=0).cumsum(axis=1), ((1, 0), (1, 0)))
    g, h = total(gradient), total(hessian)
    corners = lambda m: (m[1:-1, 1:-1], m[1:-1, -1:] - m[1:-1, 1:-1], m[-1:, 1:-1] - m[1:-1, 1:-1],
                         m[-1, -1] - m[1:-1, -1:] - m[-1:, 1:-1] + m[1:-1, 1:-1])
    gain = sum(a * a / (b + 1.0) for a, b in zip(corners(g), corners(h)))
    if not gain.size:
        return np.zeros_like(gradient), 0.0
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    value = np.zeros_like(gradient)
    for rows in (slice(None, i + 1), slice(i + 1, None)):
        for columns in (slice(None, j + 1), slice(j + 1, None)):
            value[rows, columns] = gradient[rows, columns].sum() / (hessian[rows, columns].sum() + 1.0)
    return value, float(gain[i, j])


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> dict:
    """Edges, tables of features and of pairs, and the start of the sum."""
    weight = np.ones(len(y)) if weight is None else weight
    share = float(np.clip(np.average(y, weights=weight), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    model = {"start": float(np.log(share / (1 - share))), "edges": [], "tables": [], "pairs": []}
    if len(set(y.tolist())) < 2:
        return model | ({"start": 0.0} if not len(y) else {})
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    model["edges"] = [np.unique(np.quantile(x[:, f], quantiles)) for f in range(x.shape[1])]
    b, d = bins_of(x, model["edges"]), x.shape[1]
    sizes = [len(e) + 1 for e in model["edges"]]
    model["tables"] = [np.zeros(n) for n in sizes]
    total = np.full(len(y), model["start"])

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return weight * (y - p), weight * p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(d):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b[:, f], g, sizes[f]), np.bincount(b[:, f], h, sizes[f]))
            model["tables"][f] += step
            total += step[b[:, f]]

    def grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(b[:, i] * sizes[j] + b[:, j], values, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])

    g, h = slopes()
    gains = [(_grid_tree(grid(i, j, g), grid(i, j, h))[1], i, j) for i in range(d) for j in range(i)]
    model["pairs"] = [(i, j, np.zeros((sizes[i], sizes[j]))) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model["pairs"]:
            g, h = slopes()
            step = RATE * _grid_tree(grid(i, j, g), grid(i, j, h))[0]
            table += step
            total += step[b[:, i], b[:, j]]
    return model


def score(model: dict, x: np.ndarray) -> np.ndarray:
    """The chance of label 1 for each row of features."""
    total = np.full(len(x), model["start"])
    if model["tables"]:
        b = bins_of(x, model["edges"])
        for f, table in enumerate(model["tables"]):
            total += table[b[:, f]]
        for i, j, table in model["pairs"]:
            total += table[b[:, i], b[:, j]]
    return 1 / (1 + np.exp(-total))


def learn(rows: DataFrame, known: DataFrame, sample: int = SAMPLE) -> dict:
    """A model from stored features and a sample of labels; an id has two of them at most, so rows hardly multiply."""
    joined = rows.join(F.broadcast(known), "doc_id")
    # Equal rows become one of their weight, so that a sample of different rows stands for all.
    different = joined.groupBy("doc_id", "y", "x").agg(F.sum("weight").alias("weight"))
    few = different.orderBy(F.xxhash64("doc_id", "y", "x"), "doc_id", "y", "x").limit(sample).toArrow()
    x = np.array(few.column("x").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    return fit(x, np.array(few.column("y").to_pylist(), dtype=float), few.column("weight").to_numpy())


def scored(rows: DataFrame, model: dict, threshold: float = 0.3) -> DataFrame:
    """doc_id, score and predicted of every row of features."""

    @F.arrow_udf(T.DoubleType())
    def of(x: pa.Array) -> pa.Array:
        values = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
        return pa.array(score(model, values))

    found = rows.select("doc_id", of("x").alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
