"""Quality rules: counts of a text, and robust outliers by minimum covariance determinant.

Each text gives counts and, out of them, a vector of FEATURES on transformed scales. For every language and
source the half of its documents whose covariance has the least determinant is looked for, over all
rows: from each of four deterministic starts (medians with median deviations, medians with quartiles, lower and upper
quartiles) concentration steps take the half nearest by Mahalanobis distance and compute mean and covariance again,
until no determinant falls any more; the start with the least one wins. A group holds out against nearly half
junk, equal rows too. All documents near that estimate (NEAR, 97.5 % of normal ones) then give the final mean and covariance.

Small groups lean on wider ones: the moments of a group count as its n documents, those of its language as
PRIOR more, and in the same way those of all languages for a language. So a group of a few documents is judged like
its language, a large one by itself, and nothing changes at once between them.

The sums of a step are made per group and distance class before any shuffle, and groups are salted, so a group with
a third of all rows is spread over tasks. A document is rejected if its squared distance is over CUTOFF, or by
the base rule: under 50 words, or more than half of the words in repeated windows of three words. A tenth of the
way that a feature can go is added to its deviation (FEATURES), so that each can reject a document alone.

Documents that fail the base rule take no part in the estimates. Null texts have no words and fail.
Null languages and sources are groups of their own. Repeated rows count as often as they occur. An
empty table gives an empty table. Other columns are ignored, but for those named in `carry`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgauge.llm.common import give_back, stored

# The symbols counted and the base rule.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50

STEPS, SALTS, PRIOR = 15, 64, 25
# Classes of squared distance for each factor of e; of the last class a half takes only the fraction that it needs.
CLASSES = 10
# The least fall of a determinant's logarithm that is worth another step.
LEAST_FALL = 0.01
# Squared distance beyond which a document is rejected: a normal one is with a chance of 1e-15.
CUTOFF = 80.0
# Squared distance within which 97.5 % of normal rows in five dimensions are.
NEAR = 12.83
# The scatter of the nearest half of normal rows in five dimensions, or of those within NEAR, times this, is the scatter of all.
HALF_FACTOR, NEAR_FACTOR = 1.912, 1.055
# Standard deviation added to each feature: most documents may agree exactly in one, and a small
# difference from them makes no outlier.
FEATURES = {"log_words": 0.3, "word_length": 0.15, "symbols": 0.2, "dup_lines": 0.1, "repeats": 0.07}

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
_WHITE = " \t\n\v\f\r"


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three that occur twice or more in the list."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    pairs = np.unique(ids[:-2] * len(known) + ids[1:-1], return_inverse=True)[1]
    _, where, counts = np.unique(pairs * len(known) + ids[2:], return_inverse=True, return_counts=True)
    again = counts[where] > 1
    covered = np.zeros(len(words), dtype=bool)
    for at in range(3):
        covered[at : at + len(again)] |= again
    return int(covered.sum())


def counts(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and lines with a word."""
    text = text or ""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(_WHITE)]
    return (
        len(words),
        len(text) - sum(map(text.count, _WHITE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in _COUNTS]))
def _counts(texts: pa.Array) -> pa.Array:
    rows = list(zip(*(counts(t.as_py()) for t in texts))) or [[]] * len(_COUNTS)
    give_back()
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in rows], _COUNTS)


def with_counts(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed and the features, one row per document."""
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return (
        docs.select(F.col("doc_id").cast("long"), "lang", "source", *carry, _counts("text").alias("c"))
        .select("doc_id", "lang", "source", *carry, "c.*")
        .withColumn("base_failed", failed)
        .withColumn(
            "x",
            F.array(
                F.log1p(F.col("n_words")),
                share("word_chars", "n_words"),
                F.log1p(100 * share("n_symbols", "word_chars")),
                F.sqrt(share("n_dup_lines", "n_lines")),
                F.sqrt(share("n_repeat_words", "n_words")),
            ),
        )
    )


_D = len(FEATURES)
_KEY = ["g_lang", "g_source"]
_PAIRS = [(i, j) for i in range(_D) for j in range(i, _D)]


def salted(rows: DataFrame) -> DataFrame:
    """`rows` with the columns g_lang and g_source, which are never null, and a salt."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")).alias(f"g_{c}")
    salt = F.pmod(F.xxhash64("doc_id", *[F.col("x")[i] for i in range(_D)]), F.lit(SALTS)).cast("int")
    return rows.select("*", name("lang"), name("source"), salt.alias("salt"))


def _scatter(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The covariance with mean `first` and the upper half of the mean products `second`."""
    upper = np.zeros((_D, _D))
    upper[np.triu_indices(_D)] = second
    return upper + np.triu(upper, 1).T - np.outer(first, first)


_FLOOR = np.diag(np.square(list(FEATURES.values())))
_SOLVED = (
    "g_lang string, g_source string, start int, n long, mean array<double>, second array<double>, "
    "inverse array<double>, log_det double"
)


def _solved(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each estimate's inverse scatter, and the logarithm of its determinant, out of its moments."""
    for f in frames:
        rows = []
        for r in f.itertuples(index=False):
            scatter = r.factor * _scatter(np.array(r.mean), np.array(r.second)) + _FLOOR
            det = float(np.linalg.slogdet(scatter)[1])
            rows.append((r.g_lang, r.g_source, r.start, r.n, r.mean, r.second, np.linalg.inv(scatter).ravel().tolist(), det))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in _SOLVED.split(", ")])


def _distance(rows: DataFrame, model: DataFrame, how: str = "inner") -> DataFrame:
    """`rows` once per estimate of their group (columns start, n, mean, inverse of `model`) with d2, the squared distance to it."""
    held = model.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "n", "mean", "inverse")).alias("models"))
    spread = held.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    each = F.explode if how == "inner" else F.explode_outer
    joined = rows.join(spread, [*_KEY, "salt"], how).withColumn("m", each("models")).drop("models").select(*rows.columns, "m.*")
    away = [F.col("x")[i] - F.col("mean")[i] for i in range(_D)]
    d2 = sum(
        away[i] * sum((away[j] * F.col("inverse")[i * _D + j] * (1 if i == j else 2) for j in range(i, _D)), F.lit(0.0))
        for i in range(_D)
    )
    return joined.withColumn("d2", d2)


def _starts(members: DataFrame) -> DataFrame:
    """Four first estimates of each group: start, n, mean and inverse."""
    quartiles = stored(
        members.groupBy(*_KEY).agg(
            F.count("*").alias("n"),
            *[F.percentile_approx(F.col("x")[i], [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(_D)],
        ),
        "quartiles",
    )
    spread = quartiles.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    deviations = members.join(spread, [*_KEY, "salt"]).groupBy(*_KEY).agg(
        *[F.percentile_approx(F.abs(F.col("x")[i] - F.col(f"q{i}")[1]), 0.5, 1000).alias(f"m{i}") for i in range(_D)]
    )
    both = quartiles.join(deviations, _KEY)

    def start(number: int, quartile: int, width: list[Column]) -> Column:
        wide = [F.greatest(w, F.lit(least)) for w, least in zip(width, FEATURES.values())]
        inverse = [1 / (wide[i] * wide[i]) if i == j else F.lit(0.0) for i in range(_D) for j in range(_D)]
        mean = F.array(*[F.col(f"q{i}")[quartile] for i in range(_D)])
        return F.struct(F.lit(number).alias("start"), mean.alias("mean"), F.array(*inverse).alias("inverse"))

    by_median = [1.4826 * F.col(f"m{i}") for i in range(_D)]
    by_quartile = [(F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349 for i in range(_D)]
    four = [start(0, 1, by_median), start(1, 1, by_quartile), start(2, 0, by_quartile), start(3, 2, by_quartile)]
    return both.select(*_KEY, "n", F.explode(F.array(*four)).alias("s")).select(*_KEY, "n", "s.*")


def _sums() -> list[Column]:
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(_D)]
    return sums + [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i, j in _PAIRS]


def _moments(weight: Column, size: Column, factor: float) -> list[Column]:
    """mean, second and factor out of weighted sums of rows with s0.., p0_0.. over `size` documents."""
    of = lambda c: F.sum(weight * F.col(c)) / size
    return [
        F.array(*[of(f"s{i}") for i in range(_D)]).alias("mean"),
        F.array(*[of(f"p{i}_{j}") for i, j in _PAIRS]).alias("second"),
        F.lit(factor).alias("factor"),
    ]


def _concentrated(members: DataFrame, model: DataFrame) -> DataFrame:
    """One step: for each start the estimate of the half of the group that is nearest to the last estimate."""
    near = _distance(members, model).withColumn("class", F.floor(F.log(F.col("d2") + 1e-3) * CLASSES).cast("int"))
    key = [*_KEY, "start"]
    classes = near.groupBy(*key, "class").agg(F.count("*").alias("m"), F.max("n").alias("n"), *_sums())
    before = Window.partitionBy(*key).orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    half = F.least(F.floor((F.col("n") + _D + 1) / 2), F.col("n"))
    inside = classes.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0))).filter(F.col("before") < half)
    weighted = inside.withColumn("w", F.least((half - F.col("before")) / F.col("m"), F.lit(1.0)))
    size = F.sum(F.col("w") * F.col("m"))
    merged = weighted.groupBy(*key).agg(F.max("n").alias("n"), *_moments(F.col("w"), size, HALF_FACTOR))
    return merged.mapInPandas(_solved, _SOLVED)


def least_determinants(members: DataFrame) -> DataFrame:
    """The estimate with the least determinant of each group: start, n, mean, second, inverse, log_det."""
    model, last = stored(_starts(members), "starts"), None
    for _ in range(STEPS):
        model = stored(_concentrated(members, model), "concentrated")
        if last is not None:
            was = last.select(*_KEY, "start", F.col("log_det").alias("was"))
            fall = model.join(was, [*_KEY, "start"]).agg(F.max(F.col("was") - F.col("log_det"))).first()[0]
            if fall is None or fall <= LEAST_FALL:
                break
        last = model
    order = F.struct("log_det", "start")
    columns = [c for c in model.columns if c not in _KEY]
    return model.groupBy(*_KEY).agg(F.min_by(F.struct(*columns), order).alias("b")).select(*_KEY, "b.*")


def _blended(own: str, wide: str | Column, size: Column) -> Column:
    """Moments of an estimate of `size` documents and PRIOR more of a wider one."""
    return F.zip_with(own, wide, lambda a, b: (size * a + PRIOR * b) / (size + PRIOR))


def _pooled(rows: DataFrame, key: list[str], prefix: str) -> DataFrame:
    """Moments of the estimates of a key; large groups count alike, so that none of them decides alone."""
    weight = F.col("n") / (F.col("n") + PRIOR)
    of = lambda c, i: F.sum(weight * F.col(c)[i]) / F.sum(weight)
    return rows.groupBy(*key).agg(
        F.sum("n").alias(f"{prefix}_n"),
        F.array(*[of("mean", i) for i in range(_D)]).alias(f"{prefix}_mean"),
        F.array(*[of("second", i) for i in range(len(_PAIRS))]).alias(f"{prefix}_second"),
    )


def shrunken(groups: DataFrame) -> DataFrame:
    """Group estimates with the moments of their language and of all languages blended in."""
    langs = _pooled(groups, ["g_lang"], "lang")
    parts = langs.select("g_lang", F.col("lang_n").alias("n"), F.col("lang_mean").alias("mean"), F.col("lang_second").alias("second"))
    everything = _pooled(parts, [], "all").first()
    wide = langs.select(
        "g_lang",
        _blended("lang_mean", F.array(*map(F.lit, everything["all_mean"])), F.col("lang_n")).alias("lang_mean"),
        _blended("lang_second", F.array(*map(F.lit, everything["all_second"])), F.col("lang_n")).alias("lang_second"),
    )
    blended = groups.join(wide, "g_lang").select(
        *_KEY,
        "start",
        "n",
        _blended("mean", "lang_mean", F.col("n")).alias("mean"),
        _blended("second", "lang_second", F.col("n")).alias("second"),
        F.lit(1.0).alias("factor"),
    )
    return blended.mapInPandas(_solved, _SOLVED)


def estimates(rows: DataFrame) -> DataFrame:
    """mean and inverse scatter of each group of `rows` (salted and stored)."""
    members = rows.filter("not base_failed").select(*_KEY, "salt", "x")
    core = stored(least_determinants(members), "least-determinants")
    near = _distance(members, core).filter(F.col("d2") <= NEAR)
    sums = near.groupBy(*_KEY).agg(F.max("start").alias("start"), F.max("n").alias("n"), F.count("*").alias("m"), *_sums())
    # The scatter is widened about the mean, so that plain moments can be blended.
    one = F.lit(1.0)
    found = sums.groupBy(*_KEY, "start", "n").agg(*_moments(one, F.sum("m"), NEAR_FACTOR))
    widened = F.transform(
        "second",
        lambda v, k: F.col("factor") * v + (1 - F.col("factor")) * F.element_at(F.array(*[F.col("mean")[i] * F.col("mean")[j] for i, j in _PAIRS]), k + 1),
    )
    return stored(shrunken(stored(found.withColumn("second", widened), "near")), "estimates")


def quality_rules(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The counts, base_failed, distance and kept for every row, with the carried columns."""
    rows = stored(salted(with_counts(docs, carry)), "counts")
    judged = _distance(rows.select("doc_id", *_COUNTS[:-1], "base_failed", "x", *_KEY, "salt", *carry), estimates(rows), "left")
    kept = ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= CUTOFF)
    return judged.select(
        "doc_id", *_COUNTS[:-1], "base_failed", kept.alias("kept"), F.col("d2").alias("distance2"), *carry
    )
