import re
from collections import Counter

import numpy as np
import pytest
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import AWKWARD, documents  # noqa: F401

from textgauge.llm import rules


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered), len(lines),
    )


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("ab \n\t\x0b\xa0é#|")), max_size=60))
def test_counts(text):
    assert rules.counts(text) == slow_counts(text)


def test_counts_of_documents(spark):
    for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect():
        assert rules.counts(r.text) == slow_counts(r.text)


D = len(rules.FEATURES)
FLOOR = np.diag(np.square(list(rules.FEATURES.values())))


def least_determinant(x):
    """Mean and covariance of the half with the least determinant, from the same four starts, one group at a time."""
    n, least = len(x), np.array(list(rules.FEATURES.values()))
    half = min(n, (n + D + 1) // 2)
    q1, mid, q3 = (np.quantile(x, q, axis=0, method="inverted_cdf") for q in (0.25, 0.5, 0.75))
    deviation = 1.4826 * np.quantile(abs(x - mid), 0.5, axis=0, method="inverted_cdf")
    found = []
    for centre, width in ((mid, deviation), (mid, (q3 - q1) / 1.349), (q1, (q3 - q1) / 1.349), (q3, (q3 - q1) / 1.349)):
        mean, inverse, steps = centre, np.diag(1 / np.maximum(width, least) ** 2), []
        for _ in range(rules.STEPS):
            d2 = np.einsum("ni,ij,nj->n", x - mean, inverse, x - mean)
            kind = np.floor(np.log(d2 + 1e-3) * rules.CLASSES)
            kinds, place, sizes = np.unique(kind, return_inverse=True, return_counts=True)
            before = np.cumsum(sizes) - sizes
            weight = np.clip((half - before) / sizes, 0, 1)[place]
            mean = np.average(x, axis=0, weights=weight)
            scatter = rules.HALF_FACTOR * ((x - mean).T * weight) @ (x - mean) / weight.sum() + FLOOR
            inverse = np.linalg.inv(scatter)
            steps.append((np.linalg.slogdet(scatter)[1], mean, inverse))
        found.append(steps)
    return found


def slow_verdicts(rows):
    """The same estimates with numpy. rows: (base_failed, lang, source, x)."""
    groups = {}
    for failed, lang, source, x in rows:
        if not failed:
            groups.setdefault((lang, source), []).append(x)
    starts = {g: least_determinant(np.array(x)) for g, x in groups.items()}
    # Steps are taken until no start of any group falls.
    last = 1
    while last + 1 < rules.STEPS and max(s[last - 1][0] - s[last][0] for f in starts.values() for s in f) > rules.LEAST_FALL:
        last += 1
    moments = {}
    for g, x in groups.items():
        x = np.array(x)
        _, mean, inverse = min((s[last] for s in starts[g]), key=lambda s: s[0])
        d2 = np.einsum("ni,ij,nj->n", x - mean, inverse, x - mean)
        near = x[d2 <= rules.NEAR]
        mean = near.mean(axis=0)
        scatter = rules.NEAR_FACTOR * np.cov(near.T, bias=True).reshape(D, D)
        moments[g] = (len(x), mean, scatter + np.outer(mean, mean))

    def pooled(parts):
        weights = [n / (n + rules.PRIOR) for n, _, _ in parts]
        return (sum(n for n, _, _ in parts), *(np.average([p[i] for p in parts], axis=0, weights=weights) for i in (1, 2)))

    def blended(own, wide):
        n = own[0]
        return (n, *((n * own[i] + rules.PRIOR * wide[i]) / (n + rules.PRIOR) for i in (1, 2)))

    langs = {lang: pooled([m for g, m in moments.items() if g[0] == lang]) for lang in {g[0] for g in moments}}
    everything = pooled(list(langs.values()))
    final = {}
    for g, own in moments.items():
        _, mean, second = blended(own, blended(langs[g[0]], everything))
        final[g] = mean, np.linalg.inv(second - np.outer(mean, mean) + FLOOR)
    out = []
    for failed, lang, source, x in rows:
        d2 = 0.0
        if (lang, source) in final:
            mean, inverse = final[lang, source]
            d2 = (np.array(x) - mean) @ inverse @ (np.array(x) - mean)
        out.append((not failed and d2 <= rules.CUTOFF, d2))
    return out


def test_verdicts(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    rows = rules.with_counts(docs).collect()
    expected = dict(zip([r.doc_id for r in rows], slow_verdicts([(r.base_failed, r.lang, r.source, r.x) for r in rows])))
    got = rules.quality_rules(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        kept, d2 = expected[r.doc_id]
        assert abs((r.distance2 or 0) - d2) < 1e-4 * (1 + d2) and (r.kept == kept or abs(d2 - rules.CUTOFF) < 0.1)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_junk_goes_and_clean_texts_stay(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/sf0.1/labels.parquet")
    rows = rules.quality_rules(docs).join(labels, "doc_id").filter("not base_failed").toPandas()
    assert rows[rows.quality == 1].kept.mean() > 0.995
    assert rows[rows.quality == 0].kept.mean() < 0.1


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_awkward(spark, documents, rows):  # noqa: F811
    docs = documents([*rows, (50, "w " * 60, None, None), (51, "v " * 60, "en", None)] if rows else rows, extra=("salt", "x", "kept"))
    got = rules.quality_rules(docs).collect()
    assert len(got) == docs.count()
    assert all(r.kept is not None and r.base_failed is not None for r in got)


@pytest.mark.parametrize("n_junk,junk", [(100, "buy$ {}# now%"), (90, "{} extraordinarilylongcompound"), (150, "buy$ {}# now%")])
def test_copies_of_one_junk_text_go(spark, n_junk, junk):
    """A third of a group, or nearly half, is one text: it is rejected, and the others are not."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghij"), n)) for n in rng.integers(2, 9, 500)]
    texts = [" ".join(rng.choice(words, n)) for n in rng.integers(150, 400, 200)]
    texts += [" ".join(junk.format(w) for w in sorted(set(words))[:30])] * n_junk
    rows = [(i, t, "en", "web") for i, t in enumerate(texts)]
    got = rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert not any(r.base_failed for r in got)
    assert not any(r.kept for r in got if r.doc_id >= 200)
    assert np.mean([r.kept for r in got if r.doc_id < 200]) > 0.99


@pytest.mark.parametrize("at", range(D))
def test_each_feature_rejects_alone(spark, at):
    """A document far out in one feature alone, as far as that feature goes, is rejected; a usual one is not."""
    rng = np.random.default_rng(9)
    usual = np.array([5.5, 4.6, 0.0, 0.0, 0.0]) + rng.normal(0, 1, (500, D)) * [0.3, 0.1, 0, 0, 0]
    odd = usual[0].copy()
    odd[at] = [0.5, 9.0, 3.0, 1.0, 0.5**0.5][at]
    rows = [(i, "en", "s", False, x.tolist()) for i, x in enumerate([*usual, odd])]
    table = spark.createDataFrame(rows, "doc_id long, lang string, source string, base_failed boolean, x array<double>")
    members = rules.salted(table)
    found = {r.doc_id: r.d2 for r in rules._distance(members, rules.estimates(members)).collect()}
    assert found[500] > rules.CUTOFF and np.mean([found[i] > rules.CUTOFF for i in range(500)]) == 0


def test_no_jump_between_small_and_large_groups(spark):
    """A text's distance changes little when its group grows by two documents."""
    rng = np.random.default_rng(11)
    wide = [("en", f"s{i % 5}", (np.array([5.0, 4.5, 0, 0, 0]) + rng.normal(0, 0.3, D) * [1, 1, 0, 0, 0]).tolist()) for i in range(500)]
    own = [("en", "own", (np.array([6.0, 5.0, 0, 0, 0]) + rng.normal(0, 0.3, D) * [1, 1, 0, 0, 0]).tolist()) for _ in range(60)]
    distances = []
    for size in (24, 26, 49, 51):
        rows = [(i, lang, source, False, x) for i, (lang, source, x) in enumerate([*wide, *own[:size]])]
        members = rules.salted(spark.createDataFrame(rows, "doc_id long, lang string, source string, base_failed boolean, x array<double>"))
        d2 = {r.doc_id: r.d2 for r in rules._distance(members, rules.estimates(members)).collect()}
        distances.append(np.mean([d2[500 + i] for i in range(20)]))
    assert abs(np.diff(distances)[[0, 2]]).max() < 0.5
