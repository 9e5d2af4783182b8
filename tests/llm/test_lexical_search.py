import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import AWKWARD, documents  # noqa: F401

from textgauge.llm import lexical_search as s

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
ITEMS = [
    (0, "Plain WORDS words and more"),
    (1, "word"),
    (2, None),
    (3, ""),
    (4, "no such terms anywhere xyzzy"),
    (5, "é 漢字 \U0001f600 endoftext don't"),
    (5, "w1 w2 w3 w1"),
    (None, "w5 w6 w7 w8 w9"),
    (7, " ".join(f"w{i % 90}" for i in range(150))),
]


def terms(text):
    return re.findall(s.TERM, (text or "").translate(LOWER))


def brute(rows, items, k=10):
    docs = [(d, Counter(terms(t))) for d, t in rows]
    sizes = [sum(c.values()) for _, c in docs]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for (doc, counts), n in zip(docs, sizes):
            m = 25 + 75 * n * n_docs // max(1, total)
            score = 0
            for t in terms(text):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m)) if counts[t] else 0
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, d, -sc) for i, (sc, _, _, d) in enumerate(sorted(scored)[:k])]
    return out


def corpus(seed, size=600):
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        words = [f"{'wW'[i % 2]}{int(90 * rng.random() ** 3)}" for _ in range(rng.choice([0, 1, 3, 20, 20, 80]))]
        rows.append((i if i % 50 else None, rng.choice([" ", "_", "'\n"]).join(words)))
    return rows + [(2000 + i, "w1 w2 w3") for i in range(40)] + rows[:5]


@pytest.mark.parametrize("rows", [AWKWARD + corpus(1), AWKWARD, [(1, None), (2, " ")], []])
def test_against_all_scores(spark, documents, rows, monkeypatch):
    monkeypatch.setattr(s, "SLICE_DOCS", 64)
    docs = documents(rows, extra=("n", "tf", "terms", "item_id")).repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = [tuple(r) for r in s.search(docs, items).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, ITEMS), key=str)


def test_blocks_of_items(spark, documents):
    rows = corpus(2, 200)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = [tuple(r) for r in s.search(documents(rows), items, k=3, most=40).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, ITEMS, 3), key=str)
    assert [len(b) for b in s.blocks(items.coalesce(1), 5)] == [1, 3, 1, 1, 1, 1, 1]


def _slice(rows, vocabulary, weights):
    owner, term, tf, n = [], [], [], []
    for i, (_, text) in enumerate(rows):
        counts = Counter(terms(text))
        n.append(sum(counts.values()))
        for t in sorted(vocabulary.index(t) for t in counts if t in vocabulary):
            owner.append(i)
            term.append(t)
            tf.append(counts[vocabulary[t]])
    scorer = s.Scorer(len(rows), max(1, sum(n)), weights)
    as_array = lambda v: np.array(v, dtype=np.int64)
    ids = np.array([r[0] for r in rows], dtype=object)
    return s.Slice(ids, as_array(n), as_array(owner), as_array(term), as_array(tf), scorer)


def test_most_documents_are_left_out_by_their_masks():
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(3))) for i in range(4000)] + [(9000 + i, "x y z a") for i in range(10)]
    vocabulary = list("abcdefghxyz")
    weights = np.array([100] * 8 + [5000] * 3, dtype=np.int64)
    part = _slice(rows, vocabulary, weights)
    item, times = np.arange(11), np.ones(11, dtype=np.int64)
    found, evaluated = s.search_slice(part, item, times, [], 10)
    assert [d for _, d in found] == list(range(9000, 9010)) and evaluated < 400
    again, evaluated = s.search_slice(part, item, times, found, 10)
    assert evaluated <= 10 * 8 and again[0] == found[0]


def test_no_mask_scores_above_its_maximum():
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 40)))) for i in range(500)]
    part = _slice(rows, list("abcdefg"), np.array([7, 900, 30, 4000, 250, 1, 60], dtype=np.int64))
    kept, times, largest, group = part.groups(np.arange(7), np.array([1, 2, 1, 1, 3, 1, 1]))
    scores = part.scores(np.arange(500), kept, times)
    assert (scores <= largest[group]).all() and (scores > 0).all()
