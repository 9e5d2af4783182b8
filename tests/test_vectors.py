import math
from hashlib import md5

import pyarrow as pa
import pytest

from textgauge.functions import vectors
from textgauge.plans.retrieval import embed


def brute(tokens):
    counts = [0] * 64
    for token in tokens or ():
        counts[int(md5(token.encode()).hexdigest()[:4], 16) % 64] += 1
    total = math.sqrt(sum(n * n for n in counts))
    return [n / total if total else 0.0 for n in counts]


@pytest.mark.parametrize("rows", [1, 2, 1024])
def test_frequencies_of_slices(monkeypatch, rows):
    monkeypatch.setattr(vectors, "SLICE_ROWS", rows)
    lists = [["a", "b", "a"], None, [], ["c"] * 70, ["é", "a"]]
    assert vectors._frequencies(pa.array(lists, pa.list_(pa.string()))).to_pylist() == [brute(t) for t in lists]
    some = pa.array(lists, pa.list_(pa.string())).slice(2)
    assert vectors._frequencies(some).to_pylist() == [brute(t) for t in lists[2:]]
    assert len(vectors._frequencies(pa.array([], pa.list_(pa.string())))) == 0


def test_words_are_hashed_once_while_they_are_remembered(monkeypatch):
    """Slices of the same words: each is hashed in the first only, and again once too many are held."""
    hashed = []
    monkeypatch.setattr(vectors, "SLICE_ROWS", 1)
    monkeypatch.setattr(vectors, "_bucket_of", vectors._Buckets())
    monkeypatch.setattr(vectors, "md5", lambda word: hashed.append(word) or md5(word))
    lists = [["a", "b"], ["b", "a"], ["c"], ["a"]]
    assert vectors._frequencies(pa.array(lists)).to_pylist() == [brute(t) for t in lists]
    assert hashed == [b"a", b"b", b"c"]
    monkeypatch.setattr(vectors, "REMEMBERED", 2)
    assert vectors._frequencies(pa.array(lists)).to_pylist() == [brute(t) for t in lists]
    assert hashed == [b"a", b"b", b"c", b"a", b"b", b"c", b"a"]


def test_an_embedding_is_made_once(spark):
    """A search asks for rows with a vector; that must not have each vector worked out for the test, too."""
    made = embed(spark.createDataFrame([(0, "a a B"), (1, None)], "i int, t string"), "t").filter("embedding is not null")
    assert made._jdf.queryExecution().optimizedPlan().toString().count("scaled(") == 1
    assert [r.embedding for r in made.orderBy("i").collect()] == [brute(["a", "a", "b"]), [0.0] * 64]
