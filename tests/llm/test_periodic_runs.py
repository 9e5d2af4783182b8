import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import AWKWARD, documents  # noqa: F401

from textgauge.llm import periodic_runs as p


def brute_runs(words):
    """Every maximal stretch of every period, kept with its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            stretch = (at, end + q)
            if end + q - at >= max(24, 3 * q) and stretch not in found:
                found[stretch] = q
            at = end + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a, step = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % step] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        sha("".join("%d,%d,%d\n" % r for r in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def found(words):
    ids = np.unique(np.array([ord(w) for w in words], dtype=np.int64), return_inverse=True)[1]
    runs = p.find_runs(ids.astype(np.int64), np.zeros(len(ids), dtype=np.int64))
    return [(int(s), int(e - s), int(q)) for s, q, e in runs]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.tuples(st.text("ab", min_size=1, max_size=12), st.integers(1, 30), st.integers(0, 11)), min_size=1, max_size=6
    )
)
def test_runs_of_repeated_blocks(blocks):
    words = "".join(block * times + block[:rest] for block, times, rest in blocks)
    assert found(words) == brute_runs(words)


@settings(max_examples=200, deadline=None)
@given(st.text("ab", max_size=300))
def test_runs_of_random_words(words):
    assert found(words) == brute_runs(words)


def test_runs_inside_runs():
    inner = "a" * 30 + "b"
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 1500:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    for words in (inner * 5, (inner * 4 + "c") * 4, "ab" * 40 + "ba" * 40, "x" * 24, "x" * 23, "abc" * 8, fibonacci[-1]):
        assert found(words) == brute_runs(words)


def test_texts_do_not_meet(spark, documents):
    rows = [(1, "a " * 20), (2, "a " * 20), (3, None), (4, "a " * 30), (5, ""), (6, "a " * 24)]
    got = {r.doc_id: r.n_runs for r in p.periodic_runs(documents(rows).coalesce(1)).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 1, 5: 0, 6: 1}


def _random_rows():
    rng = random.Random(7)
    rows = []
    for doc_id in range(400):
        size = rng.choice([0, 1, 5, 23, 24, 25, 60, 200, 900])
        words = [rng.choice(["a", "b", "é漢", " ", "w%d" % rng.randrange(40)]) for _ in range(size)]
        at = rng.randrange(size + 1)
        if rng.random() < 0.4:
            words[at:at] = words[: rng.randrange(1, 15)] * rng.randrange(1, 12)
        rows.append((doc_id * 7919, rng.choice([" ", "  ", "\n", "\t\x0b\x0c\r "]).join(words)))
    return rows


def test_against_text_by_text(spark, documents, monkeypatch):
    rows = AWKWARD[:7] + AWKWARD[8:] + _random_rows() + [(11, "q " * 3000), (None, "r s " * 50)]
    docs = documents(rows, extra=("n_runs", "start", "period")).repartition(3)
    got = [tuple(r) for r in p.periodic_runs(docs).collect()]
    expected = [brute(*r) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert sum(r[1] > 0 for r in got) > 60 and sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 20


def test_a_very_long_text(spark, documents):
    plain = " ".join(f"w{i}" for i in range(200_000))
    long = plain + " " + "one two three four five " * 20_000 + plain
    rows = {r.doc_id: r for r in p.periodic_runs(documents([(1, long), (2, "word " * 400_000)])).collect()}
    assert (rows[1].n_runs, rows[1].start, rows[1].length, rows[1].period) == (1, 200_000, 100_000, 5)
    assert (rows[2].length, rows[2].period, rows[2].exponent_milli) == (400_000, 1, 400_000_000)
    assert rows[2].collapsed_sha256 == hashlib.sha256(b"word").hexdigest()


def test_empty(spark, documents):
    assert p.periodic_runs(documents([])).count() == 0
