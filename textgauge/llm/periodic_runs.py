r"""Periodic runs of words in a text, by a dictionary of basic factors.

Words are the matches of `[^\x20\x09-\x0D]+`. A run is a stretch of consecutive words with smallest period q, at
least max(LEAST, REPEATS * q) long, that no word beside it extends. For every power of two L the dictionary names
the factors of L words, equal names for equal factors of one text; a factor of 2L is the pair of its halves.
A factor occurs again inside twice its length only as part of an arithmetic progression, whose step is a
period. So the successor of each occurrence is looked up, the first occurrence of each progression
proposes its step, and the names themselves, from long to short, tell how far the period reaches to both
sides. Proposals with equal ends are one run.

Level L proposes steps over L / 2 and up to L: then three periods hold two occurrences of a factor, so no run is
missed, and a factor as long as its step cannot occur nearer, so the step is the smallest period.

The texts of a slice are worked on together: names belong to one text, so no factor crosses texts. Only factors
that occur twice in their text are named on the next level, and levels end where there are none.

A word is dropped if a run contains it after the run's first period. Null texts have no words. Repeated rows are treated alike. A
null doc_id changes no word (see `changed_words`). An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, REPEATS = 24, 3

# Bytes of text that are worked on at once, unless one text is longer.
SLICE_BYTES = 1 << 20

_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[[0x20, *range(0x09, 0x0E)]] = True

_COLUMNS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


class Words:
    """The words of some texts: where each is in the bytes, and to which text it belongs."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        white = _IS_WHITE[self.data]
        # A word starts after white space or where a text starts, and ends likewise.
        edge = np.zeros(len(white) + 1, dtype=bool)
        edge[offsets] = True
        self.starts = np.flatnonzero(~white & (edge[:-1] | np.append(True, white[:-1])))
        self.ends = np.flatnonzero(~white & (edge[1:] | np.append(white[1:], True))) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.first))
        sizes = np.append(0, np.cumsum(self.ends - self.starts))
        values = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self.starts), [None, pa.py_buffer(sizes), pa.py_buffer(self.data[~white])]
        )
        self.ids = values.dictionary_encode().indices.to_numpy().astype(np.int64)

    def text(self, numbers: np.ndarray) -> Iterator[bytes]:
        """The words of these numbers, joined by one space, in parts."""
        for at in range(0, len(numbers), 1 << 16):
            some = numbers[at : at + (1 << 16)]
            part = b" ".join([self.data[a:b].tobytes() for a, b in zip(self.starts[some], self.ends[some])])
            yield b" " + part if at else part


def named(first: np.ndarray, second: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and names of the pairs that occur at least twice; a name below 0 stands for a factor that occurs once.

    Both arrays hold names at the same places, and `size` is over all of them.
    """
    at = np.flatnonzero((first >= 0) & (second >= 0))
    pair = first[at] * size + second[at]
    _, name, count = np.unique(pair, return_inverse=True, return_counts=True)
    again = count[name] > 1
    return at[again], name[again]


def dictionary(ids: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """For each power of two the name of the factor that starts at each place, -1 if it occurs once in its text."""
    levels: list[np.ndarray] = []
    first, second, size = owner, ids, int(ids.max(initial=0)) + 1
    while True:
        at, name = named(first, second, size)
        if not len(at):
            return levels
        level = np.full(len(ids), -1, dtype=np.int64)
        level[at] = name
        levels.append(level)
        half = 1 << (len(levels) - 1)
        if half >= len(ids):
            return levels
        first, second, size = level[:-half], level[half:], int(name.max()) + 1


def _equal(level: np.ndarray, a: np.ndarray, b: np.ndarray, span: int) -> np.ndarray:
    """If the factors at a and b, `span` words long, lie inside the array and are equal."""
    inside = (a >= 0) & (b + span <= len(level))
    name = level[np.where(inside, a, 0)]
    return inside & (name >= 0) & (name == level[np.where(inside, b, 0)])


def _reach(levels: list[np.ndarray], at: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of the stretch around `at` that has the period, and the place after its last."""
    left, right = at.copy(), at.copy()
    # Greedy steps from long to short; the longest names may apply more than once.
    for k in reversed(range(len(levels))):
        span = 1 << k
        moving = np.arange(len(at))
        while len(moving):
            ok = _equal(levels[k], right[moving], right[moving] + step[moving], span)
            moving = moving[ok]
            right[moving] += span
        moving = np.arange(len(at))
        while len(moving):
            ok = _equal(levels[k], left[moving] - span, left[moving] - span + step[moving], span)
            moving = moving[ok]
            left[moving] -= span
    return left, right + step


def find_runs(ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """start, period and end of every run, by start and period; places are counted over all texts."""
    levels, found = dictionary(ids, owner), [np.zeros((0, 3), dtype=np.int64)]
    for k, level in enumerate(levels):
        span = 1 << k
        at = np.flatnonzero(level >= 0)
        at = at[np.argsort(level[at], kind="stable")]
        step = np.diff(at)
        near = (np.diff(level[at]) == 0) & (step <= span) & (2 * step > span)
        # Heads of progressions: the occurrence before is not as near, or of another factor.
        head = near & ~np.append(False, near[:-1] & (step[:-1] == step[1:]))[: len(near)]
        start, end = _reach(levels, at[:-1][head], step[head])
        runs = np.stack([start, step[head], end], axis=1)
        found.append(runs[end - start >= np.maximum(LEAST, REPEATS * step[head])])
    return np.unique(np.concatenate(found), axis=0)


def changed_words(doc_id: int | None, n: int) -> np.ndarray:
    """The number of the original word at each place: one document in ten gets a periodic end.

    Fixed rule of the query: with h the crc32 of the id in decimal and g = h / 10, documents with h % 10 = 0 repeat
    p = 1 + (n - a) / (3 + g % 8) words from a = g % n on.
    """
    words = np.arange(n)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words[a:] = a + (words[a:] - a) % p
    return words


def _digest(parts: Iterator[bytes]) -> str:
    sha = hashlib.sha256()
    for part in parts:
        sha.update(part)
    return sha.hexdigest()


def _row(doc_id: int | None, words: Words, source: np.ndarray, base: int, runs: np.ndarray) -> tuple:
    """The row of a text whose first word is number `base`, with runs counted from there."""
    best, kept = (None,) * 4, np.ones(len(source), dtype=bool)
    lines = [(int(s), int(e - s), int(q)) for s, q, e in runs]
    if lines:
        top = lines[0]
        for run in lines[1:]:
            if run[1] * top[2] > top[1] * run[2]:
                top = run
        best = (*top, 1000 * top[1] // top[2])
        ends = np.zeros(len(source) + 1, dtype=np.int64)
        np.add.at(ends, runs[:, 0] + runs[:, 1], 1)
        np.add.at(ends, runs[:, 2], -1)
        kept = np.cumsum(ends[:-1]) == 0
    listed = _digest(b"%d,%d,%d\n" % line for line in lines)
    return (doc_id, len(lines), *best, listed, _digest(words.text(base + source[kept])))


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of up to SLICE_BYTES, or one row."""
    part = np.cumsum(sizes) // SLICE_BYTES
    starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, int)
    return zip(starts.tolist(), np.append(starts[1:], len(sizes)).tolist())


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    names = [c.split()[0] for c in _COLUMNS.split(", ")]
    for batch in batches:
        texts, ids = batch.column("text").cast(pa.large_string()), batch.column("doc_id").to_pylist()
        for a, b in _slices(pc.binary_length(texts).fill_null(0).to_numpy()):
            words = Words(texts.slice(a, b - a))
            first = words.first.tolist()
            sources = [changed_words(ids[a + i], first[i + 1] - first[i]) for i in range(b - a)]
            numbers = np.concatenate([s + at for s, at in zip(sources, first)])
            runs = find_runs(words.ids[numbers], words.owner)
            cuts = np.searchsorted(runs[:, 0], first)
            rows = []
            for i in range(b - a):
                own = runs[cuts[i] : cuts[i + 1]] - np.array([first[i], 0, first[i]])
                rows.append(_row(ids[a + i], words, sources[i], first[i], own))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document: its runs, the strongest of them, and digests of all runs and of the collapsed text."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_run_rows, _COLUMNS)
