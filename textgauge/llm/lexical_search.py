r"""Ranked lexical search: the best documents of every item, by presence masks.

Terms are the maximal matches of TERM in a whole text, A-Z lower-cased. With N documents that have a
term, L terms in all of them, n terms in a document, df documents holding a term and tf its occurrences in one:

* w = floor(1000 ln((2 N + 2) / (2 df + 1))), in doubles
* m = 25 + 75 n N div L
* a document's score is the sum of w (1000000000 tf div (1000 tf + 8 m)) over an item's terms, repeats included

The first pass over the texts keeps of every document its length and its items' terms with their frequencies, as
numbers of a vocabulary. The second pass works on slices of these documents. A slice has a bitmap of documents
for every term; for an item the bitmaps of its terms, read across, give each document the mask of the
terms that it holds, and documents with the same mask are a group. The largest score of a mask comes from the
highest frequency of each term and the shortest document in the slice. Masks are evaluated from
the largest down, and left as soon as the item has enough documents with more than the next mask can give; what
a task has found so far holds for its later slices. The best of all tasks are merged in two steps.

Items are handled in blocks of about BLOCK_TERMS terms, whose vocabulary alone is sent to the tasks; a larger item is a
block of its own. There is no limit on documents, frequencies or terms.

Null texts have no terms. An item without a term that occurs has no rows. Rows with equal or null item ids are ranked one by one. Repeated
documents count as often as they occur. Equal scores go by ascending doc_id, null last. Empty tables give an
empty table. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textgauge.llm.common import give_back, stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_TERMS = 1 << 16

# Documents of a slice, and bytes of text whose terms are numbered at once.
SLICE_DOCS, SLICE_BYTES = 4096, 1 << 20

# Bytes of UTF-8 that are part of a term, and all bytes with A-Z lower-cased.
_IN_TERM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)

_POSTINGS = "doc_id long, n long, terms array<int>, tf array<int>"
_BEST = "part int, item int, doc_id long, score long"


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of some texts in order, and for each the number of its text."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = _LOWER[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    inside = _IN_TERM[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | np.append(True, ~inside[:-1])))
    ends = np.flatnonzero(inside & (edge[1:] | np.append(~inside[1:], True))) + 1
    sizes = np.append(0, np.cumsum(ends - starts))
    values = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(sizes), pa.py_buffer(data[inside])]
    )
    first = np.searchsorted(starts, offsets)
    return values, np.repeat(np.arange(len(texts)), np.diff(first))


def _ranges(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to about `most`, or single rows."""
    part = np.cumsum(sizes) // most
    starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, int)
    return zip(starts.tolist(), np.append(starts[1:], len(sizes)).tolist())


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n, terms (numbers in the vocabulary, ascending) and tf of every document that has a term."""
    known = pa.array(vocabulary, pa.large_binary())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            for a, b in _ranges(pc.binary_length(texts).fill_null(0).to_numpy(), SLICE_BYTES):
                values, owner = terms_of(texts.slice(a, b - a))
                n = np.bincount(owner, minlength=b - a)
                number = pc.index_in(values, value_set=known).fill_null(-1).to_numpy().astype(np.int64)
                cells, tf = np.unique((owner * len(known) + number)[number >= 0], return_counts=True)
                has_terms = np.flatnonzero(n)
                offsets = np.searchsorted(cells, np.append(has_terms, b - a) * len(known)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a).take(pa.array(has_terms)),
                        pa.array(n[has_terms]),
                        pa.ListArray.from_arrays(offsets, pa.array((cells % max(1, len(known))).astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32))),
                    ],
                    names=["doc_id", "n", "terms", "tf"],
                )
        give_back()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, _POSTINGS)


class Scorer:
    """The weights of a corpus, and what a term adds to a score."""

    def __init__(self, documents: int, terms: int, weights: np.ndarray):
        self.documents, self.terms, self.weights = documents, terms, weights

    def spread(self, n: np.ndarray) -> np.ndarray:
        """m of documents with n terms."""
        return 25 + 75 * n * self.documents // max(1, self.terms)

    @staticmethod
    def saturated(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * tf // np.maximum(1000 * tf + 8 * m, 1)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Slice:
    """Some documents: bitmaps of the terms, and frequencies to look up."""

    def __init__(self, doc_ids: np.ndarray, n: np.ndarray, owner: np.ndarray, term: np.ndarray, tf: np.ndarray, scorer: Scorer):
        self.doc_ids, self.m, self.scorer = doc_ids, scorer.spread(n), scorer
        self.size = len(n)
        order = np.argsort(term, kind="stable")
        self.cells = term[order] * self.size + owner[order]
        self.tf = tf[order]
        self.present, at = np.unique(term[order], return_index=True)
        row = np.repeat(np.arange(len(self.present)), np.diff(np.append(at, len(term))))
        held = np.zeros((len(self.present), self.size), dtype=bool)
        held[row, owner[order]] = True
        self.bitmaps = np.packbits(held, axis=1, bitorder="little")
        highest = np.maximum.reduceat(self.tf, at) if len(at) else self.tf
        least = self.m.min(initial=1 << 40)
        self.most = scorer.weights[self.present] * scorer.saturated(highest, least)

    def groups(self, terms: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
        """The item's terms here and their counts; distinct masks with the largest score of each; the mask of each document."""
        at = np.searchsorted(self.present, terms)
        here = (at < len(self.present)) & (self.present[np.minimum(at, len(self.present) - 1)] == terms)
        at, terms, times = at[here], terms[here], times[here]
        if not len(at):
            return terms, times, np.zeros(0, np.int64), np.zeros(self.size, np.int64)
        bits = np.unpackbits(self.bitmaps[at], axis=1, count=self.size, bitorder="little")
        masks = np.packbits(bits.T, axis=1, bitorder="little")
        wide = np.zeros((self.size, -(-masks.shape[1] // 8) * 8), dtype=np.uint8)
        wide[:, : masks.shape[1]] = masks
        words = wide.view("<u8")
        keys = words[:, 0] if words.shape[1] == 1 else words.view(np.dtype((np.void, wide.shape[1])))[:, 0]
        _, one, group = np.unique(keys, return_index=True, return_inverse=True)
        return terms, times, bits[:, one].T @ (times * self.most[at]), group

    def scores(self, docs: np.ndarray, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Exact scores of some documents."""
        cells = terms[None, :] * self.size + docs[:, None]
        at = np.minimum(np.searchsorted(self.cells, cells), len(self.cells) - 1)
        tf = np.where(self.cells[at] == cells, self.tf[at], 0)
        gain = self.scorer.saturated(tf, self.m[docs][:, None])
        return gain @ (times * self.scorer.weights[terms])


def _best(rows: list[tuple], k: int) -> list[tuple]:
    """The k best of (score, doc_id or None)."""
    return sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:k]


def search_slice(part: Slice, terms: np.ndarray, times: np.ndarray, found: list[tuple], k: int) -> tuple[list[tuple], int]:
    """The best of `found` and the slice, and how many documents were evaluated."""
    if not part.size or not len(part.present):
        return found, 0
    terms, times, largest, group = part.groups(terms, times)
    if not len(terms):
        return found, 0
    ranked = np.argsort(-largest, kind="stable")
    ranked = ranked[largest[ranked] > 0]
    members = np.argsort(group, kind="stable")
    ends = np.cumsum(np.bincount(group, minlength=len(largest)))
    evaluated, at, some = 0, 0, 1
    while at < len(ranked):
        # Equal scores are still compared by doc_id, so only a smaller maximum ends the search.
        if len(found) == k and largest[ranked[at]] < found[-1][0]:
            break
        # A few masks at a time, more and more of them.
        masks = ranked[at : at + some]
        docs = np.concatenate([members[ends[g] - c : ends[g]] for g, c in zip(masks, np.diff(np.append(0, ends))[masks])])
        scores = part.scores(docs, terms, times)
        evaluated += len(docs)
        if len(found) == k:
            docs, scores = docs[scores >= found[-1][0]], scores[scores >= found[-1][0]]
        if len(docs) > 4 * k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            docs, scores = docs[scores >= least], scores[scores >= least]
        ids = part.doc_ids[docs]
        found = _best(found + [(int(s), i) for s, i in zip(scores, ids) if s > 0], k)
        at, some = at + some, 4 * some
    return found, evaluated


def best_of_tasks(rows: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], scorer: Scorer, k: int) -> DataFrame:
    """part, item (place in `items`), doc_id, score: the k best of each task for every item."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list[tuple]] = [[] for _ in items]
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_DOCS):
                some = batch.slice(at, SLICE_DOCS)
                sizes = pc.list_value_length(some.column("terms")).to_numpy()
                part = Slice(
                    np.array(some.column("doc_id").to_pylist(), dtype=object),
                    some.column("n").to_numpy(),
                    np.repeat(np.arange(some.num_rows), sizes),
                    some.column("terms").flatten().to_numpy().astype(np.int64),
                    some.column("tf").flatten().to_numpy().astype(np.int64),
                    scorer,
                )
                for i, (terms, times) in enumerate(items):
                    found[i], _ = search_slice(part, terms, times, found[i], k)
        task = TaskContext.get().partitionId()
        out = [(task, i, doc_id, score) for i, best in enumerate(found) for score, doc_id in best]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        columns = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "item", "doc_id", "score"]
        )
        give_back()

    return rows.mapInArrow(search, _BEST)


def _ranked(best: DataFrame, key: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search_block(docs: DataFrame, items: list[tuple[int | None, str | None]], k: int) -> DataFrame:
    """item_id, rank, doc_id and score for some items."""
    values, owner = terms_of(pa.array([text for _, text in items], pa.large_string()))
    numbered = values.dictionary_encode()
    vocabulary = numbered.dictionary.to_pylist()
    counts: list[tuple[np.ndarray, np.ndarray]] = []
    numbers = numbered.indices.to_numpy().astype(np.int64)
    cuts = np.searchsorted(owner, np.arange(len(items) + 1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        counts.append(np.unique(numbers[a:b], return_counts=True))
    rows = stored(postings(docs, vocabulary), "postings")
    size = rows.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for term, n in rows.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        df[term] = n
    weights = np.array([weight(size["documents"], int(d)) for d in df], dtype=np.int64)
    scorer = Scorer(size["documents"], size["terms"], weights)
    best = best_of_tasks(rows.filter(F.size("terms") > 0), counts, scorer, k)
    # A task hands on k rows for an item; a few hundred tasks meet before all do.
    some = _ranked(best.withColumn("part", F.col("part") % F.lit(256)), ["item", "part"], k)
    names = docs.sparkSession.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id long")
    return (
        _ranked(some.select("item", "doc_id", "score"), ["item"], k)
        .join(F.broadcast(names), "item")
        .select("item_id", "rank", "doc_id", "score")
    )


def blocks(items: DataFrame, most: int = BLOCK_TERMS) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items (item_id, text) in blocks of about `most` terms; one block at a time is on the driver."""
    some: list[tuple[int | None, str | None]] = []
    taken = 0
    for row in items.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        size = len(terms_of(pa.array([row["text"]], pa.large_string()))[0])
        if some and taken + size > most:
            yield some
            some, taken = [], 0
        some.append((row["item_id"], row["text"]))
        taken += size
    if some:
        yield some


def search(docs: DataFrame, items: DataFrame, k: int = 10, most: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents (doc_id, text) with the highest score above 0 of every item (item_id, text)."""
    found = [search_block(docs, block, k) for block in blocks(items, most)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if len(found) == 1:
        return found[0]
    rows = found[0]
    for other in found[1:]:
        rows = rows.unionAll(other)
    return rows
