r"""Elements of one large JSON array, read by many tasks.

A JSON document is one value, so Spark's own reader gives a file to one task. Here the file is read as text
with `}` (or `,`) as the end of a line, which Spark splits at any byte. What a byte means depends on all before it: whether
it is inside a string, and how deep. Every split is therefore summed up as a function of its start: the parity of
its quotes, and for both answers to "inside a string?" its change of depth, its least depth and what it opens there. The
functions of a file's splits, one row each, are composed in order and give each split its start; then each split cuts
its own elements. Elements that cross splits are put together from their parts by a window over two rows per split.

Nothing larger than an Arrow batch and one element is held by a task, and of a batch only a slice as Python objects and masks. The text is read three times, by states, by
elements and by parts of elements, and never shuffled.

Elements are the values of the outermost array, or of the array in the member `field` of the outermost object. Escapes,
braces, brackets and commas inside strings, nested values and white space may be anywhere. A file that is no such document gives
no elements; a file whose JSON is broken gives what its brackets say. Empty files give nothing.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_QUOTE, _ESCAPE, _COMMA = 0x22, 0x5C, 0x2C
_DEPTH = np.zeros(256, dtype=np.int64)
_DEPTH[[0x5B, 0x7B]], _DEPTH[[0x5D, 0x7D]] = 1, -1
_STRUCTURE = _DEPTH != 0
_STRUCTURE[_COMMA] = True
# Bytes of text that a task looks at once, or one piece.
_SLICE_BYTES = 1 << 20
_KEY = re.compile(rb'("(?:[^"\\]|\\.)*")\s*:\s*$', re.S)

_SUMMARY = "split long, file string, block long, odd boolean, change array<long>, least array<long>, opened array<string>"
_START = "split long, file string, block long, inside boolean, depth long, tag string"
_PARTS = "split long, no long, kind string, starts boolean, text string"


def pieces(spark: SparkSession, path: str, end: str = "}") -> DataFrame:
    """file, block (the first byte of the split), split (a hash of both) and the text up to each `end`, in order."""
    lines = spark.read.option("lineSep", end).text(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return lines.select(*place, "value").select(F.xxhash64("file", "block").alias("split"), "file", "block", "value")


def _runs(batches: Iterator[pa.RecordBatch], end: str) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """Batch, first row and bytes of each stretch of rows of one split, some at a time."""
    for batch in batches:
        split = batch.column("split").to_numpy()
        part = np.cumsum(pc.binary_length(batch.column("value")).to_numpy(), dtype=np.int64) // _SLICE_BYTES
        cuts = np.flatnonzero(np.append(True, (split[1:] != split[:-1]) | (part[1:] != part[:-1]))) if len(split) else []
        for a, b in zip(cuts, np.append(cuts[1:], len(split)).astype(int)):
            values = batch.column("value").slice(a, b - a).to_pylist()
            yield batch, int(a), np.frombuffer((end.join(values) + end).encode(), np.uint8)


def _structure(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity of the quotes before each byte and after all, and the places of brackets and commas, in strings or not."""
    quotes = data == _QUOTE
    escapes = data == _ESCAPE
    if escapes.any():
        place = np.arange(len(data))
        # Length of the run of backslashes that ends before each byte.
        last_other = np.maximum.accumulate(np.where(escapes, -1, place))
        run = np.append(0, (place - last_other)[:-1])
        quotes &= run % 2 == 0
    parity = np.append(0, np.cumsum(quotes)) & 1
    return parity, np.flatnonzero(_STRUCTURE[data])


def _tag(data: np.ndarray, at: int) -> str:
    """What the bracket at a place opens: { or [ and the key before it, if it has one."""
    if data[at] == 0x7B:
        return "{"
    key = _KEY.search(data[max(0, at - 4096) : at].tobytes())
    return "[" + (json.loads(key[1]) if key else "")


# What opens more than this many levels above a split's least depth cannot hold the array.
_LEVELS = 3


class _Summary:
    """A split as a function of its start, for both answers to whether it starts inside a string."""

    def __init__(self) -> None:
        self.odd = 0
        self.change, self.least = [0, 0], [0, 0]
        self.opened: list[dict[int, str]] = [{}, {}]

    def add(self, data: np.ndarray) -> None:
        parity, at = _structure(data)
        for inside in (0, 1):
            # The state of the bytes, if the split had started so.
            outside = at[(parity[at] ^ self.odd) == inside]
            steps = _DEPTH[data[outside]]
            after = self.change[inside] + np.cumsum(steps)
            if not len(after):
                continue
            self.least[inside] = min(self.least[inside], int(after.min()))
            levels = {}
            for level in range(self.least[inside], self.least[inside] + _LEVELS):
                opening = np.flatnonzero((steps == 1) & (after - 1 == level))
                if len(opening):
                    levels[level] = _tag(data, int(outside[opening[-1]]))
                elif level in self.opened[inside]:
                    levels[level] = self.opened[inside][level]
            self.opened[inside] = levels
            self.change[inside] = int(after[-1])
        self.odd ^= int(parity[-1])


def _summaries(end: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, split = None, None
        for batch, at, data in _runs(batches, end):
            if batch.column("split")[at].as_py() != split:
                if now:
                    yield _summary_row(name, now)
                split, now = batch.column("split")[at].as_py(), _Summary()
                name = (split, batch.column("file")[at].as_py(), batch.column("block")[at].as_py())
            now.add(data)
        if now:
            yield _summary_row(name, now)

    return run


def _summary_row(name: tuple, s: _Summary) -> pa.RecordBatch:
    opened = [o.get(s.least[i] + level) for i, o in enumerate(s.opened) for level in range(_LEVELS)]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
    row = [*name, bool(s.odd), s.change, s.least, opened]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=[c.split()[0] for c in _SUMMARY.split(", ")])


def _starts(level: int):
    def run(splits: pd.DataFrame) -> pd.DataFrame:
        """The state at the start of each split of a file, by composing the functions of those before."""
        rows, inside, depth, tag = [], 0, 0, ""
        for s in splits.sort_values("block").itertuples(index=False):
            rows.append((s.split, s.file, s.block, bool(inside), depth, tag))
            # The bracket opened last at the level that holds the array's own bracket.
            above = level - depth - s.least[inside]
            if 0 <= above < _LEVELS:
                tag = s.opened[inside * _LEVELS + above] or tag
            depth += s.change[inside]
            inside ^= int(s.odd)
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _START.split(", ")])

    return run


class _Cutter:
    """Cuts the text of one split into elements, parts of elements and what is outside the array."""

    def __init__(self, inside: bool, depth: int, tag: str, level: int, wanted: str):
        self.odd, self.depth, self.level, self.wanted = int(inside), depth, level, wanted
        self.open = depth > level and tag == wanted
        self.starts, self.no, self.held = False, 0, []

    def _take(self, text: bytes, kind: str) -> tuple | None:
        """The text held so far and some more, as a row; an empty element is none."""
        whole = b"".join([*self.held, text])
        self.held = []
        if kind == "element" and self.starts and not whole.strip():
            return None
        row = (self.no, kind if self.starts or kind == "outer" else "part", self.starts, whole.decode("utf-8", "replace"))
        self.no += 1
        return row

    def add(self, data: np.ndarray) -> Iterator[tuple]:
        parity, at = _structure(data)
        at = at[(parity[at] ^ self.odd) == 0]
        steps = _DEPTH[data[at]]
        after = self.depth + np.cumsum(steps)
        cuts = np.flatnonzero(
            ((steps == 0) & (after == self.level + 1)) | ((steps == 1) & (after == self.level + 1)) | ((steps == -1) & (after == self.level))
        )
        done = 0
        for i in cuts.tolist():
            place, step = int(at[i]), int(steps[i])
            if self.open:
                row = self._take(data[done:place].tobytes(), "element")
                if row:
                    yield row
                done = place + (step == 0)
                self.starts, self.open = step == 0, step == 0
            elif step == 1 and _tag(data, place) == self.wanted:
                yield self._take(data[done : place + 1].tobytes(), "outer")
                done, self.open, self.starts = place + 1, True, True
        self.held.append(data[done:].tobytes())
        self.odd ^= int(parity[-1])
        if len(after):
            self.depth = int(after[-1])

    def finish(self) -> tuple:
        """What is left at the end of the split; an element that ends here shows that only in the next."""
        rest = b"".join(self.held).decode("utf-8", "replace")
        return (self.no, "part" if self.open else "outer", self.open and self.starts, rest)


def _cut(end: str, level: int, wanted: str):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string()]

    def rows(split: int, found: list[tuple]) -> pa.RecordBatch:
        columns = [[split] * len(found), *zip(*found)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in _PARTS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, split = None, None
        for batch, at, data in _runs(batches, end):
            if batch.column("split")[at].as_py() != split:
                if now:
                    yield rows(split, [now.finish()])
                state = [batch.column(c)[at].as_py() for c in ("inside", "depth", "tag")]
                split, now = batch.column("split")[at].as_py(), _Cutter(*state, level, wanted)
            found = list(now.add(data))
            if found:
                yield rows(split, found)
        if now:
            yield rows(split, [now.finish()])

    return run


def _cut_rows(spark: SparkSession, path: str, field: str | None, end: str) -> tuple[DataFrame, DataFrame]:
    """Rows of all splits by kind, and file and block of each split."""
    level, wanted = (0, "[") if field is None else (1, "[" + field)
    if field is not None and end in field:
        raise ValueError(f"a member with {end!r} in its name needs another end of pieces")
    text = pieces(spark, path, end)
    starts = text.mapInArrow(_summaries(end), _SUMMARY).groupBy("file").applyInPandas(_starts(level), _START)
    # One row per split, that is per task of this scan.
    known = text.select("split", "value").join(F.broadcast(starts.drop("file", "block")), "split")
    return known.mapInArrow(_cut(end, level, wanted), _PARTS), starts.select("split", "file", "block")


def elements(spark: SparkSession, path: str, field: str | None = None, end: str = "}") -> DataFrame:
    """file, block, no and element (its JSON text) of every element; (block, no) ascends in the order of the file."""
    rows, splits = _cut_rows(spark, path, field, end)
    placed = rows.join(F.broadcast(splits), "split").drop("split")
    whole = placed.filter("kind = 'element'").select("file", "block", "no", F.col("text").alias("element"))
    parts = placed.filter("kind = 'part'")
    order = Window.partitionBy("file").orderBy("block", "no")
    own = F.when(F.col("starts"), F.struct("block", "no"))
    owner = F.last(own, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = (
        parts.withColumn("own", owner)
        .groupBy("file", "own")
        .agg(F.array_sort(F.collect_list(F.struct("block", "no", "text"))).alias("p"))
        .select("file", "own.block", "own.no", F.array_join("p.text", "").alias("element"))
        .filter(F.col("element").rlike(r"[^ \t\r\n]"))
    )
    return whole.unionByName(joined)


def outer_documents(spark: SparkSession, path: str, field: str | None = None, end: str = "}") -> DataFrame:
    """file and document: each document with its array emptied. All else of a document becomes one row."""
    rows, splits = _cut_rows(spark, path, field, end)
    outside = rows.filter("kind = 'outer'").join(F.broadcast(splits), "split")
    return outside.groupBy("file").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("block", "no", "text"))).getField("text"), "").alias("document")
    )
