"""Best-fit packing by minimum bin slack.

Token lists longer than a sequence are cut into full pieces, the first of which may be shorter. The
sequences depend only on how many pieces there are of each length, a table of at most `capacity`
rows: the solver takes the longest length left, finds by subset-sum dynamic programming on a bit set
the lengths that fill the rest best, and uses that combination as often as its lengths last, as
taking it once and searching again would find it again. Pieces then take their places by their rank
among the pieces of their length, which is counted in tasks.

Null text counts as empty; an empty document is one piece with the end id alone. Rows with the
same or a null doc_id are packed one by one. An empty table gives an empty table. Other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textgauge.llm.common import stored
from textgauge.llm.encode import encoder

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES = f"{_PIECE}, shard int, shard_rank long"


def cut(n_tokens: int, capacity: int) -> Iterator[tuple[int, int]]:
    """start and length of each piece; only the first may be shorter than `capacity`."""
    start, length = 0, (n_tokens - 1) % capacity + 1
    while start < n_tokens:
        yield start, length
        start, length = start + length, capacity


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece, with its rank among the pieces of its length in the same task.

    `with_ids` adds the column ids, the token list of the piece.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for at, ids, sizes in encoder(vocabulary).encode_slices(batch.column("text")):
                rows: list[tuple] = []
                doc_ids = batch.column("doc_id").slice(at, len(sizes)).to_pylist()
                ends = np.cumsum(sizes).tolist()
                for doc_id, a, b in zip(doc_ids, [0, *ends], ends):
                    data = ids[a:b].tobytes() + end
                    for number, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                        part = data[4 * start : 4 * (start + length)]
                        row = (doc_id, number, start, length, zlib.crc32(part), shard, seen[length])
                        rows.append((*row, np.frombuffer(part, "<i4")) if with_ids else row)
                        seen[length] += 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                kinds += [pa.list_(pa.int32())] * with_ids
                names = [f.split()[0] for f in _PIECES.split(", ")] + ["ids"] * with_ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
                )
        encoder(vocabulary).release()

    schema = _PIECES + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, schema)


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> list[int]:
    """The lengths, with repeats, whose sum comes nearest to `room` without passing it.

    Bit s of `reach` says that a sum s can be made. Lengths go from long to short, each as often as
    it is left, in steps of 1, 2, 4 ... copies; the search ends once `room` itself can be made.
    """
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in lengths:
        left = min(counts[length], room // length)
        copies = 1
        while left > 0:
            copies = min(copies, left)
            steps.append((reach, length, copies))
            reach |= (reach << (length * copies)) & mask
            left -= copies
            copies *= 2
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, []
    for before, length, copies in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * copies
            total -= length * copies
    return chosen


def solve(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Combinations of lengths and how many sequences each fills; together they use every piece."""
    counts = {n: c for n, c in counts.items() if c}
    lengths = sorted(counts, reverse=True)
    found = []
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        rest = fullest(counts, [n for n in lengths if n <= capacity - longest and counts[n]], capacity - longest)
        counts[longest] += 1
        combination = [longest, *sorted(rest, reverse=True)]
        times = min(counts[n] // combination.count(n) for n in set(combination))
        for n in combination:
            counts[n] -= times
        lengths = [n for n in lengths if counts[n]]
        found.append((combination, times))
    return found


def _slots(solution: list[tuple[list[int], int]]) -> np.ndarray:
    """length, first rank, first sequence and offset of each place, sorted by length and rank.

    Each combination uses up one of its lengths at least, so the number of places is bounded by the
    capacity, not by the data.
    """
    taken: dict[int, int] = {}
    places, sequence = [], 0
    for combination, times in solution:
        offset = 0
        for length in combination:
            places.append((length, taken.get(length, 0), sequence, offset))
            taken[length] = taken.get(length, 0) + times
            offset += length
        sequence += times
    return np.array(sorted(places), dtype=np.int64).reshape(-1, 4)


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """`pieces` (stored, with length, shard, shard_rank) with sequence_id and offset."""
    per_shard = pieces.groupBy("shard", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_shard.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(solve(counts, capacity))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_shard.select("shard", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = pieces.join(offsets, ["shard", "length"])
    kept = [c for c in pieces.columns if c not in ("shard", "shard_rank")]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = slots[:, 0] * (1 << 48) + slots[:, 1]
        for batch in batches:
            rank = batch.column("__rank").to_numpy()
            length = batch.column("length").to_numpy()
            slot = slots[np.searchsorted(starts, length * (1 << 48) + rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(slot[:, 2] + rank - slot[:, 1]), pa.array(slot[:, 3])],
                names=[*kept, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name in kept)
    rank = (F.col("earlier") + F.col("shard_rank")).alias("__rank")
    return ranked.select(*kept, rank).mapInArrow(assign, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most `capacity` tokens."""
    return place(stored(token_pieces(docs, vocabulary, capacity, end_id, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: whole sequences out of pieces packed with their ids. A group is one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
