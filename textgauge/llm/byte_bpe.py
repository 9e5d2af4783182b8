"""Byte-level BPE, encoding and decoding, without regular expressions.

Pre-tokenisation works on arrays over all characters of many texts. Each character has a class: letter,
number, white space or other. Boundaries depend on neighbours' classes and on one thing that does not
look like a class: an apostrophe that opens a token may open a contraction, whose letters belong to
it and after which a new token starts. That is a machine of four states, and each character is a function from
states to states. Functions compose associatively, so the states before all characters come out of a
scan in blocks: compose inside blocks, scan the blocks, apply. A function of four states is one byte
and composing two is one lookup.

Slices between boundaries feed pair merging, whose results are kept for each distinct slice. Encoding
returns the ids with the byte offset of each in the text, so any range of ids decodes on its own.

The pattern meant is the one usual with these ranks: contractions ('s 't 're 've 'm 'll 'd), then runs of
letters, numbers or others with one space before, then white space without its last character if
text follows, then white space. Null text counts as empty and gives no ids. Repeated rows and rows with a null doc_id
are encoded alike. Long runs of one class are merged with a heap, in n log n steps. An empty table
gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.llm.common import slices

LETTER, NUMBER, WHITE, OTHER, EDGE = range(5)

# States: ordinary, contraction with one or two letters to go, contraction just over.
PLAIN, ONE_LEFT, TWO_LEFT, OVER = range(4)

# The letters of contractions, and the characters with the White_Space property.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
WHITE_SPACE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Pieces kept with their ids, and the longest that is kept.
KEPT_PIECES, KEPT_LENGTH = 500_000, 64

_BLOCK = 128


def _function(images: tuple[int, ...]) -> int:
    """A function from states to states as one byte, two bits for each image."""
    return sum(image << 2 * state for state, image in enumerate(images))


STEP = _function((PLAIN, OVER, ONE_LEFT, PLAIN))
OPEN_ONE = _function((ONE_LEFT, OVER, ONE_LEFT, ONE_LEFT))
OPEN_TWO = _function((TWO_LEFT, OVER, ONE_LEFT, TWO_LEFT))
IDENTITY = _function((PLAIN, ONE_LEFT, TWO_LEFT, OVER))


def _composition() -> np.ndarray:
    """THEN[f << 8 | g]: first f, then g."""
    f, g = np.divmod(np.arange(1 << 16), 256)
    found = np.zeros(1 << 16, dtype=np.int64)
    for state in range(4):
        middle = f >> 2 * state & 3
        found |= (g >> 2 * middle & 3) << 2 * state
    return found.astype(np.uint8)


THEN = _composition()


def states_before(functions: np.ndarray) -> np.ndarray:
    """The state before each character, from PLAIN at the start, by an associative scan."""
    n = len(functions)
    if n <= _BLOCK:
        state, found = PLAIN, np.empty(n, dtype=np.uint8)
        for i, f in enumerate(functions.tolist()):
            found[i] = state
            state = f >> 2 * state & 3
        return found
    blocks = -(-n // _BLOCK)
    padded = np.full(blocks * _BLOCK, IDENTITY, dtype=np.uint8)
    padded[:n] = functions
    columns = np.ascontiguousarray(padded.reshape(blocks, _BLOCK).T)
    whole = columns[0]
    for row in columns[1:]:
        whole = THEN[whole.astype(np.uint16) << 8 | row]
    state = states_before(whole)
    found = np.empty((_BLOCK, blocks), dtype=np.uint8)
    for i, row in enumerate(columns):
        found[i] = state
        state = row >> 2 * state & 3
    return found.T.ravel()[:n]


_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """The class of each code point; made once per worker."""
    if not _CLASSES:
        kinds = {"L": LETTER, "N": NUMBER}
        found = np.fromiter(
            (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000
        )
        found[WHITE_SPACE] = WHITE
        _CLASSES.append(found)
    return _CLASSES[0]


def boundaries(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Where tokens start in the texts joined with one character between, and where texts start."""
    codes = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le"), dtype="<u4")
    starts = np.cumsum([1, *(len(t) + 1 for t in texts)])
    kind = classes()[codes]
    kind[starts - 1] = EDGE
    before, after = np.append(EDGE, kind[:-1]), np.append(kind[1:], EDGE)
    # A space that is the last of its run goes with the text after it; a run splits before its last.
    last_white = (kind == WHITE) & (after != WHITE) & (after != EDGE)
    joined = np.append(False, (last_white & (codes == 0x20))[:-1])
    starts_token = (kind != before) & ~joined | last_white
    # An apostrophe opens a contraction if it opens a token and the letters follow.
    functions = np.full(len(codes), STEP, dtype=np.uint8)
    for at in np.flatnonzero((codes == 0x27) & starts_token & (after == LETTER)).tolist():
        one, two = chr(codes[at + 1]), "".join(map(chr, codes[at + 1 : at + 3].tolist()))
        if one in CONTRACTIONS:
            functions[at] = OPEN_ONE
        elif two in CONTRACTIONS:
            functions[at] = OPEN_TWO
    state = states_before(functions)
    opens = (state == OVER) | (state == PLAIN) & starts_token
    opens |= kind == EDGE
    return np.flatnonzero(opens), starts


class ByteBpe:
    """Ranks of byte strings, merged pair by pair, the lowest rank first and the leftmost of equals."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.sizes = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.kept: dict[str, bytes] = {}

    @classmethod
    def from_file(cls, path: str) -> ByteBpe:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return self._merge_short(piece) if len(piece) <= KEPT_LENGTH else self._merge_long(piece)

    def _merge_short(self, piece: bytes) -> list[int]:
        rank, none = self.ranks.get, len(self.bytes)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
        return [self.ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        rank, n = self.ranks.get, len(piece)
        end, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        alive, queue = bytearray(b"\1" * n), []

        def offer(a: int) -> None:
            b = end[a]
            if b < n and (r := rank(piece[a : end[b]])) is not None:
                queue.append((r, a, b, end[b]))

        for a in range(n):
            offer(a)
        heapq.heapify(queue)
        while queue:
            _, a, b, stop = heapq.heappop(queue)
            if not alive[a] or end[a] != b or not alive[b] or end[b] != stop:
                continue
            alive[b], end[a] = 0, stop
            if stop < n:
                previous[stop] = a
            for c in (a, previous[a]):
                size = len(queue)
                if c >= 0:
                    offer(c)
                if len(queue) > size:
                    heapq.heappush(queue, queue.pop())
        return [self.ranks[piece[a : end[a]]] for a in range(n) if alive[a]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cuts, starts = boundaries(texts)
        joined = "\n".join(["", *texts, ""])
        at = cuts.tolist()
        pieces = [joined[a:b] for a, b in zip(at, at[1:])]
        if len(self.kept) > KEPT_PIECES:
            self.kept.clear()
        long: dict[str, bytes] = {}
        for piece in set(pieces) - self.kept.keys():
            ids = np.array(self.merge(piece.encode()), dtype="<u4").tobytes()
            (self.kept if len(piece) <= KEPT_LENGTH else long)[piece] = ids
        # Each text's pieces lie between the separators, which are pieces of their own.
        first = np.searchsorted(cuts, starts).tolist()
        kept, found = self.kept, []
        for a, b in zip(first, first[1:]):
            own = pieces[a : b - 1]
            if long and not long.keys().isdisjoint(own):
                found.append(b"".join([long[p] if p in long else kept[p] for p in own]))
            else:
                found.append(b"".join(map(kept.__getitem__, own)))
        return found

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Where the bytes of each id start, and last where they end."""
        return np.append(0, np.cumsum(self.sizes[ids]))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


def decode_range(bpe: ByteBpe, ids: np.ndarray, offsets: np.ndarray, start: int, stop: int) -> bytes:
    """The bytes [start, stop) of a text, out of the ids that cover them alone."""
    a = int(np.searchsorted(offsets, start, side="right")) - 1
    b = int(np.searchsorted(offsets, stop, side="left"))
    return bpe.decode(ids[a:b])[start - offsets[a] : stop - offsets[a]] if stop > start else b""


_CODERS: dict[str, ByteBpe] = {}


def coder(path: str) -> ByteBpe:
    """The coder of this worker for a file of ranks."""
    if path not in _CODERS:
        _CODERS[path] = ByteBpe.from_file(path)
    return _CODERS[path]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, offsets: where the bytes of each id start in the text, and last where they end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text"), 2 << 20):
                data = bpe.encode(texts)
                ids = np.frombuffer(b"".join(data), dtype="<i4")
                ends = np.append(0, np.cumsum([len(d) // 4 for d in data]))
                # Offsets run over all ids of the slice; a text has one more of them than ids.
                over = bpe.offsets(ids)
                lists = [over[a : b + 1] - over[a] for a, b in zip(ends.tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(texts)),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
                        pa.ListArray.from_arrays(
                            pa.array((ends + np.arange(len(ends))).astype(np.int32)),
                            pa.array(np.concatenate(lists or [np.zeros(0)]).astype(np.int32)),
                        ),
                    ],
                    names=["doc_id", "ids", "offsets"],
                )
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, ids array<int>, offsets array<int>"
    )


def digests(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of an encoded table, decoded here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for batch in batches:
            lists = batch.column("ids")
            at, ids = lists.offsets.to_numpy().tolist(), lists.values.to_numpy()
            parts = [ids[a:b] for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(p) for p in parts], pa.int64()),
                    pa.array([hashlib.sha256(p.astype("<u4").tobytes()).hexdigest() for p in parts], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(p)).hexdigest() for p in parts], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return tokens.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
