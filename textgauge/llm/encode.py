"""Token ids of whole texts by the tokenizers library, each distinct word encoded once.

A byte-level pre-tokenizer always starts a token at a space that follows or precedes a character which is
no white space. So texts are split at single spaces, the words numbered by their values, the new ones
encoded by the library, and the ids of the texts gathered from those of their words. Texts with
longer runs of white space around spaces, and those that hold a special token of the vocabulary, are encoded whole.

The library is used as it comes: the string of a special token in a text becomes its id.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from textgauge.llm.common import give_back

# A space between two white-space characters, or last after one: no token need start there.
_WHITE = r"[\s\v\x{1c}-\x{1f}\x{85}\p{Z}]"
_INSIDE_RUN = rf"{_WHITE} {_WHITE}|{_WHITE} \z"
# A word that is empty or has white space at an end.
_ODD = rf"\A(\z|{_WHITE})|{_WHITE}\z"

# An encoder forgets its words beyond so many, or so many bytes of them.
KEPT_WORDS, KEPT_BYTES = 700_000, 32 << 20

# Bytes of text whose words are numbered at once.
SLICE_BYTES = 4 << 20

_ENCODERS: dict[str, WordEncoder] = {}


class WordEncoder:
    """Encodes columns of texts with the library's tokenizer in a file."""

    def __init__(self, path: str):
        # A task has one core; more threads of the library would keep memory of their own.
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.library.no_truncation()
        self.library.no_padding()
        self.opens = np.zeros(self.library.get_vocab_size(), dtype=bool)
        for token, number in self.library.get_vocab().items():
            self.opens[number] = token.startswith("Ġ")
        self._forget()

    def _forget(self) -> None:
        """Words kept, and the ids of each after those of the one before."""
        self.words = pa.array([], pa.large_string())
        self.ids, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), "<u4")
        return ids, np.fromiter(map(len, found), np.int64, len(found))

    def _after_spaces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words after a space: many are encoded as one text and cut at the spaces."""
        # Joined in Arrow, as a Python string for each word costs a quarter of what its encoding does.
        ends = pa.array(np.append(np.arange(0, len(words), 1000), len(words)), pa.int64())
        joined = pc.binary_join(pa.LargeListArray.from_arrays(ends, words), pa.scalar(" ", pa.large_string()))
        ids = self._whole([" " + text for text in joined.to_pylist()])[0]
        cuts = np.append(np.flatnonzero(self.opens[ids]), len(ids))
        if len(cuts) != len(words) + 1:
            raise ValueError("a word was not encoded on its own")
        return ids, np.diff(cuts)

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """The place of each of some distinct words among those kept, after learning the new ones."""
        if len(self.words) > KEPT_WORDS or self.words.nbytes > KEPT_BYTES:
            self._forget()
        at = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(at < 0)
        new = words.take(pa.array(missing))
        # Words with white space at an end might join with their neighbours, so each is its own text.
        is_odd = pc.match_substring_regex(new, _ODD)
        odd = is_odd.to_numpy(zero_copy_only=False)
        regular, others = new.filter(pc.invert(is_odd)), new.filter(is_odd)
        plain = self._after_spaces(regular)
        alone = self._whole([" " + w for w in others.to_pylist()])
        missing = np.concatenate([missing[~odd], missing[odd]])
        at[missing] = len(self.words) + np.arange(len(missing))
        self.words = pa.concat_arrays([self.words, regular, others])
        self.ids = np.concatenate([self.ids, plain[0], alone[0]])
        self.sizes = np.concatenate([self.sizes, plain[1], alone[1]])
        return at

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (large strings without nulls) in order, and how many each text has."""
        irregular = pc.match_substring_regex(texts, _INSIDE_RUN)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)
        data = memoryview(texts.buffers()[2] or b"")[offsets[texts.offset] : offsets[texts.offset + len(texts)]].tobytes()
        for token in self.special:
            # Hardly any column holds one, and all of it is searched faster than text by text.
            if token.encode() in data:
                irregular = pc.or_(irregular, pc.match_substring(texts, token))
        split = pc.split_pattern(pc.if_else(irregular, "", texts), " ")
        numbered = split.flatten().dictionary_encode()
        index = numbered.indices.to_numpy().astype(np.int64)
        # The first word of a text has no space before it; an irregular text counts as one such word.
        first = split.offsets.to_numpy()[:-1] - split.offsets[0].as_py()
        heads = self._whole(pc.if_else(irregular, texts, pc.list_element(split, 0)).to_pylist())
        is_used = np.zeros(len(numbered.dictionary), dtype=bool)
        others = np.ones(len(index), dtype=bool)
        others[first] = False
        is_used[index[others]] = True
        place = np.zeros(len(is_used), dtype=np.int64)
        place[is_used] = self._numbers(numbered.dictionary.filter(pa.array(is_used)))
        index = place[index]
        index[first] = len(self.words) + np.arange(len(first))
        known, sizes = np.concatenate([self.ids, heads[0]]), np.concatenate([self.sizes, heads[1]])
        n = sizes[index]
        ends = np.cumsum(n)
        source = np.repeat((np.cumsum(sizes) - sizes)[index] - (ends - n), n)
        source += np.arange(len(source))
        total = np.append(0, ends)
        return known[source], np.diff(total[np.append(first, len(index))])

    def encode_slices(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """encode() of a few megabytes of a column at a time, null as empty, with the first row's place."""
        texts = texts.cast(pa.large_string()).fill_null("")
        sizes = pc.binary_length(texts).to_numpy()
        part = np.cumsum(sizes) // SLICE_BYTES
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
        for a, b in zip(starts, np.append(starts[1:], len(texts))):
            yield int(a), *self.encode(texts.slice(int(a), int(b - a)))
            pa.default_memory_pool().release_unused()

    def release(self) -> None:
        """Forget all words at the end of a task."""
        self._forget()
        give_back()


def encoder(path: str) -> WordEncoder:
    """The encoder of this worker for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
