"""Matches of two texts for all pairs of an Arrow batch at once: each text cut once per slice, grams as numbers.

A pair's score needs only how many n-grams its texts share and where words meet. Texts that come in many pairs of a slice are
cut into tokens once, grams are numbered, and an occurrence is its gram and how many of the same gram follow it. The k-th last
occurrence on one side meets the k-th last on the other, so shared grams of two texts are the occurrences that both have, and
one search in sorted numbers finds those of all pairs. Scores are left to Spark's expressions.
"""

from __future__ import annotations

import re
import string
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .stem import porter
from .text import CONTRACTIONS, QUOTES, TOKENS_13A_SPACES, TOKENS_13A_TEXT

# Bytes of texts in pairs that are matched at once, or one pair.
SLICE_BYTES = 1 << 20
ORDERS = (1, 2, 3, 4)

# -- the tokens of `text`, for a string that is lowercase where they want it so --------------------

_ALNUM = re.compile("[a-z0-9]+")
_PUNCTUATION = str.maketrans("", "", string.punctuation)
_APART = str.maketrans({q: f" {q} " for q in QUOTES})
_HEADS = re.compile("|".join("{}(?={})".format(*pair.split("|")) for pair in CONTRACTIONS), re.I | re.A)
_TAILS = {head: len(tail) for head, tail in (pair.split("|") for pair in CONTRACTIONS)}
_SPACES_13A = [(re.compile(pattern), re.sub(r"\$(\d)", r"\\\1", spaced)) for pattern, spaced in TOKENS_13A_SPACES]


def _in_word(text: str, at: int) -> bool:
    """As a word boundary of Java sees it: letters, digits, underscore, and marks on a letter or digit."""
    if not 0 <= at < len(text):
        return False
    if text[at] == "_":
        return True
    while at >= 0 and unicodedata.category(text[at]) == "Mn":
        at -= 1
    return at >= 0 and unicodedata.category(text[at]) in ("Lu", "Ll", "Lt", "Lm", "Lo", "Nd")


def without_punctuation(text: str) -> str:
    return text.translate(_PUNCTUATION)


def words_of(text: str) -> list[str]:
    text = text.translate(_APART)
    cuts = [
        m.end() for m in _HEADS.finditer(text)
        if not _in_word(text, m.start() - 1) and not _in_word(text, m.end() + _TAILS[m[0].lower()])
    ]
    for at in reversed(cuts):
        text = f"{text[:at]} {text[at:]}"
    return text.split()


def words_13a_of(text: str) -> list[str]:
    for old, new in TOKENS_13A_TEXT:
        text = text.replace(old, new)
    text = f" {text} "
    for pattern, spaced in _SPACES_13A:
        text = pattern.sub(spaced, text)
    return text.split()


def alnum_of(text: str) -> list[str]:
    return _ALNUM.findall(text)


def alnum_stems_of(text: str) -> list[str]:
    return [porter(w) if len(w) > 3 else w for w in _ALNUM.findall(text)]


# -- matching ------------------------------------------------------------------------------------


class Matcher:
    """Grams of distinct texts, and the occurrences that the two texts of each pair share."""

    def __init__(self, lists: list[list[str]], hyps: np.ndarray, refs: np.ndarray):
        self.hyps, self.refs = hyps, refs
        self.words = list(chain.from_iterable(lists))
        self.sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        self.starts = np.cumsum(self.sizes) - self.sizes
        numbered = pa.array(self.words, pa.string()).dictionary_encode()
        self.ids, self.known = numbered.indices.to_numpy().astype(np.int64), max(1, len(numbered.dictionary))
        self.row = np.repeat(np.arange(len(lists)), self.sizes)
        # Grams of the order reached: where each starts among all words, and its number.
        self.n, self.at, self.gram = 1, np.arange(len(self.ids)), self.ids

    def longer(self) -> None:
        """Go on to grams of one word more."""
        self.n += 1
        fits = self.at + self.n <= (self.starts + self.sizes)[self.row[self.at]]
        self.at, codes = self.at[fits], self.gram[fits] * self.known
        self.gram = np.unique(codes + self.ids[self.at + self.n - 1], return_inverse=True)[1]

    def shared(self) -> tuple[np.ndarray, ...]:
        """pair, gram, a place of the gram among all words, and both places in their texts, by pair and gram."""
        if not len(self.at):
            return (np.zeros(0, np.int64),) * 5
        of, grams = self.row[self.at], int(self.gram.max()) + 1
        # By text and gram, the last place first.
        order = len(of) - 1 - np.argsort((of * grams + self.gram)[::-1], kind="stable")
        of, gram, at = of[order], self.gram[order], self.at[order]
        new = np.append(True, (of[1:] != of[:-1]) | (gram[1:] != gram[:-1]))
        first = np.flatnonzero(new)
        later = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
        most = int(later.max()) + 1
        occurrence = gram * most + later
        sizes = np.maximum(self.sizes - self.n + 1, 0)
        starts = np.cumsum(sizes) - sizes

        def of_pairs(texts: np.ndarray) -> tuple[np.ndarray, ...]:
            n = sizes[texts]
            pair = np.repeat(np.arange(len(texts)), n)
            place = np.repeat(starts[texts] - (np.cumsum(n) - n), n) + np.arange(len(pair))
            return pair, place, pair * (grams * most) + occurrence[place]

        pair, left, wanted = of_pairs(self.hyps)
        _, right, held = of_pairs(self.refs)
        if not len(held):
            return (np.zeros(0, np.int64),) * 5
        found = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
        hit = held[found] == wanted
        pair, left, right = pair[hit], left[hit], right[found[hit]]
        return pair, gram[left], at[left], at[left] - self.starts[of[left]], at[right] - self.starts[of[right]]


def _slices(hyps: pa.Array, refs: pa.Array) -> Iterator[tuple[pa.Array, pa.Array]]:
    size = sum(pc.binary_length(side).fill_null(0).to_numpy().astype(np.int64) for side in (hyps, refs)) + 64
    part = np.cumsum(size) // SLICE_BYTES
    starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
    for a, b in zip(starts, np.append(starts[1:], len(part)).astype(int)):
        yield hyps.slice(int(a), int(b - a)), refs.slice(int(a), int(b - a))


def _numbered(hyps: pa.Array, refs: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct texts, whether both texts of a pair are there, and the numbers of those of such pairs."""
    both = pa.concat_arrays([hyps, refs]).dictionary_encode()
    index = both.indices.fill_null(-1).to_numpy()
    left, right = index[: len(hyps)], index[len(hyps) :]
    there = (left >= 0) & (right >= 0)
    return both.dictionary.to_pylist(), there, left[there], right[there]


def _spread(there: np.ndarray, values: np.ndarray) -> pa.Array:
    """Values of the pairs that are there, null for the others."""
    out = np.zeros(len(there), np.int64)
    out[there] = values
    return pa.array(out, pa.int64(), mask=~there)


def _chunks(pair: np.ndarray, left: np.ndarray, right: np.ndarray, pairs: int) -> np.ndarray:
    """Stretches of links in which both places advance by one, by the left place."""
    order = np.lexsort((left, pair))
    pair, left, right = pair[order], left[order], right[order]
    cut = (pair[1:] != pair[:-1]) | (left[1:] != left[:-1] + 1) | (right[1:] != right[:-1] + 1)
    return np.bincount(pair[np.append(True, cut)[: len(pair)]], minlength=pairs)


Cut = Callable[[str], list[str]]
_SCORED = ("hyp_grams", "ref_grams", "shared1", "shared2", "hyp_words", "ref_words", "matches", "chunks")


def _pair_matches(hyps: pa.Array, refs: pa.Array, clean, grams: Cut, words: Cut) -> pa.StructArray:
    texts, there, left, right = _numbered(hyps, refs)
    texts = [clean(t) for t in texts] if clean else texts
    n, columns = len(left), []
    by_gram = Matcher([grams(t) for t in texts], left, right)
    shared = [np.bincount(by_gram.shared()[0], minlength=n)]
    by_gram.longer()
    shared.append(np.bincount(by_gram.shared()[0], minlength=n))
    by_word = Matcher([words(t) for t in texts], left, right)
    pair, _, _, a, b = by_word.shared()
    columns += [by_gram.sizes[left], by_gram.sizes[right], *shared, by_word.sizes[left], by_word.sizes[right]]
    columns += [np.bincount(pair, minlength=n), _chunks(pair, a, b, n)]
    return pa.StructArray.from_arrays([_spread(there, c) for c in columns], names=list(_SCORED))


def _gram_matches(hyps: pa.Array, refs: pa.Array, clean, words: Cut) -> pa.StructArray:
    texts, there, left, right = _numbered(hyps, refs)
    made = Matcher([words(clean(t) if clean else t) for t in texts], left, right)
    found = []
    for n in ORDERS:
        pair, gram, at, *_ = made.shared()
        if not len(pair):
            break  # without a shared n-gram there is no shared longer one
        first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (gram[1:] != gram[:-1])))
        counts = np.diff(np.append(first, len(pair)))
        _, one, number = np.unique(gram[first], return_index=True, return_inverse=True)
        names = pa.array([" ".join(made.words[i : i + n]) for i in at[first][one].tolist()], pa.string())
        found.append((pair[first], np.full(len(first), n), names.take(pa.array(number)), counts))
        made.longer()
    struct = pa.struct([("n", pa.int32()), ("gram", pa.string()), ("shared", pa.int32())])
    if found:
        pairs, orders, counts = (np.concatenate([f[i] for f in found]) for i in (0, 1, 3))
        by_pair = np.argsort(pairs, kind="stable")
        columns = [
            pa.array(orders[by_pair], pa.int32()),
            pa.concat_arrays([f[2] for f in found]).take(pa.array(by_pair)),
            pa.array(counts[by_pair], pa.int32()),
        ]
        values = pa.StructArray.from_arrays(columns, fields=list(struct))
    else:
        pairs, values = np.zeros(0, np.int64), pa.array([], struct)
    sizes = np.zeros(len(there), np.int64)
    sizes[there] = np.bincount(pairs, minlength=len(left))
    # Pairs without a text have an empty list here, and null lengths that say so.
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), values)
    lengths = [_spread(there, made.sizes[side]) for side in (left, right)]
    return pa.StructArray.from_arrays([*lengths, lists], names=["hyp_len", "ref_len", "grams"])


def _by_slices(work, hyps: pa.Array, refs: pa.Array, empty: pa.DataType) -> pa.Array:
    parts = [work(h, r) for h, r in _slices(hyps, refs)]
    return pa.concat_arrays(parts) if parts else pa.array([], empty)


def pair_matches(hyp: Column, ref: Column, grams: Cut, words: Cut, clean: Callable[[str], str] | None = None) -> Column:
    """struct of bigint: tokens of both sides and shared 1- and 2-grams under `grams`, and under `words` the words of
    both sides, their matches and chunks. All null where a text is."""
    empty = pa.struct([(c, pa.int64()) for c in _SCORED])

    @F.arrow_udf("struct<" + ",".join(f"{c}: bigint" for c in _SCORED) + ">")
    def matched(h: pa.Array, r: pa.Array) -> pa.Array:
        return _by_slices(lambda a, b: _pair_matches(a, b, clean, grams, words), h, r, empty)

    return matched(hyp, ref)


def gram_matches(hyp: Column, ref: Column, words: Cut, clean: Callable[[str], str] | None = None) -> Column:
    """struct of hyp_len, ref_len and array<struct<n, gram, shared>> for n = 1..4. The lengths are null where a text is."""
    fields = "n: int, gram: string, shared: int"
    struct = pa.struct([("n", pa.int32()), ("gram", pa.string()), ("shared", pa.int32())])
    empty = pa.struct([("hyp_len", pa.int64()), ("ref_len", pa.int64()), ("grams", pa.list_(struct))])

    @F.arrow_udf(f"struct<hyp_len: bigint, ref_len: bigint, grams: array<struct<{fields}>>>")
    def matched(h: pa.Array, r: pa.Array) -> pa.Array:
        return _by_slices(lambda a, b: _gram_matches(a, b, clean, words), h, r, empty)

    return matched(hyp, ref)


# -- METEOR by synonym sets ------------------------------------------------------------------------

# Words of pairs that are matched at once, or one pair.
SLICE_WORDS = 1 << 18

Entries = tuple[np.ndarray, np.ndarray, np.ndarray]


def _words(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the lists in order, and how many each list has; null has none."""
    return lists.flatten(), pc.list_value_length(lists).fill_null(0).to_numpy().astype(np.int64)


def _meet(left: Entries, right: Entries) -> tuple[np.ndarray, np.ndarray]:
    """Which entries meet. Entries are (pair, place, code) by pair and place; the k-th last of a code in its pair
    meets the k-th last of the other side."""
    codes = 1 + max(int(side[2].max(initial=0)) for side in (left, right))

    def from_last(side: Entries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key = side[0] * codes + side[2]
        order = len(key) - 1 - np.argsort(key[::-1], kind="stable")
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        later = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
        return order, key, later

    a, b = from_last(left), from_last(right)
    if not len(a[0]) or not len(b[0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    most = 1 + max(int(a[2].max()), int(b[2].max()))
    wanted, held = a[1] * most + a[2], b[1] * most + b[2]
    found = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
    hit = held[found] == wanted
    return a[0][hit], b[0][found[hit]]


def _without(side: Entries, gone: np.ndarray) -> Entries:
    kept = np.ones(len(side[0]), dtype=bool)
    kept[gone] = False
    return tuple(column[kept] for column in side)


class Senses:
    """The senses of numbered words, as numbers."""

    def __init__(self, lists: pa.Array, names: pa.Array):
        """The list of each word, and all senses that there are."""
        listed, self.sizes = _words(lists)
        self.senses = pc.index_in(listed, value_set=names).to_numpy().astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def of(self, side: Entries) -> tuple[np.ndarray, np.ndarray]:
        """The entry and the sense, for every sense of every entry."""
        n = self.sizes[side[2]]
        entry = np.repeat(np.arange(len(n)), n)
        return entry, self.senses[np.repeat(self.starts[side[2]] - (np.cumsum(n) - n), n) + np.arange(len(entry))]


def _meet_by_sense(left: Entries, right: Entries, of_left: Senses, of_right: Senses) -> tuple[np.ndarray, np.ndarray]:
    """Left entries, last first, take the last free right entry of their pair that shares a sense."""
    known = 1 + max(int(s.senses.max(initial=0)) for s in (of_left, of_right))
    (a, a_sense), (b, b_sense) = of_left.of(left), of_right.of(right)
    a_code, b_code = left[0][a] * known + a_sense, right[0][b] * known + b_sense
    # Hardly any sense is on both sides of a pair, so the walk below is over few.
    a_both, b_both = np.isin(a_code, b_code), np.isin(b_code, a_code)
    takers: dict[int, list[int]] = {}
    for entry, code in zip(a[a_both][::-1].tolist(), a_code[a_both][::-1].tolist()):
        takers.setdefault(entry, []).append(code)
    free: dict[int, list[int]] = {}
    for entry, code in zip(b[b_both].tolist(), b_code[b_both].tolist()):
        free.setdefault(code, []).append(entry)
    used, links = set(), []
    for entry, codes in takers.items():
        best = -1
        for code in codes:
            held = free[code]
            while held and held[-1] in used:
                held.pop()
            if held and held[-1] > best:
                best = held[-1]
        if best >= 0:
            used.add(best)
            links.append((entry, best))
    linked = np.array(links, np.int64).reshape(-1, 2)
    return linked[:, 0], linked[:, 1]


def sense_matches(hyps: pa.Array, refs: pa.Array, looked_up: np.ndarray, known: pa.Table) -> tuple[pa.Array, pa.Array]:
    """Matches and chunks of pairs of token lists: words, then stems, then stems that share a sense; a null
    list has no words.

    `known` has each word once, with its stem, hyp_senses and ref_senses; only pairs that are `looked_up` have the last stage.
    """
    (left, left_sizes), (right, right_sizes) = _words(hyps), _words(refs)
    words, stems, *senses = (known[c].combine_chunks() for c in ("word", "stem", "hyp_senses", "ref_senses"))
    ids = pc.index_in(pa.concat_arrays([left, right]), value_set=words).to_numpy().astype(np.int64)
    stem = stems.dictionary_encode().indices.to_numpy().astype(np.int64)
    names = pc.unique(pa.concat_arrays([lists.flatten() for lists in senses]))
    by_side = [Senses(lists, names) for lists in senses]
    ends = [np.append(0, np.cumsum(sizes)) for sizes in (left_sizes, right_sizes)]
    part = (ends[0] + ends[1])[1:] // SLICE_WORDS
    cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)]), len(part))
    matches, chunks = np.zeros(len(hyps), np.int64), np.zeros(len(hyps), np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        sides = []
        for sizes, end, skipped in ((left_sizes, ends[0], 0), (right_sizes, ends[1], len(left))):
            n = sizes[a:b]
            pair = np.repeat(np.arange(b - a), n)
            place = np.arange(len(pair)) - np.repeat(end[a:b] - end[a], n)
            sides.append((pair, place, ids[skipped + end[a] : skipped + end[b]]))
        links = []

        def link(met: tuple[np.ndarray, np.ndarray]) -> None:
            links.append((sides[0][0][met[0]], sides[0][1][met[0]], sides[1][1][met[1]]))
            sides[:] = [_without(side, gone) for side, gone in zip(sides, met)]

        link(_meet(*sides))
        link(_meet(*[(pair, place, stem[word]) for pair, place, word in sides]))
        sides = [_without(side, np.flatnonzero(~looked_up[a:b][side[0]])) for side in sides]
        link(_meet_by_sense(*sides, *by_side))
        pair, l, r = (np.concatenate(column) for column in zip(*links))  # noqa: E741
        matches[a:b], chunks[a:b] = np.bincount(pair, minlength=b - a), _chunks(pair, l, r, b - a)
    return pa.array(matches, pa.int64()), pa.array(chunks, pa.int64())
