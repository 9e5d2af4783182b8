"""Porter stems of token arrays, one stemming per distinct word of an Arrow batch."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published algorithm with the usual extensions: whole words with a set stem.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
# Fixed values of the published algorithm: suffix and replacement, steps 2 to 4.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize",
    "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "fulli": "ful",
    "logi": "log",
}
STEP3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)
_PAST, _ENDS2, _ENDS3, _ENDS4 = (tuple(sorted(ends, key=len, reverse=True)) for ends in (("ed", "ing"), STEP2, STEP3, STEP4))


def _shape(word: str) -> str:
    """One letter per character: c for consonant, v for vowel; y follows its neighbour."""
    shape = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return shape == "vc" or (shape.endswith("cvc") and word[-1] not in "wxy")


def _longest(word: str, suffixes: tuple[str, ...]) -> str | None:
    """The first of suffixes, the longest of which come first, that the word has; most words have none."""
    return next(filter(word.endswith, suffixes)) if word.endswith(suffixes) else None


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    suffix = _longest(word, _PAST)
    if suffix is None or "v" not in _shape(word[: -len(suffix)]):
        return word
    base = word[: -len(suffix)]
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if len(base) > 1 and base[-1] == base[-2] and _shape(base)[-1] == "c":
        return base if base[-1] in "lsz" else base[:-1]
    return base + "e" if _measure(base) == 1 and _short_end(base) else base


def _final_y(word: str) -> str:
    if word.endswith("y") and len(word) > 2 and _shape(word)[-2] == "c":
        return word[:-1] + "i"
    return word


def _step2(word: str) -> str:
    suffix = _longest(word, _ENDS2)
    if suffix is None:
        return word
    base = word[: -len(suffix)]
    if suffix == "alli" and _measure(base) > 0:
        return _step2(base + "al")
    # "logi" keeps its l in the part that is measured.
    measured = base + "l" if suffix == "logi" else base
    return base + STEP2[suffix] if _measure(measured) > 0 else word


def _step3(word: str) -> str:
    suffix = _longest(word, _ENDS3)
    if suffix is None or _measure(word[: -len(suffix)]) == 0:
        return word
    return word[: -len(suffix)] + STEP3[suffix]


def _step4(word: str) -> str:
    suffix = _longest(word, _ENDS4)
    if suffix is None:
        return word
    base = word[: -len(suffix)]
    if _measure(base) < 2 or (suffix == "ion" and base[-1] not in "st"):
        return word
    return base


def _step5(word: str) -> str:
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _short_end(base)):
            word = base
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


@lru_cache(maxsize=1 << 16)
def porter(word: str) -> str:
    """The stem of one word, lowercased."""
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past, _final_y, _step2, _step3, _step4, _step5):
        word = step(word)
    return word


def _stem_lists(lists: pa.Array, min_length: int) -> pa.Array:
    lengths = [0 if size is None else size for size in pc.list_value_length(lists).to_pylist()]
    words = lists.flatten().dictionary_encode()
    stems = pa.array(
        [porter(w) if len(w) >= min_length else w for w in words.dictionary.to_pylist()], pa.string()
    )
    offsets = [0]
    for length in lengths:
        offsets.append(offsets[-1] + length)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), stems.take(words.indices))


def stem_tokens(tokens: Column, min_length: int = 1) -> Column:
    """Stems of a token array; tokens shorter than `min_length` stay as they are."""

    @F.arrow_udf("array<string>")
    def stems(lists: pa.Array) -> pa.Array:
        return _stem_lists(lists, min_length)

    return stems(tokens)


def rouge_stems(tokens: Column) -> Column:
    """ROUGE stems only tokens longer than three characters."""
    return stem_tokens(tokens, min_length=4)
