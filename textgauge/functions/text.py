"""Text normalisation and tokens, as built-in expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the code points on which a bare `str.split()` breaks.
WHITESPACE_CLASS = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# What a Treebank-style word tokeniser still cuts once ASCII punctuation is gone:
# quotation marks stand alone, and these contractions come apart.
QUOTES = "«“‘„»”’"
CONTRACTIONS = ("can|not", "gim|me", "gon|na", "got|ta", "lem|me", "wan|na")
# Fixed value: one special marker in a raw completion, such as <|end|>.
SPECIAL_TAG = r"<\|[a-z0-9_]+\|>"
# The entities replaced in page text; the ampersand comes last.
HTML_ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
)
# Markup that carries no text, in the order of removal.
HTML_NOISE = (
    r"(?is)<script[^>]*>.*?</script>",
    r"(?is)<style[^>]*>.*?</style>",
    r"(?s)<!--.*?-->",
    r"<[^>]*>",
)


def normalise(text: Column) -> Column:
    """Lowercase, with the 32 ASCII punctuation characters deleted."""
    return F.translate(F.lower(text), string.punctuation, "")


def whitespace_tokens(text: Column) -> Column:
    """Words between runs of whitespace, without empties."""
    return F.array_remove(F.split(text, f"[{WHITESPACE_CLASS}]+"), "")


def word_tokens(text: Column) -> Column:
    """Words of text without ASCII punctuation: whitespace tokens, quotes and contractions cut."""
    parts = [pair.split("|") for pair in CONTRACTIONS]
    heads = "|".join(rf"{head}(?={tail}\b)" for head, tail in parts)
    apart = F.regexp_replace(text, f"([{QUOTES}])", " $1 ")
    return whitespace_tokens(F.regexp_replace(apart, rf"(?i)\b({heads})", "$1 "))


# The 13a rules. What is taken out or put in place first, in this order, and then where spaces go: around
# all punctuation but . , - and ', around . and , unless a digit is beside, and around a hyphen after a digit.
TOKENS_13A_TEXT = (
    ("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"),
)
TOKENS_13A_SPACES = (
    (r"([{-~\[-` -&(-+:-@/])", " $1 "),
    (r"([^0-9])([.,])", "$1 $2 "),
    (r"([.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
)


def tokens_13a(text: Column) -> Column:
    """Words and punctuation marks under the 13a rules of machine translation scoring."""
    for old, new in TOKENS_13A_TEXT:
        text = F.replace(text, F.lit(old), F.lit(new))
    # Both ends count as spaces.
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for pattern, spaced in TOKENS_13A_SPACES:
        text = F.regexp_replace(text, pattern, spaced)
    return whitespace_tokens(text)


def alnum_tokens(text: Column) -> Column:
    """Runs of [a-z0-9] in the lowercased text: the tokens of ROUGE."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def ngrams(tokens: str, n: int) -> str:
    """SQL text: all n-grams of a token array as strings joined by one space."""
    if n == 1:
        return tokens
    # `get` per word, not `slice`: a slice copies the whole array for every gram.
    words = ", ".join(f"get({tokens}, at + {k})" for k in range(n))
    return (
        f"case when size({tokens}) >= {n} "
        f"then transform(sequence(0, size({tokens}) - {n}), at -> concat_ws(' ', {words})) "
        "else cast(array() as array<string>) end"
    )


def page_text(html: Column) -> Column:
    """The readable text of an HTML page: markup out, entities resolved, spaces collapsed."""
    text = html
    for pattern in HTML_NOISE:
        text = F.regexp_replace(text, pattern, " ")
    text = F.trim(F.regexp_replace(text, f"[{WHITESPACE_CLASS}]+", " "))
    for entity, plain in HTML_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def completion_text(raw: Column, prompt: Column | None = None, answer_tag: str = "<|assistant|>") -> Column:
    """What a model said: all that follows the echoed prompt, without special markers.

    Where the prompt is not known, or not echoed, the answer begins after the first answer tag.
    """
    at = F.instr(raw, answer_tag)
    said = F.when(at > 0, F.substr(raw, at + len(answer_tag))).otherwise(raw)
    if prompt is not None:
        said = F.when(F.startswith(raw, prompt), F.substr(raw, F.length(prompt) + 1)).otherwise(said)
    return F.regexp_replace(said, SPECIAL_TAG, "")


def four_decimals(score: str) -> Column:
    """A score column as text with four decimals, rounded by its exact binary value, ties to even.

    The error of score * 10000 is found with the usual split into two halves of a double; it decides
    where the product looks like a tie but the score is a little off.
    """
    parts = f"{score} - ((134217729d * {score}) - ((134217729d * {score}) - {score}))"  # low half
    scaled, low = f"({score} * 10000d)", f"({parts})"
    error = f"((({score} - {low}) * 10000d - {scaled}) + {low} * 10000d)"
    whole = f"floor({scaled})"
    up = (
        f"{scaled} - {whole} > 0.5d or ({scaled} - {whole} = 0.5d "
        f"and ({error} > 0d or ({error} = 0d and {whole} % 2 = 1)))"
    )
    return F.expr(f"if({score} is null, null, format_string('%.4f', ({whole} + if({up}, 1, 0)) / 10000d))")
