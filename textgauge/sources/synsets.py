"""Synonym sets: a reader for WordNet's data files, and the base forms under which a word is looked up.

Sets stay rows of (word, sense). Two words are synonyms if they share a sense; pairs of synonyms are never listed, so a
set may have any number of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Endings of inflected words and what takes their place in the base form.
DETACHMENTS = (
    ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
    ("es", "e"), ("es", ""), ("s", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", ""),
    ("er", ""), ("est", ""), ("er", "e"), ("est", "e"),
)


def read_synsets(spark: SparkSession, path: str) -> DataFrame:
    """word and sense of every single word of the data files at a path.

    A line holds an offset, a file number, a kind, the number of words in hexadecimal, and each word with a number; the sense is
    kind and offset. Lines that begin with a space are the licence. Marks such as "(a)" are cut off, words of several
    parts, which hold an underscore, are left out. A set may be spread over lines with one offset.
    """
    parts = F.split("value", " ")
    words = F.transform(
        F.sequence(F.lit(0), F.conv(parts[3], 16, 10).cast("int") - 1), lambda i: F.get(parts, 4 + 2 * i)
    )
    lines = spark.read.text(path).filter(~F.startswith("value", F.lit(" ")) & (F.size(parts) > 5))
    found = lines.select(F.concat_ws("-", parts[2], parts[0]).alias("sense"), F.explode(words).alias("word"))
    plain = F.lower(F.regexp_replace("word", r"\([a-z]+\)$", ""))
    return found.select(plain.alias("word"), "sense").filter(~F.contains("word", F.lit("_"))).distinct()


def base_forms(word: Column) -> Column:
    """The word itself and what is left of it under each ending that it has."""
    head = lambda end: F.substring(word, F.lit(1), F.length(word) - len(end))
    has = lambda end: F.endswith(word, F.lit(end)) & (F.length(word) > len(end))
    forms = [F.when(has(end), F.concat(head(end), F.lit(base))) for end, base in DETACHMENTS]
    return F.array_distinct(F.array_compact(F.array(word, *forms)))
