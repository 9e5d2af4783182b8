"""Rows that operators must take: nulls, empty and long texts, repeated and missing ids."""

import public_tokenizers
import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """A frame of documents out of (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows, extra=()):
        full = [(*row, *("en", "s")[len(row) - 2 :], len(row[1] or "")) for row in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in extra:
            df = df.withColumn(name, df.doc_id.cast("string"))
        return df

    return make


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path("byte_bpe_50k.json")

AWKWARD = [
    (1, "plain words and more words"),
    (2, None),
    (3, ""),
    (4, "  lead \t tabs\n\n  runs   of space  "),
    (4, "the same id twice"),
    (None, "no id at all"),
    (None, None),
    (5, "word " * 30000),
    (6, "x" * 70000),
    (7, "don't we'll <|endoftext|> 12 34 é ü   z \n a　b 漢字 \U0001f600!"),
    (7, "plain words and more words"),
    (8, "Plain  words and\nmore words"),
    (9, " "),
    (10, " \n "),
]
