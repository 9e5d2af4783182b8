"""Vector expressions on array columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

try:  # a third of the time that OpenSSL's takes for a word
    from _md5 import md5
except ImportError:
    from hashlib import md5

BUCKETS = 64
# Rows whose tokens are counted at once.
SLICE_ROWS = 1024
# Words whose buckets a worker remembers: about 15 MB.
REMEMBERED = 1 << 17


def _sum_of(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def squared_l2(a: Column, b: Column) -> Column:
    return _sum_of(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)))


def dot(a: Column, b: Column) -> Column:
    return _sum_of(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null where a vector is all zero."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


class _Buckets(dict):
    """The bucket of each word, from the first four hex digits of its MD5."""

    def __missing__(self, word: str) -> int:
        first = md5(word.encode()).digest()
        self[word] = bucket = (first[0] << 8 | first[1]) % BUCKETS
        return bucket


_bucket_of = _Buckets()


def _frequencies(lists: pa.Array) -> pa.Array:
    """Bucket counts of token lists, scaled to length 1, some rows at a time; a word is hashed once while it is remembered."""
    made = [np.zeros((0, BUCKETS))]
    for at in range(0, len(lists), SLICE_ROWS):
        some = lists.slice(at, SLICE_ROWS)
        words = some.flatten().dictionary_encode()
        if len(_bucket_of) > REMEMBERED:
            _bucket_of.clear()
        hashed = [_bucket_of[w] for w in words.dictionary.to_numpy(zero_copy_only=False).tolist()]
        buckets = np.array(hashed, np.int64)[words.indices.to_numpy()]
        row = np.repeat(np.arange(len(some)), pc.list_value_length(some).fill_null(0).to_numpy())
        counts = np.bincount(row * BUCKETS + buckets, minlength=len(some) * BUCKETS).reshape(-1, BUCKETS).astype(np.float64)
        # Sums of squared counts are whole numbers, so their order does not matter.
        total = np.sqrt((counts * counts).sum(axis=1))[:, None]
        made.append(np.divide(counts, total, out=counts, where=total > 0))
    ends = np.arange(len(lists) + 1, dtype=np.int32) * BUCKETS
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(made).ravel()))


def hashed_frequencies(tokens: str) -> Column:
    """Token counts hashed to 64 buckets and scaled to length 1; all zero without tokens.

    A token's bucket comes from the first four hex digits of its MD5. The column is never null, and says so: a test for
    null would have Spark work it out once more.
    """

    @F.arrow_udf("array<double>")
    def scaled(lists: pa.Array) -> pa.Array:
        return _frequencies(lists)

    return F.coalesce(scaled(F.col(tokens)), F.array(*[F.lit(0.0)] * BUCKETS))
