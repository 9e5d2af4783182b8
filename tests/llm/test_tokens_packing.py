import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import AWKWARD, documents, vocabulary  # noqa: F401
from tokenizers import Tokenizer

from textgauge.llm import packing, token_files
from textgauge.llm.encode import WordEncoder


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_file(vocabulary)


@pytest.fixture(scope="module")
def words(vocabulary):
    return WordEncoder(vocabulary)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def per_text(words, texts):
    """The ids of each text, out of the column form."""
    got = []
    for _, ids, sizes in words.encode_slices(pa.array(texts, pa.string())):
        got += [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]
    return got


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab'st \n\t 　é1!<|>.")), max_size=25), max_size=6))
def test_pieces_of_a_text_have_the_ids_of_the_text(texts):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, words = test_pieces_of_a_text_have_the_ids_of_the_text.__dict__.setdefault(
        "both", (Tokenizer.from_file(path), WordEncoder(path))
    )
    got = per_text(words, texts)
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("special", ["<|endoftext|>", "<|endoftext", "<|endoftext|><|endoftext|>"])
def test_special_tokens_in_texts(library, words, special):
    texts = [t.replace("@", special) for t in ("@", "a @ b", "a@b", "@ a", "a @", " @ ", "x  @  y", "a\n@\nb", "no", "a b@", "@b c d")]
    got = per_text(words, texts)
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert got[0] == ([50256] * special.count("|>") if special.endswith("|>") else got[0])


def test_words_are_forgotten_at_the_end_of_a_task(library, words):
    text = "some words that are kept until the end"
    before = per_text(words, [text])
    words.release()
    assert len(words.words) == 0 and per_text(words, [text]) == before


def test_documents_encode_as_whole_texts(spark, library, words):
    texts = [r.text for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()]
    got = per_text(words, texts)
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_token_files(spark, documents, vocabulary, library, rows, tmp_path):
    docs = documents(rows, extra=("n_tokens", "shard", "tie"))
    token_files.write_tokens(docs, f"{tmp_path}/t", vocabulary)
    table = token_files.read_tokens(f"{tmp_path}/t", spark)
    got = [tuple(r) for r in token_files.token_digests(table).collect()]
    assert sorted((str(d), n, c) for d, _, n, c in got) == sorted(
        (str(d), len(ids), crc(ids)) for d, ids in ((d, ids_of(library, t)) for d, t in rows)
    )
    by_start = sorted(got, key=lambda r: r[1])
    at = 0
    for d, start, n, _ in by_start:
        assert start == at
        at += n
    order = [-1 if r[0] is None else r[0] for r in by_start]
    assert order == sorted(order)


def test_file_format(spark, vocabulary, tmp_path):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    token_files.write_tokens(docs, f"{tmp_path}/t", vocabulary)
    file = next(p for p in (tmp_path / "t").glob("*.parquet"))
    group = pq.ParquetFile(file).metadata.row_group(0)
    columns = {group.column(i).path_in_schema.split(".")[0]: group.column(i) for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert "RLE_DICTIONARY" in columns["tokens"].encodings
    assert columns["doc_id"].has_offset_index and columns["doc_id"].has_column_index
    plan = token_files.shard_offsets(token_files.read_tokens(f"{tmp_path}/t", spark))._jdf.queryExecution()
    assert "ReadSchema: struct<shard:int,shard_start:bigint,n_tokens:bigint>" in plan.executedPlan().toString()


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_packing(spark, documents, vocabulary, library, rows):
    docs = documents(rows, extra=("length", "offset", "rank"))
    got = packing.pack(docs, vocabulary, 64, with_ids=True)
    pieces = got.collect()
    whole = {}
    for r in sorted(pieces, key=lambda r: r.start):
        whole.setdefault(str(r.doc_id), []).append(r)
    expected = [(str(d), ids_of(library, t)) for d, t in rows]
    assert sum(r.length for r in pieces) == sum(len(ids) for _, ids in expected)
    for d, ids in expected:
        if sum(1 for e, _ in expected if e == d) == 1:
            parts = whole[d]
            assert [i for r in parts for i in r.ids] == ids
            assert all(r.length == 64 for r in parts[1:]) and parts[0].length <= 64
            assert [r.ids_crc32 for r in parts] == [crc(r.ids) for r in parts]
            assert [r.piece for r in parts] == list(range(len(parts)))
    filled = {}
    for r in pieces:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    flat = {r.sequence_id: r.ids for r in packing.sequences(got).collect()}
    assert sum(map(len, flat.values())) == sum(r.length for r in pieces)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), max_size=5), st.integers(1, 40))
def test_fullest_is_the_best_sum(counts, room):
    from itertools import product

    lengths = sorted((n for n in counts if n <= room), reverse=True)
    chosen = packing.fullest(counts, lengths, room)
    sums = [
        sum(n * k for n, k in zip(lengths, taken))
        for taken in product(*[range(counts[n] + 1) for n in lengths])
    ]
    assert sum(chosen) == max(s for s in sums if s <= room)
    assert all(chosen.count(n) <= counts[n] for n in chosen)


def test_few_sequences(spark, vocabulary):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    pieces = packing.pack(docs, vocabulary, 2048).toPandas()
    least = -(-pieces.length.sum() // 2048)
    assert pieces.sequence_id.nunique() <= least + 2


def test_new_words_reach_the_library_in_few_strings(library, words, monkeypatch):
    """A word is no Python string of its own unless white space at an end makes it a text."""
    texts = ["", "a " + " ".join(f"w{i}'s été{i}.\n\nNext{i}" for i in range(3000)), " x\x1c y   z 1", "a\tb c\n d"]
    seen, joined, whole, after = [], [], words._whole, words._after_spaces
    monkeypatch.setattr(words, "_whole", lambda some: seen.extend(some) or whole(some))
    monkeypatch.setattr(words, "_after_spaces", lambda some: joined.append(some) or after(some))
    got = per_text(words, texts)
    assert all(isinstance(some, pa.Array) for some in joined)
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    # 6,001 words in texts of 1,000, a few with white space at an end, and the heads of four texts.
    assert len(seen) < 30
