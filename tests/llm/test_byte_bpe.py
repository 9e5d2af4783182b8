import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import AWKWARD, documents  # noqa: F401

from textgauge.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
BPE = byte_bpe.ByteBpe.from_file(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=BPE.ranks, special_tokens={})


def same(texts):
    got = [np.frombuffer(x, "<u4") for x in BPE.encode(texts)]
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == LIBRARY.encode_ordinary(text)
        assert BPE.decode(ids) == text.encode()


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abstlrevmd'’ \n\t　\xa0\x1c\x851²é漢!<|>.")), max_size=30), max_size=5))
def test_same_ids_as_the_library(texts):
    same(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_same_ids_on_any_text(texts):
    same(texts)


def test_every_code_point():
    points = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}1 {c}!" for c in points[i : i + 64]) for i in range(0, len(points), 64)]
    wrong = []
    for text, ids in zip(texts, BPE.encode(texts)):
        if np.frombuffer(ids, "<u4").tolist() != LIBRARY.encode_ordinary(text):
            wrong.append(hex(ord(text[1])))
    assert wrong == []


def test_long_runs():
    same(["a" * 20000, "ab" * 5000, " " * 3000, "!" * 2000 + "x", "\n" * 999 + " x", "é" * 3000])


def test_documents():
    import pyarrow.parquet as pq

    same(pq.read_table(f"{DATA}/sf0.001/documents.parquet").column("text").to_pylist())


@given(st.lists(st.sampled_from([byte_bpe.STEP, byte_bpe.OPEN_ONE, byte_bpe.OPEN_TWO]), max_size=40), st.integers(1, 300))
@settings(max_examples=60, deadline=None)
def test_scan_is_the_machine(part, times):
    functions = np.array(part * times, dtype=np.uint8)
    state, expected = byte_bpe.PLAIN, []
    for f in functions.tolist():
        expected.append(state)
        state = f >> 2 * state & 3
    assert byte_bpe.states_before(functions).tolist() == expected


def test_ranges_decode_alone():
    text = "Ünïcode words and 12345 more, don't they? 漢字" * 3
    ids = np.frombuffer(BPE.encode([text])[0], "<u4")
    offsets = BPE.offsets(ids)
    data = text.encode()
    for start, stop in [(0, 5), (7, 7), (3, 40), (20, len(data)), (0, len(data))]:
        assert byte_bpe.decode_range(BPE, ids, offsets, start, stop) == data[start:stop]


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_table(spark, documents, rows):  # noqa: F811
    docs = documents(rows, extra=("ids", "offsets"))
    tokens = byte_bpe.encoded(docs, PATH)
    got = byte_bpe.digests(tokens, PATH).collect()
    expected = []
    for d, t in rows:
        ids = np.array(LIBRARY.encode_ordinary(t or ""), dtype="<u4")
        expected.append((d, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    for r in tokens.collect():
        assert len(r.offsets) == len(r.ids) + 1 and r.offsets[0] == 0
