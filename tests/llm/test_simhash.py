import random
import re

import pytest
import xxhash
from conftest import DATA
from llm_cases import AWKWARD, documents  # noqa: F401
from pyspark.sql import functions as F

from textgauge.llm import simhash


def slow_print(text, n):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """doc ids (None: no id) with fingerprints to the smallest id that each row can reach."""
    found, left = {}, set(range(len(prints)))
    while left:
        todo, group = [left.pop()], []
        while todo:
            i = todo.pop()
            group.append(i)
            near = {j for j in left if (prints[i][1] ^ prints[j][1]).bit_count() <= 3}
            left -= near
            todo += near
        ids = [prints[i][0] for i in group if prints[i][0] is not None]
        found |= {i: min(ids, default=None) for i in group}
    return found


def check(docs, rows):
    prints = [(d, slow_print(t, 3)) for d, t in rows]
    component = slow_components(prints)
    expected = sorted((str(d), f"{p:016x}", str(component[i])) for i, (d, p) in enumerate(prints))
    got = simhash.simhash_groups(docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected


def test_documents(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_awkward(spark, documents):
    check(documents(AWKWARD, extra=("fp", "mask", "key")), AWKWARD)


def test_empty(spark, documents):
    assert simhash.simhash_groups(documents([])).count() == 0


def test_same_hash_as_spark(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_masks_hide_any_three_bits():
    rng = random.Random(1)
    masks = [m % 2**64 for m in simhash.masks(3)]
    assert len(masks) == 15
    for _ in range(20000):
        bits = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not bits & m for m in masks)


@pytest.mark.parametrize("tile", [4, 1000])
def test_links_connect_all_close_pairs(spark, tile):
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(6)]
    values = {rng.getrandbits(64) for _ in range(200)}
    for c in centres:
        x = c
        for _ in range(60):
            x ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            values.add(x)
        values |= {c ^ (1 << i) for i in range(64)}
    values = sorted(values)
    signed = [(v - 2**64 if v >> 63 else v,) for v in values]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), 3, tile)
    assert all((r.a ^ r.b).bit_count() <= 3 or ((r.a ^ r.b) % 2**64).bit_count() <= 3 for r in links.collect())
    got = {r.node % 2**64: r.root for r in simhash.components(links).collect()}
    expected = slow_components([(v, v) for v in values])
    groups = {}
    for i, v in enumerate(values):
        groups.setdefault(expected[i], []).append(v)
    for members in groups.values():
        if len(members) == 1:
            assert members[0] not in got
        else:
            assert len({got[m] for m in members}) == 1
    assert len(set(got.values())) == sum(len(m) > 1 for m in groups.values())


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(24)]
    star = [(1000, 1001 + i) for i in range(50)]
    links = spark.createDataFrame(path + star, "a long, b long")
    got = {r.node: r.root for r in simhash.components(links).collect()}
    assert got == {**{i: 0 for i in range(25)}, **{i: 1000 for i in range(1000, 1051)}}


def test_one_row_of_each_component_stays(spark, documents):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (3, "other words here now"), (None, "x y"), (None, "x y")]
    docs = documents(rows).withColumn("row", F.monotonically_increasing_id())
    groups = simhash.simhash_groups(docs, carry=("row",))
    assert simhash.redundant(groups, "row").count() == 3
