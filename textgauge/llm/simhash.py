"""Near duplicates by SimHash and covering locality-sensitive hashing.

A fingerprint has 64 bits; bit i is set if more than half of the shingles' hashes have it set. Every
bit position gets a vector of radius + 1 bits that is not zero, and each of the 2^(radius+1) - 1
vectors v that are not zero gives a mask of the positions whose vector has an odd product with v.
The vectors of `radius` differing bits never span all dimensions, so some v is orthogonal to them all
and its mask hides them: every pair within the radius shares a masked value in some table.

Distinct fingerprints alone are compared. A bucket with few members is one cell; a larger one is cut
into tiles and each pair of tiles is a cell, so no task gets a whole bucket, no pair is lost and no pair
is listed: a cell hands on only the edges of a spanning forest. Components come from
alternating star contraction, each step a join and an aggregate over edges.

Words are runs of characters other than [\\x20\\x09-\\x0D] after lower-casing A-Z. Texts shorter than a
shingle are one shingle; null texts and texts without words have fingerprint zero and are linked like
any other. Rows with a null doc_id are linked too, a component's id is its smallest doc_id that is not
null. Repeated rows have equal fingerprints. An empty table gives an empty table. Other columns are
ignored, but for those named in `carry`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.llm.common import give_back, stored

SEED = 42
TILE = 1024


def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint as an unsigned 64-bit integer."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
    hashes = np.array(
        [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())], dtype="<u8"
    )
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        block = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long) and the carried columns."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        prints = [fingerprint(t.as_py(), shingle) for t in texts]
        give_back()
        return pa.array(np.array(prints, dtype=np.uint64).view(np.int64))

    return docs.select(F.col("doc_id").cast("long"), of("text").alias("fp"), *carry)


def masks(radius: int, bits: int = 64) -> list[int]:
    """The masks of the covering family, as signed 64-bit integers."""
    vectors = (1 << (radius + 1)) - 1
    found = []
    for v in range(1, vectors + 1):
        mask = sum(1 << i for i in range(bits) if ((1 + i % vectors) & v).bit_count() % 2)
        found.append(mask - (1 << 64) if mask >> 63 else mask)
    return found


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct fingerprints (unsigned)."""
    edges, left = [], values
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            node = frontier.pop()
            near = np.bitwise_count(left ^ node) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                edges += [(int(node), int(other)) for other in found]
                frontier += list(found)
    return edges


def _link_cells(radius: int):
    """Links inside each cell; the rows of a cell follow each other, and pairs are done at once."""

    def links(values: np.ndarray, cells: np.ndarray) -> list[np.ndarray]:
        starts = np.flatnonzero(np.append(True, (cells[1:] != cells[:-1]).any(axis=1)))
        ends = np.append(starts[1:], len(values))
        two = starts[ends - starts == 2]
        close = two[np.bitwise_count(values[two] ^ values[two + 1]) <= radius]
        found = [np.stack([values[close], values[close + 1]], axis=1)]
        for a, b in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
            found.append(np.array(forest(values[a:b], radius), dtype=np.uint64).reshape(-1, 2))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_values, kept_cells = np.zeros(0, np.uint64), np.zeros((0, 4), np.int64)

        def out(found: list[np.ndarray]) -> pa.RecordBatch:
            pairs = np.concatenate(found)
            pairs = np.sort(pairs.view(np.int64), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy().astype(np.int64) for c in ("mask", "key", "t1", "t2")]
            values = np.concatenate([kept_values, batch.column("fp").to_numpy().view(np.uint64)])
            cells = np.concatenate([kept_cells, np.stack(columns, axis=1)])
            last = np.flatnonzero((cells != cells[-1]).any(axis=1))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield out(links(values[:cut], cells[:cut]))
            kept_values, kept_cells = values[cut:], cells[cut:]
        if len(kept_values):
            yield out(links(kept_values, kept_cells))

    return run


def near_links(prints: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """a < b: distinct fingerprints (column fp) linked so that all within `radius` bits are connected."""
    tables = F.array(
        *[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks(radius))]
    )
    keys = prints.select("fp", F.explode(tables).alias("k")).select("fp", "k.mask", "k.key")
    shared = keys.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    one = F.array(F.struct(F.lit(0).alias("t1"), F.lit(0).alias("t2")))
    # A tile meets every other tile; it meets itself in each of those cells.
    others = F.filter(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: t != F.col("own"))
    pairs = F.transform(
        others, lambda t: F.struct(F.least(t, "own").alias("t1"), F.greatest(t, "own").alias("t2"))
    )
    cells = (
        keys.join(shared, ["mask", "key"])
        .withColumn("tiles", tiles)
        .withColumn("own", own)
        .select("mask", "key", "fp", F.explode(F.when(F.col("tiles") == 1, one).otherwise(pairs)).alias("c"))
        .select("mask", "key", "c.t1", "c.t2", "fp")
    )
    dealt = cells.repartition("mask", "key", "t1", "t2").sortWithinPartitions("mask", "key", "t1", "t2")
    return dealt.mapInArrow(_link_cells(radius), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root: for every node of a link table (a, b) the smallest node of its component."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    seen = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct()
            )
        seen = state


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fingerprint, component_id and the carried columns, for every row."""
    rows = stored(with_fingerprints(docs, shingle, carry), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    nodes = components(near_links(prints, radius)).withColumnRenamed("node", "fp")
    linked = nodes.join(prints, "fp")
    ids = linked.groupBy("root").agg(F.min("first_id").alias("linked_id"))
    groups = prints.join(nodes.join(ids, "root").select("fp", "linked_id"), "fp", "left").select(
        "fp", F.coalesce("linked_id", "first_id").alias("component_id")
    )
    # Stored, so that both sides of the next join are plain exchanges, whose hot keys Spark splits.
    groups = stored(groups, "groups")
    return rows.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *carry
    )


def redundant(groups: DataFrame, row: str) -> DataFrame:
    """The rows of a grouping (with a carried row id) to drop so that one of each component stays.

    The row with the smallest doc_id (null last) stays, then the one with the smallest row id. Rows
    whose component has no doc_id at all are grouped by fingerprint.
    """
    key = ["component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint")).alias("loose")]
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col(row).alias("row"))
    keepers = groups.groupBy(*key).agg(F.min(rank).alias("keep")).select(F.col("keep.row").alias(row))
    return groups.select(row).join(keepers, row, "left_anti")
