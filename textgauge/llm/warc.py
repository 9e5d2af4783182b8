"""WARC files of pages, and an audit of replicas by Merkle trees.

Pages are written as WARC records, in page order, one file for each range of page ids, or several where a
range has more than FILE_BYTES: then pages are dealt by id and url. A reader
gives every record of a set of files with its file, number, offset, length, id, target and SHA-256. The audit builds a tree
over the records of each file in offset order: a leaf hashes a record's offset, length and digest, an inner
node hashes the range of offsets it covers and its children's hashes, FAN_OUT at a time; over the roots of the files, in order, the
same kind of tree makes one root for a replica. Two replicas are compared from the roots down, and only children of
nodes that differ are looked at.

A lost, added or lengthened record moves all later ones of its file, so their leaves differ too. The records of the differing
leaves alone are aligned: by record id, target and digest, then by record id (target, if it has none); of equal ones
the first meets the first. So each record is `same`, `shifted` (the same bytes at another offset), `changed`, `missing` in
the other replica or `extra` there.

Files are bounded by FILE_BYTES and by the pages with one id and url, which stay together. Repeated ids keep one
record each, ordered by url and html. Null html is an empty body, a null url an
empty target; pages with a null page_id are spread over LOOSE_FILES files by a hash. An empty table gives no files and equal roots. Other
columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textgauge.llm.common import stored

IDS_PER_FILE, LOOSE_FILES, FAN_OUT = 2048, 4096, 16
FILE_BYTES = 64 << 20

_RECORDS = (
    "warc_file string, record_no long, offset long, length long, record_id string, target string, record_sha256 string"
)
_LENGTH = re.compile(rb"^content-length:[ \t]*(\d+)[ \t]*\r?$", re.I | re.M)
_TARGET = re.compile(rb"^warc-target-uri:[ \t]*(.*?)[ \t]*\r?$", re.I | re.M)
_ID = re.compile(rb"^warc-record-id:[ \t]*(.*?)[ \t]*\r?$", re.I | re.M)
_END = b"\r\n\r\n"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """A WARC record without the empty lines that end it."""
    body = F.coalesce(html, F.lit(""))
    head = [
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("none")),
        F.lit(">\r\nWARC-Target-URI: "),
        # A line break in a url would end the header line.
        F.regexp_replace(F.coalesce(url, F.lit("")), "[\\r\\n]+", " "),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    ]
    return F.concat(*head, body)


def range_of() -> Column:
    """The range of a page: of ids, or one of LOOSE_FILES for pages without an id."""
    loose = F.concat(F.lit("none-"), F.pmod(F.xxhash64("url", "html"), F.lit(LOOSE_FILES)).cast("string"))
    return F.coalesce(F.floor(F.col("page_id") / IDS_PER_FILE).cast("string"), loose)


def file_layout(pages: DataFrame) -> DataFrame:
    """id_range and parts: into how many files each range of pages goes."""
    size = F.octet_length(record(F.col("page_id"), F.col("url"), F.col("html"))) + len(_END)
    sizes = pages.groupBy(range_of().alias("id_range")).agg(F.sum(size.cast("long")).alias("bytes"))
    return sizes.select("id_range", F.ceil(F.col("bytes") / FILE_BYTES).cast("int").alias("parts"))


def file_of() -> Column:
    """The file of a page, out of id_range and parts: the range alone, or the range and a part."""
    digest = F.md5(F.concat_ws("|", F.col("page_id").cast("string"), "url").cast("binary"))
    part = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.col("parts"))
    return F.when(F.col("parts") <= 1, F.col("id_range")).otherwise(F.concat_ws("_", "id_range", part.cast("string")))


def write_warc(pages: DataFrame, path: str, layout: DataFrame | None = None) -> None:
    """Pages (page_id, url, html) as compressed WARC files, one in each folder warc_file=<name>.

    `layout` is a stored `file_layout`, of these pages if not given; ranges that it lacks are one file.
    """
    known = stored(file_layout(pages), "layout") if layout is None else layout
    placed = pages.select("page_id", "url", "html", range_of().alias("id_range")).join(known, "id_range", "left")
    rows = placed.withColumn("parts", F.coalesce("parts", F.lit(1))).select(
        file_of().alias("warc_file"),
        F.col("page_id").alias("at"),
        F.coalesce("url", F.lit("")).alias("to"),
        record(F.col("page_id"), F.col("url"), F.col("html")).alias("value"),
    )
    dealt = rows.repartition("warc_file").sortWithinPartitions("warc_file", "at", "to", "value")
    writer = dealt.select("warc_file", "value").write.partitionBy("warc_file")
    writer.options(lineSep=_END.decode(), compression="gzip").text(path)


def _field(found: re.Match | None) -> str:
    return found[1].decode("utf-8", "replace") if found else ""


def parsed(content: bytes) -> Iterator[tuple[int, int, str, str, str]]:
    """offset, length, id, target and SHA-256 of each record of a file; a cut-off record counts as it is."""
    at = 0
    while at < len(content):
        head = content.find(_END, at)
        header = content[at:head] if head >= 0 else content[at:]
        found = _LENGTH.search(header)
        stop = head + 4 + int(found[1]) + len(_END) if head >= 0 and found else len(content)
        stop = min(stop, len(content))
        names = _field(_ID.search(header)), _field(_TARGET.search(header))
        yield at, stop - at, *names, hashlib.sha256(content[at:stop]).hexdigest()
        at = stop


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC files at a path."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in _RECORDS.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        for batch in batches:
            for folder, content in zip(batch.column("warc_file"), batch.column("content")):
                rows = [
                    (folder.as_py(), number, *row) for number, row in enumerate(parsed(gzip.decompress(content.as_py())))
                ]
                columns = list(zip(*rows)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path)
    folder = F.regexp_extract("path", "warc_file=([^/]+)/", 1).alias("warc_file")
    return files.select(folder, "content").mapInArrow(records, _RECORDS)


def leaves(records: DataFrame) -> DataFrame:
    """A leaf for each record, with the range of offsets it covers."""
    text = F.concat_ws("|", F.lit("leaf"), F.col("offset").cast("string"), F.col("length").cast("string"), "record_sha256")
    return records.select(
        "warc_file",
        F.col("record_no").alias("node"),
        F.col("offset").alias("start"),
        (F.col("offset") + F.col("length")).alias("stop"),
        F.sha2(text, 256).alias("hash"),
    )


# Room for so many parts of a range in the order of files.
_PARTS = 1 << 20


def file_nodes(roots: DataFrame) -> DataFrame:
    """The files' roots as leaves of one tree; a file's place depends on its name alone."""
    range_name, part = F.substring_index("warc_file", "_", 1), F.get(F.split("warc_file", "_"), F.lit(1)).try_cast("long")
    number, loose = range_name.try_cast("long"), F.substring_index(range_name, "-", -1).try_cast("long")
    range_place = F.when(number.isNull(), 3 * F.coalesce(loose, F.lit(0))).when(number >= 0, 3 * number + 1).otherwise(2 - 3 * number)
    place = range_place * _PARTS + F.coalesce(part, F.lit(0))
    text = F.concat_ws("|", F.lit("file"), "warc_file", "hash")
    return roots.select(
        F.lit("").alias("tree"), "warc_file", place.alias("node"), place.alias("start"), place.alias("stop"),
        F.sha2(text, 256).alias("hash"),
    )


def parents(nodes: DataFrame, key: str) -> DataFrame:
    """One level up: at most FAN_OUT nodes, in order, hashed with the range they cover."""
    up = nodes.groupBy(key, F.floor(F.col("node") / FAN_OUT).alias("up")).agg(
        F.array_sort(F.collect_list(F.struct("node", "hash"))).alias("c"),
        F.min("start").alias("start"),
        F.max("stop").alias("stop"),
    )
    hashes = F.array_join(F.transform("c", lambda x: x["hash"]), ",")
    text = F.concat_ws("|", F.lit("node"), F.col("start").cast("string"), F.col("stop").cast("string"), hashes)
    return up.select(key, F.col("up").alias("node"), "start", "stop", F.sha2(text, 256).alias("hash"))


def climb(sides: list[DataFrame], key: str) -> list[list[DataFrame]]:
    """All levels of both replicas' trees, up to the same height."""
    highest = max(t.agg(F.max("node")).first()[0] or 0 for t in sides)
    levels = [sides]
    while highest:
        levels.append([stored(parents(t, key), "tree") for t in levels[-1]])
        highest //= FAN_OUT
    return levels


def differing(sides: list[DataFrame], key: str) -> DataFrame:
    """key, node of the nodes that one side lacks or that differ."""
    a, b = (t.select(key, "node", F.col("hash").alias(name)) for t, name in zip(sides, ("ours", "theirs")))
    return a.join(b, [key, "node"], "full").filter(~F.col("ours").eqNullSafe(F.col("theirs"))).select(key, "node")


def descend(levels: list[list[DataFrame]], key: str, among: DataFrame | None = None) -> DataFrame:
    """The differing leaves, reached by way of differing nodes; `among` limits the trees looked at."""
    found = None
    for sides in reversed(levels):
        if found is not None:
            ups = found.select(key, F.col("node").alias("up"))
            sides = [
                t.withColumn("up", F.floor(F.col("node") / FAN_OUT)).join(ups, [key, "up"], "left_semi") for t in sides
            ]
        elif among is not None:
            sides = [t.join(among, key, "left_semi") for t in sides]
        found = stored(differing(sides, key), "differing")
    return found


def damaged(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """warc_file, record_no of the records that differ between two replicas (stored record tables)."""
    inside = climb([stored(leaves(r), "leaves") for r in (ours, theirs)], "warc_file")
    files = [stored(file_nodes(t), "files") for t in inside[-1]]
    over = climb([t.drop("warc_file") for t in files], "tree")
    wrong = descend(over, "tree")
    names = files[0].union(files[1]).join(wrong, "node", "left_semi").select("warc_file").distinct()
    return descend(inside, "warc_file", names).withColumnRenamed("node", "record_no")


_ROW = ["record_no", "offset", "length", "target", "record_sha256"]


def _numbered(rows: DataFrame, key: list[Column]) -> DataFrame:
    """`rows` with the key's columns k0, k1, ... and `nth`, the number of a row among those with its key in its file."""
    keyed = rows.select("*", *[c.alias(f"k{i}") for i, c in enumerate(key)])
    names = ["warc_file", *[f"k{i}" for i in range(len(key))]]
    return keyed.withColumn("nth", F.row_number().over(Window.partitionBy(*names).orderBy("record_no")))


def _met(ours: DataFrame, theirs: DataFrame, key: list[Column]) -> DataFrame:
    """Both sides joined by file, key and place among equals: warc_file, o (ours) and t (theirs), either may be null."""
    names = ["warc_file", *[f"k{i}" for i in range(len(key))], "nth"]
    o, t = (
        _numbered(rows, key).select(*names, F.struct("record_id", *_ROW).alias(side)) for rows, side in ((ours, "o"), (theirs, "t"))
    )
    return stored(o.join(t, names, "full").select("warc_file", "o", "t"), "aligned")


def aligned(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """The records of differing leaves of both replicas with their states."""
    name = F.when(F.col("record_id") != "", F.concat(F.lit("id:"), "record_id")).otherwise(F.concat(F.lit("to:"), "target"))
    first = _met(ours, theirs, [F.col("record_id"), F.col("target"), F.col("record_sha256")])
    whole = first.filter("o IS NOT NULL AND t IS NOT NULL")
    left = first.filter("o IS NOT NULL AND t IS NULL").select("warc_file", "o.*")
    right = first.filter("o IS NULL AND t IS NOT NULL").select("warc_file", "t.*")
    second = _met(left, right, [name])
    place = F.when(F.col("o.offset") == F.col("t.offset"), "same").otherwise("shifted")
    kind = F.when(F.col("t").isNull(), "missing").when(F.col("o").isNull(), "extra").otherwise("changed")
    return (
        whole.select("warc_file", "o.*", place.alias("state"))
        .unionByName(second.select("warc_file", F.coalesce("o", "t").alias("r"), kind.alias("state")).select("warc_file", "r.*", "state"))
        .select("warc_file", *_ROW, "state")
    )


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Every record of either replica (stored record tables) with its state; an extra record is shown as it is there."""
    key = ["warc_file", "record_no"]
    wrong = damaged(ours, theirs)
    sound = ours.join(wrong, key, "left_anti").select("warc_file", *_ROW, F.lit("same").alias("state"))
    return sound.unionByName(aligned(ours.join(wrong, key, "left_semi"), theirs.join(wrong, key, "left_semi")))
