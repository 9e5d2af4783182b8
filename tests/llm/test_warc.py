import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from textgauge.llm import warc
from textgauge.llm.common import stored

SCHEMA = "page_id long, url string, html string, offset string, state string"


@pytest.fixture(autouse=True)
def small_files(monkeypatch):
    monkeypatch.setattr(warc, "IDS_PER_FILE", 512)


def pages_of(spark, n):
    rows = [(i, f"http://a/{i}", f"<p>page {i}\r\n\r\nWARC/1.1\r\n é</p>" * (i % 4), "x", "y") for i in range(n)]
    rows += [(None, None, None, "x", "y"), (None, "u\r\nv", "b", "x", "y"), (3, "http://a/3", "again", "x", "y"), (-5, "neg", "c" * 100000, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def records(spark, pages, path):
    warc.write_warc(pages, path)
    return stored(warc.read_warc(spark, path), "records")


def test_files_hold_whole_records_in_order(spark, tmp_path):
    pages = pages_of(spark, 1200)
    got = records(spark, pages, f"{tmp_path}/w").collect()
    assert len(got) == pages.count()
    files = {}
    for r in got:
        files.setdefault(r.warc_file, []).append(r)
    assert {"0", "1", "2", "-1"} <= set(files)
    for name, rows in files.items():
        (file,) = (tmp_path / "w" / f"warc_file={name}").glob("*.gz")
        data, at = gzip.decompress(file.read_bytes()), 0
        for r in sorted(rows, key=lambda r: r.record_no):
            assert r.offset == at
            part = data[at : at + r.length]
            assert hashlib.sha256(part).hexdigest() == r.record_sha256 and part.startswith(b"WARC/1.1\r\n")
            head, body = part.split(b"\r\n\r\n", 1)
            assert int(head.rsplit(b" ", 1)[1]) == len(body) - 4 and body.endswith(b"\r\n\r\n")
            at += r.length
        assert at == len(data)


def test_audit_finds_each_difference(spark, tmp_path):
    pages = pages_of(spark, 1200)
    ours = records(spark, pages, f"{tmp_path}/a")
    theirs = ours.withColumn(
        "record_sha256", F.when((F.col("warc_file") == "1") & F.col("record_no").isin(7, 300), "bad").otherwise(F.col("record_sha256"))
    ).filter("NOT (warc_file = '2' AND record_no = 100)")
    extra = ours.limit(1).select(
        F.lit("9").alias("warc_file"), F.lit(0).cast("long").alias("record_no"), "offset", "length", "record_id", "target", "record_sha256"
    )
    got = warc.audit(ours, stored(theirs.unionByName(extra), "theirs")).collect()
    assert {(r.warc_file, r.record_no, r.state) for r in got if r.state != "same"} == {
        ("1", 7, "changed"), ("1", 300, "changed"), ("2", 100, "missing"), ("9", 0, "extra"),
    }
    assert len(got) == ours.count() + 1


def _states(ours, theirs):
    return sorted((r.target, r.state) for r in warc.audit(ours, theirs).collect() if r.state not in ("same", "shifted"))


def test_lost_added_and_lengthened_records_are_located(spark, tmp_path):
    pages = pages_of(spark, 1200)
    layout = stored(warc.file_layout(pages), "layout")
    harmed = pages.filter("page_id IS NULL OR page_id NOT IN (0, 40, 700, 1199)").withColumn(
        "html", F.when(F.col("page_id").isin(5, 600), F.concat("html", F.lit("longer"))).otherwise(F.col("html"))
    )
    added = spark.createDataFrame([(41, "http://b/41", "new", "x", "y"), (900, "http://b/900", "", "x", "y")], SCHEMA)
    warc.write_warc(pages, f"{tmp_path}/a", layout)
    warc.write_warc(harmed.unionByName(added), f"{tmp_path}/b", layout)
    ours, theirs = (stored(warc.read_warc(spark, f"{tmp_path}/{n}"), "records") for n in "ab")
    expected = [(f"http://a/{i}", "missing") for i in (0, 40, 700, 1199)]
    expected += [("http://a/5", "changed"), ("http://a/600", "changed"), ("http://b/41", "extra"), ("http://b/900", "extra")]
    assert _states(ours, theirs) == sorted(expected)
    back = {"missing": "extra", "extra": "missing", "changed": "changed"}
    assert _states(theirs, ours) == sorted((t, back[s]) for t, s in expected)
    rows = warc.audit(ours, theirs).collect()
    assert len(rows) == ours.count() + 2
    # Records before the first harm of a file are where they were; the loss of page 0 moves all of its file.
    by_file = {s: {r.state for r in rows if r.warc_file == s} for s in ("0", "1", "-1")}
    assert "same" not in by_file["0"] and "same" in by_file["1"] and by_file["-1"] == {"same"}


def test_repeated_ids_meet_in_order(spark, tmp_path):
    rows = [(7, "u", f"copy {i % 3}") for i in range(9)] + [(8, "v", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    ours = records(spark, pages, f"{tmp_path}/a")
    one_less = spark.createDataFrame(rows[1:], pages.schema)
    assert _states(ours, records(spark, one_less, f"{tmp_path}/b")) == [("u", "missing")]
    other = spark.createDataFrame([(7, "u", "changed"), *rows[1:]], pages.schema)
    assert _states(ours, records(spark, other, f"{tmp_path}/c")) == [("u", "changed")]


def test_large_ranges_become_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 30_000)
    rows = [(3, f"http://hot/{i}", "z" * 500) for i in range(400)] + [(600 + i, f"http://b/{i}", "y") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    ours = records(spark, pages, f"{tmp_path}/a")
    sizes = {r.warc_file: r.n for r in ours.groupBy("warc_file").agg(F.sum("length").alias("n")).collect()}
    assert sizes.pop("1") < 30_000 and len(sizes) >= 8 and max(sizes.values()) < 2 * 30_000
    layout = stored(warc.file_layout(pages), "layout")
    warc.write_warc(pages.filter("url != 'http://hot/77'"), f"{tmp_path}/b", layout)
    theirs = stored(warc.read_warc(spark, f"{tmp_path}/b"), "records")
    assert _states(ours, theirs) == [("http://hot/77", "missing")]


def test_only_differing_branches_are_looked_at(spark, tmp_path):
    ours = records(spark, pages_of(spark, 1200), f"{tmp_path}/a")
    assert warc.damaged(ours, ours).count() == 0
    bad = F.when((F.col("warc_file") == "1") & (F.col("record_no") == 7), "bad").otherwise(F.col("record_sha256"))
    theirs = stored(ours.withColumn("record_sha256", bad), "theirs")
    levels = warc.climb([stored(warc.leaves(r), "l") for r in (ours, theirs)], "warc_file")
    assert [warc.differing(sides, "warc_file").count() for sides in levels] == [1] * len(levels)


def test_cut_off_file():
    whole = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = list(warc.parsed(whole + whole[:-6] + b""))
    assert [(r[0], r[1]) for r in rows] == [(0, len(whole)), (len(whole), len(whole) - 6)]
    assert [r[:2] for r in warc.parsed(b"no record")] == [(0, 9)]


def test_empty(spark, tmp_path):
    empty = pages_of(spark, 0).filter("false")
    ours = records(spark, empty, f"{tmp_path}/e")
    assert warc.audit(ours, ours).count() == 0
