r"""Secrets in texts, told apart by who holds them, in DataFrame functions only.

Every text is searched once for candidates; positions are code points, the end exclusive:

* `assign`: a name such as password, an equals sign or colon, and a value of ASSIGNED characters or more
* `access`: `AKIA` and capitals or digits, 20 characters or more
* `hex`: 24 lower-case hexadecimal digits or more
* `bare`: BARE characters or more of an alphabet of keys with small and capital letters, digits and MIXED different
  characters, in what lies between assignments, and without an access or hex candidate inside

The digests of the candidates' values are aggregated over the whole corpus: in how many repositories and
at how many owners each occurs. A value at more than OWNERS owners is a widely copied `example`; else it is `live` if
it looks random (a letter, a digit and VARIED different characters) and `weak` if not. Candidates of the first three kinds are always
reported; of the fourth only the live ones are, as kind `owned`.

A value that a third of all documents hold is counted by repository, then by owner, then as a whole, each time combined before the
shuffle. The counts go back in two joins: to one row per value and reading task, then to the candidates
by task and value, so no key of the second join has more rows than one task has read.

Null texts count as empty. A null owner is one owner, a null repository one repository. Repeated rows are
documents of their own, but of one repository. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.llm.common import stored

# The patterns of the base rules. A run of the last two is a whole match or none, so
# their least lengths can stand in the pattern; a short assignment still hides what it covers.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "owned"]
ASSIGNED = 6

BARE, MIXED, VARIED, OWNERS = 20, 12, 8, 2
_KEY_LIKE = f"[A-Za-z0-9+/_=-]{{{BARE},}}"

# Running sums are made block by block, so that a text with many matches takes no quadratic time.
_BLOCK = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def _sums_before(sizes: Column, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """`body` of a function that gives the sum of the first i elements of an array of integers."""
    blocks = F.sequence(F.lit(0), (F.size(sizes) / _BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: _sum(F.slice(sizes, b * _BLOCK + 1, _BLOCK)))
    starts = lambda s: F.transform(blocks, lambda b: _sum(F.slice(s, 1, b)))

    def of(known: Column) -> Callable[[Column], Column]:
        at = lambda i: (i / _BLOCK).cast("int")
        return lambda i: known[at(i)] + _sum(F.slice(sizes, at(i) * _BLOCK + 1, i % _BLOCK))

    return _let(sums, lambda s: _let(starts(s), lambda known: body(of(known))))


def _matches(text: Column, pattern: str, first: Column, body: Callable[[Column, Column, Column], Column]) -> Column:
    """`body` of the texts between matches, and of start and text of every match; a match is in no other.

    `first` is the position of the text. body(gaps, starts, hits): starts[i] is where hits[i] begins.
    """

    def placed(p: Column) -> Column:
        lengths = F.zip_with(p["gap"], p["hit"], lambda g, h: F.length(g) + F.length(h))
        starts = lambda lens: _sums_before(
            lens, lambda before: F.transform(p["hit"], lambda h, i: first + before(i) + F.length(p["gap"][i]))
        )
        return _let(_let(F.slice(lengths, F.lit(1), F.size(p["hit"])), starts), lambda s: body(p["gap"], s, p["hit"]))

    pair = F.struct(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit")
    )
    return _let(pair, placed)


def _variety(value: Column) -> Column:
    return F.size(F.array_distinct(F.split(value, "")))


def _candidate(kind: int, start: Column, hit: Column, value: Column) -> Column:
    random = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (_variety(value) >= VARIED)
    return F.struct(
        start.cast("int").alias("start"),
        F.lit(kind).alias("kind"),
        (start + F.length(hit)).cast("int").alias("end"),
        F.unhex(F.sha2(value, 256)).alias("digest"),
        random.alias("random"),
    )


def _simple(kind: int, starts: Column, hits: Column) -> Column:
    return F.zip_with(starts, hits, lambda s, h: _candidate(kind, s, h, h))


def _bare(gap: Column, first: Column) -> Column:
    """Candidates of the fourth kind in a text that begins at a position."""
    found = _matches(gap, _KEY_LIKE, first, lambda gaps, starts, hits: F.arrays_zip(starts.alias("s"), hits.alias("h")))
    mixed = lambda h: h.rlike("[a-z]") & h.rlike("[A-Z]") & h.rlike("[0-9]") & (_variety(h) >= MIXED)
    kept = F.filter(found, lambda m: mixed(m["h"]) & ~m["h"].rlike(ACCESS) & ~m["h"].rlike(HEX))
    return F.transform(kept, lambda m: _candidate(3, m["s"], m["h"], m["h"]))


def candidates(text: Column) -> Column:
    """All candidates of a text by start, then kind: an array of start, kind, end, digest, random."""

    def assigned(gaps: Column, starts: Column, hits: Column) -> Column:
        value = lambda h: F.regexp_extract(h, ASSIGN, 2)
        own = F.filter(
            F.zip_with(starts, hits, lambda s, h: F.struct(s.alias("s"), h.alias("h"), value(h).alias("v"))),
            lambda m: F.length(m["v"]) >= ASSIGNED,
        )
        after = lambda i: F.when(i == 0, 0).otherwise(starts[i - 1] + F.length(hits[i - 1]))
        return F.concat(
            F.transform(own, lambda m: _candidate(0, m["s"], m["h"], m["v"])),
            F.flatten(F.transform(gaps, lambda g, i: _bare(g, after(i)))),
        )

    zero = F.lit(0)
    return F.array_sort(
        F.concat(
            _matches(text, ASSIGN, zero, assigned),
            _matches(text, ACCESS, zero, lambda _, starts, hits: _simple(1, starts, hits)),
            _matches(text, HEX, zero, lambda _, starts, hits: _simple(2, starts, hits)),
        )
    )


def scan(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """run, row_no, doc_id, repository, owner and found (the candidates) of every document, stored."""
    rows = docs.select(
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row_no"),
        F.col("doc_id").cast("long"),
        F.col(repository).cast("string").alias("repository"),
        F.col(owner).cast("string").alias("owner"),
        candidates(F.coalesce(F.col("text"), F.lit(""))).alias("found"),
    )
    return stored(rows, "secret-candidates")


def _spread(scanned: DataFrame) -> DataFrame:
    one = scanned.select("run", "row_no", "doc_id", "repository", "owner", F.explode("found").alias("f"))
    return one.select("run", "row_no", "doc_id", "repository", "owner", "f.*")


def ownership(scanned: DataFrame) -> DataFrame:
    """digest, n_owners, n_repositories of every candidate value of the corpus."""
    per_repository = _spread(scanned).groupBy("digest", "owner", "repository").agg(F.count("*").alias("n"))
    per_owner = per_repository.groupBy("digest", "owner").agg(F.count("*").alias("n"))
    return per_owner.groupBy("digest").agg(
        F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories")
    )


def findings(scanned: DataFrame, owners: int = OWNERS) -> DataFrame:
    """row_no, doc_id, kind, start, end, digest, n_owners, n_repositories and verdict of every candidate.

    Candidates of the fourth kind are left out unless they are live.
    """
    rows = _spread(scanned).select("run", "row_no", "doc_id", "start", "kind", "end", "digest", "random")
    # One row per value and task: a value that is everywhere has as many as there are tasks.
    per_run = rows.select("run", "digest").distinct().join(ownership(scanned), "digest")
    verdict = F.when(F.col("n_owners") > owners, "example").when(F.col("random"), "live").otherwise("weak")
    return (
        rows.join(stored(per_run, "secret-owners"), ["run", "digest"])
        .withColumn("verdict", verdict)
        .filter((F.col("kind") < 3) | (F.col("verdict") == "live"))
        .select("row_no", "doc_id", "kind", "start", "end", "digest", "n_owners", "n_repositories", "verdict")
    )


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def secret_spans(docs: DataFrame, repository: str = "doc_id", owner: str = "source", owners: int = OWNERS) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans, and how many are of which verdict."""
    scanned = scan(docs, repository, owner)
    spans = F.array_sort(F.collect_list(F.struct("start", "kind", "end", "verdict")))
    some = findings(scanned, owners).groupBy("row_no").agg(spans.alias("spans"))
    # Documents without a candidate are not shuffled.
    none = F.array().cast("array<struct<start:int,kind:int,end:int,verdict:string>>")
    clean = scanned.filter(F.size("found") == 0).select("doc_id", none.alias("spans"))
    held = scanned.filter(F.size("found") > 0).select("row_no", "doc_id").join(some, "row_no", "left")
    rows = held.select("doc_id", F.coalesce("spans", none).alias("spans")).unionAll(clean)
    base = F.filter("spans", lambda s: s["kind"] < 3)
    of = lambda name, value: F.size(F.filter("spans", lambda s: s[name] == value)).cast("long")
    return rows.select(
        "doc_id",
        *[of("kind", i).alias(f"n_{kind}") for i, kind in enumerate(KINDS[:3])],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        of("kind", 3).alias("n_owned"),
        of("verdict", "live").alias("n_live"),
        of("verdict", "example").alias("n_example"),
    )
