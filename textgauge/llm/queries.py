"""One query for each operator over its whole table, and the SQL that DuckDB can check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.llm import (
    byte_bpe,
    exact_dedup,
    html_text,
    language,
    lexical_search,
    packing,
    periodic_runs,
    quality,
    rules,
    secret_scan,
    simhash,
    token_files,
    warc,
)
from textgauge.llm.common import stored
from textgauge.session import scratch_path


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes the documents into token files, reads them back and digests each token list."""
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path, _vocabulary("byte_bpe_50k.json"))
    return token_files.token_digests(token_files.read_tokens(path, spark))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), 2048)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes the documents by ranks, decodes the ids and digests both."""
    ranks = _vocabulary("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.encoded(_table(spark, sf_dir, "documents"), ranks), ranks)


def _remainder(n: int, held: int) -> Column:
    """If the crc32 of the id as text leaves the remainder `held`; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % n == held, F.lit(False))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels outside the held-out fifth."""
    held_out = _remainder(5, 0)
    rows = stored(quality.with_features(_table(spark, sf_dir, "documents")), "features")
    model = quality.learn(rows, quality.labelled(_table(spark, sf_dir, "labels"), held_out))
    return quality.scored(rows, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those outside the held-out quarter."""
    docs, held_out = _table(spark, sf_dir, "documents"), _remainder(4, 2)
    found = language.identify(docs, language.learn(docs, held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group and the survivor of every document."""
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


def op8_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes two replicas of all pages, one with changed, lengthened, lost and added records, and audits them."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    page = F.col("page_id")
    hit = (page % 97 == 5) & (F.substring("html", 2, 1) == "!")
    html = F.when(hit, F.overlay("html", F.lit("?"), 2, 1)).when(page % 151 == 3, F.concat("html", F.lit("<!-- more -->")))
    harmed = pages.filter(F.coalesce(page % 193 != 7, F.lit(True))).withColumn("html", F.coalesce(html, "html"))
    added = pages.filter(page % 211 == 9).withColumn("url", F.concat("url", F.lit("#added")))
    layout = stored(warc.file_layout(pages), "layout")
    replicas = []
    for name, rows in (("warc", pages), ("warc-replica", harmed.unionByName(added))):
        path = scratch_path(spark, name)
        warc.write_warc(rows, path, layout)
        replicas.append(stored(warc.read_warc(spark, path), "warc-records"))
    return warc.audit(*replicas)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return rules.quality_rules(_table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, 3 bits."""
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"), shingle=3, radius=3)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; a document is a repository and its source the owner."""
    return secret_scan.secret_spans(_table(spark, sf_dir, "documents"), repository="doc_id", owner="source")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document."""
    return periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_files,
        op2_best_fit_packing,
        op3_byte_bpe,
        op4_quality_classifier,
        op5_language_id,
        op6_exact_dedup,
        op7_html_text,
        op8_warc_audit,
        op9_quality_rules,
        op10_simhash,
        op11_secret_scan,
        op12_periodic_runs,
        op13_lexical_search,
    )
}

# Assignments, with both cases spelled out, as DuckDB's flag for any case covers more than ASCII.
_NAMES = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name)
    for name in ("password", "passwd", "secret", "token", "api_?key")
)
_ASSIGN = rf"""({_NAMES})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

ORACLE_SQL = {
    "op6_exact_dedup": r"""
        WITH rows AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER w = 1 AS kept,
               text_sha256
        FROM rows
        WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id)
    """,
    "op8_warc_audit": r"""
        WITH harmed AS (
            SELECT page_id, url,
                   CASE WHEN page_id % 97 = 5 AND substring(html, 2, 1) = '!' THEN html[1:1] || '?' || html[3:]
                        WHEN page_id % 151 = 3 THEN html || '<!-- more -->' ELSE html END AS html
            FROM pages WHERE page_id % 193 <> 7
            UNION ALL
            SELECT page_id, url || '#added', html FROM pages WHERE page_id % 211 = 9
        ),
        records AS (
            SELECT side, page_id, url, coalesce(url, '') AS target, html, page_id // 2048 AS id_range,
                   concat(E'WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:', page_id,
                          E'>\r\nWARC-Target-URI: ', coalesce(url, ''),
                          E'\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ',
                          strlen(coalesce(html, '')), E'\r\n\r\n', coalesce(html, ''), E'\r\n\r\n') AS record
            FROM (SELECT 'o' AS side, page_id, url, html FROM pages UNION ALL SELECT 't', * FROM harmed)
        ),
        layout AS (
            SELECT id_range, ceil(sum(strlen(record)) / 67108864)::BIGINT AS parts FROM records WHERE side = 'o' GROUP BY id_range
        ),
        dealt AS (
            SELECT *, CASE WHEN parts <= 1 THEN id_range::VARCHAR
                           ELSE concat(id_range, '_', ('0x' || substr(md5(concat_ws('|', page_id, url)), 1, 8))::BIGINT % parts)
                      END AS warc_file
            FROM records JOIN layout USING (id_range)
        ),
        placed AS (
            SELECT side, warc_file, page_id, target, row_number() OVER w - 1 AS record_no,
                   (sum(strlen(record)) OVER w - strlen(record))::BIGINT AS "offset",
                   strlen(record) AS length, sha256(record) AS record_sha256
            FROM dealt
            WINDOW w AS (PARTITION BY side, warc_file ORDER BY page_id, target, html)
        ),
        o AS (SELECT * FROM placed WHERE side = 'o'),
        t AS (SELECT * FROM placed WHERE side = 't')
        SELECT coalesce(o.warc_file, t.warc_file) AS warc_file, coalesce(o.record_no, t.record_no) AS record_no,
               coalesce(o."offset", t."offset") AS "offset", coalesce(o.length, t.length) AS length,
               coalesce(o.target, t.target) AS target, coalesce(o.record_sha256, t.record_sha256) AS record_sha256,
               CASE WHEN t.page_id IS NULL THEN 'missing' WHEN o.page_id IS NULL THEN 'extra'
                    WHEN o.record_sha256 <> t.record_sha256 THEN 'changed'
                    WHEN o."offset" <> t."offset" THEN 'shifted' ELSE 'same' END AS state
        FROM o FULL JOIN t ON o.page_id = t.page_id AND o.target = t.target
    """,
    "op11_secret_scan": rf"""
        WITH texts AS (
            SELECT row_number() OVER () AS r, doc_id, doc_id AS repository, source AS owner, coalesce(text, '') AS text
            FROM documents
        ),
        cut AS (
            SELECT r, 0 AS kind, string_split_regex(text, '{_ASSIGN}') AS gaps,
                   regexp_extract_all(text, '{_ASSIGN}') AS hits, regexp_extract_all(text, '{_ASSIGN}', 2) AS vals FROM texts
            UNION ALL
            SELECT r, 1, string_split_regex(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+'),
                   regexp_extract_all(text, 'AKIA[A-Z0-9]+') FROM texts
            UNION ALL
            SELECT r, 2, string_split_regex(text, '[0-9a-f]+'), regexp_extract_all(text, '[0-9a-f]+'),
                   regexp_extract_all(text, '[0-9a-f]+') FROM texts
        ),
        piece AS (
            -- The last gap has no match after it.
            SELECT r, kind, unnest(gaps) AS gap, unnest(list_append(hits, '')) AS hit, unnest(list_append(vals, '')) AS val,
                   unnest(range(len(gaps))) AS i
            FROM cut
        ),
        placed AS (
            SELECT *, (sum(length(gap) + length(hit)) OVER w - length(hit))::BIGINT AS "start",
                   (sum(length(gap) + length(hit)) OVER w)::BIGINT AS "end"
            FROM piece WINDOW w AS (PARTITION BY r, kind ORDER BY i)
        ),
        base AS (
            SELECT r, kind, "start", "end", val FROM placed
            WHERE (kind = 0 AND length(val) >= 6) OR (kind = 1 AND length(val) >= 20) OR (kind = 2 AND length(val) >= 24)
        ),
        rest AS (
            SELECT r, i, "start" - length(gap) AS gap_start, string_split_regex(gap, '[A-Za-z0-9+/_=-]+') AS gaps,
                   regexp_extract_all(gap, '[A-Za-z0-9+/_=-]+') AS hits
            FROM placed WHERE kind = 0
        ),
        word AS (
            SELECT r, i, gap_start, unnest(gaps) AS gap, unnest(list_append(hits, '')) AS hit, unnest(range(len(gaps))) AS j
            FROM rest
        ),
        bare AS (
            SELECT r, 3 AS kind, (gap_start + sum(length(gap) + length(hit)) OVER w - length(hit))::BIGINT AS "start",
                   (gap_start + sum(length(gap) + length(hit)) OVER w)::BIGINT AS "end", hit AS val
            FROM word WINDOW w AS (PARTITION BY r, i ORDER BY j)
        ),
        candidate AS (
            SELECT * FROM base
            UNION ALL
            SELECT * FROM bare
            WHERE length(val) >= 20 AND regexp_matches(val, '[a-z]') AND regexp_matches(val, '[A-Z]')
              AND regexp_matches(val, '[0-9]') AND len(list_distinct(string_split(val, ''))) >= 12
              AND NOT regexp_matches(val, 'AKIA[A-Z0-9]{{16}}|[0-9a-f]{{24}}')
        ),
        held AS (
            SELECT val, count(DISTINCT coalesce('=' || owner, '')) AS n_owners
            FROM candidate JOIN texts USING (r) GROUP BY val
        ),
        judged AS (
            SELECT c.*, CASE WHEN n_owners > 2 THEN 'example'
                             WHEN regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Za-z]')
                                  AND len(list_distinct(string_split(val, ''))) >= 8 THEN 'live'
                             ELSE 'weak' END AS verdict
            FROM candidate c JOIN held USING (val)
        ),
        named AS (
            SELECT r, kind, "start", verdict,
                   concat(['assign', 'access', 'hex', 'owned'][kind + 1], ':', "start", ':', "end") AS span
            FROM judged WHERE kind < 3 OR verdict = 'live'
        )
        SELECT doc_id,
               count(*) FILTER (kind = 0) AS n_assign,
               count(*) FILTER (kind = 1) AS n_access,
               count(*) FILTER (kind = 2) AS n_hex,
               sha256(coalesce(string_agg(span, ',' ORDER BY "start", kind) FILTER (kind < 3), '')) AS base_sha256,
               coalesce(string_agg(span, ',' ORDER BY "start", kind), '') AS spans,
               count(*) FILTER (kind = 3) AS n_owned,
               count(*) FILTER (verdict = 'live') AS n_live,
               count(*) FILTER (verdict = 'example') AS n_example
        FROM texts LEFT JOIN named USING (r) GROUP BY r, doc_id
    """,
    "op13_lexical_search": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
            FROM documents
        ),
        sizes AS (SELECT r, doc_id, len(ts) AS n FROM texts WHERE len(ts) > 0),
        corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
        frequency AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM texts) GROUP BY r, t),
        weights AS (
            SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM frequency, corpus GROUP BY t, docs
        ),
        items AS (
            SELECT i, item_id, t, count(*) AS times
            FROM (SELECT i, item_id,
                         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                             'abcdefghijklmnopqrstuvwxyz'),
                                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
                  FROM (SELECT row_number() OVER () AS i, * FROM benchmark))
            GROUP BY i, item_id, t
        ),
        scores AS (
            SELECT i, item_id, r, doc_id,
                   sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::BIGINT AS score
            FROM items JOIN frequency USING (t) JOIN weights USING (t) JOIN sizes USING (r), corpus
            GROUP BY i, item_id, r, doc_id
        )
        SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank,
               doc_id, score
        FROM scores WHERE score > 0
        QUALIFY rank <= 10
    """,
}
