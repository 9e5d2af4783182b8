"""DuckDB SQL for the recursive splitter on texts whose lines and words are all it has to cut at.

A line of `size` characters or more is cut at words and packed for itself; runs of shorter lines are packed
together. Each step of the recursion makes one chunk: the first span that no longer fits ends it, and the
next chunk begins with the earliest span that the overlap allows.
"""

from __future__ import annotations

# Fixed value: the code points on which a bare `str.strip()` cuts.
SPACE = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)


def _spans(name: str, source: str, keys: str, text: str, separator: str) -> str:
    """key, i, s, e: the spans of a text (s0 its start), each opened by its separator; empty ones left out."""
    return f"""{name} AS (
  SELECT {keys}, i, s0 + e - n AS s, s0 + e AS e FROM (
    SELECT {keys}, s0, i, n, sum(n) OVER (PARTITION BY {keys} ORDER BY i) AS e FROM (
      SELECT {keys}, s0, i, length(p) + CASE WHEN i = 1 THEN 0 ELSE 1 END AS n
      FROM (SELECT {keys}, s0, unnest(ps) AS p, generate_subscripts(ps, 1) AS i
            FROM (SELECT {keys}, s0, string_split({text}, {separator}) AS ps FROM {source}))))
  WHERE n > 0)"""


def chunks(name: str, source: str, keys: str, text: str, size: int, overlap: int) -> list[str]:
    """CTEs that end in `name` ({keys}, chunk_no, chunk_start, chunk_text), for unique keys."""
    on = f"USING ({keys})"
    k = name
    return [
        f"{k}_src AS (SELECT {keys}, {text} AS t, 0 AS s0 FROM {source})",
        _spans(f"{k}_lines", f"{k}_src", keys, "t", "chr(10)"),
        # A text of one line is cut at words however short it is.
        f"""{k}_kinds AS (
  SELECT *, long <> lag(long, 1, NOT long) OVER w OR long AS opens FROM (
    SELECT l.*, (e - s >= {size} OR NOT contains(t, chr(10))) AS long, t FROM {k}_lines l JOIN {k}_src {on})
  WINDOW w AS (PARTITION BY {keys} ORDER BY i))""",
        f"""{k}_groups AS (
  SELECT *, sum(opens::INT) OVER (PARTITION BY {keys} ORDER BY i) AS g FROM {k}_kinds)""",
        f"""{k}_long AS (
  SELECT {keys}, g, s AS s0, substr(t, s::BIGINT + 1, (e - s)::BIGINT) AS t FROM {k}_groups WHERE long)""",
        _spans(f"{k}_words", f"{k}_long", f"{keys}, g", "t", "' '"),
        f"""{k}_lists AS (
  SELECT {keys}, g, list(s::BIGINT ORDER BY i) AS ss, list(e::BIGINT ORDER BY i) AS es
  FROM (SELECT {keys}, g, i, s, e FROM {k}_groups WHERE NOT long
        UNION ALL SELECT {keys}, g, i, s, e FROM {k}_words) GROUP BY ALL)""",
        f"""{k}_steps AS (
  SELECT {keys}, g, 1::BIGINT AS f, 1::BIGINT AS n, NULL::BIGINT AS s, NULL::BIGINT AS e FROM {k}_lists
  UNION ALL
  SELECT {keys}, g,
    list_min(list_filter(range(f, m + 1), lambda j: j = m OR (ss[m] - ss[j] <= {overlap} AND es[m] - ss[j] <= {size}))),
    m, ss[f], ss[m]
  FROM (SELECT {keys}, g, f, ss, es,
          list_min(list_filter(range(n + 1, len(ss) + 1), lambda i: es[i] - ss[f] > {size})) AS m
        FROM {k}_steps JOIN {k}_lists USING ({keys}, g))
  WHERE m IS NOT NULL)""",
        f"""{k}_raw AS (
  SELECT {keys}, g, n, s, e FROM {k}_steps WHERE s IS NOT NULL
  UNION ALL
  SELECT {keys}, g, 1000000000, ss[f], es[len(es)]
  FROM (SELECT {keys}, g, max(n) AS n, arg_max(f, n) AS f FROM {k}_steps GROUP BY ALL) JOIN {k}_lists USING ({keys}, g))""",
        f"""{k}_cut AS (
  SELECT {keys}, g, n, s, raw, regexp_replace(raw, '^[{SPACE}]+', '') AS headless
  FROM (SELECT r.*, substr(t, s + 1, e - s) AS raw FROM {k}_raw r JOIN {k}_src {on}))""",
        f"""{name} AS (
  SELECT {keys}, row_number() OVER (PARTITION BY {keys} ORDER BY g, n) - 1 AS chunk_no,
    s + length(raw) - length(headless) AS chunk_start, regexp_replace(headless, '[{SPACE}]+$', '') AS chunk_text
  FROM {k}_cut WHERE headless <> '')""",
    ]
