"""DuckDB SQL for Porter stems, step by step over a table of distinct words, from the published rules."""

from __future__ import annotations

# Fixed values of the published algorithm with the usual extensions: whole words with a set stem.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
# Fixed values of the published algorithm: suffix and replacement.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "fulli": "ful", "logi": "log",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = dict.fromkeys(
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split(), ""
)


def _marked(x: str) -> str:
    """The word with each y that is a consonant as Y."""
    return f"regexp_replace({x}, '(^|[aeiou])y', '\\1Y', 'g')"


def _measure(x: str) -> str:
    return f"len(regexp_extract_all({_marked(x)}, '[aeiouy]+[^aeiouy]+'))"


def _vowel(x: str) -> str:
    return f"regexp_matches({_marked(x)}, '[aeiouy]')"


def _short(x: str) -> str:
    return (
        f"(regexp_matches({_marked(x)}, '^[aeiouy][^aeiouy]$') OR (regexp_matches({_marked(x)}, "
        f"'[^aeiouy][aeiouy][^aeiouy]$') AND right({x}, 1) NOT IN ('w', 'x', 'y')))"
    )


def _swap(name: str, source: str, table: dict[str, str], test: str, where: str = "true") -> list[str]:
    """The longest suffix of a table replaced if `test` holds for what is before it (b)."""
    suffix = f"regexp_extract(x, '({'|'.join(table)})$', 1)"
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items())
    return [
        f"{name}_b AS (SELECT *, {suffix} AS f, left(x, length(x) - length({suffix})) AS b FROM {source})",
        f"""{name} AS (SELECT w, f, CASE WHEN f <> '' AND {where} AND ({test}) THEN b || CASE f {cases} END ELSE x END AS x,
  CASE WHEN f <> '' AND {where} THEN ({test}) ELSE false END AS hit FROM {name}_b)""",
    ]


def stems(words: str) -> list[str]:
    """CTEs that end in stems(w, stem), for a CTE with the distinct words in column w."""
    irregular = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in IRREGULAR.items())
    step2_test = f"{_measure('''b || CASE f WHEN 'logi' THEN 'l' ELSE '' END''')} > 0"
    return [
        f"""st_1 AS (SELECT w, CASE
  WHEN w LIKE '%ies' THEN left(w, CASE WHEN length(w) = 4 THEN -1 ELSE -2 END)
  WHEN w LIKE '%sses' THEN left(w, -2)
  WHEN w LIKE '%s' AND w NOT LIKE '%ss' THEN left(w, -1) ELSE w END AS x FROM {words})""",
        f"""st_2b AS (SELECT w, x, CASE
  WHEN x LIKE '%ied' OR x LIKE '%eed' THEN NULL
  WHEN x LIKE '%ed' AND {_vowel("left(x, -2)")} THEN left(x, -2)
  WHEN x LIKE '%ing' AND {_vowel("left(x, -3)")} THEN left(x, -3) END AS b FROM st_1)""",
        f"""st_2 AS (SELECT w, CASE
  WHEN x LIKE '%ied' THEN left(x, CASE WHEN length(x) = 4 THEN -1 ELSE -2 END)
  WHEN x LIKE '%eed' THEN CASE WHEN {_measure("left(x, -3)")} > 0 THEN left(x, -1) ELSE x END
  WHEN b IS NULL THEN x
  WHEN regexp_matches(b, '(at|bl|iz)$') THEN b || 'e'
  WHEN length(b) > 1 AND right(b, 1) = left(right(b, 2), 1) AND regexp_matches({_marked("b")}, '[^aeiouy]$')
    THEN CASE WHEN right(b, 1) IN ('l', 's', 'z') THEN b ELSE left(b, -1) END
  WHEN {_measure("b")} = 1 AND {_short("b")} THEN b || 'e' ELSE b END AS x FROM st_2b)""",
        f"""st_3 AS (SELECT w, CASE WHEN x LIKE '%y' AND length(x) > 2 AND regexp_matches({_marked("x")}, '[^aeiouy].$')
  THEN left(x, -1) || 'i' ELSE x END AS x FROM st_2)""",
        *_swap("st_4", "st_3", STEP2, step2_test),
        # What was left of "alli" goes through the step again.
        *_swap("st_4c", "(SELECT w, x, f = 'alli' AND hit AS again FROM st_4)", STEP2, step2_test, "again"),
        *_swap("st_5", "(SELECT w, x FROM st_4c)", STEP3, f"{_measure('b')} > 0"),
        *_swap(
            "st_6", "(SELECT w, x FROM st_5)", STEP4,
            f"{_measure('b')} > 1 AND (f <> 'ion' OR right(b, 1) IN ('s', 't'))",
        ),
        f"""st_7 AS (SELECT w, CASE WHEN x LIKE '%e' AND ({_measure("left(x, -1)")} > 1
    OR ({_measure("left(x, -1)")} = 1 AND NOT {_short("left(x, -1)")})) THEN left(x, -1) ELSE x END AS x FROM st_6)""",
        f"""stems AS (SELECT w, CASE {irregular.replace("WHEN '", "WHEN w = '")} WHEN length(w) <= 2 THEN w
  WHEN x LIKE '%ll' AND {_measure("left(x, -1)")} > 1 THEN left(x, -1) ELSE x END AS stem FROM st_7)""",
    ]


def stemmed(name: str, source: str, key: str, lists: list[str], least: int) -> list[str]:
    """A CTE like `source` with the words of its lists stemmed, words under `least` letters as they are."""
    parts = [
        f"""{name}_{c} AS (
  SELECT {key}, list(CASE WHEN length(w) >= {least} THEN stem ELSE w END ORDER BY i) AS {c}
  FROM (SELECT {key}, unnest({c}) AS w, generate_subscripts({c}, 1) AS i FROM {source}) JOIN stems USING (w) GROUP BY ALL)"""
        for c in lists
    ]
    columns = ", ".join(f"coalesce({name}_{c}.{c}, []) AS {c}" for c in lists)
    joins = " ".join(f"LEFT JOIN {name}_{c} USING ({key})" for c in lists)
    return [*parts, f"{name} AS (SELECT {key}, {columns} FROM (SELECT {key} FROM {source}) {joins})"]


def distinct_words(source: str, lists: list[str]) -> str:
    words = " UNION ALL ".join(f"SELECT unnest({c}) AS w FROM {source}" for c in lists)
    return f"st_words AS (SELECT DISTINCT w FROM ({words}))"
