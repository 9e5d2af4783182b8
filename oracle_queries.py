"""DuckDB SQL for the queries of the catalog, written from the definitions, not from the Spark code.

N-grams and words are exploded to rows and counted by GROUP BY here, where the Spark side works
inside a row; distances are taken over all pairs, where the Spark side keeps the best per block.
"""

from __future__ import annotations

import chunk_sql
import stem_sql

# Fixed value: the code points on which a bare `str.split()` breaks.
SPACE = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
CHAT_OPEN = "<|user|><|image_1|>"
CHAT_CLOSE = "<|end|><|assistant|>"
STYLE = "'Peanuts comic style illustration of:' || chr(10) || chr(10) || "
GROUNDING = (
    "Use the given context to answer the question. "
    "If you don''t know the answer, say you don''t know. "
    "Use three sentences maximum and keep the answer concise. Context: "
)


def lowered(text: str) -> str:
    return f"lower({text})"


def stripped(text: str) -> str:
    punctuation = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"
    return f"translate(lower({text}), '{punctuation}', '')"


def same(text: str) -> str:
    return text


def words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '[{SPACE}]+'), lambda w: w <> '')"


def low_words(text: str) -> str:
    return words(f"lower({text})")


def cut_words(text: str) -> str:
    text = f"regexp_replace(lower({text}), '([«“‘„»”’])', ' \\1 ', 'g')"
    for head, tail in (("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na")):
        text = f"regexp_replace({text}, '\\b({head})({tail})\\b', '\\1 \\2', 'g')"
    return words(text)


def words_13a(text: str) -> str:
    """The published 13a rules, one replacement after the other."""
    for old, new in (("<skipped>", "''"), ("-' || chr(10) || '", "''"), ("' || chr(10) || '", "' '"), ("&quot;", "'\"'"), ("&amp;", "'&'"), ("&lt;", "'<'"), ("&gt;", "'>'")):
        text = f"replace({text}, '{old}', {new})"
    text = f"concat(' ', {text}, ' ')"
    for pattern, spaced in (
        (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "), (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 "),
    ):
        text = f"regexp_replace({text}, '{pattern}', '{spaced}', 'g')"
    return words(text)


def class_ends() -> list[int]:
    """Longest texts of the length classes: a tenth more than the last, or one."""
    ends = [1]
    while ends[-1] < 1 << 20:
        ends.append(max(ends[-1] + 1, ends[-1] * 11 // 10))
    return ends


def alnum(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[a-z0-9]+')"


REFS = """refs AS (
  SELECT conv_id AS item_id, turn AS ref_no, text AS reference,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS slot
  FROM conversations WHERE role = 'user')"""
HYPS = """hyps AS (
  SELECT 'one' AS model, 'all' AS dataset, conv_id * 1000000 + turn AS item_id, conv_id, text AS hypothesis
  FROM conversations WHERE role = 'assistant')"""
RUN_HYPS = """hyps AS (
  SELECT CASE WHEN turn // 2 % 2 = 0 THEN 'model_0' ELSE 'model_1' END AS model,
         CASE WHEN conv_id % 2 = 0 THEN 'even' ELSE 'odd' END AS dataset,
         conv_id * 1000000 + turn AS item_id, conv_id, turn // 4 AS pair_no, text AS hypothesis
  FROM conversations WHERE role = 'assistant')"""
PAIRS = """pairs AS (
  SELECT model, dataset, hyps.item_id, ref_no, slot, hypothesis, reference
  FROM hyps JOIN refs ON refs.item_id = hyps.conv_id)"""
KEY = "model, dataset, item_id, ref_no, slot"


def pair_base(runs: bool) -> list[str]:
    return [REFS, RUN_HYPS if runs else HYPS, PAIRS]


def tokens(name: str, tokenise, clean=same) -> str:
    return (
        f"{name} AS (SELECT {KEY}, {tokenise(clean('hypothesis'))} AS ht, "
        f"{tokenise(clean('reference'))} AS rt FROM pairs)"
    )


def grams(name: str, source: str, column: str, orders: str) -> str:
    """Per pair, n and gram the count on one side."""
    return f"""{name} AS (
  SELECT {KEY}, n, array_to_string({column}[i : i + n - 1], ' ') AS gram, count(*) AS c
  FROM (SELECT {KEY}, {column}, n, unnest(generate_series(1, len({column}) - n + 1)) AS i
        FROM {source}, (SELECT unnest([{orders}]) AS n))
  GROUP BY ALL)"""


def rouge(tok: str, tokenise=alnum, clean=same) -> list[str]:
    return [
        tokens(f"{tok}_t", tokenise, clean),
        grams(f"{tok}_h", f"{tok}_t", "ht", "1, 2"),
        grams(f"{tok}_r", f"{tok}_t", "rt", "1, 2"),
        f"""{tok}_o AS (
  SELECT {KEY}, n, sum(least(h.c, r.c)) AS o
  FROM {tok}_h h JOIN {tok}_r r USING ({KEY}, n, gram) GROUP BY ALL)""",
        f"""{tok} AS (
  SELECT {KEY},
    2.0::DOUBLE * coalesce(max(o) FILTER (n = 1), 0)
      / (greatest(any_value(len(ht)), 1) + greatest(any_value(len(rt)), 1)) AS rouge1,
    2.0::DOUBLE * coalesce(max(o) FILTER (n = 2), 0)
      / (greatest(any_value(len(ht)) - 1, 1) + greatest(any_value(len(rt)) - 1, 1)) AS rouge2
  FROM {tok}_t LEFT JOIN {tok}_o USING ({KEY}) GROUP BY {KEY})""",
    ]


def rouge_of_stems(tok: str, tokenise=alnum, clean=same) -> list[str]:
    """ROUGE of stemmed tokens; the stems are those of the CTE `stems`."""
    key = f"{tok}_t"
    return [
        tokens(f"{tok}_u", tokenise, clean),
        *stem_sql.stemmed(key, f"{tok}_u", KEY, ["ht", "rt"], 4),
        *rouge(tok)[1:],
    ]


def stems_of_pairs(*columns) -> list[str]:
    """The stems of all words of the pairs, under each (name, tokenise, clean)."""
    made = [tokens(f"sw_{name}", tokenise, clean) for name, tokenise, clean in columns]
    union = " UNION ".join(
        f"SELECT unnest({side}) AS w FROM sw_{name}" for name, _, _ in columns for side in ("ht", "rt")
    )
    return [*made, f"st_words AS ({union})", *stem_sql.stems("st_words")]


# The words that the third stage of METEOR may exchange.
SYNONYMS = [("the", "a", "an"), ("of", "in", "on", "at"), ("is", "are", "was", "be"), ("that", "this", "it"), ("and", "or")]


# Stems that are words of the conversations, in classes by their letters.
LETTER_CLASSES = f"""classes AS (
  SELECT DISTINCT stem, array_to_string(list_sort(list_distinct(string_split(stem, ''))), '') AS c FROM stems
  WHERE stem IN (SELECT unnest({low_words('text')}) FROM conversations) AND regexp_full_match(stem, '[a-z]+'))"""


def meteor_of_stems(clean=same, tokenise=low_words, synonyms: bool = False, classes: str = "") -> list[str]:
    """METEOR with its second stage: words still free meet by their stems, the k-th last of each.

    The third stage does the same by class: words of one class are synonyms of all its others, and equal
    stems have met before.
    """
    def free(side: str, at: str, by: str = "stem", taken: str = "links", name: str = "free") -> str:
        more = "" if by == "stem" else "JOIN classes USING (stem)"
        return f"""{side}_{name} AS (
  SELECT {KEY}, {by}, p, row_number() OVER (PARTITION BY {KEY}, {by} ORDER BY p DESC) AS k
  FROM {side} JOIN stems USING (w) {more}
  WHERE NOT EXISTS (SELECT 1 FROM {taken} l WHERE {' AND '.join(f'l.{c} = {side}.{c}' for c in KEY.split(', '))}
    AND l.{at} = {side}.p))"""

    parts = meteor(clean, tokenise)
    at = next(i for i, part in enumerate(parts) if part.startswith("steps AS"))
    more = [
        free("met_h", "hyp_at"),
        free("met_r", "ref_at"),
        f"""both_links AS (
  SELECT {KEY}, hyp_at, ref_at FROM links UNION ALL
  SELECT {KEY}, h.p, r.p FROM met_h_free h JOIN met_r_free r USING ({KEY}, stem, k))""",
    ]
    last = "both_links"
    if synonyms:
        listed = ", ".join(f"('{w}', {i})" for i, group in enumerate(SYNONYMS) for w in group)
        more += [
            classes or f"classes AS (SELECT DISTINCT stem, c FROM (VALUES {listed}) v(w, c) JOIN stems USING (w))",
            free("met_h", "hyp_at", "c", "both_links", "left"),
            free("met_r", "ref_at", "c", "both_links", "left"),
            f"""all_links AS (
  SELECT {KEY}, hyp_at, ref_at FROM both_links UNION ALL
  SELECT {KEY}, h.p, r.p FROM met_h_left h JOIN met_r_left r USING ({KEY}, c, k))""",
        ]
        last = "all_links"
    return [*parts[:at], *more, parts[at].replace("FROM links)", f"FROM {last})"), *parts[at + 1 :]]


def meteor(clean=same, tokenise=low_words) -> list[str]:
    def placed(name: str, column: str) -> str:
        return f"""{name} AS (
  SELECT {KEY}, w, p, row_number() OVER (PARTITION BY {KEY}, w ORDER BY p DESC) AS k
  FROM (SELECT {KEY}, unnest({column}) AS w, unnest(generate_series(0, len({column}) - 1)) AS p FROM met_t))"""

    return [
        tokens("met_t", tokenise, clean),
        placed("met_h", "ht"),
        placed("met_r", "rt"),
        f"""links AS (
  SELECT {KEY}, h.p AS hyp_at, r.p AS ref_at FROM met_h h JOIN met_r r USING ({KEY}, w, k))""",
        f"""steps AS (
  SELECT {KEY}, hyp_at, ref_at,
    lag(hyp_at) OVER (PARTITION BY {KEY} ORDER BY hyp_at) AS hb,
    lag(ref_at) OVER (PARTITION BY {KEY} ORDER BY hyp_at) AS rb FROM links)""",
        f"""met_c AS (
  SELECT {KEY}, count(*) AS m,
    count(*) FILTER (hb IS NULL OR hyp_at <> hb + 1 OR ref_at <> rb + 1) AS ch
  FROM steps GROUP BY ALL)""",
        f"""met AS (
  SELECT {KEY}, coalesce(m, 0) AS matches, coalesce(ch, 0) AS chunks,
    CASE WHEN m IS NULL THEN 0.0::DOUBLE ELSE
      (1 - 0.5::DOUBLE * pow(ch / m, 3.0::DOUBLE)) * ((m / len(ht)) * (m / len(rt)))
      / (0.9::DOUBLE * (m / len(ht)) + 0.1::DOUBLE * (m / len(rt))) END AS meteor
  FROM met_t LEFT JOIN met_c USING ({KEY}))""",
    ]


def scored(clean=same) -> list[str]:
    return [
        *rouge("rou", alnum, clean),
        *meteor(clean, cut_words if clean is stripped else low_words),
        f"scored AS (SELECT {KEY}, rouge1, rouge2, meteor FROM rou JOIN met USING ({KEY}))",
    ]


ITEMS = """items AS (
  SELECT model, dataset, item_id, avg(rouge1) AS rouge1, avg(rouge2) AS rouge2, avg(meteor) AS meteor
  FROM scored GROUP BY ALL)"""
MACRO = """macro AS (
  SELECT model, dataset, avg(rouge1) AS rouge1, avg(rouge2) AS rouge2, avg(meteor) AS meteor
  FROM items GROUP BY ALL)"""
LONG = """long AS (
  SELECT model, dataset, 'rouge1' AS metric, rouge1 AS value FROM macro
  UNION ALL SELECT model, dataset, 'rouge2', rouge2 FROM macro
  UNION ALL SELECT model, dataset, 'meteor', meteor FROM macro)"""
LONG_BLEU = LONG[:-1] + " UNION ALL SELECT model, dataset, 'bleu', {bleu} FROM b_all)"
SLOTS = """sizes AS (SELECT model, dataset, item_id, count(*) AS n FROM pairs GROUP BY ALL),
firsts AS (SELECT model, dataset, arg_min(n, item_id) AS n FROM sizes GROUP BY ALL),
slot_avg AS (
  SELECT model, dataset, slot, avg(rouge1) AS rouge1, avg(rouge2) AS rouge2, avg(meteor) AS meteor
  FROM scored GROUP BY ALL),
slotted AS (
  SELECT model, dataset, count(*) AS slots, avg(rouge1) AS rouge1, avg(rouge2) AS rouge2,
         avg(meteor) AS meteor
  FROM slot_avg JOIN firsts USING (model, dataset) WHERE slot < n GROUP BY model, dataset)"""


def bleu(tokenise, clean=same) -> list[str]:
    return [
        tokens("b_t", tokenise, clean),
        # The hypothesis is counted once per item, not once per pair.
        """b_item AS (
  SELECT model, dataset, item_id, any_value(ht) AS ht, any_value(len(ht)) AS hl,
         arg_min(len(rt), abs(len(rt) - len(ht)) * 1000000000 + len(rt)) AS closest,
         min(len(rt)) AS shortest
  FROM b_t GROUP BY model, dataset, item_id)""",
        """b_h AS (
  SELECT model, dataset, item_id, n, array_to_string(ht[i : i + n - 1], ' ') AS gram, count(*) AS c
  FROM (SELECT model, dataset, item_id, ht, n, unnest(generate_series(1, len(ht) - n + 1)) AS i
        FROM b_item, (SELECT unnest([1, 2, 3, 4]) AS n)) GROUP BY ALL)""",
        grams("b_rg", "b_t", "rt", "1, 2, 3, 4"),
        "b_r AS (SELECT model, dataset, item_id, n, gram, max(c) AS c FROM b_rg GROUP BY ALL)",
        """b_clip AS (
  SELECT model, dataset, item_id, n, gram, least(h.c, r.c) AS clipped
  FROM b_h h JOIN b_r r USING (model, dataset, item_id, n, gram))""",
        """b_num AS (
  SELECT model, dataset,
    coalesce(sum(clipped) FILTER (n = 1), 0)::BIGINT AS num_1,
    coalesce(sum(clipped) FILTER (n = 2), 0)::BIGINT AS num_2,
    coalesce(sum(clipped) FILTER (n = 3), 0)::BIGINT AS num_3,
    coalesce(sum(clipped) FILTER (n = 4), 0)::BIGINT AS num_4
  FROM b_clip GROUP BY ALL)""",
        "b_sum AS (SELECT model, dataset, sum(hl)::BIGINT AS hyp_len, sum(closest)::BIGINT AS closest_ref, "
        "sum(shortest)::BIGINT AS shortest_ref, "
        + ", ".join(
            f"sum(greatest(hl - {n - 1}, 1))::BIGINT AS den_first_{n}, "
            f"sum(greatest(hl - {n - 1}, 0))::BIGINT AS den_again_{n}"
            for n in (1, 2, 3, 4)
        )
        + ", count(*) AS items FROM b_item GROUP BY ALL)",
        "b_all AS (SELECT b_sum.*, coalesce(num_1, 0) AS num_1, coalesce(num_2, 0) AS num_2, "
        "coalesce(num_3, 0) AS num_3, coalesce(num_4, 0) AS num_4 "
        "FROM b_sum LEFT JOIN b_num USING (model, dataset))",
    ]


def _mean_log(denominator: str, smoothed: bool) -> str:
    def numerator(n: int) -> str:
        return f"CASE WHEN num_{n} = 0 THEN 0.1::DOUBLE ELSE num_{n} END" if smoothed else f"num_{n}"

    return "(" + " + ".join(f"ln(({numerator(n)}) / {denominator}_{n})" for n in (1, 2, 3, 4)) + ") / 4"


def _brevity(reference: str) -> str:
    return f"CASE WHEN hyp_len > {reference} THEN 1.0::DOUBLE ELSE exp(1 - {reference} / hyp_len) END"


BLEU_FIRST = (
    f"CASE WHEN num_1 = 0 THEN 0.0::DOUBLE ELSE ({_brevity('closest_ref')}) * exp({_mean_log('den_first', True)}) END"
)
BLEU_AGAIN = (
    "CASE WHEN least(num_1, num_2, num_3, num_4) = 0 THEN 0.0::DOUBLE "
    f"ELSE ({_brevity('shortest_ref')}) * exp({_mean_log('den_again', False)}) END"
)


# The steps of a Poisson(1) variable on 16 bits.
POISSON = [24109, 48219, 60273, 64292, 65296, 65497, 65531, 65535]


def drawn(source: str, unit: str, keys: str, metrics: list[str], replicates: int) -> list[str]:
    """CTEs `draws` and `replicates`: weights out of md5(unit:block), eight to a digest, and the means of every draw."""
    weight = " + ".join(f"(u >= {step})::INT" for step in POISSON)
    means = ", ".join(f"sum({m} * weight) / sum(weight) FILTER ({m} IS NOT NULL) AS {m}" for m in metrics)
    return [
        f"""digests AS (SELECT {keys}, {', '.join(metrics)}, block, md5(concat({unit}, ':', block)) AS digest
  FROM {source}, (SELECT unnest(range({-(-replicates // 8)})) AS block))""",
        f"""draws AS (SELECT {keys}, {', '.join(metrics)}, block * 8 + k AS replicate, {weight} AS weight
  FROM (SELECT *, ('0x' || substr(digest, 1 + 4 * k, 4))::INT AS u FROM digests, (SELECT unnest(range(8)) AS k)))""",
        f"replicates AS (SELECT {keys}, replicate, {means} FROM draws WHERE replicate < {replicates} AND weight > 0 "
        f"GROUP BY {keys}, replicate)",
    ]


def interval_rows(keys: str, metrics: list[str]) -> str:
    points = ", ".join(f"round(round(quantile_cont(value, {q}), 12), 6) AS {n}" for n, q in (("low", 0.025), ("mid", 0.5), ("high", 0.975)))
    return (
        f"SELECT {keys}, metric, {points} FROM (UNPIVOT replicates ON {', '.join(metrics)} INTO NAME metric VALUE value) "
        f"GROUP BY {keys}, metric"
    )


def with_(parts: list[str], select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def six(value: str) -> str:
    """Six decimals. Rounding to twelve first lifts values that sit on a half but for float noise."""
    return f"round(round({value}, 12), 6)"


def r6(*columns: str) -> str:
    return ", ".join(f"{six(c)} AS {c}" for c in columns)


METRICS = r6("rouge1", "rouge2", "meteor")
PADDED = f"""WITH ends AS (SELECT {class_ends()} AS ends),
classed AS (
  SELECT doc_id, len({words('text')})::BIGINT AS n_tokens,
         len(list_filter(ends[:-2], lambda e: e < n_tokens))::BIGINT AS length_class FROM documents, ends),
batches AS (
  SELECT doc_id, n_tokens, length_class, ends[length_class + 1]::BIGINT AS padded_to,
         (row_number() OVER (PARTITION BY length_class ORDER BY doc_id) - 1) // greatest(1, 16384 // ends[length_class + 1]) AS batch
  FROM classed, ends)"""
PATH = "regexp_replace(url, '[?#].*$', '')"
NAME = f"string_split({PATH}, '/')[-1]"
STEM = f"regexp_replace({NAME}, '\\.[^.]*$', '')"
HIDDEN_STEM = f"regexp_replace({NAME}, '([^.])\\.[^.]*$', '\\1')"

PAGE_TEXT = "html"
for _pattern in ("<script[^>]*>.*?</script>", "<style[^>]*>.*?</style>"):
    PAGE_TEXT = f"regexp_replace({PAGE_TEXT}, '{_pattern}', ' ', 'gsi')"
PAGE_TEXT = f"regexp_replace({PAGE_TEXT}, '<!--.*?-->', ' ', 'gs')"
PAGE_TEXT = f"regexp_replace({PAGE_TEXT}, '<[^>]*>', ' ', 'g')"
PAGE_TEXT = f"trim(regexp_replace({PAGE_TEXT}, '[{SPACE}]+', ' ', 'g'), ' ')"
for _entity, _plain in (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
    ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
):
    PAGE_TEXT = f"replace({PAGE_TEXT}, '{_entity}', '{_plain}')"

CHUNKS = """chunks AS (
  SELECT doc_id, pos // 450 AS chunk_no, pos AS chunk_start, substr(text, pos + 1, 500) AS chunk_text
  FROM (SELECT doc_id, text,
          unnest(generate_series(0::BIGINT, greatest(length(text) - 51, 0)::BIGINT, 450)) AS pos
        FROM documents)
  WHERE length(trim(substr(text, pos + 1, 500), ' ')) > 0)"""


def embedded(name: str, source: str, key: str, text: str) -> list[str]:
    """Long form: key, bucket, weight for all 64 buckets."""
    return [
        f"""{name}_n AS (
  SELECT {key}, ('0x' || substr(md5(w), 1, 4))::INT % 64 AS bucket, count(*) AS c
  FROM (SELECT {key}, unnest({alnum(text)}) AS w FROM {source}) GROUP BY ALL)""",
        f"{name}_l AS (SELECT {key}, sqrt(sum(c * c)::DOUBLE) AS len FROM {name}_n GROUP BY ALL)",
        f"""{name} AS (
  SELECT {key}, b.bucket::BIGINT AS bucket, coalesce(c / len, 0.0::DOUBLE) AS weight
  FROM {source} CROSS JOIN (SELECT unnest(range(64)) AS bucket) b
  LEFT JOIN {name}_n USING ({key}, bucket) LEFT JOIN {name}_l USING ({key}))""",
    ]


def vectors(name: str, long: str, key: str) -> str:
    return f"{name} AS (SELECT {key}, list(weight ORDER BY bucket) AS v FROM {long} GROUP BY {key})"


STORE = [CHUNKS, "store AS (SELECT DISTINCT sha256(chunk_text) AS chunk_id, chunk_text FROM chunks)"]
RETRIEVED = [
    *STORE,
    *embedded("se", "store", "chunk_id", "chunk_text"),
    vectors("sv", "se", "chunk_id"),
    *embedded("qe", "benchmark", "item_id", "text"),
    vectors("qv", "qe", "item_id"),
    """near AS (
  SELECT item_id, chunk_id, distance, row_number() OVER (PARTITION BY item_id ORDER BY round(distance, 9), chunk_id) AS rank
  FROM (SELECT item_id, chunk_id,
          list_sum(list_transform(list_zip(qv.v, sv.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance
        FROM qv, sv) QUALIFY rank <= 4)""",
]
CONTEXT = """context AS (
  SELECT item_id, string_agg(chunk_text, chr(10) || chr(10) ORDER BY rank) AS context
  FROM near JOIN store USING (chunk_id) GROUP BY item_id)"""
GROUNDED = f"""SELECT b.item_id, 'grounded' AS mode, c.context AS context,
  'System: {GROUNDING}' || c.context || chr(10) || 'Human: ' || b.text AS prompt
FROM benchmark b JOIN context c USING (item_id)"""
UNGROUNDED = (
    "SELECT item_id, 'ungrounded' AS mode, NULL::VARCHAR AS context, text AS prompt FROM benchmark"
)


PAGE_CHUNKS = [
    f"texts AS (SELECT page_id, {PAGE_TEXT} AS text FROM pages)",
    *chunk_sql.chunks("a", "texts", "page_id", "text", 4000, 200),
    "sections AS (SELECT page_id, chunk_no AS section_no, chunk_start AS section_start, chunk_text AS section FROM a)",
    *chunk_sql.chunks("c", "sections", "page_id, section_no", "section", 500, 50),
    """page_chunks AS (
  SELECT page_id, section_no, section_start, chunk_no, section_start + chunk_start AS chunk_start, chunk_text
  FROM c JOIN sections USING (page_id, section_no))""",
]
PAGE_RETRIEVED = [
    *PAGE_CHUNKS,
    "store AS (SELECT DISTINCT sha256(chunk_text) AS chunk_id, chunk_text FROM page_chunks)",
    *RETRIEVED[len(STORE):],
]


def self_nearest(k: int, columns: str) -> str:
    return f"""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)
SELECT {columns} FROM (
  SELECT query_id, vec_id, distance,
         row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 9), vec_id) AS rank
  FROM (SELECT q.vec_id AS query_id, s.vec_id,
          list_sum(list_transform(list_zip(q.e, s.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance
        FROM v q, v s)) WHERE rank <= {k}"""


def _l2(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def cells(probes: int) -> list[str]:
    return [
        "vec AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)",
        """centre AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cell, e
  FROM (SELECT * FROM vec ORDER BY md5(vec_id::VARCHAR), vec_id LIMIT 64))""",
        f"""order_of AS (
  SELECT vec_id, cell, row_number() OVER (PARTITION BY vec_id ORDER BY round({_l2('vec.e', 'centre.e')}, 9), cell) AS r
  FROM vec, centre)""",
        "own AS (SELECT vec_id, cell FROM order_of WHERE r = 1)",
        "sizes AS (SELECT cell, count(*) AS n FROM own GROUP BY cell)",
        f"""probe AS (
  SELECT vec_id AS query_id, cell FROM (
    SELECT vec_id, cell, r, coalesce(sum(n) OVER (
      PARTITION BY vec_id ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held
    FROM order_of LEFT JOIN sizes USING (cell)) WHERE r <= {probes} OR held < 4)""",
        "met AS (SELECT query_id, vec_id FROM probe JOIN own USING (cell))",
        f"""approximate AS (
  SELECT query_id, vec_id, distance,
    row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 9), vec_id) AS rank
  FROM (SELECT query_id, met.vec_id, {_l2('q.e', 's.e')} AS distance
        FROM met JOIN vec q ON q.vec_id = query_id JOIN vec s ON s.vec_id = met.vec_id)
  QUALIFY rank <= 4)""",
    ]


def _recall(probes: int) -> str:
    return with_(
        [*cells(probes), "exact AS (" + self_nearest(4, "query_id, vec_id") + ")"],
        f"""SELECT {probes} AS probes, count(*) AS exact_rows, round(round(avg((a.vec_id IS NOT NULL)::INT), 12), 6) AS recall,
  any_value(pairs_compared) AS pairs_compared,
  round(round(any_value(pairs_compared / (SELECT count(*) * count(*) FROM embeddings)), 12), 6) AS share
FROM exact LEFT JOIN approximate a USING (query_id, vec_id), (SELECT count(*) AS pairs_compared FROM met)""",
    )


CAPTION_MODEL = (
    f"'caption: ' || text AS caption, len(regexp_extract_all(text, '[A-Za-z0-9]+'))::BIGINT AS words"
)


def all_sql() -> dict[str, str]:
    one, many = pair_base(False), pair_base(True)
    three = ["rouge1", "rouge2", "meteor"]
    first_items = [*many, *scored(), ITEMS]
    first_long = [*first_items, *bleu(words), MACRO, LONG_BLEU.replace("{bleu}", BLEU_FIRST)]
    again_slots = [*many, *scored(stripped), SLOTS]
    bleu_runs_first = [*many, *bleu(words)]
    bleu_runs_again = [*many, *bleu(words, stripped)]
    batches = f"""numbered AS (
  SELECT model, dataset, item_id, {METRICS},
         row_number() OVER (PARTITION BY model, dataset ORDER BY item_id) - 1 AS row_id FROM items)"""
    counts = (
        "hyp_len, closest_ref, shortest_ref, "
        + ", ".join(f"den_first_{n}, den_again_{n}" for n in (1, 2, 3, 4))
        + ", num_1, num_2, num_3, num_4, items"
    )
    return {
        "s1_captioned_dataset": with_(
            [REFS],
            "SELECT item_id, slot // 1000 AS block, count(*) AS n_references, "
            "string_agg(reference, ' || ' ORDER BY slot) AS reference_captions FROM refs GROUP BY ALL",
        ),
        "s2_caption_files": f"""SELECT printf('%06d.jpg', doc_id) AS image_name, text AS generated_caption,
  '{CHAT_OPEN}Caption the image in one sentence.{CHAT_CLOSE}' AS prompt FROM documents""",
        "s3_run_documents": with_(first_items, f"SELECT model, dataset, item_id, {METRICS} FROM items"),
        "s3_nested_documents": with_(
            [*first_items, *bleu(words)],
            f"""SELECT model, dataset, item_id AS image_id, hypothesis AS generated_caption, {six(BLEU_FIRST)} AS corpus_bleu, {METRICS}
FROM items JOIN hyps USING (model, dataset, item_id) JOIN b_all USING (model, dataset)""",
        ),
        "s4_sorted_files": f"""SELECT page_id, path, row_number() OVER (ORDER BY path, page_id) - 1 AS row_id
FROM (SELECT page_id, {PATH} AS path FROM pages) WHERE path LIKE '%.html'""",
        "s5_page_text": f"SELECT page_id, url, {PAGE_TEXT} AS text FROM pages",
        "k1_run_items": with_(first_items, f"SELECT model, dataset, item_id, {METRICS} FROM items"),
        "k2_captions_with_prompt": f"""SELECT printf('%06d.jpg', item_id) AS image_name,
  text AS generated_caption, '{CHAT_OPEN}Caption the image in one sentence.{CHAT_CLOSE}' AS prompt
FROM benchmark""",
        "k3_newest_summary": with_(
            [*again_slots, *bleu(words, stripped)],
            f"""SELECT model, dataset, round(round({BLEU_AGAIN}, 12), 6) AS bleu, {METRICS},
  'recomputed' AS metric_def, 2::BIGINT AS version FROM slotted JOIN b_all USING (model, dataset)""",
        ),
        "k1_run_summary": with_(
            [*first_items, *bleu(words), MACRO],
            f"SELECT model, dataset, {six(BLEU_FIRST)} AS bleu, {METRICS} FROM macro JOIN b_all USING (model, dataset)",
        ),
        "k3_merged_statistics": f"""SELECT * FROM ({with_(
            [*first_items, *bleu(words), MACRO],
            f"SELECT model, dataset, {six(BLEU_FIRST)} AS bleu, {METRICS}, 'first_run' AS metric_def FROM macro JOIN b_all USING (model, dataset)",
        )}) UNION ALL SELECT * FROM ({with_(
            [*again_slots, *bleu(words, stripped)],
            f"SELECT model, dataset, {six(BLEU_AGAIN)} AS bleu, {METRICS}, 'recomputed' AS metric_def FROM slotted JOIN b_all USING (model, dataset)",
        )})""",
        "k3_recomputed_from_store": with_(
            [*again_slots, *bleu(words, stripped)],
            f"""SELECT model, dataset, {six(BLEU_AGAIN)} AS bleu, {METRICS},
  'recomputed' AS metric_def, 2::BIGINT AS version FROM slotted JOIN b_all USING (model, dataset)""",
        ),
        "k4_chunk_store": with_(
            [*STORE, *embedded("se", "store", "chunk_id", "chunk_text")],
            """SELECT chunk_id, length(chunk_text)::BIGINT AS n_chars, length
FROM store JOIN (SELECT chunk_id, round(round(sqrt(sum(weight * weight)), 12), 6) AS length FROM se GROUP BY 1) USING (chunk_id)""",
        ),
        "k5_filled_template": """SELECT d.doc_id::INT AS "ID", coalesce(l.quality, 10)::INT AS "Answer"
FROM documents d LEFT JOIN labels l USING (doc_id)""",
        "p1_row_id": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM documents",
        "p2_normalised": f"SELECT doc_id, {stripped('text')} AS text FROM documents",
        "p3_whitespace_tokens": f"""SELECT doc_id, len(t)::BIGINT AS n_tokens, array_to_string(t, '|') AS tokens
FROM (SELECT doc_id, {words('text')} AS t FROM documents)""",
        "p4_rouge_tokens": f"""SELECT doc_id, len(t)::BIGINT AS n_tokens, array_to_string(t, '|') AS tokens
FROM (SELECT doc_id, {alnum('text')} AS t FROM documents)""",
        "p4_rouge_stems": with_(
            [
                f"pt AS (SELECT doc_id, {alnum('text')} AS t FROM documents)",
                stem_sql.distinct_words("pt", ["t"]),
                *stem_sql.stems("st_words"),
                *stem_sql.stemmed("ps", "pt", "doc_id", ["t"], 4),
            ],
            "SELECT doc_id, len(t)::BIGINT AS n_tokens, array_to_string(t, '|') AS tokens FROM ps",
        ),
        "a3_rouge_stemmed": with_(
            [*one, *stems_of_pairs(("a", alnum, same)), *rouge_of_stems("rou")],
            f"SELECT item_id, ref_no, {r6('rouge1', 'rouge2')} FROM rou",
        ),
        "a5_meteor_stemmed": with_(
            [*one, *stems_of_pairs(("m", low_words, same)), *meteor_of_stems()],
            f"SELECT item_id, ref_no, matches AS meteor_matches, {r6('meteor')} FROM met",
        ),
        "a5_meteor_synonyms": with_(
            [*one, *stems_of_pairs(("m", low_words, same)), *meteor_of_stems(synonyms=True)],
            f"SELECT item_id, ref_no, matches AS meteor_matches, chunks AS meteor_chunks, {r6('meteor')} FROM met",
        ),
        "a5_meteor_senses": with_(
            [*one, *stems_of_pairs(("m", low_words, same)), *meteor_of_stems(synonyms=True, classes=LETTER_CLASSES)],
            f"SELECT item_id, ref_no, matches AS meteor_matches, chunks AS meteor_chunks, {r6('meteor')} FROM met",
        ),
        "evaluation_first_run": with_(
            [
                *many,
                *stems_of_pairs(("a", alnum, same), ("m", low_words, same)),
                *rouge_of_stems("rou"),
                *meteor_of_stems(),
                f"scored AS (SELECT {KEY}, rouge1, rouge2, meteor FROM rou JOIN met USING ({KEY}))",
                ITEMS,
                MACRO,
                *bleu(words),
            ],
            f"""SELECT model, dataset, {six(BLEU_FIRST)} AS bleu, {METRICS}, 'first_run' AS metric_def
FROM macro JOIN b_all USING (model, dataset)""",
        ),
        "evaluation_recomputed": with_(
            [
                *many,
                *stems_of_pairs(("m", cut_words, stripped)),
                *rouge("rou", alnum, stripped),
                *meteor_of_stems(stripped, cut_words),
                f"scored AS (SELECT {KEY}, rouge1, rouge2, meteor FROM rou JOIN met USING ({KEY}))",
                SLOTS,
                *bleu(words, stripped),
            ],
            f"""SELECT model, dataset, {six(BLEU_AGAIN)} AS bleu, {METRICS}, 'recomputed' AS metric_def
FROM slotted JOIN b_all USING (model, dataset)""",
        ),
        "p5_chat_prompt": f"""SELECT conv_id, turn, role, '{CHAT_OPEN}' || text || '{CHAT_CLOSE}' AS prompt
FROM conversations""",
        "p6_style_prompt": f"SELECT item_id, {STYLE} text AS prompt FROM benchmark",
        "p7_base_name": f"SELECT page_id, {NAME} AS name FROM pages",
        "p8_output_name": f"""SELECT page_id, 'results/styled/' || {STEM} || '_styled.png' AS styled,
  'results/drawn/' || {HIDDEN_STEM} || '_diff3.jpg' AS drawn FROM pages""",
        "p9_grounded_prompt": with_([*RETRIEVED, CONTEXT], GROUNDED),
        "p10_ungrounded_prompt": UNGROUNDED,
        "p11_completion_text": r"""SELECT conv_id, turn, regexp_replace(text || text, '<\|[a-z0-9_]+\|>', '', 'g') AS completion
FROM conversations""",
        "p12_four_decimals": with_(
            first_items,
            "SELECT model, dataset, item_id, printf('%.4f', rouge1) AS rouge1, "
            "printf('%.4f', rouge2) AS rouge2, printf('%.4f', meteor) AS meteor FROM items",
        ),
        "f2_by_extension": f"SELECT page_id, path FROM (SELECT page_id, {PATH} AS path FROM pages) WHERE path LIKE '%.html'",
        "f3_split": "SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'en'",
        "f3_pruned_split": "SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'en'",
        "f3_pruned_by_table": """SELECT doc_id, lang, n_chars FROM documents
WHERE lang IN (SELECT lang FROM documents GROUP BY lang HAVING max(n_chars) > 20000)""",
        "w2_padded_batches": f"{PADDED} SELECT doc_id, n_tokens, length_class, batch, padded_to FROM batches",
        "w2_padding_share": f"""{PADDED}
SELECT sum(n)::BIGINT AS "rows", count(*) AS batches, {six("1 - sum(used) / sum(n * longest)")} AS padding
FROM (SELECT count(*) AS n, max(n_tokens) AS longest, sum(n_tokens) AS used FROM batches GROUP BY length_class, batch)""",
        "m1_padded_batches": f"""{PADDED} SELECT doc_id, n_tokens, max(n_tokens) OVER w AS longest, count(*) OVER w AS "rows"
FROM batches WINDOW w AS (PARTITION BY length_class, batch)""",
        "a2_bleu_13a": with_([*many, *bleu(words_13a)], f"SELECT model, dataset, {six(BLEU_AGAIN)} AS bleu FROM b_all"),
        "a2_tokens_13a": f"""SELECT doc_id, len(t)::BIGINT AS n_tokens, array_to_string(t, '|') AS tokens
FROM (SELECT doc_id, {words_13a('text')} AS t FROM documents)""",
        "f4_no_empty_tokens": f"""SELECT doc_id, len(list_filter(p, lambda w: w <> ''))::BIGINT AS kept,
  len(list_filter(p, lambda w: w = ''))::BIGINT AS dropped
FROM (SELECT doc_id, string_split_regex(text, '[{SPACE}]') AS p FROM documents)""",
        "j1_image_prompts": f"""SELECT printf('%06d.jpg', page_id) AS image_name, url, {STYLE} text AS prompt
FROM pages JOIN documents ON page_id = doc_id""",
        "j1_by_position": f"""SELECT row_id, url, {STYLE} text AS prompt
FROM (SELECT url, row_number() OVER (ORDER BY url, page_id) - 1 AS row_id FROM pages)
JOIN (SELECT text, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM documents) USING (row_id)""",
        "j2_pairs": with_(one, "SELECT item_id, ref_no, hypothesis, reference FROM pairs"),
        "j2_unmatched": """SELECT conv_id, turn, role FROM conversations c
WHERE role IN ('assistant', 'user') AND NOT EXISTS (
  SELECT 1 FROM conversations o WHERE o.conv_id = c.conv_id AND o.role IN ('assistant', 'user') AND o.role <> c.role)""",
        "j3_model_with_key": f"SELECT doc_id, {CAPTION_MODEL} FROM documents",
        "j5_reference_slots": with_([REFS], "SELECT item_id, slot, reference FROM refs"),
        "j6_nearest_chunks": with_(
            RETRIEVED, "SELECT item_id, chunk_id, round(round(distance, 9), 6) AS distance, rank FROM near"
        ),
        "j7_clipped_counts": with_(
            [*one, *bleu(low_words)],
            """SELECT item_id, n::BIGINT AS n, count(*) AS grams, sum(clipped)::BIGINT AS clipped
FROM b_clip GROUP BY item_id, n""",
        ),
        "j8_word_alignment": with_([*one, *meteor()], "SELECT item_id, ref_no, hyp_at, ref_at FROM links"),
        "j9_richer_but_lower": with_(
            [
                *first_items,
                """sides AS (
  SELECT conv_id, pair_no, dataset, model, length(hypothesis) AS len, rouge2, meteor
  FROM items JOIN hyps USING (model, dataset, item_id))""",
            ],
            """SELECT a.dataset, a.conv_id, a.pair_no, round(round(a.rouge2, 12), 6) AS rouge2_a, round(round(a.meteor, 12), 6) AS meteor_a,
  round(round(b.rouge2, 12), 6) AS rouge2_b, round(round(b.meteor, 12), 6) AS meteor_b,
  CASE WHEN a.len > b.len THEN 'a' ELSE 'b' END AS richer
FROM sides a JOIN sides b USING (dataset, conv_id, pair_no)
WHERE a.model = 'model_0' AND b.model = 'model_1' AND (
  (a.len > b.len AND a.rouge2 < b.rouge2 AND a.meteor < b.meteor)
  OR (b.len > a.len AND b.rouge2 < a.rouge2 AND b.meteor < a.meteor))""",
        ),
        "j10_coverage": """SELECT doc_id, d.doc_id IS NOT NULL AS in_left, l.doc_id IS NOT NULL AS in_right
FROM (SELECT DISTINCT doc_id FROM documents) d FULL OUTER JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)""",
        "j10_missing_keys": """SELECT doc_id, lang FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
        "a1_corpus_bleu_first_run": with_(
            bleu_runs_first, f"SELECT model, dataset, round(round({BLEU_FIRST}, 12), 6) AS bleu FROM b_all"
        ),
        "a2_corpus_bleu_recomputed": with_(
            bleu_runs_again, f"SELECT model, dataset, round(round({BLEU_AGAIN}, 12), 6) AS bleu FROM b_all"
        ),
        "a1_a2_bleu_counts": with_([*one, *bleu(low_words)], f"SELECT {counts} FROM b_all"),
        "a3_rouge_pairs": with_(
            [*one, *rouge("rou")], f"SELECT item_id, ref_no, {r6('rouge1', 'rouge2')} FROM rou"
        ),
        "a3_bootstrap_intervals": with_(
            [*first_items, *drawn("items", "item_id", "model, dataset", three, 1000)], interval_rows("model, dataset", three)
        ),
        "a7_bootstrap_slots": with_(
            [
                *again_slots,
                *drawn("scored", "item_id", "model, dataset, slot", ["rouge1", "rouge2"], 200),
                """mids AS (
  SELECT model, dataset, slot, quantile_cont(rouge1, 0.5) AS rouge1, quantile_cont(rouge2, 0.5) AS rouge2
  FROM replicates GROUP BY ALL)""",
            ],
            f"""SELECT model, dataset, count(*) AS slots, {', '.join(f"{six(f'avg({m})')} AS {m.split('.')[1]}" for m in ("mids.rouge1", "mids.rouge2", "slot_avg.meteor"))}
FROM slot_avg JOIN firsts USING (model, dataset) JOIN mids USING (model, dataset, slot) WHERE slot < n GROUP BY model, dataset""",
        ),
        "a9_margin_intervals": with_(
            [
                *first_items,
                """sides AS (
  SELECT conv_id, pair_no, dataset, model, rouge1, rouge2, meteor FROM items JOIN hyps USING (model, dataset, item_id))""",
                """leads AS (
  SELECT dataset, concat(conv_id, '-', pair_no) AS unit, a.rouge1 - b.rouge1 AS rouge1, a.rouge2 - b.rouge2 AS rouge2,
         a.meteor - b.meteor AS meteor
  FROM sides a JOIN sides b USING (dataset, conv_id, pair_no) WHERE a.model = 'model_0' AND b.model = 'model_1')""",
                *drawn("leads", "unit", "dataset", three, 1000),
            ],
            interval_rows("dataset", three),
        ),
        "a4_item_means": with_(first_items, f"SELECT model, dataset, item_id, {METRICS} FROM items"),
        "a5_meteor_exact": with_([*one, *meteor()], f"SELECT item_id, ref_no, {r6('meteor')} FROM met"),
        "a6_macro_means": with_([*first_items, MACRO], f"SELECT model, dataset, {METRICS} FROM macro"),
        "a7_slot_means": with_(again_slots, f"SELECT model, dataset, slots, {METRICS} FROM slotted"),
        "a7_short_items": with_(
            [
                *many,
                "sizes AS (SELECT model, dataset, item_id, count(*) AS \"references\" FROM pairs GROUP BY ALL)",
                'firsts AS (SELECT model, dataset, arg_min("references", item_id) AS slots FROM sizes GROUP BY ALL)',
            ],
            'SELECT model, dataset, item_id, "references", slots FROM sizes JOIN firsts USING (model, dataset) '
            'WHERE "references" < slots',
        ),
        "a8_cross_tab": with_(
            first_long,
            "SELECT model, "
            + ", ".join(
                f"round(round(max(value) FILTER (dataset = '{d}' AND metric = '{m}'), 12), 6) AS {d}_{m}"
                for d in ("even", "odd")
                for m in ("bleu", "rouge1", "rouge2", "meteor")
            )
            + " FROM long GROUP BY model",
        ),
        "a9_best_models": with_(
            first_long,
            """SELECT dataset, metric, arg_max(model, value) AS best_model, round(round(max(value), 12), 6) AS best_value,
  round(round(max(value) - min(value), 12), 6) AS margin FROM long GROUP BY dataset, metric""",
        ),
        "a10_dataset_means": with_(
            first_long,
            "SELECT dataset, metric, round(round(avg(value), 12), 6) AS mean_value FROM long GROUP BY dataset, metric",
        ),
        "a11_item_batches": with_(
            [*first_items, batches],
            """SELECT model, dataset, row_id // 10 AS batch, count(*) AS n_items,
  string_agg(item_id::VARCHAR, ',' ORDER BY row_id) AS item_ids, round(round(sum(rouge1), 12), 6) AS rouge1_sum
FROM numbered GROUP BY model, dataset, batch""",
        ),
        "a12_context": with_([*RETRIEVED, CONTEXT], "SELECT item_id, context FROM context"),
        "a13_stale_summaries": with_(
            [
                *many,
                *scored(),
                ITEMS,
                MACRO,
                LONG,
                *[part.replace("rou", "rox").replace("roxge", "rouge") for part in rouge("rou", alnum, stripped)],
                *[_renamed(part) for part in meteor(stripped, cut_words)],
                f"scored2 AS (SELECT {KEY}, rouge1, rouge2, meteor FROM rox JOIN met2 USING ({KEY}))",
                SLOTS.replace("FROM scored ", "FROM scored2 "),
                """long2 AS (
  SELECT model, dataset, 'rouge1' AS metric, rouge1 AS stored FROM slotted
  UNION ALL SELECT model, dataset, 'rouge2', rouge2 FROM slotted
  UNION ALL SELECT model, dataset, 'meteor', meteor FROM slotted)""",
            ],
            """SELECT model, dataset, metric, round(round(stored, 12), 6) AS stored, round(round(value, 12), 6) AS actual,
  abs(stored - value) > 1e-9 AS stale FROM long2 JOIN long USING (model, dataset, metric)""",
        ),
        "w1_row_number": "SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS row_id FROM documents",
        "w2_batches": """SELECT doc_id, row_id // 10 AS batch_of_10, row_id // 4 AS batch_of_4
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM documents)""",
        "w3_meteor_chunks": with_(
            [*one, *meteor()],
            "SELECT item_id, ref_no, matches AS meteor_matches, chunks AS meteor_chunks FROM met",
        ),
        "w4_rank": self_nearest(10, "query_id, vec_id, round(round(distance, 9), 6) AS distance, rank"),
        "o1_sorted_pages": "SELECT url, page_id, row_number() OVER (ORDER BY url, page_id) - 1 AS row_id FROM pages",
        "o2_top_k": self_nearest(4, "query_id, vec_id, round(round(distance, 9), 6) AS distance"),
        "o2_bounded_top_k": self_nearest(4, "query_id, vec_id, round(round(distance, 9), 6) AS distance"),
        "o3_reference_order": with_([REFS], "SELECT item_id, ref_no, slot FROM refs"),
        "u1_both_modes": with_([*RETRIEVED, CONTEXT], f"{GROUNDED} UNION ALL {UNGROUNDED}"),
        "u2_runs": """SELECT CASE role WHEN 'assistant' THEN 'assistant' ELSE 'user' END AS model,
  CASE WHEN conv_id % 2 = 0 THEN 'even' ELSE 'odd' END AS dataset, conv_id * 1000000 + turn AS item_id,
  text AS hypothesis
FROM conversations WHERE role IN ('assistant', 'user')""",
        "c1_recursive_chunks": "WITH RECURSIVE "
        + ",\n".join(chunk_sql.chunks("c", "documents", "doc_id", "text", 500, 50))
        + "\nSELECT doc_id, chunk_no, chunk_start, chunk_text FROM c",
        "c2_page_then_chunks": "WITH RECURSIVE "
        + ",\n".join(PAGE_CHUNKS)
        + "\nSELECT page_id, section_no, section_start, chunk_no, chunk_start, chunk_text FROM page_chunks",
        "rag_sources": "WITH RECURSIVE "
        + ",\n".join(PAGE_RETRIEVED)
        + f"""
SELECT item_id, chunk_id, {six("distance")} AS distance, rank, page_id, section_no, chunk_no, chunk_start
FROM near JOIN page_chunks p ON sha256(p.chunk_text) = chunk_id""",
        "rag_answers": "WITH RECURSIVE "
        + ",\n".join([*PAGE_RETRIEVED, CONTEXT])
        + f"\nSELECT item_id, mode, 'answer to: ' || prompt AS answer FROM ({GROUNDED} UNION ALL {UNGROUNDED})",
        "c3_stride_chunks": with_([CHUNKS], "SELECT doc_id, chunk_no, chunk_start, chunk_text FROM chunks"),
        "m1_model_batches": f"SELECT conv_id, turn, {CAPTION_MODEL} FROM conversations",
        "m2_hashed_embedding": with_(
            embedded("e", "documents", "doc_id", "text"),
            "SELECT doc_id, bucket, round(round(weight, 12), 6) AS weight FROM e",
        ),
        "m3_squared_l2": """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)
SELECT a.vec_id, round(round(list_sum(list_transform(list_zip(a.e, b.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 12), 6) AS distance
FROM v a JOIN v b ON b.vec_id = a.vec_id + 1""",
        "caption_flow": f"""SELECT image_name, url AS path, {STYLE} 'A page of ' || length(html) || ' characters.' AS prompt,
  'results/styled/' || printf('%06d', page_id) || '_styled.png' AS styled,
  'results/drawn/' || printf('%06d', page_id) || '_diff3.jpg' AS drawn
FROM (SELECT *, printf('%06d.jpg', page_id) AS image_name FROM pages)""",
        "m5_approximate_nearest": with_(
            cells(40),
            "SELECT query_id, vec_id, round(round(distance, 9), 6) AS distance, rank FROM approximate",
        ),
        "m5_recall": " UNION ALL ".join("FROM (" + _recall(probes) + ")" for probes in (16, 40)),
        "m4_cosine": with_(
            [
                *one,
                *embedded("he", "hyps", "item_id", "hypothesis"),
                "rtexts AS (SELECT item_id * 1000000 + ref_no AS rid, reference FROM pairs)",
                *embedded("re", "rtexts", "rid", "reference"),
            ],
            """SELECT item_id, ref_no,
  round(round(CASE WHEN sum(r.weight * r.weight) = 0 OR sum(h.weight * h.weight) = 0 THEN NULL
    ELSE sum(h.weight * r.weight) END, 12), 6) AS cosine
FROM pairs JOIN he h USING (item_id) JOIN re r ON r.rid = item_id * 1000000 + ref_no AND r.bucket = h.bucket
GROUP BY item_id, ref_no""",
        ),
    }


def _renamed(part: str) -> str:
    """The METEOR steps under second names, so that one statement can hold two definitions."""
    for name in ("met_t", "met_h", "met_r", "met_c", "links", "steps"):
        part = part.replace(name, name + "2")
    return part.replace("met AS", "met2 AS")
