"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from lacuna.llm.quality import BASE, RULES, STOP_WORDS

_WORDS = r"'[^\x20\x09-\x0D]+'"

ORACLES: dict[str, str] = {}

ORACLES["op1_url_filter"] = r"""
WITH parts AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), matched AS (
    SELECT *, CASE
        WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM parts
)
SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM matched
"""


def _passes() -> str:
    tests = []
    for rule in RULES:
        for value, sign in ((rule.least, "<"), (rule.most, ">")):
            if value is not None:
                above, below = rule.figure.split(" / ")
                tests.append(f"NOT coalesce(({above}::DOUBLE / nullif({below}, 0)) {sign} {value}, FALSE)")
    return " AND ".join(tests)


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
FIGURES = rf"""
base AS (
    SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents
), windows AS (
    SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
    FROM (SELECT k, w, unnest(generate_series(1, len(w) - 2)) AS i FROM base)
), repeated AS (
    SELECT k, count(DISTINCT p) AS n FROM (
        SELECT k, unnest([i, i + 1, i + 2]) AS p
        FROM windows JOIN (SELECT k, s FROM windows GROUP BY k, s HAVING count(*) > 1) USING (k, s)
    ) GROUP BY k
), figures AS (
    SELECT base.k, doc_id, len(w)::BIGINT AS n_words,
        length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words,
        len(list_filter(w, lambda x: lower(x) IN ({_STOP})))::BIGINT AS n_stop_words,
        len(l)::BIGINT AS n_lines,
        len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•|]')))::BIGINT AS n_bullet_lines,
        len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')))::BIGINT AS n_ellipsis_lines
    FROM base LEFT JOIN repeated USING (k)
), judged AS (
    SELECT *, {BASE} AS base_failed, NOT ({BASE}) AND {_passes()} AS kept FROM figures
)
"""

ORACLES["op4_quality_rules"] = f"""
WITH {FIGURES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged
"""

ORACLES["op5_chat_format"] = """
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, chr(1)) AS role, coalesce(text, chr(1)) AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS pos
    FROM conversations
), grown AS (
    SELECT *, string_agg(role || chr(2) || text, chr(3)) OVER (PARTITION BY conv_id ORDER BY pos) AS prefix,
        count(*) OVER (PARTITION BY conv_id) AS turns
    FROM turns
), ends AS (
    SELECT prefix, pos, min(conv_id) AS conv_id FROM grown WHERE pos = turns GROUP BY prefix, pos
), kept AS (
    SELECT conv_id FROM ends
    WHERE NOT EXISTS (SELECT 1 FROM grown g WHERE g.pos < g.turns AND g.pos = ends.pos AND g.prefix = ends.prefix)
)
SELECT conv_id, turns AS n_turns, (pos - 1) // 1000 AS segment, count(*) AS n_segment_turns,
    string_agg('<|' || replace(role, chr(1), 'unknown') || '|>' || chr(10) || replace(text, chr(1), '')
        || chr(10) || '<|end|>' || chr(10), '' ORDER BY pos) AS text
FROM grown JOIN kept USING (conv_id)
GROUP BY conv_id, turns, segment
"""
