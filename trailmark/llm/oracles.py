"""DuckDB texts for the queries that SQL can express. They share rule tables with the operators, and no logic."""

from __future__ import annotations

from .license_rules import CONFIDENCE, rules


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _licenses() -> str:
    values = ",\n".join(
        f"({r.number}, {_text(r.label)}, {_text('  ' + r.keyword + '  ')}, {_text(' ' + r.pattern.replace(' ?', '@').replace(' ', '  ').replace('@', '(?:  )?') + ' ')}, {r.priority}, {CONFIDENCE[r.priority]}, {str(r.base).lower()})"
        for r in rules()
    )
    return f"""
WITH rule(number, label, keyword, pattern, priority, sure, base) AS (VALUES {values}),
doc AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS ws FROM documents
),
norm AS (SELECT doc_id, len(ws) AS n_words, '  ' || array_to_string(ws, '  ') || '  ' AS line FROM doc),
tried AS (
    SELECT DISTINCT doc_id, number, label, priority, sure, base, substr(line, 2, length(line) - 2) AS line, pattern
    FROM norm, rule WHERE contains(line, keyword)
),
parts AS (
    SELECT *, unnest(regexp_extract_all(line, pattern)) AS hit, unnest(regexp_split_to_array(line, pattern)[:-2]) AS gap,
        generate_subscripts(regexp_extract_all(line, pattern), 1) AS place
    FROM tried WHERE regexp_matches(line, pattern)
),
sized AS (
    SELECT *, (length(hit) - length(replace(hit, ' ', ''))) // 2 AS h, (length(gap) - length(replace(gap, ' ', ''))) // 2 AS g FROM parts
),
placed AS (SELECT *, sum(g + h) OVER (PARTITION BY doc_id, number ORDER BY place) AS stop FROM sized),
spans AS (SELECT DISTINCT doc_id, number, label, priority, sure, base, stop - h AS start, stop FROM placed),
judged AS (
    SELECT a.*, EXISTS (
        SELECT 1 FROM spans b WHERE b.doc_id = a.doc_id AND b.start <= a.start AND b.stop >= a.stop
        AND (b.priority > a.priority OR (b.priority = a.priority AND (b.stop - b.start > a.stop - a.start
             OR (b.stop - b.start = a.stop - a.start AND b.number < a.number))))
    ) AS covered FROM spans a
),
found AS (
    SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
        array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
        array_to_string(list_sort(list(DISTINCT label) FILTER (base OR NOT covered)), ',') AS labels, max(sure) FILTER (NOT covered) AS score
    FROM judged GROUP BY doc_id
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
    CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM norm LEFT JOIN found USING (doc_id)
"""


def deduplicated(docs: str) -> str:
    """CTEs that end in ``kept(doc_id, n_lines, n_removed, n_runs, text)`` of a relation with unlike doc_ids."""
    blanks = "' ' || chr(9) || chr(13) || chr(12) || chr(11)"
    return f"""
line AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM {docs}
),
bare AS (SELECT doc_id, line_no, raw, trim(raw, {blanks}) AS body FROM line),
numbered AS (
    SELECT *, row_number() OVER (ORDER BY doc_id, line_no) AS place, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS seq,
        len(regexp_extract_all(body, '[^ \\t\\n\\r\\f\\v]+')) AS words FROM bare WHERE body <> ''
),
windowed AS (
    SELECT *, body || chr(10) || lead(body, 1) OVER w || chr(10) || lead(body, 2) OVER w || chr(10) || lead(body, 3) OVER w AS four
    FROM numbered WINDOW w AS (PARTITION BY doc_id ORDER BY seq)
),
firsts AS (
    SELECT *, min(place) OVER (PARTITION BY body) AS first_line, min(place) OVER (PARTITION BY four) AS first_four FROM windowed
),
covered AS (
    SELECT *, (words >= 6 AND place > first_line)
        OR coalesce(bool_or(four IS NOT NULL AND place > first_four) OVER (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), false) AS gone
    FROM firsts
),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY seq), false) AS opens FROM covered),
kept AS (
    SELECT b.doc_id, count(r.seq) AS n_lines, count(*) FILTER (r.gone) AS n_removed, count(*) FILTER (r.opens) AS n_runs,
        coalesce(string_agg(b.raw, chr(10) ORDER BY b.line_no) FILTER (NOT coalesce(r.gone, false)), '') AS text
    FROM bare b LEFT JOIN runs r USING (doc_id, line_no) GROUP BY b.doc_id
)"""


def collocated(docs: str, least: int = 100, longest: int = 5, top: int = 2000) -> str:
    """Collocations of a relation: every phrase of every piece is written out and counted."""
    return f"""
WITH piece AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS body FROM {docs}
),
split AS (SELECT lang, list_filter(string_split_regex(body, '[ \\t]+'), lambda w: w <> '') AS ws FROM piece),
size AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM split GROUP BY lang),
spot AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM split),
span AS (SELECT lang, ws, i, unnest(range(1, {longest} + 1)) AS m FROM spot),
f AS (
    SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, m, count(*) AS a FROM span WHERE i + m - 1 <= len(ws)
    GROUP BY ALL HAVING count(*) >= {least}
),
candidate AS (SELECT * FROM f WHERE m >= 2),
held AS (
    SELECT c.lang, c.phrase FROM candidate c JOIN candidate d ON d.lang = c.lang AND d.m > c.m
        AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * d.a >= 100 * c.a
),
cut AS (SELECT c.*, string_split(c.phrase, ' ') AS ws, unnest(range(1, m)) AS k FROM candidate c ANTI JOIN held h ON h.lang = c.lang AND h.phrase = c.phrase),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, s.n, 1000::HUGEINT * c.a * s.n // (l.a::HUGEINT * r.a) AS score
    FROM cut c JOIN size s ON s.lang = c.lang
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(ws[1:k], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(ws[k + 1:], ' ')
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {top}
"""


SQL: dict[str, str] = {
    "op1_licenses": _licenses(),
    "op9_line_dedup": f"WITH {deduplicated('documents')} SELECT doc_id, coalesce(n_lines, 0) AS n_lines, "
    "coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs, sha256(kept.text) AS kept_sha256 FROM documents LEFT JOIN kept USING (doc_id)",
    "op13_collocations": collocated("documents"),
}
