"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from trendloom.llm.licenses import CONTAINMENT, PHRASES, TEMPLATES

# Escapes of op3, outermost last: the backslash, then the four control strings.
_ESCAPED = r"replace(replace(replace(replace(replace({0}, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')"

OP3 = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked AS (
    SELECT *, role IS NOT DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS same FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (7 + sum(7 + length({_ESCAPED.format("text")}) + CASE WHEN same THEN 0 ELSE 6 + length({_ESCAPED.format("role")}) END))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

_RULES = {
    "symbol_share": ("n_symbols / greatest(word_chars, 1)", (0.5, 0.3, 0.2, 0.15, 0.1, 0.05, 0.03, 0.02)),
    "upper_share": ("n_upper / greatest(n_letters, 1)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3)),
    "dup_line_share": ("n_dup_lines / greatest(n_lines, 1)", (0.8, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "repeat_share": ("n_repeat_words / greatest(n_words, 1)", (0.5, 0.4, 0.3, 0.2, 0.1)),
    "word_length": ("word_chars / greatest(n_words, 1)", (30.0, 20.0, 15.0, 12.0, 10.0)),
}
_TESTS = ", ".join(f"('{rule}', {step}, {cut}::DOUBLE)" for rule, (_, cuts) in _RULES.items() for step, cut in enumerate(cuts))

# The binomial sum is taken with log-gamma here, by recurrence in the query.
OP7 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT rid, doc_id, lang, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs
), grams AS (
    SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
    FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), repeated AS (
    SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), covered AS (
    SELECT rid, count(DISTINCT i + d) AS n FROM repeated, (VALUES (0), (1), (2)) AS v(d) GROUP BY rid
), base AS (
    SELECT rid, doc_id, lang, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
           length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g')) AS n_letters,
           len(lines) AS n_lines, len(lines) - list_unique(lines) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
    FROM split LEFT JOIN covered USING (rid)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
), measured AS (
    SELECT j.*, rule, value FROM judged j, LATERAL (VALUES {", ".join(f"('{r}', {e})" for r, (e, _) in _RULES.items())}) AS v(rule, value)
), good AS (
    SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1
), holdout AS (
    SELECT lang, rule, value FROM measured SEMI JOIN good USING (doc_id) WHERE NOT base_failed
), counts AS (
    SELECT lang, rule, step, cut, count(*) AS n, count(*) FILTER (value > cut) AS k
    FROM holdout JOIN (VALUES {_TESTS}) AS t(rule, step, cut) USING (rule) GROUP BY ALL
), tested AS (
    SELECT *, k <= n * 0.01 AND list_sum(list_transform(range(0, k + 1), lambda j:
               exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.01::DOUBLE) + (n - j) * ln(0.99::DOUBLE))))
           <= 0.05 / ((SELECT count(DISTINCT coalesce('lang ' || lang, 'no lang')) FROM holdout) * {len(_RULES)}) AS passed FROM counts
), chosen AS (
    SELECT lang, rule, min(cut) AS cut FROM (
        SELECT *, bool_and(passed) OVER (PARTITION BY lang, rule ORDER BY step) AS usable FROM tested) WHERE usable GROUP BY ALL
), rejected AS (
    SELECT DISTINCT rid FROM measured m JOIN chosen c ON m.lang IS NOT DISTINCT FROM c.lang AND m.rule = c.rule WHERE value > cut
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rid NOT IN (SELECT rid FROM rejected) AS kept
FROM judged
"""

_PHRASES = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES.items())
_TEMPLATES = ", ".join(f"({i}, '{label}', list_distinct(string_split('{text}', ' ')))" for i, (label, text) in enumerate(TEMPLATES))

# Every line against every template, without any filter.
OP8 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), split AS (
    SELECT rid, doc_id, text, list_filter(regexp_split_to_array(text, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM docs
), phrases AS (
    SELECT string_split(phrase, ' ') AS phrase, label, k FROM (VALUES {_PHRASES}) AS p(phrase, label, k)
), places AS (
    SELECT rid, label, i - 1 AS start FROM (SELECT rid, words, label, phrase, k, unnest(range(1, len(words) + 1)) AS i FROM split, phrases)
    WHERE words[i] = phrase[1] AND words[i : i + k - 1] = phrase
), base AS (
    SELECT rid, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list(DISTINCT label) AS found FROM places GROUP BY rid
), lines AS (
    SELECT rid, list_distinct(regexp_split_to_array(unnest(string_split(text, chr(10))), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS tokens FROM split
), templates AS (
    SELECT * FROM (VALUES {_TEMPLATES}) AS t(template, label, tokens)
), matches AS (
    SELECT rid, label, len(list_intersect(l.tokens, t.tokens)) / len(t.tokens) AS containment FROM lines l, templates t
    WHERE len(list_intersect(l.tokens, t.tokens)) >= ceil(len(t.tokens) * {CONTAINMENT} - 1e-9)
), best AS (
    SELECT rid, list(DISTINCT label) AS found, max(containment) AS best FROM matches GROUP BY rid
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(b.found), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.found, []), coalesce(m.found, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM split LEFT JOIN base b USING (rid) LEFT JOIN best m USING (rid)
"""

OP12 = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM docs),
keyed AS (
    SELECT r, doc_id, line, i, translate(
        trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
    ) AS k FROM lines
),
shared AS (SELECT k AS shared_key FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(shared_key) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE shared_key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN shared ON k = shared_key GROUP BY r, doc_id
"""
