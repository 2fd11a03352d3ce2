"""DuckDB SQL for the rows of the training-data queries that SQL can express, over the same tables."""

from __future__ import annotations

from . import quality, substrings

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

OP3 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source AS host, text, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '{WORD}') AS w FROM d),
gram AS (SELECT r, i, array_to_string(w[i : i + {quality.GRAM - 1}], chr(31)) AS g FROM (SELECT r, w, unnest(range(1, len(w) - {quality.GRAM - 2})) AS i FROM w WHERE len(w) >= {quality.GRAM})),
twice AS (SELECT r, unnest(range(i, i + {quality.GRAM})) AS j FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM gram) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM twice GROUP BY r),
line AS (SELECT r, doc_id, host, text, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
norm AS (SELECT *, regexp_matches(x, '{WORD}') AS has, lower(trim(regexp_replace(x, '{BLANKS}', ' ', 'g'), ' ')) AS k FROM line),
dup AS (SELECT r, count(*) - count(DISTINCT x) AS n_dup_lines FROM norm WHERE has GROUP BY r),
docs AS (SELECT host, count(*) AS docs FROM (SELECT DISTINCT host, doc_id, text FROM d WHERE text IS NOT NULL) GROUP BY host),
seen AS (SELECT host, k, count(*) AS n FROM (SELECT DISTINCT host, k, doc_id, text FROM norm WHERE has AND text IS NOT NULL) GROUP BY host, k),
often AS (SELECT s.host, s.k FROM seen s JOIN docs USING (host) WHERE n > {quality.MAX_DOCS} AND n > {quality.MAX_SHARE} * docs
    UNION ALL SELECT s.host, s.k FROM seen s, docs o WHERE s.host IS NULL AND o.host IS NULL AND n > {quality.MAX_DOCS} AND n > {quality.MAX_SHARE} * docs),
left_of AS (SELECT n.r, string_agg(x, chr(10) ORDER BY i) AS "left" FROM norm n LEFT JOIN often o ON n.host IS NOT DISTINCT FROM o.host AND n.k = o.k AND n.has WHERE o.k IS NULL GROUP BY n.r),
base AS (
    SELECT d.r, d.doc_id, len(w.w) AS n_words, length(regexp_replace(t, '{BLANKS}', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce("left", '') AS "left"
    FROM d JOIN w USING (r) LEFT JOIN repeated USING (r) LEFT JOIN dup USING (r) LEFT JOIN left_of USING (r)
),
judged AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words AS base_failed, len(regexp_extract_all("left", '{WORD}')) AS n_left FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND n_left >= {quality.MIN_LEFT} * n_words AND n_left >= {quality.MIN_WORDS} AS kept, n_words - n_left AS n_line_words, sha256("left") AS left_sha256
FROM judged
"""

OP4 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
word AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM d),
win AS (SELECT r, i, array_to_string(w[i : i + {substrings.SPAN - 1}], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - {substrings.SPAN - 2})) AS i FROM d WHERE len(w) >= {substrings.SPAN})),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY g) AS n FROM win) WHERE n > 1),
last AS (SELECT word.r, x, j, max(i) OVER (PARTITION BY word.r ORDER BY j) AS i FROM word LEFT JOIN again ON again.r = word.r AND again.i = word.j),
left_of AS (SELECT r, string_agg(x, ' ' ORDER BY j) AS kept, count(*) AS n FROM last WHERE i IS NULL OR j - i >= {substrings.SPAN} GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN left_of USING (r)
"""

OP5 = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, i, if(i = 0, 'user', 'assistant'), '</s>[INST] ok [/INST]' FROM range(2) x(i)
),
m AS (SELECT *, length(role || text) + length(regexp_replace(role || text, '[^\\\[<\n]', '', 'g')) + 1 + if(role = 'assistant', length('</s>'), length('[INST][/INST]')) AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(n)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""

OP6 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_of AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both_of JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least AS component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) x ON x.a = d.doc_id
"""

ORACLE_SQL = {"op3_line_frequency": OP3, "op4_repeated_phrases": OP4, "op5_chat_spans": OP5, "op6_jaccard_groups": OP6}
