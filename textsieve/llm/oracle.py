"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

import string

from textsieve.llm import lexical, licenses, resample

ORACLE: dict[str, str] = {}

ORACLE["op3_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), p AS (
  SELECT doc_id, generate_subscripts(words, 1) AS i, words FROM w
), g AS (
  SELECT doc_id, i, [words[i], words[i + 1], words[i + 2]] AS g FROM p WHERE i + 2 <= len(words)
), r AS (
  SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), c AS (
  SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n_repeat_words FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), l AS (
  SELECT doc_id, host, text, unnest(lines) AS line FROM w
), n AS (
  SELECT doc_id, host, text, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS line,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS k
  FROM l
), f AS (
  SELECT host, line FROM n GROUP BY host, line
  HAVING count(DISTINCT doc_id) > 10 AND count(DISTINCT text) > 1
), s AS (
  SELECT doc_id, sum(k) AS k FROM n JOIN f USING (host, line) GROUP BY doc_id
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         (len(words) - coalesce(k, 0))::BIGINT AS words_left
  FROM w LEFT JOIN c USING (doc_id) LEFT JOIN s USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * words_left >= 30 * n_words AS kept
FROM m
"""

ORACLE["op2_line_dedup"] = r"""
WITH d AS (
  SELECT doc_id, text, CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS lines FROM documents
), a AS (
  SELECT doc_id, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM d
), w AS (
  SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM a WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), r AS (
  SELECT doc_id, k, 1 AS lines, [line] AS run FROM w WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 20
  UNION ALL
  SELECT x.doc_id, x.k, 3, [x.line, y.line, z.line]
  FROM w x JOIN w y ON y.doc_id = x.doc_id AND y.k = x.k + 1 JOIN w z ON z.doc_id = x.doc_id AND z.k = x.k + 2
), l AS (
  SELECT doc_id, k, lines FROM r QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, k) > 1
), x AS (
  SELECT DISTINCT doc_id, k + unnest(range(lines)) AS k FROM l
), t AS (
  SELECT a.doc_id, count(x.k) AS n_removed,
         string_agg(a.line, chr(10) ORDER BY a.i) FILTER (WHERE x.k IS NULL) AS kept
  FROM a LEFT JOIN w USING (doc_id, i) LEFT JOIN x ON x.doc_id = a.doc_id AND x.k = w.k
  GROUP BY a.doc_id
)
SELECT doc_id, len(lines)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN n_removed > 0 THEN coalesce(kept, '') ELSE text END AS text
FROM d LEFT JOIN t USING (doc_id)
"""


def _list(words: str) -> str:
    return "[" + ", ".join(f"'{word}'" for word in words.split()) + "]"


def _offset(template: str, key: str) -> int:
    parts, own = template.split(), key.split()
    return next(i for i in range(len(parts)) if parts[i : i + len(own)] == own)


_PHRASES = ", ".join(f"({_list(phrase)}, '{label}')" for phrase, label in licenses.PHRASES.items())
_TEMPLATES = ", ".join(
    f"('{label}', {_list(template)}, {_list(key)}, {_offset(template, key)})" for label, template, key in licenses.TEMPLATES
)

ORACLE["op4_license_scan"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{licenses.WORD}') AS words
  FROM documents
), w AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i FROM d
), p(phrase, label) AS (VALUES {_PHRASES}
), places AS (
  SELECT w.r, i, label FROM w JOIN p ON word = phrase[1] JOIN d ON d.r = w.r
  WHERE words[i + 1 : i + len(phrase)] = phrase
), t(label, template, key, o) AS (VALUES {_TEMPLATES}
), found AS (
  SELECT w.r, label, list_sum(list_transform(range(1, len(template) + 1),
           lambda j: CASE WHEN i - o + j > 0 AND words[i - o + j] = template[j] THEN 1 ELSE 0 END)) / len(template)::DOUBLE AS share
  FROM w JOIN t ON word = key[1] JOIN d ON d.r = w.r WHERE words[i + 1 : i + len(key)] = key
), b AS (
  SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM places GROUP BY r
), l AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS share FROM (
    SELECT r, label, NULL AS share FROM places
    UNION ALL SELECT r, label, share FROM found WHERE share >= {licenses.LEAST_SHARE}
  ) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0) END::DOUBLE AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN l USING (r)
"""

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

ORACLE["op11_lexical_search"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{lexical.TERM}') AS terms FROM documents
), g AS (
  SELECT count(*) AS docs, sum(len(terms))::BIGINT AS terms FROM d WHERE len(terms) > 0
), q AS (
  SELECT q, item_id, unnest(list_distinct(terms)) AS term
  FROM (SELECT row_number() OVER () AS q, item_id, regexp_extract_all({_LOWER}, '{lexical.TERM}') AS terms FROM benchmark)
), p AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, n, term
), w AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, g GROUP BY term
), s AS (
  SELECT q, item_id, r, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // g.terms))))::BIGINT AS score
  FROM p JOIN w USING (term) JOIN q USING (term), g GROUP BY q, item_id, r, doc_id
), k AS (
  SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0
)
SELECT * FROM k WHERE rank <= 10
"""

# One step of CRC-32 for each value of a byte, then one per byte of a word.
_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_BYTES = "list_transform(range(strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::BIGINT, 2))::BIGINT)"

ORACLE["op12_importance_resampling"] = rf"""
WITH b AS (
  SELECT list(list_reduce([v::BIGINT] || range(8), lambda c, x: {_STEP}) ORDER BY v) AS t FROM range(256) AS r(v)
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{resample.WORD}') AS words FROM documents
), e AS (
  SELECT unnest(regexp_extract_all({_LOWER}, '{resample.WORD}')) AS word FROM benchmark
), f AS (
  SELECT r, unnest(words) AS word FROM d
), v AS (
  SELECT word, xor(list_reduce([4294967295] || {_BYTES}, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT word FROM f UNION SELECT word FROM e), b
), s AS (
  SELECT bucket, count(*) AS s FROM f JOIN v USING (word) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS t FROM e JOIN v USING (word) GROUP BY bucket
), g AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM f) + 10000))
                                 / ((s + 1)::DOUBLE * ((SELECT count(*) FROM e) + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)
), w AS (
  SELECT r, sum(gain) AS weight FROM f JOIN v USING (word) JOIN g USING (bucket) GROUP BY r
), c AS (
  SELECT r, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                       / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN w USING (r)
), k AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM c WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM k) THEN rank END::BIGINT AS rank
FROM c LEFT JOIN k USING (r)
"""
