"""The queries of checks.queries as DuckDB SQL over the same tables.

RE2 has no look-around and no back-references, so word edges are matched by
consuming the neighbouring character, twice where hits may touch.
"""

from __future__ import annotations

import string

from checks.queries import (
    CONFIG, INPUT_LIMIT, MADE_BLANKS, MADE_HTML, MADE_TEXT, NAME_PATTERNS, NOISY, SHARD_SIZE, SKIPPED,
)
from textsieve.config import STAGES
from textsieve.functions import code, pii
from textsieve.operators import language, toxicity

SPACES = r"\s\x0b\x1c-\x1f\x85\p{Z}"
SPACE = f"[{SPACES}]"
WORDS = r"\p{L}\p{N}_"
WORD = f"[{WORDS}]"
EDGE_BEFORE = f"(^|[^{WORDS}])"
EDGE_AFTER = f"([^{WORDS}]|$)"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replace_all(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {quote(pattern)}, {by}, 'g')"


def matches(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {quote(pattern)})"


def count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, {quote(pattern)}))"


# Column rules


def strip_control(text: str) -> str:
    return replace_all(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "' '")


def straight_quotes(text: str) -> str:
    return f"translate({text}, '“”‘’', '\"\"''''')"


def collapse_whitespace(text: str) -> str:
    return replace_all(replace_all(text, r"[ \t]+", "' '"), r"\n{2,}", "chr(10)")


def normalize(text: str) -> str:
    return collapse_whitespace(straight_quotes(strip_control(text)))


def tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[a-z'']+')"


def share(part: str, text: str) -> str:
    return f"CASE WHEN length({text}) > 0 THEN ({part}) / length({text}) ELSE 0.0 END"


def ascii_ratio(text: str) -> str:
    kept = replace_all(text, r"[^\x00-\x7F]", "''")
    return share(f"length({kept})", text)


def symbol_ratio(text: str) -> str:
    kept = replace_all(text, rf"[^\p{{L}}\p{{N}}{SPACES}]", "''")
    return share(f"length({text}) - length({kept})", text)


def long_repeat(text: str) -> str:
    return matches(text, "|".join(f"{letter}{{10}}" for letter in string.ascii_letters))


def preliminary(text: str) -> str:
    return f"""CASE WHEN length({text}) < {CONFIG.min_char_len} THEN 'too_short'
        WHEN length({text}) > {CONFIG.max_char_len} THEN 'too_long'
        WHEN {ascii_ratio(text)} < {CONFIG.min_ascii_ratio} THEN 'non_ascii_heavy'
        WHEN {symbol_ratio(text)} > {CONFIG.max_symbol_ratio} THEN 'symbol_heavy'
        WHEN {long_repeat(text)} THEN 'long_repeat' END"""


def function_def(text: str) -> str:
    return matches(text, rf"{EDGE_BEFORE}(def|function|const|let|var){SPACE}+{WORD}+{SPACE}*\(")


def method_calls(text: str) -> str:
    return count(text, rf"\.{WORD}+{SPACE}*\(")


def assignments(text: str) -> str:
    return count(text, rf"""(?m)^{SPACE}*{WORD}+{SPACE}*={SPACE}*[{WORDS}\[{{('"]""")


def fingerprint(text: str) -> str:
    return f"sha1(trim({replace_all(f'lower({text})', SPACE + '+', repr(' '))}))"


def mask(text: str, entity: str) -> str:
    return replace_all(text, pii.PATTERNS[entity][0], quote(f"<{entity}>"))


def mask_patterns(text: str) -> str:
    for entity in pii.PATTERNS:
        text = mask(text, entity)
    return text


def pronouns(text: str) -> str:
    for token, words in pii.PRONOUNS:
        forms = "|".join([*words, *(word.capitalize() for word in words)])
        for _ in range(2):
            text = replace_all(text, f"{EDGE_BEFORE}({forms}){EDGE_AFTER}", quote(rf"\1{token}\3"))
    return text


def line_cleanup(text: str) -> str:
    text = replace_all(replace_all(text, " {2,}", "' '"), r"\t+", "' '")
    trimmed = replace_all("x", f"^{SPACE}+|{SPACE}+$", "''")
    letters = matches("x", r"^\p{L}+$")
    lines = f"""list_filter(
        list_transform(string_split({text}, chr(10)), lambda x: {trimmed}), lambda x: length(x) > 2 OR {letters})"""
    # A line next to its like, by pairing each line with the one before.
    return f"""coalesce(array_to_string(list_transform(
        list_filter(list_zip({lines}, list_prepend(NULL, {lines})), lambda x: x[1] IS NOT NULL AND x[1] IS DISTINCT FROM x[2]),
        lambda x: x[1]), chr(10)), '')"""


def unescape(text: str) -> str:
    """The entities that occur in the pages, & last, so that nothing is decoded twice."""
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"')):
        text = f"replace({text}, '{entity}', '{char}')"
    return replace_all(text, "&amp;?", "'&'")


def page_text(text: str, scope: str) -> str:
    """The extraction rules for the tags and the one noisy class that occur in the pages."""
    if scope == "document":
        text = replace_all(text, '(?s)<div class="ad">.*', "''")
    for tag in ("script", "style", "nav", "footer", *SKIPPED, *NOISY):
        text = replace_all(text, rf"(?s)<{tag}( [^>]*)?>.*?(</{tag}>|\z)", "''")
    text = replace_all(text, "(?s)<input .*", "''")
    text = replace_all(text, '(?s)<div class="ad">.*?</div>', "chr(10)")
    text = replace_all(text, r"(?s)<!--.*?-->|<!DOCTYPE[^>]*>|<[a-zA-Z/][^>]*\z", "''")
    text = replace_all(text, r"\s*</?(html|head|meta|title|body|ul|br)( [^>]*)?>\s*", "''")
    text = replace_all(text, r"</?(a|b)( [^>]*)?>", "' '")
    text = replace_all(text, "<li>", "chr(10) || '• '")
    text = replace_all(text, r"</?(p|h1|h3|blockquote|article|li)( [^>]*)?>", "chr(10)")
    return unescape(text)


def extracted(text: str, scope: str) -> str:
    return f"CASE WHEN {is_html(text)} THEN {line_cleanup(page_text(text, scope))} END"


def is_html(text: str) -> str:
    return matches(text, "<[a-zA-Z][^>]*>")


def in_list(words: tuple[str, ...]) -> str:
    return ", ".join(quote(word) for word in words)


# Common table expressions

LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
STARTS = f"^{SPACE}*(" + "|".join(rf"\Q{start}\E" for start in code.LINE_STARTS) + ")"
ENDS = "(" + "|".join(rf"\Q{end}\E" for end in code.LINE_ENDS) + ")$"


def measured(source: str, words_of: str = "text") -> str:
    """CTEs ending in code_counts: the code rules' counts over source(id, text), tokens taken of words_of."""
    punctuation = replace_all("text", r"[^{}\[\]();=<>]", "''")
    pieces = f"list_filter(regexp_split_to_array(low, {quote(SPACE + '+')}), lambda x: x <> '')"
    pairs = " + ".join(
        f"least(length(marks) - length(replace(marks, '{a}', '')), length(marks) - length(replace(marks, '{b}', '')))"
        for a, b in ("()", "[]", "{}")
    )
    nonblank = matches("x", f"[^{SPACES}]")
    indented = matches("x", rf"^({SPACE}{{8}}|\t\t)")
    return f"""
    code_parts AS (
        SELECT id, text, lower(text) AS low, {tokens(words_of)} AS tokens, {punctuation} AS marks FROM {source}
    ),
    code_lists AS (
        SELECT *, list_filter(regexp_split_to_array(low, {quote(LINE_BREAK)}), lambda x: {nonblank}) AS line_list,
            CASE WHEN len(tokens) > 0 THEN tokens ELSE {pieces} END AS word_list
        FROM code_parts
    ),
    code_counts AS (
        SELECT id, ({function_def('text')} OR {method_calls('text')} >= 3 OR {assignments('text')} >= 4) AS strong_pattern,
            len(line_list) AS lines,
            len(list_filter(line_list, lambda x: {matches('x', STARTS)} OR {matches('x', ENDS)})) AS codey_lines,
            len(list_filter(line_list, lambda x: {indented})) AS indented_lines,
            length(marks) AS punctuation, {pairs} AS bracket_pairs, len(word_list) AS words,
            len(list_filter(word_list, lambda x: x IN ({in_list(code.STOPWORDS)}))) AS stopwords,
            len(list_filter(word_list, lambda x: x IN ({in_list(code.KEYWORDS)}))) AS keywords,
            greatest(length(text), 1) AS chars
        FROM code_lists
    )"""


CODE_REASON = """CASE WHEN strong_pattern OR (lines > 0 AND (
        codey_lines / lines > 0.4 OR (indented_lines / lines > 0.5 AND codey_lines / lines > 0.25)
        OR (words > 0 AND (
            (stopwords / words < 0.05 AND keywords >= 3 AND punctuation / chars > 0.15)
            OR (bracket_pairs / chars * 100 > 3.0 AND stopwords / words < 0.08)
            OR (keywords / words > 0.20 AND stopwords / words < 0.10)
            OR (words < 15 AND keywords >= 2 AND stopwords / words < 0.05 AND punctuation / chars > 0.12)
            OR (words >= 30 AND keywords >= 5 AND keywords / words > 0.15 AND stopwords / words < 0.10)
        )))) THEN 'code_snippet' END"""

DOCS = "docs AS (SELECT doc_id AS id, text FROM documents WHERE text <> '')"

PROFILE = f"""
    lang_words AS (SELECT lang, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS word FROM documents),
    known AS (SELECT lang, left(md5(word), {language.BUCKET_DIGITS}) AS bucket, count(*) AS n FROM lang_words GROUP BY ALL),
    vocabulary AS (SELECT DISTINCT bucket FROM known),
    priors AS (
        SELECT lang, CAST(round(ln(count(*) / (SELECT count(*) FROM documents)) * 1000) AS BIGINT) AS prior
        FROM documents GROUP BY lang
    ),
    totals AS (
        SELECT priors.lang, coalesce(sum(n), 0) + (SELECT count(*) FROM vocabulary) AS total
        FROM priors LEFT JOIN known USING (lang) GROUP BY priors.lang
    ),
    lang_weights AS (
        SELECT vocabulary.bucket, totals.lang,
            CAST(round(ln((coalesce(n, 0) + 1) / CAST(total AS DOUBLE)) * 1000) AS BIGINT) AS w
        FROM vocabulary CROSS JOIN totals
        LEFT JOIN known ON known.bucket = vocabulary.bucket AND known.lang = totals.lang
    )"""


def labels(source: str) -> str:
    """CTEs ending in lang_labels(id, lang) for source(id, text)."""
    return f"""
    text_words AS (SELECT id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS word FROM {source}),
    text_buckets AS (SELECT id, left(md5(word), {language.BUCKET_DIGITS}) AS bucket FROM text_words),
    lang_sums AS (SELECT id, lang, sum(w) AS s FROM text_buckets JOIN lang_weights USING (bucket) GROUP BY ALL),
    lang_ranked AS (
        SELECT t.id, p.lang, row_number() OVER (PARTITION BY t.id ORDER BY coalesce(s, 0) + prior DESC, p.lang) AS rank
        FROM {source} t CROSS JOIN priors p LEFT JOIN lang_sums s ON s.id = t.id AND s.lang = p.lang
    ),
    lang_labels AS (SELECT id, lang FROM lang_ranked WHERE rank = 1)"""


TOXIC_MODEL = f"""
    labelled AS (SELECT doc_id, text, toxic = 1 AS bad FROM documents JOIN labels USING (doc_id)),
    sizes AS (
        SELECT bad, good, bad / (bad + good) AS share FROM (
            SELECT CAST(count(*) FILTER (bad) AS DOUBLE) AS bad, CAST(count(*) FILTER (NOT bad) AS DOUBLE) AS good
            FROM labelled
        )
    ),
    toxic_words AS (
        SELECT word, count(*) FILTER (bad) AS bad_n, count(*) AS all_n FROM (
            SELECT DISTINCT doc_id, bad, unnest({tokens('text')}) AS word FROM labelled
        ) GROUP BY word
    ),
    toxic_weights AS (
        SELECT word, CAST(round(ln(
            ((bad_n + {toxicity.SMOOTHING}::DOUBLE * share) / bad)
            / ((all_n - bad_n + {toxicity.SMOOTHING}::DOUBLE * (1 - share)) / good)) * 1000) AS BIGINT) AS w
        FROM toxic_words, sizes
        WHERE CAST(round((bad_n - all_n * share) * (bad_n - all_n * share) / (all_n * share * (1 - share)) * 1000)
            AS BIGINT) >= {toxicity.LEAST_EVIDENCE} * 1000
    ),
    toxic_prior AS (SELECT CAST(round(ln(bad / good) * 1000) AS BIGINT) AS prior FROM sizes)"""


def scores(source: str) -> str:
    """CTEs ending in toxic_scores(id, toxicity) for source(id, text)."""
    return f"""
    text_tokens AS (SELECT DISTINCT id, unnest({tokens('text')}) AS word FROM {source}),
    toxic_sums AS (SELECT id, sum(w) AS w FROM text_tokens JOIN toxic_weights USING (word) GROUP BY id),
    toxic_scores AS (
        SELECT t.id, 1 / (1 + exp(-((coalesce(w, 0) + prior) / 1000.0::DOUBLE))) AS toxicity
        FROM {source} t LEFT JOIN toxic_sums s ON s.id = t.id, toxic_prior
    )"""


def chain(models: bool, pages: bool = False) -> str:
    """CTEs ending in rows: the default plan over documents, which hold no HTML and no entities, or pages."""
    docs, plain, extraction = DOCS, normalize("text"), "CAST(NULL AS VARCHAR)"
    if pages:
        docs = "docs AS (SELECT page_id AS id, html AS text FROM pages WHERE html <> '')"
        plain, extraction = normalize(unescape("text")), extracted("text", CONFIG.noise_scope)
    verdict = "CASE WHEN copy > 1 THEN 'duplicate' END"
    lang = "CAST(NULL AS VARCHAR)"
    joins = ""
    with_models = ""
    if models:
        verdict = f"""CASE WHEN copy > 1 THEN 'duplicate' WHEN l.lang <> 'en' THEN 'non_english'
            WHEN toxicity > {CONFIG.toxicity_threshold} THEN 'toxic_content' END"""
        lang = "CASE WHEN copy = 1 THEN l.lang END"
        joins = "LEFT JOIN lang_labels l ON l.id = c.id LEFT JOIN toxic_scores x ON x.id = c.id"
        with_models = f"{PROFILE}, {labels('living')}, {TOXIC_MODEL}, {scores('living')},"
    masked = pronouns(mask_patterns("text"))
    return f"""WITH {docs},
    plain AS (SELECT id, {plain} AS text FROM docs),
    judged AS (SELECT id, text, {preliminary('text')} AS reason FROM plain),
    pages_text AS (SELECT id, text AS before, {extraction} AS found FROM judged WHERE reason IS NULL),
    passed AS (
        SELECT id, before, coalesce(length(found) >= {CONFIG.min_char_len}, false) AS html_extracted,
            CASE WHEN length(found) >= {CONFIG.min_char_len} THEN found ELSE before END AS text
        FROM pages_text
    ),
    {measured('passed', 'before')},
    coded AS (SELECT id, {CODE_REASON} AS reason FROM code_counts),
    living AS (SELECT id, text FROM passed JOIN coded USING (id) WHERE coded.reason IS NULL),
    copies AS (
        SELECT id, row_number() OVER (PARTITION BY {fingerprint('text')} ORDER BY id) AS copy FROM living
    ),
    {with_models}
    late AS (SELECT c.id, {verdict} AS reason, {lang} AS lang FROM copies c {joins}),
    reasons AS (
        SELECT id, coalesce(passed.text, judged.text) AS text, coalesce(html_extracted, false) AS html_extracted,
            late.lang, coalesce(judged.reason, coded.reason, late.reason) AS omit_reason
        FROM judged LEFT JOIN passed USING (id) LEFT JOIN coded USING (id) LEFT JOIN late USING (id)
    ),
    outcome AS (
        SELECT id, text, html_extracted, lang, omit_reason, CASE WHEN omit_reason IS NULL THEN {masked} ELSE text END AS cleaned
        FROM reasons
    ),
    rows AS (
        SELECT o.id, docs.text AS original, lang, omit_reason,
            CASE WHEN omit_reason = 'code_snippet' THEN 5 WHEN omit_reason = 'duplicate' THEN 6
                WHEN omit_reason = 'non_english' THEN 7 WHEN omit_reason = 'toxic_content' THEN 8
                WHEN omit_reason IS NOT NULL THEN 3 END AS omit_stage,
            cleaned, omit_reason IS NULL AND cleaned <> o.text AS anonymized, html_extracted
        FROM outcome o JOIN docs USING (id)
    )"""


CHAIN = chain(models=True)


def columns(**made: str) -> str:
    return "SELECT doc_id, " + ", ".join(f"{sql} AS {name}" for name, sql in made.items()) + " FROM documents"


def where(condition: str) -> str:
    return f"SELECT doc_id FROM documents WHERE {condition}"


def code_query(select: str) -> str:
    return f"WITH {DOCS}, {measured('docs')} SELECT id AS doc_id, {select} FROM code_counts"


def _lines(limit: int | None = None) -> str:
    numbered = "SELECT row_number() OVER (ORDER BY doc_id) AS id, text AS original, source AS url FROM documents"
    if limit is None:
        return numbered
    # A whole line and its cut copy per document: the limit covers half as many documents.
    return f"SELECT id, original FROM ({numbered}) WHERE id <= {(limit + 1) // 2}"


def _entities(then: str = "") -> str:
    """CTEs found0, found1, … (r, entity, value, start, end) and, with all pattern matches blanked out, left(r, text).

    A match is overwritten by as many "<" as it has characters, so that places in what is left are those in the text.
    """
    parts, text = ["text0 AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents)"], "text0"
    for n, (entity, (pattern, _)) in enumerate(pii.PATTERNS.items()):
        parts.append(f"""cut{n} AS (
            SELECT r, string_split_regex(text, {quote(pattern)}) AS p, regexp_extract_all(text, {quote(pattern)}) AS v FROM {text}
        ), found{n} AS (
            SELECT r, '{entity}' AS entity, v[i] AS value,
                (list_sum(list_transform(p[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(v[1:i - 1], lambda x: len(x))), 0))::BIGINT AS start
            FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM cut{n})
        ), text{n + 1} AS (
            SELECT r, array_to_string(list_transform(range(1, len(p) + 1), lambda i: p[i] || coalesce(repeat('<', len(v[i])), '')), '') AS text
            FROM cut{n}
        )""")
        text = f"text{n + 1}"
    union = " UNION ALL ".join(f"SELECT * FROM found{n}" for n in range(len(pii.PATTERNS)))
    return f"WITH RECURSIVE {', '.join(parts)}, patterns AS ({union}) {then or _placed('patterns')}"


def _placed(found: str) -> str:
    return f'''SELECT doc_id, entity, value, start, start + len(value) AS "end" FROM {found} JOIN text0 USING (r)'''


NAMES = " UNION ".join(
    f"SELECT unnest(regexp_extract_all(text, {quote(pattern)})) AS phrase FROM conversations" for pattern in NAME_PATTERNS
)


def _entities_names() -> str:
    """Names one after the other, longest first, each overwritten before the next is looked for."""
    pattern = f"{quote(EDGE_BEFORE)} || phrase || {quote(EDGE_AFTER)}"
    once = f"regexp_replace(text, {pattern}, '\\1' || repeat('<', len(phrase)) || '\\2', 'g')"
    twice = f"regexp_replace({once}, {pattern}, '\\1' || repeat('<', len(phrase)) || '\\2', 'g')"
    last = f"text{len(pii.PATTERNS)}"
    return _entities(f""", names AS ({NAMES}), hits AS (
        SELECT r, phrase, row_number() OVER (PARTITION BY r ORDER BY len(phrase) DESC, phrase) AS k
        FROM text0 JOIN names ON contains(text, phrase)
    ), steps AS (
        SELECT r, 0 AS k, '' AS phrase, '' AS before, text FROM {last}
        UNION ALL
        SELECT r, hits.k, hits.phrase, text, {twice.replace('phrase', 'hits.phrase')} FROM steps JOIN hits USING (r) WHERE hits.k = steps.k + 1
    ), tries AS (
        SELECT r, phrase, before, text, string_split(before, phrase) AS p FROM steps WHERE text <> before
    ), places AS (
        SELECT *, (list_sum(list_transform(p[1:i], lambda x: len(x))) + (i - 1) * len(phrase))::BIGINT AS start
        FROM (SELECT *, unnest(range(1, len(p))) AS i FROM tries)
    ), found AS (
        SELECT * FROM patterns
        UNION ALL SELECT r, 'PERSON', phrase, start FROM places WHERE text[start + 1:start + len(phrase)] = repeat('<', len(phrase))
    ) {_placed('found')}""")


def _mask_person() -> str:
    pattern = f"{quote(EDGE_BEFORE)} || x || {quote(EDGE_AFTER)}"
    once = f"regexp_replace(masked, {pattern}, '\\1<PERSON>\\2', 'g')"
    twice = f"regexp_replace({once}, {pattern}, '\\1<PERSON>\\2', 'g')"
    return f"""WITH names AS ({NAMES}), hits AS (
        SELECT doc_id, list(phrase ORDER BY length(phrase) DESC, phrase) AS phrases
        FROM documents JOIN names ON contains(text, phrase) GROUP BY doc_id
    ), masked AS (
        SELECT doc_id, text AS original, CASE WHEN phrases IS NULL THEN text
            ELSE list_reduce(list_prepend(text, phrases), lambda masked, x: {twice}) END AS text
        FROM documents LEFT JOIN hits USING (doc_id)
    ) SELECT doc_id, text, text <> original AS named FROM masked"""


_OUTPUT = "SELECT id, lang, omit_reason, omit_stage, anonymized, cleaned FROM rows"
_KINDS = {entity: f"<{entity}>" for entity in pii.ENTITIES} | {"PRONOUN": "|".join(pii.PRONOUN_TOKENS)}
_FINGERPRINTS = f"WITH prints AS (SELECT doc_id, {fingerprint('text')} AS fingerprint FROM documents)"
_COPIES = "row_number() OVER (PARTITION BY fingerprint ORDER BY doc_id)"
_LANG_LABELS = f"WITH {DOCS}, {PROFILE}, {labels('docs')}"
_TOXIC_SCORES = f"WITH {DOCS}, {TOXIC_MODEL}, {scores('docs')}"
_STAGES = ", ".join(f"({number}, '{name}')" for number, name in enumerate(STAGES, 1))
_SHARDS = f"(row_number() OVER (ORDER BY id) - 1) // {SHARD_SIZE} AS shard"

ORACLE: dict[str, str] = {
    "scan_documents": "SELECT doc_id AS id, text AS original FROM documents WHERE text <> ''",
    "read_lines": _lines(),
    "nonblank_text": where("text IS NOT NULL AND text <> ''"),
    "input_limit": f"SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT {INPUT_LIMIT}",
    "input_limit_lines": _lines(INPUT_LIMIT),
    "assign_ids": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS id FROM documents",
    "strip_control": columns(text=strip_control("text")),
    "straight_quotes": columns(text=straight_quotes("text")),
    "collapse_whitespace": columns(text=collapse_whitespace("text")),
    "normalize": columns(text=normalize("text")),
    "tokenize": columns(tokens=f"coalesce(array_to_string({tokens('text')}, ' '), '')"),
    "text_attributes": columns(
        char_count="length(text)",
        token_count=f"len({tokens('text')})",
        ascii_ratio=ascii_ratio("text"),
        symbol_ratio=symbol_ratio("text"),
    ),
    "filter_too_short": where(f"length(text) < {CONFIG.min_char_len}"),
    "filter_too_long": where(f"length(text) > {CONFIG.max_char_len}"),
    "filter_non_ascii": where(f"{ascii_ratio('text')} < {CONFIG.min_ascii_ratio}"),
    "filter_symbol_heavy": where(f"{symbol_ratio('text')} > {CONFIG.max_symbol_ratio}"),
    "filter_long_repeat": where(long_repeat("text")),
    "preliminary_reason": columns(omit_reason=preliminary("text")),
    "html_unescape": f"SELECT page_id, {unescape('html')} AS html FROM pages",
    "html_extract": f"SELECT page_id, {extracted('html', 'document')} AS extracted FROM pages",
    "html_extract_element": f"SELECT page_id, {extracted('html', 'element')} AS extracted FROM pages",
    "html_accept": f"""SELECT page_id, length(extracted) >= {CONFIG.min_char_len} AS html_extracted,
        CASE WHEN length(extracted) >= {CONFIG.min_char_len} THEN length(extracted) END AS chars
        FROM (SELECT page_id, {extracted('html', 'element')} AS extracted FROM pages)""",
    "prepared_pages": f"""{chain(models=False, pages=True)}
        SELECT id, omit_reason, html_extracted, anonymized, cleaned FROM rows""",
    "is_html": f"""SELECT id, kind, {is_html('text')} AS is_html FROM (
        SELECT page_id AS id, 'page' AS kind, html AS text FROM pages
        UNION ALL SELECT doc_id, 'document', text FROM documents)""",
    "line_cleanup": columns(text=line_cleanup("text")),
    "code_function_def": where(function_def("text")),
    "code_method_calls": columns(method_calls=method_calls("text")),
    "code_assignments": columns(assignments=assignments("text")),
    "code_line_features": code_query("lines, codey_lines, indented_lines"),
    "code_char_features": code_query(
        "punctuation / chars AS punctuation_ratio, bracket_pairs / chars * 100 AS bracket_density"
    ),
    "code_token_features": code_query("words, stopwords, keywords"),
    "code_reason": code_query(f"{CODE_REASON} AS omit_reason"),
    "fingerprint": columns(fingerprint=fingerprint("text")),
    "dedup_keep": f"{_FINGERPRINTS} SELECT doc_id FROM prints QUALIFY {_COPIES} = 1",
    "dedup_mark": f"{_FINGERPRINTS} SELECT doc_id, {_COPIES} > 1 AS duplicate FROM prints",
    "dedup_groups": f"{_FINGERPRINTS} SELECT fingerprint, count(*) AS copies FROM prints GROUP BY fingerprint",
    "stream_dedup": f"{_FINGERPRINTS} SELECT doc_id, {_COPIES} > 1 AS duplicate FROM prints",
    "language_profile": f"""WITH {PROFILE} SELECT bucket, {', '.join(
        f"max(w) FILTER (lang = '{lang}') AS weight_{lang}" for lang in ('de', 'en', 'es', 'fr')
    )} FROM lang_weights GROUP BY bucket""",
    "detect_language": f"{_LANG_LABELS} SELECT id AS doc_id, lang FROM lang_labels",
    "filter_language": f"{_LANG_LABELS} SELECT id AS doc_id, lang FROM lang_labels WHERE lang <> 'en'",
    "language_bypass": """SELECT doc_id AS id, CAST(NULL AS VARCHAR) AS lang,
        CAST(NULL AS VARCHAR) AS omit_reason FROM documents WHERE text <> ''""",
    "toxicity_weights": f"WITH {TOXIC_MODEL} SELECT word, w FROM toxic_weights",
    "toxicity_score": f"{_TOXIC_SCORES} SELECT id AS doc_id, round(toxicity, 6) AS toxicity FROM toxic_scores",
    "filter_toxicity": f"""{_TOXIC_SCORES} SELECT id AS doc_id FROM toxic_scores
        WHERE toxicity > {CONFIG.toxicity_threshold}""",
    "mask_email": columns(text=mask("text", "EMAIL_ADDRESS")),
    "mask_ip": columns(text=mask("text", "IP_ADDRESS")),
    "mask_phone": columns(text=mask("text", "PHONE_NUMBER")),
    "mask_patterns": columns(text=mask_patterns("text")),
    "mask_person": _mask_person(),
    "mask_location": """SELECT c_custkey, c_name || ' of <LOCATION>, <LOCATION>.' AS text, true AS named
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "pii_entities": _entities(),
    "pii_entities_names": _entities_names(),
    "neutralize_pronouns": columns(text=pronouns("text")),
    "conversation_pronouns": f"SELECT conv_id, turn, {pronouns('text')} AS text FROM conversations",
    "anonymized_flag": columns(anonymized=f"{pronouns(mask_patterns('text'))} <> text"),
    "native_chain": f"{chain(models=False)} SELECT id, omit_reason, omit_stage, anonymized, cleaned FROM rows",
    "whole_chain": f"{CHAIN} {_OUTPUT}",
    "stream_chain": f"{CHAIN} {_OUTPUT}",
    "custom_steps": """WITH counted AS (
        SELECT doc_id AS id, text, len(regexp_extract_all(text, '[aeiou]')) AS vowels FROM documents WHERE text <> ''
    ), judged AS (
        SELECT *, CASE WHEN vowels < 100 THEN 'few_vowels' WHEN contains(text, '!!') THEN 'shouting' END AS omit_reason
        FROM counted
    ) SELECT id, vowels, omit_reason,
        CASE omit_reason WHEN 'few_vowels' THEN 2 WHEN 'shouting' THEN 3 END AS omit_stage,
        CASE WHEN omit_reason IS NULL THEN '> ' || text ELSE text END AS cleaned FROM judged""",
    "cleaned_output": f"""{CHAIN} SELECT id, cleaned, anonymized, html_extracted FROM rows
        WHERE omit_reason IS NULL""",
    "omitted_output": f"""{CHAIN} SELECT id, omit_reason AS reason, lang, original FROM rows
        WHERE omit_reason IS NOT NULL""",
    "reread_outputs": f"""{CHAIN} SELECT id, omit_reason AS reason,
        CASE WHEN omit_reason IS NOT NULL THEN lang END AS lang,
        CASE WHEN omit_reason IS NULL THEN cleaned ELSE original END AS text FROM rows""",
    "route_counts": f"""{CHAIN} SELECT CASE WHEN omit_reason IS NULL THEN 'kept' ELSE 'omitted' END AS route,
        count(*) AS n FROM rows GROUP BY 1""",
    "shard_assignment": f"{CHAIN} SELECT id, {_SHARDS} FROM rows WHERE omit_reason IS NULL",
    "written_shards": f"""{CHAIN} SELECT id, cleaned, anonymized, html_extracted, {_SHARDS} FROM rows
        WHERE omit_reason IS NULL""",
    "insight_counts": f"""{CHAIN} SELECT omit_reason, count(*) AS n FROM rows
        WHERE omit_reason IS NOT NULL GROUP BY 1""",
    "omit_reason_counts": f"""{CHAIN} SELECT omit_reason, count(*) AS n FROM rows
        WHERE omit_reason IS NOT NULL GROUP BY 1""",
    "omit_reason_share": f"""{CHAIN} SELECT omit_reason, count(*) AS n,
        round(count(*) / sum(count(*)) OVER () * 100, 6) AS percent
        FROM rows WHERE omit_reason IS NOT NULL GROUP BY 1""",
    "stage_funnel": f"""{CHAIN}, stages(stage, name) AS (VALUES {_STAGES}), funnel AS (
        SELECT stage, name, count(*) FILTER (omit_stage IS NULL OR omit_stage >= stage) AS rows_in,
            count(*) FILTER (omit_stage = stage) AS omits
        FROM stages CROSS JOIN rows GROUP BY ALL
    ) SELECT *, round(CASE WHEN rows_in > 0 THEN omits * 100.0 / rows_in ELSE 0 END, 6) AS omit_percent FROM funnel""",
    "step_measures": f"""{CHAIN}, stages(stage, name) AS (VALUES {_STAGES})
        SELECT stage, name, count(*) FILTER (omit_stage IS NULL OR omit_stage >= stage) AS rows_in,
            count(*) FILTER (omit_stage = stage) AS omits, true AS timed
        FROM stages CROSS JOIN rows GROUP BY ALL""",
    "insight_times": f"""{CHAIN}, stages(stage, name) AS (VALUES {_STAGES})
        SELECT name, count(*) FILTER (omit_stage IS NULL OR omit_stage >= stage) AS number_of_calls, true AS timed
        FROM stages CROSS JOIN rows GROUP BY ALL""",
    "measured_chain": f"{CHAIN} {_OUTPUT}",
    "insight_document": f"""{CHAIN}, stages(stage, name) AS (VALUES {_STAGES}), funnel AS (
        SELECT stage, name, count(*) FILTER (omit_stage IS NULL OR omit_stage >= stage) AS calls,
            count(*) FILTER (omit_stage = stage) AS omits
        FROM stages CROSS JOIN rows GROUP BY ALL
    ), omitted AS (SELECT omit_reason, count(*) AS n FROM rows WHERE omit_reason IS NOT NULL GROUP BY 1)
    SELECT '{{"omit_reasons":{{' || (SELECT string_agg('"' || omit_reason || '":' || n, ',' ORDER BY omit_reason) FROM omitted)
        || '}},"steps":{{' || (SELECT string_agg('"' || name || '":{{"number_of_calls":' || calls || ',"number_of_omits":' || omits
            || ',"omit_percentage":' || CASE WHEN calls > 0 THEN omits::DOUBLE * 100.0 / calls ELSE 0.0::DOUBLE END::VARCHAR || '}}',
            ',' ORDER BY stage) FROM funnel) || '}}}}' AS insights""",
    "insight_steps": f"""{CHAIN}, stages(stage, name) AS (VALUES {_STAGES}), funnel AS (
        SELECT stage, name, count(*) FILTER (omit_stage IS NULL OR omit_stage >= stage) AS number_of_calls,
            count(*) FILTER (omit_stage = stage) AS number_of_omits
        FROM stages CROSS JOIN rows GROUP BY ALL
    ) SELECT name, number_of_calls, number_of_omits, round(CASE WHEN number_of_calls > 0
        THEN number_of_omits * 100.0 / number_of_calls ELSE 0 END, 6) AS omit_percentage FROM funnel""",
    "length_series": f"""{CHAIN} SELECT id, 'original' AS series, length(original) AS length FROM rows
        UNION ALL SELECT id, 'cleaned', length(cleaned) FROM rows WHERE omit_reason IS NULL
        UNION ALL SELECT id, 'omitted', length(original) FROM rows WHERE omit_reason IS NOT NULL""",
    "length_histogram": f"""{CHAIN}, lengths AS (
        SELECT 'original' AS series, length(original) AS n FROM rows
        UNION ALL SELECT 'cleaned', length(cleaned) FROM rows WHERE omit_reason IS NULL
    ), bounds AS (SELECT series, min(n) AS low, max(n) AS high, count(*) AS total FROM lengths GROUP BY series),
    bins AS (
        SELECT series, low, total, least((n - low) // 10, greatest(CAST(ceil((high - low) / 10) AS BIGINT) - 1, 0)) AS bin
        FROM lengths JOIN bounds USING (series)
    ) SELECT series, bin, low + bin * 10 AS start, count(*) AS n, round(count(*) / (total * 10), 9) AS density
        FROM bins GROUP BY series, bin, low, total""",
    "kept_flag_shares": f"""{CHAIN} SELECT count(*) AS kept,
        round(avg(CAST(html_extracted AS DOUBLE)) * 100, 6) AS html_extracted_percent,
        round(avg(CAST(anonymized AS DOUBLE)) * 100, 6) AS anonymized_percent FROM rows WHERE omit_reason IS NULL""",
    "redaction_counts": f"{CHAIN} " + " UNION ALL ".join(
        f"""SELECT '{kind}' AS kind, CAST(coalesce(sum({count('cleaned', pattern)}), 0) AS BIGINT) AS n
        FROM rows WHERE omit_reason IS NULL AND anonymized"""
        for kind, pattern in _KINDS.items()
    ),
    "selection_rate": f"{CHAIN} SELECT round(avg(CAST(omit_reason IS NULL AS DOUBLE)), 9) AS selection_rate FROM rows",
}

_MADE = f"FROM (SELECT doc_id, text FROM (SELECT doc_id, {MADE_TEXT} AS text FROM documents) WHERE text <> '') made"
ORACLE |= {
    f"made_{name}": ORACLE[name].replace("FROM documents", _MADE)
    for name in (
        "strip_control", "straight_quotes", "normalize", "filter_non_ascii", "filter_long_repeat",
        "preliminary_reason", "code_function_def", "code_method_calls", "code_assignments", "code_line_features",
        "code_char_features", "code_token_features", "code_reason",
    )
}

ORACLE |= {
    "made_nonblank_text": f"SELECT doc_id FROM (SELECT doc_id, {MADE_BLANKS} AS text FROM documents) WHERE text <> ''",
    "made_pages": f"""WITH made AS (SELECT page_id, {MADE_HTML} AS html FROM pages), walked AS (
        SELECT page_id, html, CASE WHEN page_id % 6 <> 3 THEN {extracted('html', 'element')} END AS found FROM made
    ) SELECT page_id, CASE WHEN length(found) >= {CONFIG.min_char_len} THEN found ELSE html END AS text,
        coalesce(length(found) >= {CONFIG.min_char_len}, false) AS html_extracted FROM walked""",
}

_RULES = """indented_lines / greatest(lines, 1) > 0.5 AND codey_lines / greatest(lines, 1) > 0.25 AS c6,
    stopwords / greatest(words, 1) < 0.05 AND keywords >= 3 AND punctuation / chars > 0.15 AS c10,
    words < 15 AND keywords >= 2 AND stopwords / greatest(words, 1) < 0.05 AND punctuation / chars > 0.12 AS c13"""
ORACLE["made_code_rules"] = code_query(_RULES).replace("FROM documents", _MADE)
