"""SQL for DuckDB with the same results as the registered queries.

Written from the rules, not from the Spark code: other functions, another
regex dialect, recursion instead of a fold.
"""

from docsheaf import constants as C


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# regex class of the whitespace set, and the set itself, in RE2 and SQL form
_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# fixed values are spelled out here, so that a wrong one in the library shows
_SPACES = [
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199,
    8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288,
]
_WS_CHARS = "||".join(f"chr({code})" for code in _SPACES)
_LF = "chr(10)"


def _swap(text: str, *pairs) -> str:
    for old, new in pairs:
        text = f"replace({text}, {_lit(old)}, {_lit(new)})"
    return text


def _dirty(key: str, text: str) -> str:
    kinds = [
        text,
        f"{text} || {_lit(chr(10) * 4 + 'Accept all cookies to continue' + chr(10) + 'Tail line.')}",
        "'“' || "
        + _swap(text, (", ", " – "), ("e ", "e’ "), ("a ", "‘a — "))
        + " || '”'",
        _swap(text, ("\n", "\r\n"), (". ", ".\r")),
        _swap(text, ("\n", "  \n"), (". ", ".\n \n\t\n")) + " || " + _lit("\n \n \nEnd. "),
        _swap(text, ("\n", "\n\n")),
        "'﻿' || " + _swap(text, (", ", ", "), ("e", "e​")),
        _swap(text, ("é", "é")) + " || " + _lit("\ncafé\nSHARE THIS ARTICLE now"),
    ]
    cases = " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(kinds))
    return f"CASE {key} % 8 {cases} END"


_DOCS = "docs AS (SELECT doc_id AS doc_seq, source, 'file_txt' AS source_type, text AS raw_text FROM documents)"
_DIRTY = (
    "docs AS (SELECT doc_id AS doc_seq, source, 'file_txt' AS source_type, "
    f"{_dirty('doc_id', 'text')} AS raw_text FROM documents)"
)


# --- cleaning ------------------------------------------------------------------------------

_PATTERNS = "|".join(
    p.replace("_", _WS)
    for p in (
        r"accept(ing)? (all )?cookies", r"subscribe to (our )?newsletter",
        r"sign up for (our )?(free )?newsletter", r"©_*\p{Nd}{4}.*all rights reserved",
        r"privacy policy_*[|·]_*terms", r"share (this )?(article|post|page)", r"follow us on",
        r"advertisement", r"skip to (main )?(content|navigation)", r"read (also|more)[:\-]",
    )
)


def _replace(x: str) -> str:
    return _swap(
        x, ("‘", "'"), ("’", "'"), ("“", '"'), ("”", '"'), ("–", "-"),
        ("—", "--"), (" ", " "), ("​", ""), ("﻿", ""), ("\r\n", "\n"), ("\r", "\n"),
    )


def _boilerplate(x: str) -> str:
    return (
        f"array_to_string(list_filter(string_split({x}, {_LF}), "
        f"lambda l: NOT regexp_matches(l, {_lit('(?i)' + _PATTERNS)})), {_LF})"
    )


def _newlines(x: str) -> str:
    return f"regexp_replace({x}, '\\n{{3,}}', {_LF} || {_LF}, 'g')"


def _trim(x: str) -> str:
    lines = f"list_transform(string_split({x}, {_LF}), lambda l: rtrim(l, {_WS_CHARS}))"
    return f"trim(array_to_string({lines}, {_LF}), {_WS_CHARS})"


def _clean(x: str) -> str:
    return _trim(_newlines(_boilerplate(_replace(f"nfc_normalize({x})"))))


def _words(x: str) -> str:
    return f"len(list_filter(string_split_regex({x}, {_lit(_WS + '+')}), lambda w: w <> ''))"


def _tokens(x: str) -> str:
    return f"CAST(floor({_words(x)} * CAST(1.33 AS DOUBLE)) AS BIGINT)"


def _paragraphs(x: str) -> str:
    return (
        f"list_filter(list_transform(string_split_regex({x}, '\\n\\n+'), "
        f"lambda p: trim(p, {_WS_CHARS})), lambda p: p <> '')"
    )


def _sentences(x: str) -> str:
    # no look-behind in RE2: mark the cuts, then split on the mark
    return f"string_split(regexp_replace({x}, {_lit('([.!?])' + _WS + '+')}, '\\1' || chr(1), 'g'), chr(1))"


def _per_document(expression: str) -> str:
    return f"WITH {_DIRTY} SELECT doc_seq, {expression} AS text FROM docs"


# --- chunking --------------------------------------------------------------------------------


def _chunk_ctes(docs: str, max_tokens: int, text: str = "raw_text") -> str:
    """CTEs up to ``chunks(doc_seq, source, source_type, chunk_index, total_chunks, text)``.

    ``walk`` visits the units of all documents one step at a time.
    """
    return f"""
    {docs},
    cleaned AS MATERIALIZED (SELECT * EXCLUDE (raw_text), {_clean(text)} AS txt FROM docs),
    listed AS (SELECT doc_seq, {_paragraphs('txt')} AS ps FROM cleaned),
    paras AS MATERIALIZED (
        SELECT doc_seq, p_no, ps[p_no] AS p, {_tokens('ps[p_no]')} AS p_tok
        FROM (SELECT doc_seq, ps, unnest(range(1, len(ps) + 1)) AS p_no FROM listed)),
    parts AS (
        SELECT doc_seq, p_no, p_tok > {max_tokens} AS long,
               CASE WHEN p_tok > {max_tokens} THEN {_sentences('p')} ELSE [p] END AS us FROM paras),
    flat AS (
        SELECT doc_seq, p_no, long, u_no, us[u_no] AS u, {_tokens('us[u_no]')} AS tok
        FROM (SELECT *, unnest(range(1, len(us) + 1)) AS u_no FROM parts)),
    units AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY doc_seq ORDER BY p_no, u_no) AS n,
               lag(long) OVER (PARTITION BY doc_seq ORDER BY p_no, u_no) AS after_long
        FROM flat),
    walk AS (
        SELECT doc_seq, n, tok AS total, CAST(0 AS BIGINT) AS chunk FROM units WHERE n = 1
        UNION ALL
        SELECT u.doc_seq, u.n,
               CASE WHEN (u.long AND u.u_no = 1) OR (NOT u.long AND u.after_long)
                         OR w.total + u.tok > {max_tokens} THEN u.tok ELSE w.total + u.tok END,
               CASE WHEN (u.long AND u.u_no = 1) OR (NOT u.long AND u.after_long)
                         OR w.total + u.tok > {max_tokens} THEN w.chunk + 1 ELSE w.chunk END
        FROM walk w JOIN units u ON u.doc_seq = w.doc_seq AND u.n = w.n + 1),
    glued AS (
        SELECT doc_seq, chunk,
               CASE WHEN bool_or(long) THEN string_agg(u, ' ' ORDER BY n)
                    ELSE string_agg(u, {_LF} || {_LF} ORDER BY n) END AS text
        FROM walk JOIN units USING (doc_seq, n) GROUP BY doc_seq, chunk),
    chunks AS MATERIALIZED (
        SELECT doc_seq, source, source_type, chunk AS chunk_index,
               count(*) OVER (PARTITION BY doc_seq) AS total_chunks, text
        FROM glued JOIN cleaned USING (doc_seq))"""


def _chunks(max_tokens: int) -> str:
    return f"""WITH RECURSIVE {_chunk_ctes(_DIRTY, max_tokens)}
    SELECT *, substring(text, 1, 200) AS text_preview FROM chunks"""


# --- sources -----------------------------------------------------------------------------------

_FILES = f"""{_DIRTY}, files AS (
    SELECT *, 'in.d/' || source || '/' || doc_seq
        || ['.txt', '.TXT', '.pdf', '.md', '', '.tar.txt'][doc_seq % 6 + 1] AS path,
        [ 'file_txt', 'file_txt', 'file_pdf', NULL, NULL, 'file_txt'][doc_seq % 6 + 1] AS kind,
        ['', '', '', '.md', '', ''][doc_seq % 6 + 1] AS ext
    FROM docs)"""

# Latin-1 has no sign above U+00FF; the encoder writes a question mark for those
_LATIN1 = (
    "CASE WHEN doc_seq % 2 = 1 THEN regexp_replace(raw_text, '[^\\x{0}-\\x{ff}]', '?', 'g') ELSE raw_text END"
)

_PAGES = """turns AS (
    SELECT CAST(conv_id AS VARCHAR) AS source, turn,
        CASE WHEN conv_id % 9 = 4 THEN '  '
             WHEN (conv_id * 7 + turn) % 5 <> 2 THEN text END AS page_text,
        (conv_id * 7 + turn) % 6 = 1 AS failed
    FROM conversations),
assembled AS (
    SELECT source, string_agg(coalesce(page_text, ''), chr(10) ORDER BY turn) FILTER (NOT failed) AS raw_text
    FROM turns GROUP BY source)"""

# valid for the given pages: each has one article, no noise inside it, and only
# these four entities
_ARTICLE = "regexp_extract(html, '(?s)<article>(.*)</article>', 1)"
_NODES = (
    f"list_filter(list_transform(string_split(regexp_replace({_ARTICLE}, '(?s)<[^>]*>', chr(1), 'g'), chr(1)), "
    "lambda t: trim(replace(replace(replace(replace(t, '&quot;', '\"'), '&copy;', '©'), "
    f"'&middot;', '·'), '&amp;', '&'), {_WS_CHARS})), lambda t: t <> '')"
)
_WEB = f"""web AS (
    SELECT page_id, url AS source, 'url' AS source_type,
        CASE WHEN page_id % 10 = 6 THEN ' '
             WHEN page_id % 10 IN (3, 4, 5) THEN html
             ELSE array_to_string({_NODES}, chr(10)) END AS raw_text
    FROM pages)"""
_WEB_DOCS = f"""{_WEB}, docs AS (
    SELECT page_id AS doc_seq, source, source_type, raw_text FROM web WHERE page_id % 10 <> 6)"""


# --- calls ----------------------------------------------------------------------------------------

_PROMPT = (
    f"{_lit(C.REPLY_CONTRACT + chr(10) * 2 + "--- TEXT TO ANALYSE ---" + chr(10))} || text || "
    f"{_lit(chr(10) + "--- END TEXT ---")}"
)
_CALLS = """SELECT doc_id AS doc_seq, CASE WHEN length(text) % 4 < 2 THEN text END AS raw,
    CASE WHEN length(text) % 4 < 2 THEN 'success' ELSE 'failed' END AS status,
    [1, 3, {exhausted}, {refused}][length(text) % 4 + 1] AS attempts,
    CAST([0, {twice}, {always}, {refused_wait}][length(text) % 4 + 1] AS DOUBLE) AS waited,
    [NULL, NULL, 'timeout after ', 'status after '][length(text) % 4 + 1] || length(text) AS error
FROM documents"""


# --- replies ------------------------------------------------------------------------------------------

_NO_JSON = "'Extraction failed — raw output could not be parsed as JSON.'"
_NO_QUESTION = "'Could not extract questions.'"
_NO_SUMMARY = "'No summary available.'"
_PAD = "'No additional question generated.'"

# what each of the 32 reply shapes must give; see inputs.replies
_REPLIES = f"""cases AS (
    SELECT *, doc_id % 32 + 1 AS c, string_split_regex(text, '[ \\n]') AS w,
        ['positive', 'neutral', 'negative'][doc_id % 3 + 1] AS lab,
        (doc_id % 101) / CAST(100.0 AS DOUBLE) AS conf,
        regexp_extract(CAST(to_json(text) AS VARCHAR), '^"([^"]+)"', 1) AS quoted
    FROM documents),
expected AS (
    SELECT doc_id AS doc_seq, doc_id AS chunk_id, source, doc_id % 7 AS chunk_index, c AS case_no,
        substring(text, 1, 200) AS text_preview,
        CASE WHEN c IN (7, 8, 13, 25, 27, 31) THEN 'failed' WHEN c IN (5, 6, 10, 22) THEN 'fallback'
             WHEN c = 4 THEN 'repaired' ELSE 'strict' END AS parse_path,
        CASE c WHEN 7 THEN 'empty reply' WHEN 8 THEN 'reply is not an object'
               WHEN 31 THEN 'reply is not an object' WHEN 27 THEN 'entity list has a wrong type'
               WHEN 25 THEN 'reply is not an object' WHEN 13 THEN 'entity list has a wrong type' END AS reason,
        CASE WHEN c IN (5, 6, 10, 22) THEN true END AS parse_error,
        CASE WHEN c IN (7, 8, 13, 25, 27, 31) THEN NULL WHEN c IN (6, 22) THEN {_NO_JSON}
             WHEN c = 5 THEN 'Cut off ' || source WHEN c = 10 THEN quoted
             WHEN c = 11 THEN {_NO_SUMMARY} WHEN c = 20 THEN 'None'
             WHEN c = 26 THEN 'x: NaN, [-Infinity] ' || source
             ELSE trim(text, {_WS_CHARS}) END AS summary,
        CASE WHEN c IN (7, 8, 13, 25, 27, 31) THEN NULL WHEN c IN (5, 6, 10, 11, 21, 22) THEN []
             WHEN c = 12 THEN ['B', 'o', 'b'] WHEN c = 28 THEN ['A', 'NaN', '-Infinity'] WHEN c = 32 THEN ['None', source]
             ELSE [w[1], coalesce(w[2], 'None')] END AS people,
        CASE WHEN c IN (7, 8, 13, 25, 27, 31) THEN NULL WHEN c IN (5, 6, 10, 11, 21, 22) THEN [] WHEN c = 32 THEN [lang, 'None'] ELSE [lang] END AS places,
        CASE WHEN c IN (7, 8, 13, 25, 27, 31) THEN NULL WHEN c IN (5, 6, 10, 11, 21, 22) THEN [] WHEN c = 32 THEN ['None'] ELSE [source] END AS orgs,
        CASE WHEN c IN (7, 8, 13, 25, 27, 31) THEN NULL WHEN c = 5 THEN 'negative'
             WHEN c IN (6, 11, 17, 22, 29) THEN 'neutral' ELSE lab END AS label,
        CASE WHEN c IN (7, 8, 13, 25, 27, 31) THEN NULL WHEN c IN (5, 6, 10, 22) THEN 0.0 WHEN c IN (11, 14) THEN 0.5
             WHEN c IN (15, 16, 24, 26) THEN 1.0 WHEN c = 28 THEN 0.0 ELSE conf END AS confidence,
        CASE WHEN c IN (7, 8, 13, 25, 27, 31) THEN NULL
             WHEN c IN (5, 6, 10, 22) THEN [{_NO_QUESTION}, {_NO_QUESTION}, {_NO_QUESTION}]
             WHEN c = 11 THEN [{_PAD}, {_PAD}, {_PAD}]
             WHEN c = 29 THEN ['q1', 'nan', '-inf']
             WHEN c = 18 THEN ['only one', {_PAD}, {_PAD}]
             ELSE ['q1', 'q2', 'q3'] END AS questions
    FROM cases),
ok AS (SELECT * FROM expected WHERE parse_path <> 'failed'),
bad AS (SELECT * FROM expected WHERE parse_path = 'failed')"""


def _flat(source: str, order: str = "") -> str:
    return f"""SELECT chunk_id, source, chunk_index, text_preview, summary,
        coalesce(array_to_string(people, '; '), '') AS people,
        coalesce(array_to_string(places, '; '), '') AS places,
        coalesce(array_to_string(orgs, '; '), '') AS organizations,
        label AS sentiment_label, confidence AS sentiment_confidence,
        questions[1] AS question_1, questions[2] AS question_2, questions[3] AS question_3,
        coalesce(parse_error, false) AS parse_error
    FROM {source} {order}"""


_FLAT_REPLIES = f"WITH {_REPLIES} {_flat('ok')}"

_ENTITIES = """mentions AS (
    SELECT chunk_id, 0 AS kind_no, unnest(people) AS name, unnest(range(0, len(people))) AS pos FROM ok
    UNION ALL SELECT chunk_id, 1, unnest(places), unnest(range(0, len(places))) FROM ok
    UNION ALL SELECT chunk_id, 2, unnest(orgs), unnest(range(0, len(orgs))) FROM ok),
counted AS (
    SELECT kind_no, name, count(*) AS mentions, min(chunk_id) AS first_chunk,
           min(chunk_id * 1000000 + pos) AS first_seen
    FROM mentions GROUP BY kind_no, name),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY kind_no ORDER BY mentions DESC, first_seen) AS rank FROM counted),
top AS (SELECT * FROM ranked WHERE rank <= 5)"""

_LAST = 2**62
_RULE, _BANNER = "-" * 40, "=" * 70


def _heading(section: int, title: str) -> str:
    return (
        f"({section}, -1, 0, '{title}'), ({section}, -1, 1, '{_RULE}'), ({section}, {_LAST}, 0, '')"
    )


def _percent(label: str, name: str) -> str:
    return (
        f"'  {name:<8} : ' || printf('%3d', {label}) || '  (' || "
        f"printf('%.0f', {label} * 100 / CAST(greatest(total, 1) AS DOUBLE)) || '%)'"
    )


_REPORT = f"""WITH {_REPLIES}, {_ENTITIES},
s AS (SELECT count(*) AS total, count(*) FILTER (label = 'positive') AS positive,
             count(*) FILTER (label = 'neutral') AS neutral,
             count(*) FILTER (label = 'negative') AS negative,
             coalesce(avg(confidence), 0) AS mean FROM ok),
o AS (SELECT (SELECT count(*) FROM documents) AS d, (SELECT count(*) FROM ok) AS g, (SELECT count(*) FROM bad) AS b),
src AS (SELECT source, count(*) AS n, min(chunk_id) AS f FROM ok GROUP BY source),
fixed(section_no, item_no, line_no, line) AS (VALUES
    (0, 0, 0, '{_BANNER}'), (0, 0, 1, '  DOCUMENT EXTRACTION — SUMMARY REPORT'),
    (0, 0, 2, '  Generated: 2024-01-01 00:00:00'), (0, 0, 3, '{_BANNER}'), (0, 0, 4, ''),
    {_heading(1, 'OVERVIEW')}, {_heading(2, 'SOURCES')}, {_heading(3, 'SENTIMENT DISTRIBUTION')},
    {_heading(4, 'TOP ENTITIES')}, {_heading(5, 'CHUNK SUMMARIES')},
    (4, 0, 0, '  People:'), (4, 1, 0, '  Places:'), (4, 2, 0, '  Organizations:'),
    (7, 0, 0, '{_BANNER}'), (7, 0, 1, 'END OF REPORT'), (7, 0, 2, '{_BANNER}'))
SELECT * FROM fixed
UNION ALL SELECT 1, 0, 0, '  Total documents ingested : ' || d FROM o
UNION ALL SELECT 1, 0, 1, '  Total chunks processed   : ' || (g + b) FROM o
UNION ALL SELECT 1, 0, 2, '  Successful extractions   : ' || g FROM o
UNION ALL SELECT 1, 0, 3, '  Failed / skipped chunks  : ' || b FROM o
UNION ALL SELECT 2, f, 0, '  • ' || source || '  (' || n || ' chunk(s))' FROM src
UNION ALL SELECT 3, 0, 0, {_percent('positive', 'Positive')} FROM s
UNION ALL SELECT 3, 0, 1, {_percent('neutral', 'Neutral')} FROM s
UNION ALL SELECT 3, 0, 2, {_percent('negative', 'Negative')} FROM s
UNION ALL SELECT 3, 0, 3, '' FROM s
UNION ALL SELECT 3, 0, 4, '  Average sentiment confidence: ' || printf('%.2f', mean) FROM s
UNION ALL SELECT 4, kind_no, rank, '    - ' || name || ' (' || mentions || 'x)' FROM top
UNION ALL SELECT 5, chunk_id, 0, '' FROM ok
UNION ALL SELECT 5, chunk_id, 1, '  [Chunk ' || chunk_id || ']  ' || source || '  (part ' || (chunk_index + 1) || ')' FROM ok
UNION ALL SELECT 5, chunk_id, 2, '  Sentiment : ' || label || ' (conf: ' || printf('%.2f', confidence) || ')' FROM ok
UNION ALL SELECT 5, chunk_id, 3, '  Summary   : ' || summary FROM ok
UNION ALL SELECT 5, chunk_id, 4, '  Key Questions:' FROM ok
UNION ALL SELECT 5, chunk_id, 4 + i, '    ? ' || questions[i] FROM ok, (VALUES (1), (2), (3)) q(i)
UNION ALL SELECT 6, chunk_id, 0, '  - Source: ' || source || '  Part ' || (chunk_index + 1) || '/7' FROM bad
UNION ALL SELECT 6, -1, 0, 'FAILED / SKIPPED CHUNKS' WHERE EXISTS (FROM bad)
UNION ALL SELECT 6, -1, 1, '{_RULE}' WHERE EXISTS (FROM bad)
UNION ALL SELECT 6, {_LAST}, 0, '' WHERE EXISTS (FROM bad)"""


# --- everything --------------------------------------------------------------------------------------

_RUN = f"""WITH RECURSIVE {_chunk_ctes(_DIRTY, 200)},
numbered AS (
    SELECT *, row_number() OVER (ORDER BY doc_seq, chunk_index) AS chunk_id, length(text) AS size FROM chunks)"""
_RUN_RESULTS = f"""{_RUN},
ok AS (
    SELECT chunk_id, source, chunk_index, substring(text, 1, 200) AS text_preview,
        CASE WHEN size % 13 = 0 THEN 'Cut short' ELSE trim(text, {_WS_CHARS}) END AS summary,
        CASE WHEN size % 13 = 0 THEN [] ELSE regexp_extract_all(text, '[A-Z][a-z]+') END AS people,
        CAST([] AS VARCHAR[]) AS places,
        CASE WHEN size % 13 = 0 THEN [] ELSE ['Org ' || size % 7, 'Org ' || size % 3] END AS orgs,
        CASE WHEN size % 13 = 0 THEN 'negative' ELSE ['positive', 'neutral', 'negative'][size % 3 + 1] END AS label,
        CASE WHEN size % 13 = 0 THEN 0.0 ELSE (size % 101) / CAST(100 AS DOUBLE) END AS confidence,
        CASE WHEN size % 13 = 0
             THEN [{_NO_QUESTION}, {_NO_QUESTION}, {_NO_QUESTION}]
             ELSE ['Why ' || size || '?', {_PAD}, {_PAD}] END AS questions,
        CASE WHEN size % 13 = 0 THEN true END AS parse_error
    FROM numbered WHERE size % 17 <> 0)
{_flat('ok')}"""


ORACLES = {
    "clean_replace": _per_document(_replace("raw_text")),
    "clean_nfc": _per_document("nfc_normalize(raw_text)"),
    "clean_boilerplate": _per_document(_boilerplate("raw_text")),
    "clean_newlines": _per_document(_newlines("raw_text")),
    "clean_trim": _per_document(_trim("raw_text")),
    "clean_text": _per_document(_clean("raw_text")),
    "doc_stats": f"""WITH RECURSIVE {_chunk_ctes(_DIRTY, 200)},
        counts AS (SELECT doc_seq, count(*) AS n FROM chunks GROUP BY doc_seq)
        SELECT doc_seq, docs.source, length(raw_text) AS chars_raw, length(txt) AS chars_clean,
            {_tokens('txt')} AS tokens, coalesce(n, 0) AS total_chunks
        FROM docs JOIN cleaned USING (doc_seq) LEFT JOIN counts USING (doc_seq)""",
    "paragraphs": f"""WITH {_DIRTY}, listed AS (
            SELECT doc_seq, {_paragraphs(_clean('raw_text'))} AS ps FROM docs),
        numbered AS (SELECT doc_seq, ps, unnest(range(0, len(ps))) AS para_no FROM listed)
        SELECT doc_seq, para_no, ps[para_no + 1] AS text, {_tokens('ps[para_no + 1]')} AS tokens FROM numbered""",
    "sentences": f"""WITH {_DOCS}, listed AS (SELECT doc_seq, {_sentences('raw_text')} AS ss FROM docs),
        numbered AS (SELECT doc_seq, ss, unnest(range(0, len(ss))) AS sentence_no FROM listed)
        SELECT doc_seq, sentence_no, ss[sentence_no + 1] AS text,
            {_tokens('ss[sentence_no + 1]')} AS tokens FROM numbered""",
    "chunks_60": _chunks(60),
    "chunks_200": _chunks(200),
    "chunks_800": _chunks(800),
    "long_chunks": f"""WITH RECURSIVE {_chunk_ctes(_DIRTY, 60)}
        SELECT doc_seq, chunk_index, total_chunks, text FROM chunks""",
    "chunk_numbers": f"""WITH RECURSIVE {_chunk_ctes(_DOCS, 200)}
        SELECT doc_seq, source, chunk_index, total_chunks,
            row_number() OVER (ORDER BY doc_seq, chunk_index) AS chunk_id FROM chunks""",
    "chunks_by_source": f"""WITH RECURSIVE {_chunk_ctes(_DOCS, 200)}
        SELECT source, count(*) AS chunks, round(avg({_tokens('text')}), 6) AS mean_tokens
        FROM chunks GROUP BY source""",
    "text_decode": f"""WITH {_DIRTY}
        SELECT doc_seq, {_swap(_LATIN1, (chr(13) + chr(10), chr(10)), (chr(13), chr(10)))} AS text FROM docs""",
    "file_routes": f"WITH {_FILES} SELECT doc_seq, path AS source, kind AS source_type FROM files",
    "file_rejects": f"""WITH {_FILES} SELECT path AS source, 'ingest' AS stage,
        'unsupported file type ''' || ext || '''' AS reason FROM files WHERE kind IS NULL""",
    "text_files": """SELECT ['', '_', '.', 'sub/_x/'][doc_id % 4 + 1] || doc_id || '.txt' AS path,
        'file_txt' AS source_type, CASE WHEN doc_id % 9 = 0 THEN '' ELSE text END AS text FROM documents""",
    "number_files": f"""WITH {_FILES} SELECT row_number() OVER (ORDER BY path) - 1 AS doc_seq, path AS source,
        'file_txt' AS source_type FROM files
        UNION ALL SELECT {2**40} + page_id, url, 'url' FROM pages""",
    "missing_rejects": f"""WITH {_FILES} SELECT path AS source, 'ingest' AS stage, 'file not found' AS reason
        FROM files WHERE doc_seq % 7 = 3""",
    "pdf_rejects": f"""WITH {_FILES} SELECT path AS source, 'ingest' AS stage, 'no page texts' AS reason
        FROM files WHERE doc_seq % 6 = 2 AND doc_seq % 4 <> 0""",
    "fetch_rejects": """SELECT url AS source, 'fetch' AS stage, 'status ' || length(html) AS reason
        FROM pages WHERE page_id % 11 = 5""",
    "blank_rejects": """SELECT source, 'preprocess' AS stage, 'no usable text' AS reason
        FROM documents WHERE doc_id % 13 = 4""",
    "assemble_pages": f"""WITH {_PAGES} SELECT source, 'file_pdf' AS source_type, raw_text
        FROM assembled WHERE trim(raw_text, {_WS_CHARS}) <> ''""",
    "page_rejects": f"""WITH {_PAGES} SELECT source, 'ingest' AS stage, 'no extractable text' AS reason
        FROM assembled WHERE coalesce(trim(raw_text, {_WS_CHARS}), '') = ''""",
    "html_main_text": f"""WITH {_WEB} SELECT page_id, source, source_type, raw_text AS text
        FROM web WHERE page_id % 10 <> 6""",
    "page_chunks": f"WITH RECURSIVE {_chunk_ctes(_WEB_DOCS, 100)} SELECT * FROM chunks",
    "capture_rejects": """SELECT url AS source, 'ingest' AS stage, 'empty content' AS reason
        FROM pages WHERE page_id % 10 = 6""",
    "union_sources": f"""WITH {_WEB} SELECT doc_id AS doc_seq, source, 'file_txt' AS source_type,
            text AS raw_text FROM documents
        UNION ALL SELECT {2**40} + page_id, source, source_type, raw_text FROM web WHERE page_id % 10 <> 6""",
    "requests_openai": f"""SELECT doc_id AS doc_seq, 'gpt-4o-mini' AS model, 2 AS messages,
        'system' AS first_role, {_lit(C.SYSTEM_MESSAGE)} AS first_content, {_PROMPT} AS prompt,
        CAST(0.1 AS DOUBLE) AS temperature, 45 AS timeout FROM documents""",
    "requests_gemini": f"""SELECT doc_id AS doc_seq, 'gemini-1.5-flash' AS model, 1 AS messages,
        'user' AS first_role, {_PROMPT} AS first_content, {_PROMPT} AS prompt,
        CAST(0.1 AS DOUBLE) AS temperature, CAST(NULL AS INTEGER) AS timeout FROM documents""",
    "classify_errors": """WITH log AS (
            SELECT event_id, concat_ws(' ', event_type, props) AS said,
                (event_id + length(concat_ws(' ', event_type, props))
                    + coalesce(CAST(floor(abs(value)) AS BIGINT), 0)) % 6 + 1 AS k FROM events),
        worded AS (
            SELECT event_id, [200, 429, 503, NULL, 400, 400][k] AS status_code, k,
                concat_ws(' ', ['ok', 'rate limit', 'unavailable', 'request timeout', 'bad request',
                    'could not generate'][k], said) AS message FROM log)
        SELECT event_id, status_code, message,
            ['success', 'retry', 'retry', 'retry', 'fatal', 'fatal'][k] AS typed_class,
            CASE WHEN k = 1 THEN 'success' WHEN regexp_matches(lower(message), '429|quota|rate|timeout')
                 THEN 'retry' ELSE 'fatal' END AS message_class FROM worded""",
    "call_rows_model": _CALLS.format(exhausted=4, refused=1, twice=4, always=8, refused_wait=0),
    "call_rows_fetch": _CALLS.format(exhausted=3, refused=3, twice=6, always=6, refused_wait=6),
    "split_outcomes": """SELECT doc_id AS doc_seq, CASE WHEN length(text) % 4 < 2 THEN 'results' ELSE 'failed' END AS part,
        [NULL, NULL, 'timeout after ', 'status after '][length(text) % 4 + 1] || length(text) AS error FROM documents""",
    "resume_calls": "SELECT doc_id AS doc_seq, length(text) AS chars FROM documents WHERE length(text) % 4 >= 2",
    "parse_replies": f"WITH {_REPLIES} SELECT doc_seq, case_no, parse_path, reason, parse_error FROM expected",
    "coerce_replies": f"""WITH {_REPLIES} SELECT doc_seq, summary,
        array_to_string(people, '|') AS people, array_to_string(places, '|') AS places,
        array_to_string(orgs, '|') AS organizations, label, confidence,
        array_to_string(questions, '|') AS questions FROM expected""",
    "flat_rows": _FLAT_REPLIES,
    "csv_roundtrip": _FLAT_REPLIES,
    "json_roundtrip": _FLAT_REPLIES,
    "report_overview": f"""WITH {_REPLIES} SELECT (SELECT count(*) FROM documents) AS documents,
        (SELECT count(*) FROM expected) AS chunks, (SELECT count(*) FROM ok) AS succeeded,
        (SELECT count(*) FROM bad) AS failed""",
    "report_sources": f"""WITH {_REPLIES} SELECT source, count(*) AS chunks, min(chunk_id) AS first_chunk
        FROM ok GROUP BY source""",
    "report_sentiment": f"""WITH {_REPLIES}, labels3(position, label) AS (
            VALUES (0, 'positive'), (1, 'neutral'), (2, 'negative')),
        counts AS (SELECT label, count(*) AS n FROM ok GROUP BY label)
        SELECT position, l.label, coalesce(n, 0) AS chunks,
            coalesce(n, 0) * 100 / CAST((SELECT greatest(count(*), 1) FROM ok) AS DOUBLE) AS percent
        FROM labels3 l LEFT JOIN counts c ON l.label = c.label""",
    "report_confidence": f"""WITH {_REPLIES} SELECT count(*) AS total,
        round(coalesce(avg(confidence), 0), 6) AS mean_confidence FROM ok""",
    "report_entities": f"""WITH {_REPLIES}, {_ENTITIES}
        SELECT ['people', 'places', 'organizations'][kind_no + 1] AS kind, rank, name, mentions, first_chunk FROM top""",
    "report_lines": _REPORT,
    "extraction_run": _RUN_RESULTS,
    "extraction_failures": f"""{_RUN} SELECT chunk_id, doc_seq, source, source_type, chunk_index,
        total_chunks, text, 'bad request' AS reason FROM numbered WHERE size % 17 = 0""",
}

# a Latin-1 character is one byte
_SIZE = f"CASE WHEN doc_seq % 2 = 0 THEN octet_length(encode(raw_text)) ELSE length({_LATIN1}) END"
ORACLES["unreadable_rejects"] = f"""WITH {_FILES}, sized AS (
        SELECT path, kind, {_SIZE} AS size FROM files)
    SELECT path AS source, 'ingest' AS stage, 'cannot be read: stream ended after ' || size AS reason
    FROM sized WHERE kind IS NOT NULL AND size % 5 = 2"""
ORACLES["stop_on_empty"] = """SELECT 'none' AS "case", 'no documents' AS reason, CAST(0 AS BIGINT) AS documents, false AS saved
    UNION ALL SELECT 'blank', 'no chunks', count(*), false FROM documents
    UNION ALL SELECT 'refused', 'no results', count(*), false FROM documents"""
ORACLES["text_ranges"] = ORACLES["text_decode"]
ORACLES["all_rejects"] = " UNION ALL ".join(
    f"({ORACLES[name]})" for name in (
        "file_rejects", "page_rejects", "capture_rejects",
        "missing_rejects", "pdf_rejects", "fetch_rejects", "blank_rejects", "unreadable_rejects",
    )
)
ORACLES["report_roundtrip"] = f"""WITH cut AS (
        SELECT *, string_split(line, chr(10)) AS parts FROM ({_REPORT})),
    listed AS (SELECT *, unnest(parts) AS part, unnest(range(0, len(parts))) AS k FROM cut)
    SELECT row_number() OVER (ORDER BY section_no, item_no, line_no, k) - 1 AS line_no, part AS line FROM listed"""
ORACLES["saved_run"] = f"""WITH rows AS ({_RUN_RESULTS})
    SELECT 'results_r1.json' AS file, * FROM rows UNION ALL SELECT 'results_r1.csv', * FROM rows"""
