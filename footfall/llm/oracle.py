"""SQL equivalents (DuckDB) of the corpus queries that SQL can express."""

from __future__ import annotations

import string

from footfall.llm.chat import ATTACHED, AUDIO_NAMES, DOCUMENT_NAMES, EXPANSION, LOOKS, WORD
from footfall.llm.licenses import COPYRIGHT_LINE, NOTICES, SPELLINGS, TEXTS, VERSION, without_title
from footfall.llm.mixing import BLOCK_ROWS, schedule

# The target weights of the mix: parts of 100.
TARGETS = {"src0": 20, **{f"src{i}": 4 for i in range(1, 20)}}
TARGETS_OTHER = 4

LOWERED = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, {LOWERED} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical() -> str:
    form = f"regexp_replace({LOWERED}, {_quoted(COPYRIGHT_LINE)}, chr(10), 'g')"
    form = f"' ' || regexp_replace({form}, '[^a-z0-9]+', '  ', 'g') || ' '"
    form = f"regexp_replace({form}, {_quoted(VERSION)}, ' version  \\1', 'g')"
    for other, same in SPELLINGS:
        form = f"replace({form}, ' {other.replace(' ', '  ')} ', ' {same} ')"
    return f"trim(regexp_replace({form}, ' +', ' ', 'g'))"


WHOLE = [*NOTICES, *((name, form) for name, text in TEXTS for form in (text, without_title(text)))]
LICENSES = f"""
WITH notices(license, text) AS (VALUES {', '.join(f"({_quoted(a)}, {_quoted(b)})" for a, b in WHOLE)}),
units AS (
    SELECT doc_id, true AS whole, text FROM documents
    UNION ALL SELECT doc_id, false, unnest(string_split(coalesce(text, ''), chr(10))) FROM documents),
forms AS (SELECT doc_id, whole, {_canonical()} AS form FROM units),
known AS (SELECT {_canonical()} AS form, min(license) AS license FROM notices GROUP BY 1)
SELECT doc_id, max(CASE WHEN whole AND f.form != '' THEN sha256(f.form) END) AS digest,
       max(CASE WHEN whole THEN license END) AS license,
       count(CASE WHEN NOT whole THEN license END) AS n_lines,
       coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS licenses
FROM forms f LEFT JOIN known k ON f.form = k.form AND f.form != ''
GROUP BY doc_id
"""

_PARTS = [*TARGETS.values(), TARGETS_OTHER]
_TOTAL = sum(_PARTS)


def _places() -> str:
    """(class, number of the block in a period, slot) of one period."""
    seen, rows = [0] * len(_PARTS), []
    for slot, which in enumerate(schedule(_PARTS)):
        rows.append(f"({which}, {seen[which]}, {slot})")
        seen[which] += 1
    return ", ".join(rows)


MIXING = f"""
WITH targets(source, class, part) AS (VALUES {', '.join(f"({_quoted(s)}, {i}, {p})" for i, (s, p) in enumerate(TARGETS.items()))}),
places(class, k, slot) AS (VALUES {_places()}),
numbered AS (
    SELECT doc_id, d.source, coalesce(class, {len(TARGETS)}) AS class, coalesce(part, {TARGETS_OTHER}) AS part,
           row_number() OVER (PARTITION BY coalesce(class, {len(TARGETS)})
                              ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS n
    FROM documents d LEFT JOIN targets t ON d.source = t.source),
blocks AS (SELECT *, n // {BLOCK_ROWS} AS b FROM numbered)
SELECT doc_id, source, blocks.class AS mix_class, b AS mix_block, b * {_TOTAL} // part AS mix_release,
       ((b + 1) * {_TOTAL} + part - 1) // part AS mix_deadline,
       b // part * {_TOTAL} + slot AS mix_slot, n - b * {BLOCK_ROWS} AS mix_row
FROM blocks JOIN places ON places.class = blocks.class AND places.k = b % part
"""

SAYS_MARKS = "</s>[INST] ok [/INST]"

_IS_AUDIO, _IS_DOCUMENT = (f"regexp_matches(lower(x), {_quoted(p)})" for p in (AUDIO_NAMES, DOCUMENT_NAMES))


def _escaped(text: str) -> str:
    return f"regexp_replace({text}, {_quoted(LOOKS)}, '\\1\\\\\\2\\3', 'g')"


def _of_kind(what: int) -> str:
    values = {k: (repr(v[what]) if what == 0 else v[what]) for k, v in EXPANSION.items()}
    return f"CASE WHEN {_IS_AUDIO} THEN {values['audio']} WHEN {_IS_DOCUMENT} THEN {values['document']} ELSE {values['image']} END"


# A placeholder takes the place of an attachment: its kind twice, its number (1, 3, 5, ... after the texts before it) and five signs.
CHAT = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', {_quoted(SAYS_MARKS)}), (-7, 1, 'assistant', {_quoted(SAYS_MARKS)})),
turns AS (
    SELECT *, regexp_extract_all(text, {_quoted(ATTACHED)}) AS files,
           regexp_replace(text, {_quoted(ATTACHED)}, chr(10), 'g') AS plain FROM rows),
sizes AS (
    SELECT *, len(files) AS n_files,
           20 + length({_escaped('role')}) + length({_escaped('plain')}) - len(files)
           + coalesce(list_sum(list_transform(files, lambda x, i: 2 * length({_of_kind(0)}) + 5 + length(CAST(2 * i - 1 AS VARCHAR)))), 0) AS chars,
           len(regexp_extract_all(plain, {_quoted(WORD)})) + coalesce(list_sum(list_transform(files, lambda x: {_of_kind(1)})), 0) AS tokens
    FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars, CAST(sum(n_files) AS BIGINT) AS n_attachments, CAST(sum(tokens) AS BIGINT) AS n_tokens
FROM sizes GROUP BY conv_id
"""

TERMS = f"regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

LEXICAL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {TERMS} AS terms FROM documents),
sizes AS (SELECT count(*) AS docs, sum(len(terms)) AS total FROM d WHERE len(terms) > 0),
held AS (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
counts AS (SELECT row, doc_id, n, term, count(*) AS tf FROM held GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, sizes GROUP BY term),
asked AS (SELECT DISTINCT item, item_id, unnest(terms) AS term
          FROM (SELECT row_number() OVER () AS item, item_id, {TERMS} AS terms FROM benchmark)),
scores AS (SELECT item, item_id, row, doc_id,
                  CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) AS BIGINT) AS score
           FROM asked JOIN counts USING (term) JOIN weights USING (term), sizes GROUP BY item, item_id, row, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""

ORACLE: dict[str, str] = {
    "op4_licenses": LICENSES,
    "op7_mixing": MIXING,
    "op8_exact_dedup": EXACT_DEDUP,
    "op11_chat": CHAT,
    "op12_lexical_search": LEXICAL,
}
