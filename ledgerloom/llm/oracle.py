"""SQL for DuckDB that the queries of this subpackage must agree with, where SQL can express them.

Plain definitions over whole tables: every window, shingle, pair of lines and turn is spelled out,
with none of the operators' filters.  Models (op7, op10), page structure (op3), compression (op1) and
a tokenizer (op6) have no SQL form.
"""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_LETTERS = r"[^\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SUBSTRING_DEDUP = f"""
WITH tokens AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM tokens),
windows AS (
  SELECT doc_id, pos, string_agg(word, ' ') OVER run AS seq, count(*) OVER run AS n
  FROM words WINDOW run AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)
),
owned AS (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY seq) AS owner FROM windows WHERE n = 13),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM owned, range(13) r(k) WHERE owner < doc_id),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY pos) AS rest
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM tokens LEFT JOIN kept USING (doc_id)
"""


def _shingles(source: str, key: str, text: str, word: str) -> str:
    """The distinct five-word shingles of each row; of fewer words, the whole sequence."""
    return f"""
  SELECT DISTINCT {key}, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS shingle
  FROM (SELECT {key}, regexp_extract_all({text}, '{word}') AS w FROM {source}) WHERE len(w) > 0"""


JACCARD_JOIN = f"""
WITH RECURSIVE shingles AS ({_shingles("documents", "doc_id", _LOWER, _WORD)}),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
  FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * n_both >= 75 * (s.n + t.n - n_both)
),
reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
),
roots AS (SELECT x, min(y) AS component_id FROM reached GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN roots ON x = doc_id
"""

NEAR_DEDUP = f"""
WITH RECURSIVE shingles AS ({_shingles("documents", "doc_id", _LOWER, _WORD)}),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
  FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * n_both >= 85 * (s.n + t.n - n_both)
),
reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
),
roots AS (SELECT x, min(y) AS component_id FROM reached GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN roots ON x = doc_id
"""

DECONTAMINATION = f"""
WITH own AS ({_shingles("documents", "doc_id", _LOWER, _LETTERS)}),
items AS ({_shingles("benchmark", "item_id", _LOWER, _LETTERS)}),
sizes AS (SELECT item_id, count(*) AS n_item FROM items GROUP BY item_id),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM own JOIN items USING (shingle) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM shared JOIN sizes USING (item_id) WHERE 4 * n_shared >= 3 * n_item
"""

CHAT_FORMATTING = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(i)
),
placed AS (
  SELECT *, row_number() OVER o AS place, coalesce(lag(role) OVER o <> role, true) AS opens
  FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
marks(role, n_marks) AS (VALUES ('system', 17), ('user', 15), ('assistant', 9)),
measured AS (
  SELECT placed.*,
    length(regexp_replace(text, '(\\*)(</?s>|<</?SYS>>|\[/?INST\]|\[TURN\]|\[ROLE [0-9A-F]*\]|\[/ROLE\])', '\1\1\\\2', 'g'))
    + CASE WHEN opens THEN coalesce(n_marks, 16 + 2 * strlen(role)) ELSE 8 END AS n_chars
  FROM placed LEFT JOIN marks USING (role)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n_chars)::BIGINT AS formatted_chars
FROM measured GROUP BY conv_id
"""

LINE_DEDUP = """
WITH raws AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL
),
lines AS (SELECT doc_id, pos, raw, trim(lower(raw), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM raws),
firsts AS (SELECT line, min((doc_id, pos)) AS place FROM lines WHERE line <> '' GROUP BY line),
long AS (SELECT line, place, length(line) AS n FROM firsts WHERE length(line) >= 16),
-- one edit lies in one half of the shorter line, so two such lines share the other half
halves AS (
  SELECT DISTINCT line, place, n, h, part, CASE part WHEN 0 THEN left(line, h) ELSE right(line, h) END AS half
  FROM (SELECT long.*, unnest([n // 2, (n - 1) // 2]) AS h FROM long), range(2) r(part)
),
pairs AS (
  SELECT DISTINCT a.line AS a, b.line AS b, a.n AS na, b.n AS nb, a.place < b.place AS a_first
  FROM halves a JOIN halves b USING (h, part, half)
  WHERE a.line <> b.line AND a.n <= b.n AND b.n <= a.n + 1 AND h = a.n // 2
),
prefixed AS (
  SELECT *, list_reduce(
    list_transform(range(30), lambda k: (1::BIGINT << (29 - k))),
    lambda p, s: CASE WHEN p + s <= na AND left(a, p + s) = left(b, p + s) THEN p + s ELSE p END,
    0::BIGINT) AS same
  FROM pairs
),
near AS (
  SELECT DISTINCT CASE WHEN a_first THEN b ELSE a END AS line FROM prefixed
  WHERE substr(b, same + 2) = CASE WHEN na = nb THEN substr(a, same + 2) ELSE substr(a, same + 1) END
),
rest AS (
  SELECT doc_id,
    string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone) AS kept,
    count(*) FILTER (gone) AS n_gone
  FROM (
    SELECT l.doc_id, l.pos, l.raw, coalesce(near.line IS NOT NULL OR (l.doc_id, l.pos) <> f.place, false) AS gone
    FROM lines l LEFT JOIN firsts f USING (line) LEFT JOIN near USING (line)
  ) GROUP BY doc_id
)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(kept, '') END AS text, coalesce(n_gone, 0) AS n_lines_removed
FROM documents LEFT JOIN rest USING (doc_id)
"""

ORACLE = {
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op4_jaccard_join": JACCARD_JOIN,
    "op11_near_dedup": NEAR_DEDUP,
    "op5_decontamination": DECONTAMINATION,
    "op8_chat_formatting": CHAT_FORMATTING,
    "op9_line_dedup": LINE_DEDUP,
}
