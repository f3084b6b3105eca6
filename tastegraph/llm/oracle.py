"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

#: The base32 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

USABLE = "embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"

OP1 = f"""
WITH v AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS c FROM embeddings WHERE {USABLE} AND vec_id IS NOT NULL),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.c, d.c) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 20 = 0 AND d.vec_id <> q.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def _base32(hexed: str) -> str:
    """Five hexadecimal digits are four letters."""
    def letter(part: int, shift: int) -> str:
        number = f"CAST('0x' || substr({hexed}, {5 * part + 1}, 5) AS INTEGER)"
        return f"substr('{BASE32}', (({number} >> {shift}) & 31) + 1, 1)"

    return " || ".join(letter(part, shift) for part in range(8) for shift in (15, 10, 5, 0))


OP5 = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, {_base32("p.h")} AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM p JOIN f ON p.h = f.h
"""

REACHED = """
reached AS (SELECT id AS id, id AS other FROM nodes UNION SELECT r.id, l.b FROM reached r JOIN links l ON l.a = r.other),
least AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)
"""

OP8 = f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS id FROM embeddings),
v AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS c FROM embeddings
  WHERE {USABLE} AND vec_id IS NOT NULL AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.c, y.c) >= 0.95),
{REACHED}
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.id = e.vec_id
"""

OP9 = rf"""
WITH RECURSIVE nodes AS (SELECT doc_id AS id FROM documents),
w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(array_to_string(ws[k:k + 2], ' ')) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS k FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n m ON m.doc_id = a JOIN n o ON o.doc_id = b WHERE 100 * common >= 90 * (m.n + o.n - common)),
{REACHED}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, l.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN least l ON l.id = d.doc_id
"""




def _characters(text: str, characters: str) -> str:
    return f"(len({text}) - len(translate({text}, '{characters}', '')))"


def _op13() -> str:
    marks, closing, symbols = ".!?…。", "\"'')\\]»”’", "#*$%&|<>"
    phrases = (
        "all rights reserved|licensed under|released under the|terms of (?:use|service)|privacy policy|cookie policy|uses? cookies|"
        "enable javascript|lorem ipsum|copyright (?:\\(c\\)|©|[0-9]{4})|click here|read more|sign up|log in|subscribe to|"
        "share (?:this|on)|follow us|back to top|skip to (?:main )?content|powered by")
    word, space = "[^\\x20\\x09-\\x0D]+", "[\\x20\\x09-\\x0D]"
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{word}') AS ws,
         [l FOR l IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(l, '{word}')] AS ls
  FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS k, unnest(ls) AS l FROM d),
c AS (
  SELECT *, len(regexp_extract_all(l, '{word}')) AS n, {_characters("l", marks)} AS m, {_characters("l", symbols + "»›•·→")} AS s FROM l),
j AS (
  SELECT doc_id, k, l, CASE
    WHEN s >= 2 AND s * 4 >= n THEN 'navigation'
    WHEN NOT regexp_matches(l, '[{marks}][{closing}]*{space}*\\z') AND m * 60 < n THEN 'punctuation'
    WHEN n >= 8 AND m * 2 > n THEN 'punctuation'
    WHEN n <= 30 AND regexp_matches(l, '(?i){phrases}') THEN 'boilerplate' END AS failed
  FROM c),
k AS (
  SELECT doc_id, count(*) AS n_lines, count_if(failed = 'punctuation') AS n_punctuation, count_if(failed = 'navigation') AS n_navigation,
         count_if(failed = 'boilerplate') AS n_boilerplate, count(*) - count(DISTINCT l) AS n_dup_lines,
         coalesce(string_agg(l, chr(10) ORDER BY k) FILTER (failed IS NULL), '') AS clean
  FROM j GROUP BY doc_id),
w AS (SELECT doc_id, k, array_to_string(ws[k:k + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS k FROM d)),
r AS (SELECT doc_id, g FROM w GROUP BY doc_id, g HAVING count(*) > 1),
o AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT w.doc_id, unnest(range(w.k, w.k + 5)) AS p FROM w JOIN r ON w.doc_id = r.doc_id AND w.g = r.g)
  GROUP BY doc_id),
f AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST({_characters("t", symbols)} AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(o.n, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_punctuation, 0) AS n_punctuation, coalesce(n_navigation, 0) AS n_navigation,
         coalesce(n_boilerplate, 0) AS n_boilerplate, coalesce(clean, '') AS clean,
         CAST(len(regexp_replace(coalesce(clean, ''), '{space}', '', 'g')) AS BIGINT) AS kept_chars
  FROM d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN o ON o.doc_id = d.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT * EXCLUDE (clean), NOT base_failed AND 100 * kept_chars >= 50 * word_chars AS kept, sha256(clean) AS clean_sha256 FROM b
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_maxscore": OP1, "op5_warc": OP5, "op8_neighbours": OP8, "op9_jaccard": OP9, "op13_linerules": _op13()}
