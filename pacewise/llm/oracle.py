"""DuckDB SQL of the operators' queries, where SQL can state the result over whole tables.

None for the others: tokenizers (1, 6), HTML parsing (7), sketches (3), word rules on code points with
counted windows plus a trained model (10), and control-string escapes, whose patterns need look-ahead (9), are
held against brute force in tests/llm instead, as are 2 and 8, whose window searches SQL can only do as
joins of every window with every item.
"""

_SUBSTRING = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS first FROM g),
c AS (SELECT DISTINCT doc_id, i + j AS p FROM (SELECT doc_id, i, unnest(range(13)) AS j FROM m WHERE first < doc_id)),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT x.doc_id, count(c.p) AS gone, string_agg(x.word, ' ' ORDER BY x.p) FILTER (WHERE c.p IS NULL) AS kept
      FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.p = c.p GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(k.gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

_LINES = r"""
WITH d AS (SELECT doc_id, text, CASE WHEN length(text) > 0 THEN string_split(text, chr(10)) ELSE [] END AS l FROM documents),
x AS (SELECT doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS p FROM d),
w AS (SELECT doc_id, p, line AS a, lead(line, 1) OVER o AS b, lead(line, 2) OVER o AS c FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p) AS n FROM w
      WHERE c IS NOT NULL AND regexp_matches(a || b || c, '[^\x20\x09-\x0D]')),
g AS (SELECT DISTINCT doc_id, p + j AS p FROM (SELECT doc_id, p, unnest(range(3)) AS j FROM r WHERE n > 1)),
k AS (SELECT x.doc_id, count(g.p) AS gone, string_agg(x.line, chr(10) ORDER BY x.p) FILTER (WHERE g.p IS NULL) AS kept
      FROM x LEFT JOIN g ON x.doc_id = g.doc_id AND x.p = g.p GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(d.l) AS BIGINT) AS n_lines, CAST(coalesce(k.gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS text_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

ORACLE_SQL: dict[str, str] = {"op4_substring": _SUBSTRING, "op5_linededup": _LINES}
