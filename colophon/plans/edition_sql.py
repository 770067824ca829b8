"""DuckDB SQL for the scan of marked documents: by windows over marks and tokens, where Spark goes over each document once."""

from __future__ import annotations

from colophon.functions.lexicon import quoted, table

from . import edition

SPACE = r"\s\x0B\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
STOP = rf"{SPACE},;:.?!\[\]()\-&\x01"
LEX = rf"&amp;|&|[\[\]()]|[,;:?!]|\.\.\.|\.|[^{STOP}]+(?:-[^{STOP}]+)*"
KIND = "CASE WHEN x IN ('&', '&amp;') THEN 'amp' WHEN x IN ('[', ']', '(', ')', ',', ';', ':', '?', '!') THEN 'pc' WHEN x IN ('.', '...') THEN 'dot' ELSE 'word' END"
DOTTED, SEMICOLONS = quoted(table("dotted")), quoted(table("semicolons"))
MERGES = f"""coalesce(kind = 'word' AND NOT regexp_full_match(x, '[0-9]+') AND ((yk = 'dot' AND (x || '.' IN ({DOTTED}) OR lower(x || '.') IN ({DOTTED}))) OR (y = ';' AND (x || ';' IN ({SEMICOLONS}) OR lower(x || ';') IN ({SEMICOLONS})))), false)"""
MARK = r"¶|\x01|@@|@|\*"


def lines(marks: bool) -> str:
    return rf"""
src AS MATERIALIZED ({edition.sql(marks)}),
l0 AS (SELECT r, doc_id, unnest(range(1, len(ls) + 1))::INTEGER AS line_n, regexp_replace(unnest(ls), '^[{SPACE}]+|[{SPACE}]+$', '', 'g') AS t FROM (SELECT r, doc_id, string_split(text, chr(10)) AS ls FROM src)),
l1 AS (SELECT * FROM l0 WHERE t <> ''),
l AS MATERIALIZED (SELECT r, doc_id, line_n, regexp_replace(t, '[{SPACE}]*¬$', '') AS text, suffix(t, '¬') AS soft_hyphen FROM l1)"""


#: t: tokens of unmarked lines, before words are joined
PLAIN_TOKENS = lines(False) + rf""",
t0 AS (SELECT r, doc_id, line_n, unnest(range(1, len(a) + 1)) AS i, unnest(a) AS x FROM (SELECT r, doc_id, line_n, regexp_extract_all(text, '{LEX}') AS a FROM l)),
t1 AS (SELECT *, {KIND} AS kind, lead(x) OVER w AS y FROM t0 WINDOW w AS (PARTITION BY r, line_n ORDER BY i)),
t2 AS (SELECT *, lead(kind) OVER (PARTITION BY r, line_n ORDER BY i) AS yk FROM t1),
t3 AS (SELECT *, {MERGES} AS m FROM t2),
t4 AS (SELECT *, coalesce(lag(m) OVER (PARTITION BY r, line_n ORDER BY i), false) AS gone FROM t3),
t AS MATERIALIZED (SELECT r, doc_id, line_n, row_number() OVER (PARTITION BY r, line_n ORDER BY i)::INTEGER AS tok_n, CASE WHEN m THEN 'abbrev_dot' ELSE kind END AS kind,
  CASE WHEN m THEN x || (CASE WHEN y = ';' THEN ';' ELSE '.' END) ELSE x END AS text FROM t4 WHERE NOT gone)"""

#: k: tokens of marked documents, as scan.tokens
TOKENS = lines(True) + rf""",
l2 AS (SELECT r, doc_id, line_n, t, replace(t, '//', chr(1)) AS u FROM l1),
l3 AS (SELECT *, regexp_replace(u, '[¶@*]', '', 'g') AS cb FROM l2),
l4 AS (SELECT *, regexp_matches(replace(cb, chr(1), ''), '¬[{SPACE}]*$') AS hyphen, contains(t, '¶') AS mark FROM l3),
l5 AS (SELECT *, CASE WHEN hyphen THEN regexp_replace(cb, '¬([{SPACE}\x01]*)$', '\1') ELSE cb END AS body FROM l4),
l6 AS (SELECT *, regexp_matches(body, '[^{SPACE}\x01]') AS full_ FROM l5),
l7 AS (SELECT *, full_ AND mark AND count(*) FILTER (full_) OVER (PARTITION BY r ORDER BY line_n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 0 AS starts FROM l6),
l8 AS MATERIALIZED (SELECT *, (1 + sum(starts::INTEGER) OVER (PARTITION BY r ORDER BY line_n))::INTEGER AS para_id FROM l7),
nx AS (SELECT r, line_n, CASE WHEN lead(starts) OVER w THEN NULL ELSE lead(line_n) OVER w END AS next_n FROM l8 WHERE full_ WINDOW w AS (PARTITION BY r ORDER BY line_n)),
mk AS (SELECT r, line_n, para_id, unnest(range(1, len(ms) + 1)) AS seq, unnest(ms) AS m, ps FROM (SELECT r, line_n, para_id, regexp_extract_all(u, '{MARK}') AS ms, string_split_regex(u, '{MARK}') AS ps FROM l8) WHERE len(ms) > 0),
lx AS (SELECT r, line_n, para_id, unnest(range(1, len(a) + 1)) AS i, unnest(a) AS x FROM (SELECT r, line_n, para_id, regexp_extract_all(body, '{LEX}|\x01|[^\x01]') AS a FROM l8 WHERE full_)),
l9 AS (SELECT *, coalesce(sum(CASE WHEN x = chr(1) THEN 0 ELSE length(x) END) OVER (PARTITION BY r, line_n ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INTEGER AS start,
  sum((x = chr(1))::INTEGER) OVER (PARTITION BY r, line_n ORDER BY i) AS piece FROM lx),
u0 AS (SELECT *, {KIND} AS kind, lead(x) OVER w AS y FROM l9 WHERE regexp_full_match(x, '{LEX}') WINDOW w AS (PARTITION BY r, line_n, piece ORDER BY i)),
u1 AS (SELECT *, lead(kind) OVER (PARTITION BY r, line_n, piece ORDER BY i) AS yk FROM u0),
u2 AS (SELECT *, {MERGES} AS m FROM u1),
u3 AS (SELECT *, coalesce(lag(m) OVER (PARTITION BY r, line_n, piece ORDER BY i), false) AS gone FROM u2),
u AS (SELECT r, line_n, para_id, i, start, CASE WHEN m THEN 'abbrev_dot' ELSE kind END AS kind, CASE WHEN m THEN x || (CASE WHEN y = ';' THEN ';' ELSE '.' END) ELSE x END AS text FROM u3 WHERE NOT gone),
ev AS (
  SELECT r, line_n, para_id, start AS pos, 1 AS o, i AS seq, NULL AS m, kind, text FROM u
  UNION ALL SELECT r, line_n, para_id, length(array_to_string(ps[1:seq], '')), 0, seq, m, NULL, NULL FROM mk
  UNION ALL SELECT r, line_n, para_id, -1, 0, 0, 'P', NULL, NULL FROM l8 WHERE starts),
e1 AS (SELECT *, coalesce(sum((m = '*')::INTEGER) OVER w, 0) AS stars, coalesce(sum((m = '*')::INTEGER) OVER (PARTITION BY r), 0) AS all_stars,
    coalesce(sum((m IN ('@', '@@'))::INTEGER) OVER w, 0) AS signs, coalesce(sum((m IN ('@', '@@'))::INTEGER) OVER (PARTITION BY r), 0) AS all_signs,
    coalesce(sum((m = '@@')::INTEGER) OVER w, 0) AS seg, coalesce(sum((m IN ('P', chr(1)))::INTEGER) OVER w, 0) AS breaks
  FROM ev WINDOW w AS (PARTITION BY r ORDER BY line_n, pos, o, seq)),
e2 AS (SELECT *, (coalesce(sum((m = '@')::INTEGER) OVER (PARTITION BY r, seg ORDER BY line_n, pos, o, seq), 0) + (seg > 0)::INTEGER) % 2 = 1 AS open_ FROM e1),
e3 AS (SELECT *, coalesce(sum((m IN ('@', '@@') AND open_)::INTEGER) OVER w, 0) + max((m = 'P' AND open_ AND signs < all_signs)::INTEGER) OVER (PARTITION BY r, para_id) AS nth
  FROM e2 WINDOW w AS (PARTITION BY r, para_id ORDER BY line_n, pos, o, seq)),
v0 AS (SELECT r, line_n, para_id, pos AS start, seq, kind, text, dense_rank() OVER (PARTITION BY r ORDER BY breaks)::INTEGER AS sent_id, stars % 2 = 1 AND stars < all_stars AS italic,
    (CASE WHEN open_ AND signs < all_signs THEN coalesce(nth, 0) ELSE 0 END)::INTEGER AS bibl_id FROM e3 WHERE o = 1),
v1 AS (SELECT *, row_number() OVER (PARTITION BY r, line_n ORDER BY start DESC, seq DESC) = 1 AS last_, row_number() OVER (PARTITION BY r, para_id ORDER BY line_n, start, seq) = 1 AS first_, row_number() OVER (PARTITION BY r ORDER BY line_n, start, seq) AS n0 FROM v0),
v2 AS (SELECT v1.*, CASE WHEN last_ AND NOT hyphen THEN next_n END AS eol0, CASE WHEN last_ AND hyphen THEN next_n END AS split FROM v1 JOIN l8 USING (r, line_n) LEFT JOIN nx USING (r, line_n)),
v3 AS (SELECT *, coalesce(split IS NOT NULL AND kind = 'word' AND lead(kind) OVER w = 'word' AND lead(sent_id) OVER w = sent_id, false) AS can FROM v2 WINDOW w AS (PARTITION BY r ORDER BY n0)),
v4 AS (SELECT *, n0 - row_number() OVER (PARTITION BY r, can ORDER BY n0) AS island FROM v3),
v5 AS (SELECT *, can AND row_number() OVER (PARTITION BY r, can, island ORDER BY n0) % 2 = 1 AS joins FROM v4),
v6 AS (SELECT *, lead(text) OVER w AS right_, lead(coalesce(eol0, split)) OVER w AS right_eol, coalesce(lag(joins) OVER w, false) AS gone FROM v5 WINDOW w AS (PARTITION BY r ORDER BY n0)),
k AS MATERIALIZED (SELECT r, doc_id, line_n, row_number() OVER (PARTITION BY r ORDER BY n0)::INTEGER AS tok_n, start, CASE WHEN joins THEN 'word_lb' ELSE kind END AS kind, CASE WHEN joins THEN text || right_ ELSE text END AS text,
    CASE WHEN joins THEN length(text) END::INTEGER AS left_len, para_id, sent_id, italic, bibl_id, CASE WHEN first_ THEN v6.line_n END AS sol_n, CASE WHEN joins THEN right_eol ELSE coalesce(eol0, split) END AS eol_n, CASE WHEN joins THEN split END AS lb_n, NULL::VARCHAR AS expansion
  FROM v6 JOIN (SELECT r, doc_id FROM src) USING (r) WHERE NOT gone)"""
