"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOW = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

LINE_DEDUP = rf"""
WITH L AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line
           FROM documents WHERE text IS NOT NULL),
W AS (SELECT doc_id, line, regexp_extract_all(translate(t, '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM L),
T AS (SELECT DISTINCT doc_id, line, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS token FROM W WHERE len(w) > 0),
N AS (SELECT doc_id, line, count(*) AS n FROM T GROUP BY ALL),
P AS (SELECT x.doc_id, x.line, y.doc_id AS d, y.line AS l, count(*) AS shared FROM T x JOIN T y ON x.token = y.token
      WHERE y.doc_id < x.doc_id OR y.doc_id = x.doc_id AND y.line < x.line GROUP BY ALL),
G AS (SELECT DISTINCT P.doc_id, P.line FROM P JOIN N a ON a.doc_id = P.doc_id AND a.line = P.line JOIN N b ON b.doc_id = P.d AND b.line = P.l
      WHERE 100 * shared >= 80 * (a.n + b.n - shared)),
R AS (SELECT doc_id, count(*) AS n, string_agg(line::VARCHAR, ',' ORDER BY line) AS lines FROM G GROUP BY doc_id)
SELECT documents.doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END::BIGINT AS n_lines,
  coalesce(R.n, 0)::BIGINT AS n_removed, coalesce(R.lines, '') AS removed_lines
FROM documents LEFT JOIN R ON R.doc_id = documents.doc_id
"""

DECONTAMINATE = rf"""
WITH D AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
B AS (SELECT item_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
I AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS phrase
      FROM B WHERE len(w) > 0),
S AS (SELECT DISTINCT n FROM I),
V AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos, w FROM D, S WHERE len(w) >= n),
M AS (SELECT V.doc_id, V.pos, V.n, I.item_id FROM V JOIN I ON I.n = V.n AND I.phrase = array_to_string(V.w[V.pos:V.pos + V.n - 1], ' ')),
H AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM M) GROUP BY doc_id),
K AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM M) GROUP BY doc_id)
SELECT D.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM D LEFT JOIN H ON H.doc_id = D.doc_id LEFT JOIN K ON K.doc_id = D.doc_id
"""

NEAR_DUP = rf"""
WITH RECURSIVE D AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
T AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) AS s FROM D WHERE len(w) > 0),
N AS (SELECT doc_id, count(*) AS n FROM T GROUP BY doc_id),
P AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM T x JOIN T y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
E AS (SELECT a, b FROM P JOIN N x ON x.doc_id = a JOIN N y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
R(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT R.a, E.b FROM R JOIN E ON E.a = R.b),
C AS (SELECT a, min(b) AS component_id FROM R GROUP BY a)
SELECT D.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, D.doc_id = component_id AS kept
FROM D JOIN C ON C.a = D.doc_id LEFT JOIN N ON N.doc_id = D.doc_id
"""


LEXICAL = rf"""
WITH W AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
S AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_words FROM W WHERE len(w) > 0),
U AS (SELECT DISTINCT item_id, text FROM benchmark),
I AS (SELECT item_id, term, count(*) AS asked FROM (SELECT item_id, unnest(regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM U) GROUP BY ALL),
T AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM W)
      WHERE term IN (SELECT term FROM I) GROUP BY ALL),
F AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM T, S GROUP BY term),
P AS (SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_words))) AS impact FROM T, S),
X AS (SELECT item_id, r, any_value(doc_id) AS doc_id, sum(asked * weight * impact)::BIGINT AS score FROM I JOIN F USING (term) JOIN P USING (term) GROUP BY item_id, r),
R AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM X WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM R WHERE rank <= 20
"""


def chat_sql(control: list[str]) -> str:
    """Lengths of the template's marks: <s> 3, <|turn|> 8, <|text|> 8, </s> 4."""
    escaped = "".join("\\" + c if c in "<>[]|/()" else c for c in "\x00".join(sorted(control, key=len, reverse=True)))
    pattern = escaped.replace("\x00", "|")
    size = f"len({{c}}) + len({{c}}) - len(replace({{c}}, chr(92), '')) + len(regexp_extract_all({{c}}, '{pattern}'))"
    return f"""
WITH C AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
T AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM C),
G AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
  coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS loss,
  3 + sum(20 + {size.format(c='role')} + {size.format(c='text')}) AS formatted_chars FROM T GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(turns) AS turns_sha256, len(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars::BIGINT AS formatted_chars FROM G
"""


WARC = """
WITH P AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
H AS (SELECT page_id, strlen(html) AS n, sha1(html) || '0' AS hex, max(page_id) OVER (PARTITION BY html) AS last FROM P)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((
      (strpos('0123456789abcdef', substr(hex, (5 * i) // 4 + 1, 1)) - 1) * 16 + strpos('0123456789abcdef', substr(hex, (5 * i) // 4 + 2, 1)) - 1)
      >> (3 - (5 * i) % 4)) & 31)::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM H
"""
