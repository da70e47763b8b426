"""The same results in DuckDB's SQL, where it can express them.

Without SQL: op3 (a seed may miss what a search of all alignments finds), op5 (approximate),
op8, op12 and op13 (tokens), op9 (offsets of matches), op10 (a trained network).
"""

from __future__ import annotations

SHARDS = [f"shard-{i:02d}" for i in range(16)]

_NUMBER = "CAST('0x' || md5({key})[1:15] AS BIGINT)"
_SLOTS = 2039

_SHARDING = f"""
WITH RECURSIVE shard AS (
  SELECT CAST(n AS INTEGER) AS id, 'shard-' || lpad(CAST(n AS VARCHAR), 2, '0') AS name
  FROM range({len(SHARDS)}) AS r(n)),
lists AS (
  SELECT list(l ORDER BY id) AS p
  FROM (SELECT id, [(o + j * s) % {_SLOTS} FOR j IN range({_SLOTS})] AS l
        FROM (SELECT id, {_NUMBER.format(key="name || '/offset'")} % {_SLOTS} AS o,
                     {_NUMBER.format(key="name || '/skip'")} % {_SLOTS - 1} + 1 AS s FROM shard))),
filled AS (
  SELECT 0 AS turn, [CAST(-1 AS INTEGER) FOR k IN range({_SLOTS})] AS held
  UNION ALL
  SELECT turn + 1,
         list_concat(list_concat(held[1:slot], [CAST(turn % {len(SHARDS)} AS INTEGER)]), held[slot + 2:])
  FROM (SELECT turn, held,
               p[turn % {len(SHARDS)} + 1][list_position([held[x + 1] FOR x IN p[turn % {len(SHARDS)} + 1]], -1)] AS slot
        FROM filled, lists WHERE turn < {_SLOTS}) AS t),
owner AS (SELECT held FROM filled WHERE turn = {_SLOTS})
SELECT doc_id, CAST(slot AS INTEGER) AS slot, 'shard-' || lpad(CAST(held[slot + 1] AS VARCHAR), 2, '0') AS shard
FROM (SELECT doc_id, {_NUMBER.format(key="CAST(doc_id AS VARCHAR)")} % {_SLOTS} AS slot FROM documents), owner"""
_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_URLS = f"""
WITH rule(host, path, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
judged AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), {_ASCII}), '') AS h,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS p
  FROM pages)
SELECT page_id, h AS host, p AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM (SELECT page_id, h, p, host || r.path AS rule, verdict,
             row_number() OVER (PARTITION BY page_id ORDER BY length(host || r.path) DESC NULLS LAST, length(host) DESC) AS nth
      FROM judged LEFT JOIN rule r
        ON (h = host OR ends_with(h, '.' || host)) AND starts_with(p, r.path))
WHERE nth = 1"""

_JACCARD = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_ASCII}), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
gram AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS g
  FROM worded),
sized AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN sized x ON a = x.doc_id JOIN sized y ON b = y.doc_id
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c AS component_id
FROM documents d LEFT JOIN sized USING (doc_id)
JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) ON a = d.doc_id"""

_BARE = "trim(x, ' ' || chr(9) || chr(13))"
_LINES = f"""
WITH page AS (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL),
total AS (SELECT source, count(*) AS n FROM page GROUP BY source),
line AS (
  SELECT DISTINCT source, text, unnest([{_BARE} FOR x IN string_split(text, chr(10))]) AS line FROM page),
common AS (
  SELECT c.source, c.line
  FROM (SELECT source, line, count(*) AS n FROM line WHERE line <> '' GROUP BY ALL) c
  JOIN total t ON c.source IS NOT DISTINCT FROM t.source
  WHERE c.n >= 5 AND c.n > CAST(0.1 AS DOUBLE) * t.n),
listed AS (SELECT source, list(line) AS lines FROM common GROUP BY source),
cut AS (
  SELECT doc_id, d.source, text, string_split(text, chr(10)) AS parts,
         [x FOR x IN string_split(text, chr(10)) IF lines IS NULL OR NOT list_contains(lines, {_BARE})] AS kept
  FROM documents d LEFT JOIN listed l ON d.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, source, CASE WHEN text IS NOT NULL THEN array_to_string(kept, chr(10)) END AS text,
       CAST(coalesce(len(parts) - len(kept), 0) AS BIGINT) AS lines_dropped
FROM cut"""

_ESCAPED = r"regexp_replace(replace({x}, '\', '\\'), '<\|', '<\\|', 'g')"
_CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, t, r, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)),
placed AS (
  SELECT *, {_ESCAPED.format(x="role")} AS er, {_ESCAPED.format(x="text")} AS et,
         row_number() OVER o AS nth, lag(role) OVER o AS before
  FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)),
sized AS (
  SELECT *, CASE WHEN nth > 1 AND role = before THEN 8
                 ELSE 16 + length(er) + 7 END AS lead FROM placed)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(lead + length(et)) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""

def _field(x: str) -> str:
    return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(x) for x in ('doc_id', 'source', 'lang', 'n_chars', text))})"


#: Eight steps of CRC-32 for one byte, lowest bit first.
_CRC_BYTE = "c"
for _ in range(8):
    _CRC_BYTE = f"list_transform([{_CRC_BYTE}], lambda v: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)[1]"

_MERKLE = f"""
WITH RECURSIVE row_leaf AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf, {_leaf("replace(text, chr(10), '')")} AS changed
  FROM documents),
crc AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS t, 0 AS k, CAST(4294967295 AS BIGINT) AS r
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, t, k + 1, (SELECT {_CRC_BYTE} FROM (SELECT xor(r, CAST(ascii(t[k + 1]) AS BIGINT)) AS c))
  FROM crc WHERE k < length(t)),
odd AS (SELECT doc_id FROM crc WHERE k = length(t) AND xor(r, 4294967295) % 2 = 0),
tree AS (
  SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM documents GROUP BY source),
placed AS (
  SELECT l.doc_id, l.leaf, CASE WHEN o.doc_id IS NOT NULL THEN changed ELSE leaf END AS start, tree, n,
         row_number() OVER (PARTITION BY tree ORDER BY l.doc_id NULLS FIRST, l.leaf) - 1 AS idx
  FROM row_leaf l JOIN tree t ON l.source IS NOT DISTINCT FROM t.source LEFT JOIN odd o ON l.doc_id = o.doc_id),
node AS (
  SELECT tree, n, CAST(0 AS BIGINT) AS level, CAST(idx AS BIGINT) AS idx, leaf AS h FROM placed
  UNION ALL
  SELECT tree, CAST(ceil(n / 3) AS BIGINT), level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM node WHERE n > 1 GROUP BY tree, n, level, idx // 3),
subroot AS (SELECT tree, h, count(*) OVER () AS trees FROM node WHERE n = 1),
over AS (
  SELECT trees AS n, CAST(0 AS BIGINT) AS level, CAST(tree AS BIGINT) AS idx, h FROM subroot
  UNION ALL
  SELECT CAST(ceil(n / 3) AS BIGINT), level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM over WHERE n > 1 GROUP BY n, level, idx // 3),
every AS (SELECT tree, n, level, idx, h FROM node UNION ALL SELECT -1, n, level, idx, h FROM over),
run AS (
  SELECT a.tree, a.n, a.level, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM every a JOIN every b ON a.tree = b.tree AND a.level = b.level AND a.idx // 3 = b.idx // 3
  WHERE a.n > 1 GROUP BY a.tree, a.n, a.level, a.idx),
walk AS (
  SELECT row_number() OVER () AS id, doc_id, leaf, tree AS home, CAST(tree AS BIGINT) AS tree, CAST(0 AS BIGINT) AS level,
         CAST(idx AS BIGINT) AS idx, n, start AS h, '' AS proof FROM placed
  UNION ALL
  SELECT w.id, w.doc_id, w.leaf, w.home,
         CASE WHEN w.n > 1 THEN w.tree ELSE -1 END,
         CASE WHEN w.n > 1 THEN w.level + 1 ELSE 0 END,
         CASE WHEN w.n > 1 THEN w.idx // 3 ELSE w.tree END,
         CASE WHEN w.n > 1 THEN CAST(ceil(w.n / 3) AS BIGINT) ELSE (SELECT max(trees) FROM subroot) END,
         CASE WHEN w.n > 1 THEN sha256(run.l || w.h || run.r) ELSE w.h END,
         CASE WHEN w.n > 1 THEN w.proof || run.l || run.r ELSE w.proof END
  FROM walk w LEFT JOIN run ON w.n > 1 AND run.tree = w.tree AND run.level = w.level AND run.idx = w.idx
  WHERE w.n > 1 OR w.tree >= 0),
top AS (SELECT h AS root FROM over WHERE n = 1)
SELECT doc_id, leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, w.h AS folded_root, w.h = root AS verified
FROM walk w JOIN subroot s ON s.tree = w.home, top WHERE w.tree = -1 AND w.n = 1"""

ORACLE: dict[str, str] = {
    "op1_sharding": _SHARDING,
    "op2_url_filters": _URLS,
    "op4_jaccard_join": _JACCARD,
    "op6_line_dedup": _LINES,
    "op7_chat_formatting": _CHAT,
    "op11_merkle_manifest": _MERKLE,
}
