"""SQL for the queries of this subpackage that SQL can state."""

#: ``op12_dual_tree`` without trees: every item's terms joined with all documents.
DUAL_TREE_SQL = r"""
WITH words AS (
  SELECT 0 AS kind, row_number() OVER () AS r, doc_id AS id,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS w
  FROM documents
  UNION ALL
  SELECT 1, row_number() OVER () AS r, item_id,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+'))
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
counts AS (SELECT kind, r, id, w, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM counts WHERE kind = 0 GROUP BY r),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
weights AS (
  SELECT w, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM counts, corpus WHERE kind = 0 GROUP BY w, docs),
impacts AS (
  SELECT r, id, w, weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total))) AS impact
  FROM counts JOIN lengths USING (r) JOIN weights USING (w), corpus WHERE kind = 0),
scores AS (
  SELECT i.r AS item, i.id AS item_id, d.r, d.id AS doc_id, CAST(sum(i.tf * impact) AS BIGINT) AS score
  FROM counts i JOIN impacts d USING (w) WHERE i.kind = 1 GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, r) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""

#: ``op13_conversation_repair`` without a search: row by row the cheapest edits that lead to each state, the least in
#: ASCII among them. The check sum goes through the bits of each byte.
REPAIR_SQL = r"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
fates AS (
  SELECT *, xor(4294967295, list_reduce(
    flatten(list_transform(string_split(name, ''), lambda c: [CAST(ord(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
    lambda a, x: CASE WHEN xor(a, x) & 1 = 1 THEN xor(xor(a, x) >> 1, 3988292384) ELSE xor(a, x) >> 1 END, 4294967295)) % 20 AS fate
  FROM given),
damaged AS (
  SELECT conv, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS copy FROM fates WHERE fate > 0),
numbered AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER (
    PARTITION BY conv ORDER BY turn NULLS FIRST, role, left(sha256(length(role) || ':' || role || text), 32), copy) AS i FROM damaged),
marked AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault,
    coalesce(lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS illegal,
    max(i) OVER (PARTITION BY conv) AS n FROM numbered),
-- states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant
inserts(q, letters, q2, put) AS (VALUES
  (0, '', 0, CAST([] AS VARCHAR[])), (0, 'I', 2, ['user:']), (0, 'II', 3, ['user:', 'assistant:']), (1, '', 1, []), (1, 'I', 2, ['user:']),
  (1, 'II', 3, ['user:', 'assistant:']), (2, '', 2, []), (2, 'I', 3, ['assistant:']), (3, '', 3, []), (3, 'I', 2, ['user:'])),
edits(q2, initial, letter, cost, q3, role) AS (VALUES
  (0, 's', 'K', 0, 1, NULL), (0, 'u', 'K', 0, 2, NULL), (1, 'u', 'K', 0, 2, NULL), (2, 'a', 'K', 0, 3, NULL), (3, 'u', 'K', 0, 2, NULL),
  (0, NULL, 'R', 2, 2, 'user'), (1, NULL, 'R', 2, 2, 'user'), (2, NULL, 'R', 2, 3, 'assistant'), (3, NULL, 'R', 2, 2, 'user'),
  (0, NULL, 'D', 3, 0, NULL), (1, NULL, 'D', 3, 1, NULL), (2, NULL, 'D', 3, 2, NULL), (3, NULL, 'D', 3, 3, NULL)),
ways(conv, i, q, cost, audit, told) AS (
  SELECT DISTINCT conv, CAST(0 AS BIGINT), 0, 0, '', CAST([] AS VARCHAR[]) FROM marked
  UNION ALL
  (SELECT w.conv, m.i, e.q3, w.cost + 2 * length(p.letters) + e.cost + CASE WHEN fault = 3 AND e.letter <> 'D' THEN 1 ELSE 0 END AS cost2,
     w.audit || p.letters || e.letter AS audit2,
     w.told || p.put || CASE WHEN e.letter = 'D' THEN CAST([] AS VARCHAR[]) ELSE [coalesce(e.role, m.role) || ':' || m.text] END
   FROM ways w JOIN marked m ON m.conv = w.conv AND m.i = w.i + 1 JOIN inserts p ON p.q = w.q
     JOIN edits e ON e.q2 = p.q2 AND (e.letter = 'D' OR fault NOT IN (1, 2)) AND (e.initial IS NULL OR e.initial = m.initial)
   QUALIFY row_number() OVER (PARTITION BY w.conv, e.q3 ORDER BY cost2, audit2) = 1)),
ended AS (
  SELECT w.conv, w.cost + 2 * length(letters) AS total, audit || letters AS edits, told || put AS told
  FROM ways w JOIN (SELECT DISTINCT conv, n FROM marked) USING (conv) JOIN inserts p ON p.q = w.q
  WHERE w.i = n AND (p.q2 = 3 OR w.q = 0 AND p.q2 = 0)
  QUALIFY row_number() OVER (PARTITION BY w.conv ORDER BY total, edits) = 1),
figures AS (
  SELECT conv, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (illegal) AS illegal FROM marked GROUP BY conv)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(total, 0) AS BIGINT) AS cost, coalesce(edits, '') AS audit,
  sha256(coalesce(array_to_string(told, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM given) LEFT JOIN figures USING (conv) LEFT JOIN ended USING (conv)
"""
