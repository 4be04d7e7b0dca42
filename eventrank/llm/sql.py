"""SQL for the results of the operators that SQL can state."""

DECONTAMINATION = """
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (
  SELECT DISTINCT item, w[i:i + least(len(w), 13) - 1] AS g, least(len(w), 13) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
places AS (
  SELECT r, n, i, w[i:i + n - 1] AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n)),
found AS (SELECT r, places.n, i, item FROM places JOIN win ON win.g = places.g),
hit AS (SELECT r, count(DISTINCT p) AS n_hit
        FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN items USING (r)"""

NEAR_DUPLICATES = """
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, w[i:least(i + 2, len(w))] AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM doc
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT reach.a AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id, reach.a = min(b) AS kept
FROM reach LEFT JOIN size ON size.doc_id = reach.a GROUP BY reach.a"""

LINE_DEDUP = """
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS x FROM documents),
line AS (
  SELECT doc_id, nr, row_number() OVER (PARTITION BY doc_id ORDER BY nr) - 1 AS pos,
    CAST('0x' || substr(md5(line), 1, 15) AS BIGINT) AS key, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM (SELECT doc_id, nr, trim(x[nr + 1], ' ' || chr(9) || chr(13)) AS line
        FROM (SELECT doc_id, x, unnest(range(len(x))) AS nr FROM split))
  WHERE line <> ''),
gram AS (
  SELECT doc_id, pos, CAST('0x' || substr(md5(key || ',' || next), 1, 15) AS BIGINT) AS print, words
  FROM (SELECT doc_id, pos, key, lead(key) OVER w AS next, words + lead(words) OVER w AS words
        FROM line WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
  WHERE next IS NOT NULL),
long AS (
  SELECT doc_id, pos, print FROM gram WHERE words >= 50
  UNION ALL
  SELECT doc_id, pos, CAST('0x' || substr(md5(key::VARCHAR), 1, 15) AS BIGINT) FROM line WHERE words >= 50),
slid AS (
  SELECT *, lead(print) OVER w AS next, row_number() OVER w AS r FROM gram WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
chosen AS (
  SELECT DISTINCT doc_id, CASE WHEN next <= print THEN pos + 1 ELSE pos END AS pos, least(print, next) AS print
  FROM slid WHERE next IS NOT NULL OR r = 1
  UNION
  SELECT doc_id, pos, print FROM long),
placed AS (SELECT *, lag(pos) OVER (PARTITION BY doc_id, print ORDER BY pos) AS before FROM chosen),
first AS (
  SELECT print, min((doc_id, pos)) AS f FROM placed WHERE before IS NULL GROUP BY print HAVING count(*) > 1),
found AS (
  SELECT doc_id, pos, doc_id AS doc0, pos - before AS shift FROM placed WHERE before IS NOT NULL
  UNION
  SELECT doc_id, pos, f[1], pos - f[2] FROM placed JOIN first USING (print) WHERE before IS NULL AND f[1] <> doc_id),
same AS (
  SELECT d.doc_id, d.doc0, d.shift, a.pos, a.nr
  FROM (SELECT DISTINCT doc_id, doc0, shift FROM found) d JOIN line a ON a.doc_id = d.doc_id
  JOIN line b ON b.doc_id = d.doc0 AND b.pos = a.pos - d.shift AND b.key = a.key),
run AS (
  SELECT s.*, s.pos - row_number() OVER (PARTITION BY doc_id, doc0, shift ORDER BY pos) AS island, f.pos IS NOT NULL AS hit
  FROM same s LEFT JOIN found f USING (doc_id, doc0, shift, pos)),
gone AS (
  SELECT DISTINCT doc_id, min(nr)::INTEGER AS a, max(nr)::INTEGER AS z FROM run
  GROUP BY doc_id, doc0, shift, island HAVING bool_or(hit)),
runs AS (SELECT doc_id, string_agg(a || '-' || z, ',' ORDER BY a, z) AS removed FROM gone GROUP BY doc_id),
deleted AS (SELECT DISTINCT doc_id, unnest(range(a, z + 1)) AS nr FROM gone),
kept AS (
  SELECT p.doc_id, string_agg(x, chr(10) ORDER BY p.nr) AS text
  FROM (SELECT doc_id, unnest(range(len(x))) AS nr, unnest(x) AS x FROM split) p
  LEFT JOIN deleted d ON d.doc_id = p.doc_id AND d.nr = p.nr WHERE d.nr IS NULL GROUP BY p.doc_id)
SELECT s.doc_id, CASE WHEN s.text IS NULL THEN 0 ELSE len(s.x) END::INTEGER AS n_lines, coalesce(r.removed, '') AS removed,
  CASE WHEN s.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM split s LEFT JOIN runs r USING (doc_id) LEFT JOIN kept k USING (doc_id)"""

SUBSTRING_DEDUP = """
WITH piece AS (
  SELECT doc_id, i, x[i] AS raw, list_sum([len(z) + 1 for z in x[1:i - 1]]) AS before
  FROM (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS i
        FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?]) ', '\\1' || chr(10), 'g'), chr(10)) AS x
              FROM documents))),
worded AS (
  SELECT doc_id, i, raw, coalesce(before, 0) AS before,
    regexp_extract_all(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x20\\x09-\\x0D]+') AS w
  FROM piece),
unit AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS unit, array_to_string(w, ' ') AS norm,
    len(w) AS n_words, before + len(regexp_extract(raw, '^[\\x20\\x09-\\x0D]*')) AS "start",
    before + len(regexp_replace(raw, '[\\x20\\x09-\\x0D]+$', '')) AS "end"
  FROM worded WHERE len(w) > 0),
first AS (SELECT norm, min((doc_id, "start")) AS f FROM unit GROUP BY norm HAVING count(*) > 1),
later AS (SELECT unit.*, f[1] AS first_doc FROM unit JOIN first USING (norm) WHERE (doc_id, "start") <> f),
island AS (SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS island FROM later)
SELECT doc_id, min("start")::BIGINT AS "start", max("end")::BIGINT AS "end", count(*) AS n_units,
  sum(n_words)::BIGINT AS n_words, arg_min(first_doc, unit) AS first_doc_id
FROM island GROUP BY doc_id, island HAVING sum(n_words) >= 25"""

EXPECTED = {
    "op1_decontamination": DECONTAMINATION,
    "op6_substring_dedup": SUBSTRING_DEDUP,
    "op7_near_duplicates": NEAR_DUPLICATES,
    "op8_line_dedup": LINE_DEDUP,
}
