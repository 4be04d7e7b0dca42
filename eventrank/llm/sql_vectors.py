"""SQL for the results of the operators on vectors and on spelling."""

NEIGHBOURS = """
WITH kept AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pair AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM kept q JOIN kept c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pair)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM placed WHERE rank <= 10"""


def _vector_codes(rounds: int = 4, entries: int = 256, parts: int = 4) -> str:
    """Assignment and replacement of codebook entries, written out round by round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT row, part, (b).d AS d, (b).entry AS entry FROM (
    SELECT row, p.part, min({{'d': list_sum(list_transform(list_zip(p.z, c.z), lambda q: (q[1] - q[2]) * (q[1] - q[2]))),
      'entry': entry}}) AS b
    FROM part p JOIN book{r} c USING (part) GROUP BY row, p.part))""")
        if r < rounds:
            steps.append(f"""
book{r + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(n.z, book{r}.z) AS z FROM book{r} LEFT JOIN (
    SELECT part, entry, list((s - ((s % c) + c) % c) // c ORDER BY i) AS z FROM (
      SELECT part, entry, i, sum(x) AS s, count(*) AS c
      FROM (SELECT part, entry, unnest(z) AS x, unnest(range(len(z))) AS i FROM near{r} JOIN part USING (row, part))
      GROUP BY part, entry, i) GROUP BY part, entry) n USING (part, entry))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (
  SELECT row, part, z[part * (len(z) // {parts}) + 1:(part + 1) * (len(z) // {parts})] AS z
  FROM kept, (SELECT unnest(range({parts})) AS part)),
book0 AS MATERIALIZED (SELECT part, row - 1 AS entry, z FROM part WHERE row <= {entries}),{",".join(steps)},
code AS (
  SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM near{rounds} GROUP BY row),
books AS (
  SELECT sha256(string_agg(array_to_string(z, ','), ',' ORDER BY part, entry)) AS sha FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256
FROM kept JOIN code USING (row), books"""


VECTOR_CODES = _vector_codes()

def _crc_nibbles() -> str:
    """Remainders of the 16 half-bytes under the reversed CRC-32 polynomial."""
    out = []
    for x in range(16):
        for _ in range(4):
            x = (x >> 1) ^ (0xEDB88320 if x & 1 else 0)
        out.append(x)
    return str(out)


SPELLING = f"""
WITH RECURSIVE run AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-z\u00c0-\u00ff]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run),
hashed AS MATERIALIZED (
  SELECT run, times, CASE WHEN doc_id IS NULL THEN 1 ELSE xor(4294967295, list_reduce(
    list_transform(range(0, length(h)),
      lambda i: CAST('0x' || substr(h, CAST(CASE WHEN i % 2 = 0 THEN i + 2 ELSE i END AS BIGINT), 1) AS BIGINT)),
    lambda c, d: xor(({_crc_nibbles()}::BIGINT[])[(xor(c, d) & 15) + 1], c >> 4), 4294967295)) END AS h
  FROM (SELECT *, hex(encode(doc_id || ':' || run)) AS h FROM run)),
word AS MATERIALIZED (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % 199 = 0
      THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
short AS MATERIALIZED (
  SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM word)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n FROM short a JOIN short b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT s.word, w.word, w.n FROM short s JOIN word w ON s.rest = w.word
  UNION
  SELECT w.word, s.word, s.n FROM short s JOIN word w ON s.rest = w.word),
best AS MATERIALIZED (
  SELECT word, count(*) AS n_near, max(n) AS top, arg_min(other, (-n, other)) AS other FROM near GROUP BY word),
form AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * n THEN other END AS form, CASE WHEN top >= 5 * n THEN top END AS form_n
  FROM word LEFT JOIN best USING (word)),
up AS (
  SELECT word, word AS root FROM form
  UNION ALL
  SELECT up.word, form.form FROM up JOIN form ON form.word = up.root WHERE form.form IS NOT NULL)
SELECT form.word, form.form, up.root, form.n, form.n_near, form.form_n
FROM form JOIN up USING (word) JOIN form last ON last.word = up.root AND last.form IS NULL"""

EXPECTED = {
    "op11_spelling_variants": SPELLING,
    "op12_nearest_neighbours": NEIGHBOURS,
    "op13_vector_codes": VECTOR_CODES,
}
