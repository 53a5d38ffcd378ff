"""DuckDB SQL of the registered queries that SQL can express.

The others have none: op2 (positions of matches, entropy windows), op3 and
op5 (tokenizers), op4 (a similarity join over all pairs is too slow as SQL),
op6 (a trained model), op7 and op11 (compression) and op10 (a hashed shuffle). Their
tests compare with brute force.
"""

# SHA-1 in base 32: 40-bit quarters of the hex digest, 5 bits a digit
_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         (CAST('0x' || substr(hex, CAST(1 + 10 * (i // 8) AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS BIGINT)) & 31
         AS BIGINT), 1)), '')"""



def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Rounds of assignment and floored means, unrolled."""
    steps = [f"""
whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cell AS (
  SELECT vec_id, part, list_slice(v, part * (len(v) // {parts}) + 1, (part + 1) * (len(v) // {parts})) AS p
  FROM whole, (SELECT unnest(range({parts})) AS part)),
book0 AS (
  SELECT part, entry, p AS e FROM cell
  JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM whole) USING (vec_id) WHERE entry < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS (
  SELECT vec_id, part, min_by(entry, (d, entry)) AS entry, min(d) AS d
  FROM (SELECT vec_id, c.part, entry,
               CAST(list_sum(list_transform(list_zip(p, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM cell c JOIN book{r} b ON b.part = c.part)
  GROUP BY vec_id, part)""")
        if r < rounds:
            steps.append(f"""
mean{r} AS (
  SELECT part, entry, list(m ORDER BY k) AS e
  FROM (SELECT part, entry, k, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
        FROM (SELECT part, entry, unnest(p) AS x, generate_subscripts(p, 1) AS k
              FROM near{r} JOIN cell USING (vec_id, part)) GROUP BY part, entry, k) GROUP BY part, entry),
book{r + 1} AS (
  SELECT part, entry, coalesce(m.e, b.e) AS e FROM book{r} b LEFT JOIN mean{r} m USING (part, entry))""")
    return "WITH " + ",".join(steps) + f""",
coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id),
digest AS (
  SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN whole USING (vec_id), digest"""


ORACLE: dict[str, str] = {
    "op12_vector_codes": _vector_codes(),
    # CRC-32 byte by byte through its table; near words share the text left when one code point goes
    "op13_spelling": r"""
WITH RECURSIVE bits AS (SELECT range AS b, CAST(range AS BIGINT) AS c, 0 AS k FROM range(256) UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
run AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS r FROM documents),
times AS (SELECT doc_id, r, count(*) AS n FROM run WHERE length(r) >= 5 GROUP BY doc_id, r),
hashed AS (
  SELECT r, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
           string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r, ''),
           lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [195, CAST(ord(c) - 64 AS BIGINT)] END))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM times, crc),
result AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, CAST(h % length(r) AS BIGINT)) || substr(r, CAST(h % length(r) + 2 AS BIGINT))
              ELSE r END AS word, n FROM hashed),
word AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM result WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
  SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS d
  FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS BIGINT) AS k FROM word)),
pair AS (
  SELECT a.word AS w, b.word AS v, b.n AS m FROM cut a JOIN cut b ON a.d = b.d AND a.k = b.k AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN word w ON w.word = c.d
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN word w ON w.word = c.d),
best AS (SELECT w, count(*) AS n_near, max(m) AS top, arg_min(v, (-m, v)) AS v FROM pair GROUP BY w),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * n THEN v END AS form,
         CASE WHEN top >= 2 * n THEN top END AS form_n FROM word LEFT JOIN best ON w = word),
chain AS (
  SELECT word, word AS stop, form AS onward FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.onward)
SELECT word, form, stop AS root, n, n_near, form_n FROM formed JOIN chain USING (word) WHERE onward IS NULL""",
    "op1_warc": f"""
WITH payload AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
kept AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex, max(page_id) OVER (PARTITION BY body) AS keeper
         FROM payload)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM kept""",
    "op8_near_vector": """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
   AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
class AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM class LEFT JOIN degree USING (vec_id)""",
    "op9_top_k": """
WITH quantized AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM quantized q JOIN quantized c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) r
WHERE rank <= 20""",
}
