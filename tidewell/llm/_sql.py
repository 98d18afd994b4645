"""DuckDB SQL of the operators 11 to 13."""

_ROUND = """, d{0} AS (
  SELECT rid, min({{'d': CAST(list_sum(list_transform(range(1, 65), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i]))) AS BIGINT), 'k': c.k}}) AS m
  FROM v, c{0} c GROUP BY rid
)"""
_MOVE = """, c{1} AS (
  SELECT c.k, coalesce(s.e, c.e) AS e
  FROM c{0} c LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS e
    FROM (SELECT m.k AS k, i, CAST(sum(v.e[i]) AS BIGINT) AS s, count(*) AS n FROM d{0} d JOIN v ON v.rid = d.rid, range(1, 65) r(i) GROUP BY m.k, i)
    GROUP BY k
  ) s ON s.k = c.k
)"""
LLOYD = (
    r"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, sha256('2:' || vec_id) AS h, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY h, e) - 1 AS k, e FROM (SELECT h, e FROM v ORDER BY h NULLS LAST, e LIMIT 40)
)"""
    + "".join(_ROUND.format(i) + _MOVE.format(i, i + 1) for i in range(5))
    + _ROUND.format(5)
    + r"""
SELECT v.vec_id, CAST(d.m.k AS INTEGER) AS cluster, d.m.d AS distance,
       CAST(sum(d.m.d) OVER (PARTITION BY d.m.k) AS BIGINT) AS cluster_inertia, CAST(sum(d.m.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM d5 d JOIN v ON v.rid = d.rid JOIN c5 c ON c.k = d.m.k
"""
)

#: DuckDB compares bytes: the 64 letters beyond ASCII stand for one byte each, none of which a lower-cased word has.
_BYTES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_`{|}"
_ONE_BYTE = f"translate(word, '{''.join(map(chr, range(0xC0, 0x100)))}', '{_BYTES}')"
#: crc32 goes byte by byte through the usual table, here made by eight steps of the reversed polynomial.
SPELLING = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, CAST(b AS BIGINT))) AS t
), runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
  )
  GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_transform(range(CAST(len(hx) / 2 AS BIGINT)), lambda i: CAST('0x' || substr(hx, 2 * i + 1, 2) AS BIGINT)),
                                             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) AS h
  FROM (SELECT run, n, hex(encode(doc_id || ':' || run)) AS hx FROM runs), crc
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM hashed
  )
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), plain AS (
  SELECT word, n, ONE_BYTE AS w FROM words
), near AS (
  SELECT a.word, b.word AS other, b.n
  FROM plain a JOIN plain b ON length(b.w) BETWEEN length(a.w) - 1 AND length(a.w) + 1 AND a.w <> b.w AND levenshtein(a.w, b.w) = 1
), best AS (
  SELECT word, count(*) AS n_near, min({'n': -n, 'w': other}) AS b FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.n >= 10 * w.n THEN b.w END AS form, CASE WHEN -b.n >= 10 * w.n THEN -b.n END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word
), chain AS (
  SELECT word, word AS root, form AS following FROM formed
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.following
)
SELECT f.word, f.form, c.root, f.n, f.n_near, CAST(f.form_n AS BIGINT) AS form_n FROM formed f JOIN chain c ON c.word = f.word AND c.following IS NULL
""".replace("ONE_BYTE", _ONE_BYTE)

#: Bytes are pairs of hexadecimal digits here; windows are told apart by md5.
RUN_INDEX = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT doc_id, p, md5(substr(hx, 2 * p + 1, 200)) AS k FROM (SELECT doc_id, hx, unnest(range(greatest(n - 99, 0))) AS p FROM d)
), r AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS i FROM w) WHERE i > 1
), g AS (
  SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS g
  FROM (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS opens FROM r)
), s AS (
  SELECT doc_id, min(p) AS a, max(p) + 100 AS b, lag(max(p) + 100, 1, 0) OVER (PARTITION BY doc_id ORDER BY g) AS before FROM g GROUP BY doc_id, g
), k AS (
  SELECT s.doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last, string_agg(substr(hx, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM s JOIN d ON d.doc_id = s.doc_id GROUP BY s.doc_id
)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(hx, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""
