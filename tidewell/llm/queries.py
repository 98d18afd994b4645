"""The registered queries of the corpus operators, and DuckDB SQL where it can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _sql, bpe, katz, langid, lloyd, near_dup, order_minhash, packing, quality, run_index, spelling, token_orc, topk, toxicity
from ._shared import read_table, shared_dir


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), ids=False)


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(read_table(spark, sf_dir, "documents"))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(read_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), width=2, percent=80)


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read_table(spark, sf_dir, "embeddings"))


def op8_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    out = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    token_orc.write_tokens(read_table(spark, sf_dir, "documents"), out, tokenizer_path("word_bpe_49k.json"))
    tokens = token_orc.read_tokens(spark, out)
    return token_orc.with_starts(token_orc.token_digests(tokens), tokens).select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), ids=False)


def op11_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.cluster(read_table(spark, sf_dir, "embeddings"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def op13_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_index.dedup(read_table(spark, sf_dir, "documents"), texts=False)


QUERIES = {
    f.__name__: f
    for f in (op1_pack, op2_katz, op3_order_minhash, op4_quality, op5_near_dup, op6_langid, op7_topk, op8_token_orc, op9_toxicity, op10_bpe, op11_lloyd, op12_spelling, op13_run_index)
}

_TOPK_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

_NEAR_DUP_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 2 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])
                                      WHEN len(ws) = 1 THEN [ws[1]] ELSE [] END) AS s
  FROM w
), n AS (
  SELECT w.doc_id, CAST(count(sh.s) AS BIGINT) AS n FROM w LEFT JOIN sh ON sh.doc_id = w.doc_id GROUP BY w.doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE 100 * least(na.n, nb.n) >= 80 * greatest(na.n, nb.n)
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM n
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), c AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept FROM n JOIN c ON c.doc_id = n.doc_id
"""

SQL = {"op5_near_dup": _NEAR_DUP_SQL, "op7_topk": _TOPK_SQL, "op11_lloyd": _sql.LLOYD, "op12_spelling": _sql.SPELLING, "op13_run_index": _sql.RUN_INDEX}
