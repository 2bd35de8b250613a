"""Queries of the operators of this folder, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from hydrolake.llm import (alignment, bestfit, centroids, decontaminate, langid, licenses, packing, quality, shards,
                           simhash, substrings, tokenfiles, topk)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op10_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        with_ids=False).drop("ids")


@query
def op8_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component of near copies."""
    return simhash.classes(table(spark, sf_dir, "documents"))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 13-word windows that start in an earlier one too."""
    done = substrings.dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL["op6_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(len(ws))) AS i FROM w),
g AS (SELECT doc_id, i, array_to_string(ws[i + 1:i + 13], ' ') AS t FROM p WHERE i + 13 <= len(ws)),
m AS (SELECT t, min(doc_id) AS first FROM g GROUP BY t),
b AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g JOIN m USING (t) WHERE g.doc_id > m.first),
k AS (SELECT p.doc_id, count(b.i) AS n, string_agg(p.ws[p.i + 1], ' ' ORDER BY p.i) FILTER (WHERE b.i IS NULL) AS kept
      FROM p LEFT JOIN b ON p.doc_id = b.doc_id AND p.i = b.i GROUP BY p.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)"""


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every whole text."""
    return langid.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds."""
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    return shards.assign(table(spark, sf_dir, "documents"))


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every whole text."""
    return licenses.scan(table(spark, sf_dir, "documents")).drop("notices", "blocks")


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text."""
    done = quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return done.select("doc_id", "held_out", "score", "predicted")


@query
def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every twentieth embedding."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op1_exact_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20"""


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files, read back through their index."""
    return tokenfiles.token_table(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, whole where they fit, in few sequences of 1024 tokens."""
    return bestfit.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        with_ids=False).drop("ids")


@query
def op12_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between byte-level and sentencepiece tokens of every whole text."""
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model")).drop("groups")


@query
def op13_cluster_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's centroid among 40, after five rounds."""
    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("centroid")


def _cluster_sql(k: int = 40, rounds: int = 5) -> str:
    """Plain k-means, one pair of tables a round; sums of integers in doubles are exact here."""
    sql = [f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q, sha256('2:' || vec_id) AS h FROM embeddings
  WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS k, q AS c FROM v QUALIFY row_number() OVER (ORDER BY h) <= {k})"""]
    for r in range(rounds + 1):
        sql.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, any_value(q) AS q, min({{d: list_inner_product(q, q) - 2 * list_inner_product(q, c) + list_inner_product(c, c), k: k}}) AS b
  FROM v, c{r} GROUP BY vec_id)""")
        if r < rounds:
            sql.append(f"""m{r} AS (SELECT k, list(x ORDER BY i) AS c FROM (SELECT k, i, floor(sum(x) / count(*)) AS x
  FROM (SELECT b.k AS k, unnest(range(64)) AS i, unnest(q) AS x FROM a{r}) GROUP BY k, i) GROUP BY k),
c{r + 1} AS MATERIALIZED (SELECT k, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (k))""")
    return f"""WITH {", ".join(sql)}
SELECT vec_id, k::INTEGER AS cluster, b.d::BIGINT AS distance, (sum(b.d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(b.d) OVER ())::BIGINT AS inertia,
 sha256(array_to_string(list_transform(c, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON b.k = k"""


ORACLE_SQL["op13_cluster_centroids"] = _cluster_sql()


def _license_sql() -> str:
    """The scan without its filters, which must not change the result."""
    words = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    base = " UNION ALL ".join(
        f"SELECT doc_id, i, '{label}' AS label FROM p WHERE " + " AND ".join(f"ws[i + {k}] = '{w}'" for k, w in enumerate(phrase.split(), 1))
        for label, phrase in licenses.PHRASES.items())
    tops = ", ".join("('{}', [{}], {}, {})".format(label, ", ".join(f"'{w}'" for w in sorted(set(t.split()))), *licenses.grid(t))
                     for label, t in licenses.TEMPLATES)
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{words}') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(len(ws))) AS i FROM w),
b AS ({base}),
t(label, top, size, step) AS (VALUES {tops}),
g AS (SELECT DISTINCT size, step FROM t),
k AS (SELECT doc_id, size, list_distinct(ws[s + 1:s + size]) AS block FROM (SELECT doc_id, ws, size, unnest(range(0, len(ws), step)) AS s FROM w, g)),
f AS (SELECT doc_id, label, len(list_intersect(top, block)) AS n, n / len(top) AS share FROM k JOIN t USING (size) WHERE n >= ceil(0.9 * len(top) - 1e-9)),
a AS (SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM b GROUP BY doc_id),
e AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM b UNION SELECT doc_id, label FROM f) GROUP BY doc_id),
h AS (SELECT doc_id, max(share) AS share FROM f GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(a.n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word, coalesce(a.labels, '') AS base_labels,
 coalesce(e.labels, '') AS labels, CASE WHEN a.n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN a USING (doc_id) LEFT JOIN e USING (doc_id) LEFT JOIN h USING (doc_id)"""


ORACLE_SQL["op9_license_scan"] = _license_sql()
