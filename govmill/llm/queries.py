"""The registered queries of this subpackage: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govmill.llm import byte_bpe, chat_repair, decontaminate, embedding_dedup, exact_topk, jaccard_join, lexical_search, pii
from govmill.llm import quality_lm, token_alignment, token_counts, toxicity, url_filter
from govmill.llm.shared import ship

CONTEXT_TOKENS = 1024  #: a document with more tokens is over the limit


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > CONTEXT_TOKENS)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repaired(table(spark, sf_dir, "conversations"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


#: Which hosts and paths are judged by rule (fixed values of the query).
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.report(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that stay, with perplexity, score and the limit of their language."""
    return quality_lm.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).where("keep")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return coded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_toxicity": op2_toxicity,
    "op3_chat_repair": op3_chat_repair,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_pii": op6_pii,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_quality": op8_quality,
    "op9_decontaminate": op9_decontaminate,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_lexical_search": op11_lexical_search,
    "op12_exact_topk": op12_exact_topk,
    "op13_token_alignment": op13_token_alignment,
}

#: Twins in SQL of those that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op7_jaccard_join": r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM worded WHERE len(w) > 0) x),
sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT DISTINCT x AS a, x AS b FROM edges UNION SELECT a, y FROM reached JOIN edges ON x = b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS least_id FROM reached GROUP BY a) r USING (doc_id)""",
    "op11_lexical_search": r"""
WITH letters AS (
  SELECT '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, upper, lower), term) AS terms FROM documents, letters),
sizes AS (SELECT r, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
wanted AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, upper, lower), term)) AS t FROM benchmark, letters),
held AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(terms) AS t FROM docs) SEMI JOIN wanted USING (t) GROUP BY r, t),
weight AS (SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, corpus GROUP BY t),
impact AS (
  SELECT r, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))) AS x
  FROM held JOIN weight USING (t) JOIN sizes USING (r), corpus),
scored AS (SELECT item_id, r, doc_id, sum(x)::BIGINT AS score FROM wanted JOIN impact USING (t) GROUP BY item_id, r, doc_id HAVING sum(x) > 0)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scored
QUALIFY rank <= 10""",
    "op12_exact_topk": """
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM scaled q JOIN scaled c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM scored
QUALIFY rank <= 10""",
}
