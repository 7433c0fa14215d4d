"""A training corpus from raw documents: each stage works on all that the one before it kept.

quality classifier -> one document of each near-copy group -> benchmark decontamination -> personal data -> byte-level BPE.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govmill.llm import byte_bpe, decontaminate, jaccard_join, pii, quality_lm
from govmill.llm.shared import checkpoint_folder, ship, small_enough, stored

#: Documents that leave may be sent to every task as ids, if they are at most so many (16 MB).
SEND_BOUND = 1_000_000
#: Bytes that Python gets at a time; one longer text is a batch of its own. Spark's own limit is 64 MB, held several times over by both sides of each task.
BATCH_BYTES = 1 << 20


def ready(spark: SparkSession) -> SparkSession:
    """The session, with the package shipped and small batches to Python. The setting stays, for frames are computed after their stage returns."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return ship(spark)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of trusted text does not reject."""
    return quality_lm.kept(docs, ready(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id. Documents without id stay.

    Only the keys that leave are looked up. Where ids repeat, a row's key is its id and text: texts of one id are documents of their own.
    Of rows with equal id and text the first by the other columns stays; texts without a word are copies of nothing and stay.
    """
    ready(spark)
    named = docs.where("doc_id is not null")
    if not named.groupBy("doc_id").count().where("count > 1").limit(1).count():
        classes = jaccard_join.jaccard_classes(docs)
        gone = stored(classes.where("component_id <> doc_id").select("doc_id").distinct())
        return docs.join(F.broadcast(gone) if small_enough(gone, SEND_BOUND) else gone, "doc_id", "left_anti").select(docs.columns)
    row_key = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64("text").alias("text")))
    classes = jaccard_join.jaccard_classes(docs.select(row_key.alias("_key"), "text"), "_key")
    gone = stored(classes.where("component_id <> _key").select("_key").distinct())
    keyed = docs.withColumn("_key", row_key)
    stays = keyed.join(F.broadcast(gone) if small_enough(gone, SEND_BOUND) else gone, "_key", "left_anti")
    again = keyed.where(F.col("_key").isNotNull() & F.col("text").rlike("[^ \\t-\\r]")).groupBy("_key").count().where("count > 1").select("_key")
    first = stays.join(again, "_key", "left_semi").groupBy("_key").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return stays.join(again, "_key", "left_anti").select(docs.columns).unionByName(first)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, ready(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, and their length set anew."""
    return pii.redacted(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (little-endian 32-bit), their number, and whether decoding gives the text back."""
    ready(spark)
    coded = byte_bpe.round_trip(docs.withColumn("source_text", F.encode(F.coalesce("text", F.lit("")), "UTF-8")),
                                public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return coded.select("doc_id", "lang", "source", "n_chars", "n_tokens", "token_ids", (F.col("decoded") == F.col("source_text")).alias("lossless"))


STAGES = [("quality classifier", quality), ("n-gram jaccard join", near_copies), ("benchmark decontamination", no_benchmark),
          ("pii", personal_data), ("byte-level bpe", encoded)]

#: No SQL twin: SQL does not express the language model, the fingerprints or the merges. Stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each stage keeps is written to the shared folder and read again by the next."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs

