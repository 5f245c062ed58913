"""A training-data pipeline over ``documents``: each stage takes what the one before has kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import byte_bpe, decontaminate, line_dedup, simhash, toxicity
from tessera.llm.ship import ship
from tessera.session import use_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score doesn't reject."""
    ship(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; those of which nothing is left go."""
    ship(spark)
    cut = line_dedup.dedup_lines(docs).where("n_removed = 0 or n_removed < n_lines")
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group."""
    ship(spark)
    return simhash.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold nothing of the benchmark."""
    ship(spark)
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text_sha256): token ids, and the digest of what they decode to."""
    ship(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = byte_bpe.decode(byte_bpe.encode(docs, path, public_tokenizers.PATTERN), path)
    return decoded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("text_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("byte_bpe", encode),
]

#: A learned score, SimHash components and byte-pair merges have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each keeps is written to the shared folder and read again."""
    sf_dir = sf_dir.rstrip("/")
    folder = f"{use_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
