"""The operators of this package as queries on the given tables, with production parameters."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import byte_bpe, bwt_dedup, decontaminate, epsilon_join, line_dedup, packing, sharding, simhash, surrogates, token_files, token_links, toxicity, turns
from tessera.llm.ship import ship
from tessera.session import use_checkpoint_dir

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` gives the same rows."""

    def add(run):
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir.rstrip("/"))

        QUERIES[name] = call
        if sql:
            ORACLE_SQL[name] = sql
        return run

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_line_dedup", sql=line_dedup.ORACLE)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op4_decontaminate", sql=decontaminate.ORACLE)
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query("op5_epsilon_join", sql=epsilon_join.ORACLE)
def op5_epsilon_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epsilon_join.near_duplicates(_table(spark, sf_dir, "embeddings"))


@query("op6_sharding")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(_table(spark, sf_dir, "documents"), shards=40)


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, path)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{use_checkpoint_dir(spark)}/token-files-{uuid.uuid4().hex}"
    docs = _table(spark, sf_dir, "documents")
    files = token_files.round_trip(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return files.select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op9_surrogates")
def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = surrogates.replace(_table(spark, sf_dir, "documents"), key="documents")
    return replaced.select("doc_id", "n_entities", "text")


@query("op10_bwt_dedup")
def op10_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = bwt_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, span: total + span["end"] - span["start"])
    return left.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op11_best_two_fit")
def op11_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{use_checkpoint_dir(spark)}/packing-{uuid.uuid4().hex}"
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack(_table(spark, sf_dir, "documents"), folder, tokenizer, capacity=4096, end_id=1)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op12_token_links")
def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{use_checkpoint_dir(spark)}/token-links-{uuid.uuid4().hex}"
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    linked = token_links.align(_table(spark, sf_dir, "documents"), folder, a, b, keep_groups=False)
    return linked.withColumnRenamed("groups", "groups_sha256")


@query("op13_turn_repair")
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.report(_table(spark, sf_dir, "conversations"))
