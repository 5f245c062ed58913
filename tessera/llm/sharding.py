"""Shards of one mixture by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.prefix import prefix

#: Bytes that a row takes besides its text.
OVERHEAD = 16


def interleave(docs: DataFrame, shards: int, stratum: str = "source", seed: int = 17) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    Rows are shuffled within each stratum by a seeded hash of doc_id and ranked; sorted by
    fractional rank, (rank - 1/2) / rows of the stratum, the strata interleave in proportion.
    Cuts at equal counts then give shards whose row counts are at most one apart (law
    ``rows``) and whose share of each stratum is that of the table, but for a row or so.
    size: UTF-8 bytes of the text (null: none) plus 16. text_crc32: unsigned, of the UTF-8
    text (null: empty). slot: the place in the shard, from 0. grown_shard: null, as this law
    does not keep rows in place when a shard is added.

    A null stratum is one of its own. Rows that repeat doc_id, size and text are
    interchangeable. An empty table gives no rows; fewer rows than shards leave some shards
    without a row. Ranks come from range partitions, so that no stratum is in one task, and
    no text is moved.
    """
    seeded = F.xxhash64(F.lit(seed), F.col("doc_id"))
    rows = docs.select(
        "doc_id",
        F.col(stratum).alias("_stratum"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        seeded.alias("_seeded"),
    )
    shuffled = ["_seeded", "doc_id", "size", "text_crc32"]
    ranked = prefix(rows, ["_stratum"], shuffled, pos="_rank", totals=True)
    ranked = ranked.withColumn("_fraction", (F.col("_rank") - 0.5) / F.col("_rank_total"))
    ordered = prefix(ranked, [], ["_fraction", *shuffled, "_stratum"], pos="_at", totals=True)
    at, total = F.col("_at") - 1, F.col("_at_total")
    # integer division: shard s holds the places from ceil(s * total / shards) on
    cut = ordered.withColumns({"_place": at, "_total": total}).withColumn("shard", F.expr(f"_place * {shards} div _total").cast("int"))
    return cut.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.expr(f"_place - (shard * _total + {shards - 1}) div {shards}").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
