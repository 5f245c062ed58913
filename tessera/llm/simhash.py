"""SimHash near-duplicates by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.batches import pieces, tidy
from tessera.llm.columns import shielded
from tessera.llm.components import components
from tessera.plans.prefix import cut_lineage

BITS = 64


def _fingerprints(texts: list[str | None], words_per_shingle: int) -> np.ndarray:
    hashes, counts = [], []
    for text in texts:
        # bytes.lower and bytes.split know A-Z and the six ASCII spaces only, as asked for
        words = (text or "").encode().lower().split()
        if 0 < len(words) < words_per_shingle:
            shingles = [b" ".join(words)]
        else:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(words_per_shingle)), strict=False))
        before = len(hashes)
        hashes += [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        counts.append(len(hashes) - before)
    out = np.zeros(len(texts), dtype=np.uint64)
    counts = np.array(counts, dtype=np.int64)
    filled = np.flatnonzero(counts)
    if len(filled):
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        starts = np.concatenate([[0], np.cumsum(counts[filled])[:-1]])
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        majority = 2 * ones > counts[filled][:, None]
        out[filled] = np.packbits(majority, axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """(doc_id, fp bigint): the 64-bit SimHash of every whole text.

    Words are runs of other characters than ASCII white space, A-Z in lower case. A bit is
    set if it is set in over half of the shingle hashes (XXH64, seed 42), repeats included.
    Fewer words than a shingle takes: the whole sequence is the shingle; null texts and
    texts without a word: zero.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                fp = _fingerprints(piece.column("text").to_pylist(), words_per_shingle)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp bigint")


def _masks(low: int, width: int) -> list[int]:
    """For each bit of the segment at ``low``: the segment without that bit, as a signed mask."""
    segment = ((1 << width) - 1) << low
    masks = [segment & ~(1 << (low + bit)) for bit in range(width)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _variants(df: DataFrame, slot: str, value: str, masks: list[int]) -> DataFrame:
    """One row for each mask: ``slot`` is its number, ``value`` the fingerprint under it."""
    exploded = df.select("*", F.posexplode(F.array(*[F.lit(m).cast("bigint") for m in masks])).alias(slot, "_mask"))
    return exploded.withColumn(value, F.col("fp").bitwiseAND(F.col("_mask"))).drop("_mask")


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _pairs(members: DataFrame, keys: list[str], distance: int) -> DataFrame:
    """Links between fingerprints of different roots that share ``keys``."""
    a = members.select(*keys, F.col("fp").alias("u"), F.col("root").alias("_ru"))
    b = members.select(*keys, F.col("fp").alias("v"), F.col("root").alias("_rv"))
    near = (F.col("u") < F.col("v")) & (F.col("_ru") != F.col("_rv")) & (_distance(F.col("u"), F.col("v")) <= distance)
    return a.join(b.hint("merge"), keys).where(near).select("u", "v").distinct()


def _buckets(variants: DataFrame, keys: list[str]) -> DataFrame:
    """Members of the buckets of two and more, with their number and the least of them."""
    sizes = variants.groupBy(*keys).agg(F.count("*").alias("size"), F.min("fp").alias("least")).where("size > 1")
    return variants.join(sizes.hint("merge"), keys)


def _other_half(slot: str, slot2: str, width: int) -> Column:
    """Whether the quarter of ``slot2`` lies outside the segment of ``slot``; always, if that is all 64 bits."""
    if width == BITS:
        return F.lit(True)
    return F.floor(F.col(slot2) / width) != F.floor(F.col(slot) / width)


def linked_fingerprints(fps: DataFrame, distance: int = 3, crowd: int = 64) -> DataFrame:
    """(fp, root): distinct fingerprints joined by chains of links of at most ``distance`` bits.

    Deletion variants: of distance // 2 + 1 segments, one differs by at most one bit, so two
    linked fingerprints share one of the variants that leave out a single bit of a segment.
    An equality join on the variants thus finds every link. Work in a bucket stays small:
    first all members are verified against the bucket's least one; then pairs are formed
    only between members which those links have not joined yet. Buckets of over ``crowd``
    members are cut by the variants of the other bits as well before that, which again loses
    no link. Only linked fingerprints are returned.
    """
    if not 1 <= distance <= 3:
        raise ValueError("one-wildcard variants of up to two segments serve 1 to 3 bits")
    count = distance // 2 + 1
    width = BITS // count
    masks = [m for s in range(count) for m in _masks(s * width, width)]
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # few bytes now, 64 rows each later; another key than that of distinct, so that it is kept
    distinct = fps.select("fp").distinct().repartition(parts, F.xxhash64("fp"))
    members = cut_lineage(_buckets(_variants(distinct, "slot", "value", masks), ["slot", "value"]))

    stars = members.where(F.col("fp") != F.col("least")).where(_distance(F.col("fp"), F.col("least")) <= distance)
    first = cut_lineage(components(stars.select(F.col("fp").alias("u"), F.col("least").alias("v"))))
    rooted = cut_lineage(
        members.join(first.hint("merge"), F.col("fp") == F.col("node"), "left").select(
            "slot", "value", "fp", "size", F.coalesce("root", "fp").alias("root")
        )
    )
    open_keys = rooted.groupBy("slot", "value").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a < _b")
    rooted = rooted.join(open_keys.select("slot", "value").hint("merge"), ["slot", "value"])

    few = _pairs(rooted.where(F.col("size") <= crowd), ["slot", "value"], distance)
    # quarters of 16 bits: where one of two halves differs by at most a bit, the other by
    # at most ``distance``, so that one of that half's quarters differs by at most a bit too
    inner = [m for s in range(4) for m in _masks(s * BITS // 4, BITS // 4)]
    crowded = _variants(rooted.where(F.col("size") > crowd), "slot2", "value2", inner)
    many = _pairs(crowded.where(_other_half("slot", "slot2", width)), ["slot", "value", "slot2", "value2"], distance)
    rest = cut_lineage(few.unionByName(many).distinct())
    return components(first.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(rest)).select(
        F.col("node").alias("fp"), "root"
    )


def near_duplicates(docs: DataFrame, words_per_shingle: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): the group of every document under links of ``distance`` bits.

    component_id is the smallest doc_id reachable over links, the document's own included;
    equal fingerprints are linked, also those of texts without a word. Rows without a
    doc_id belong to their group but don't name it: a group of none but those has a null
    component_id. Repeated rows stay repeated; an empty table gives no rows. Only doc_id
    and text are read, other columns are ignored.
    """
    fps = cut_lineage(fingerprints(docs, words_per_shingle))
    roots = linked_fingerprints(fps, distance)
    own = fps.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    rooted = own.join(roots.hint("merge"), "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    rooted = cut_lineage(rooted)
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = rooted.join(named.hint("merge"), "root").select("fp", "component_id")
    return fps.join(classes.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, words_per_shingle: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``docs`` that are the first of their near-duplicate group, all columns.

    Rows without a doc_id cannot be told apart from others of their group and go if the
    group has a row with one; else all of them stay. Of rows that repeat a doc_id, all stay
    or go together.
    """
    docs, restore = shielded(docs, ["doc_id", "text"])
    groups = near_duplicates(docs, words_per_shingle, distance)
    gone = groups.where("component_id is not null and (doc_id is null or doc_id != component_id)")
    gone = gone.select(F.col("doc_id").alias("_gone")).distinct()
    return restore(docs.join(gone.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_gone")), "left_anti"))
