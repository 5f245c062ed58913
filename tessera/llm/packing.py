"""Packing documents into sequences: best-two-fit over the counts of lengths, places by rank."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.batches import cut, offsets, pieces, ragged
from tessera.llm.token_files import STEP_BYTES, WordEncoder, with_end

Bin = tuple[int, list[tuple[int, int]]]


def best_two_fit(counts: np.ndarray, capacity: int) -> list[Bin]:
    """Bins for ``counts[n]`` pieces of each length n: (how many equal bins, [(length, pieces), ...]).

    A bin is filled with the longest piece that still fits, again and again. If it then holds
    two pieces or more and has a gap, its shortest one gives way to the two left-over pieces
    that fill the widened gap best, if these fill more. A bin is repeated as long as the
    pieces last that its choices looked at: choices only depend on which lengths are left, so
    this gives the bins of one-by-one packing. Work depends on the number of lengths, not of
    pieces; longest lengths come first in a bin.
    """
    left = counts.astype(np.int64).copy()
    out: list[Bin] = []
    while left.any():
        own: dict[int, int] = {}
        gap, lengths = capacity, np.flatnonzero(left)
        for length in lengths[::-1].tolist():
            fits = min(gap // length, int(left[length]))
            if fits:
                own[length] = fits
                gap -= fits * length
            if not gap:
                break
        seen = dict(own)
        if gap and sum(own.values()) > 1:
            least = min(own)
            pair = _best_pair(left, own, gap + least)
            if sum(pair) > least:
                for length in pair:
                    seen[length] = seen.get(length, 0) + 1
                    own[length] = own.get(length, 0) + 1
                own[least] -= 1
        times = min(int(left[length]) // n for length, n in seen.items())
        bins = [(length, n) for length, n in sorted(own.items(), reverse=True) if n]
        for length, n in bins:
            left[length] -= times * n
        out.append((times, bins))
    return out


def _best_pair(left: np.ndarray, own: dict[int, int], gap: int) -> tuple[int, int]:
    """The two lengths with the largest sum up to ``gap`` among pieces not in the bin; (0, 0) if there are none."""
    free = left[: gap + 1].copy()
    for length, n in own.items():
        if length <= gap:
            free[length] -= n
    lengths = np.flatnonzero(free)
    if not len(lengths):
        return 0, 0
    # for each longer one, the longest that fits beside it and is no longer than it
    mate = np.searchsorted(lengths, np.minimum(gap - lengths, lengths), side="right") - 1
    alone = (mate >= 0) & (lengths[mate] == lengths) & (free[lengths] < 2)
    mate = np.where(alone, mate - 1, mate)
    total = np.where(mate >= 0, lengths + lengths[mate], 0)
    best = len(total) - 1 - int(np.argmax(total[::-1]))
    return (int(lengths[best]), int(lengths[mate[best]])) if total[best] else (0, 0)


class Places:
    """Where the piece of a given length and rank goes: sequence and offset."""

    def __init__(self, bins: list[Bin], capacity: int):
        rows: list[tuple[int, int, int, int, int]] = []
        used, first = np.zeros(capacity + 1, dtype=np.int64), 0
        for times, content in bins:
            at = 0
            for length, n in content:
                rows.append((length, int(used[length]), n, first, at))
                used[length] += times * n
                at += length * n
            first += times
        rows.sort()
        self.sequences = first
        length, self.start, self.per_bin, self.first, self.at = np.array(rows, dtype=np.int64).reshape(-1, 5).T
        # one ascending key for all lengths: rank within the length, lengths one behind the other
        self.shift = offsets(used)[:-1]
        self.key = self.shift[length] + self.start

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.key, self.shift[length] + rank, side="right") - 1
        inside = rank - self.start[row]
        bin_, slot = np.divmod(inside, self.per_bin[row])
        return self.first[row] + bin_, self.at[row] + slot * length


def cut_documents(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids binary, nth): token ids of whole texts in pieces.

    ids: little-endian unsigned 32-bit. nth counts a task's pieces of one length from 0.
    """
    with open(tokenizer_path, encoding="utf-8") as definition:
        shared = docs.sparkSession.sparkContext.broadcast(WordEncoder(definition.read()))  # a fixed file of 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for some in pieces(batch, "text", STEP_BYTES):
                ids, counts = shared.value.encode(some.column("text"))
                ids = with_end(ids, counts, end_id).astype("<u4")
                counts = counts + 1
                per_doc = -(-counts // capacity)
                doc = np.repeat(np.arange(len(counts)), per_doc)
                number = ragged(np.zeros(len(counts), dtype=np.int64), per_doc)
                length = np.minimum(counts[doc] - number * capacity, capacity)
                nth = np.empty(len(length), dtype=np.int64)
                by_length = np.argsort(length, kind="stable")
                kinds, often = np.unique(length, return_counts=True)
                nth[by_length] = ragged(met[kinds], often)
                met[kinds] += often
                columns = [some.column("doc_id").take(pa.array(doc)), pa.array(number, pa.int32()), pa.array(number * capacity)]
                columns += [pa.array(length), cut(ids, 4 * offsets(length)), pa.array(nth)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids", "nth"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids binary, nth bigint"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(docs: DataFrame, folder: str, tokenizer_path: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids binary, ids_crc32, sequence_id, offset): a place for each piece of each document.

    A document is its ids and ``end_id``; only longer ones than ``capacity`` are cut, every
    ``capacity`` ids. Pieces are written to ``folder`` once. The driver sees how often each
    length occurs, ``capacity`` numbers at most, and decides what kinds of bins there are;
    pieces of a length are numbered over all files from the counts per file and take the
    places of that length in this order, so that no length is gathered anywhere.

    Null and empty texts hold the end id alone. A null doc_id is kept; rows that repeat a
    doc_id are packed one by one, each with pieces from 0. An empty table gives no rows.
    Only doc_id and text are read.
    """
    spark = docs.sparkSession
    cut_up = cut_documents(docs, tokenizer_path, capacity, end_id).withColumn("part", F.spark_partition_id())
    cut_up.write.option("compression", "zstd").parquet(folder)
    # the digest is taken before the join, which carries the ids only if they are asked for
    rows = spark.read.parquet(folder).withColumn("ids_crc32", F.crc32("ids"))
    own = rows.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # a row per file at most for each length
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = own.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")

    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in own.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` lengths
        counts[row.length] = row.n
    places = spark.sparkContext.broadcast(Places(best_two_fit(counts, capacity), capacity))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, at = places.value.find(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": at})

    ranked = rows.join(earlier, ["part", "length"])
    put = ranked.withColumn("_place", place("length", F.col("before") + F.col("nth")))
    return put.select("doc_id", "piece", "start", "length", "ids", "ids_crc32", "_place.sequence_id", "_place.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids binary): the packed sequences; at most ``capacity`` ids each."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(inside, F.lit(b""), lambda all_, one: F.concat(all_, one["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def least_sequences(counts: np.ndarray, capacity: int) -> int:
    """A lower bound: all ids over the capacity, or the pieces of which no two fit together."""
    lengths = np.arange(len(counts))
    return max(-(-int((counts * lengths).sum()) // capacity), int(counts[lengths > capacity // 2].sum()))
