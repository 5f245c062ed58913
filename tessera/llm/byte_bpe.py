"""Byte-level BPE in two tiers: a minimal perfect hash for whole pre-tokens, a heap for the rest."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from tessera.llm.batches import ALL_SPACES, LETTERS, NUMBERS, SPACES, cut, offsets, pieces, ragged, spell, spelled_out, tidy

#: Pre-tokens outside the vocabulary whose merges a task remembers.
REMEMBERED = 200_000

_BEYOND = re.compile("[^\u0000-\u024f]")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file with one ``base64 rank`` pair a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """A minimal perfect hash of distinct keys: n keys, n slots, one number for each bucket.

    Keys are dealt into buckets by a hash. From the largest bucket on, a displacement is
    sought that sends all its keys to free slots; a bucket of one key names its slot.
    """

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.buckets = max(1, self.n // 2)
        self.shift = np.zeros(self.buckets, dtype=np.int64)
        self.key_at = np.zeros(self.n, dtype=np.int64)
        hashes = self.hashes(keys)
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        starts = np.cumsum(sizes) - sizes
        by_size = np.argsort(-sizes, kind="stable")
        low, step = (x.astype(np.int64).tolist() for x in self._walk(hashes))
        taken = bytearray(self.n)
        for b in by_size[sizes[by_size] > 1].tolist():
            members = order[starts[b] : starts[b] + sizes[b]].tolist()
            move = 0
            while True:
                slots = {(low[m] + move * step[m] + move * move) % self.n for m in members}
                if len(slots) == len(members) and not any(taken[s] for s in slots):
                    break
                move += 1
            self.shift[b] = move
            for m in members:
                at = (low[m] + move * step[m] + move * move) % self.n
                taken[at], self.key_at[at] = 1, m
        free = np.flatnonzero(np.frombuffer(taken, dtype=np.uint8) == 0)
        single = by_size[sizes[by_size] == 1]
        self.shift[single] = -1 - free[: len(single)]
        self.key_at[free[: len(single)]] = order[starts[single]]

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), dtype=np.uint64, count=len(keys))

    def _walk(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key starts and the step that a displacement takes it on by."""
        low = (hashes >> np.uint64(20)) % np.uint64(self.n)
        step = (hashes >> np.uint64(40)) % np.uint64(max(1, self.n - 1)) + np.uint64(1)
        return low, step

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of the only key that may have each hash; the caller compares the key."""
        move = self.shift[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        low, step = self._walk(hashes)
        by = np.maximum(move, 0).astype(np.uint64)
        moved = ((low + by * step + by * by) % np.uint64(self.n)).astype(np.int64)
        return self.key_at[np.where(move < 0, -1 - move, moved)]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranks of the tokens of a pre-token: the lowest-ranked neighbours merge first, leftmost on ties.

    The tokens are a linked list over the bytes; a heap holds candidate pairs, as numbers
    that sort by rank and start, and drops those whose tokens have changed since.
    """
    size = len(piece)
    wide = size.bit_length()
    ends = (1 << wide) - 1
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    rank = ranks.get
    heap = [(r << wide | i) << wide | i + 2 for i in range(size - 1) if (r := rank(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        pair = heappop(heap)
        end, start = pair & ends, pair >> wide & ends
        second = after[start]
        if not 0 < second < size or after[second] != end:
            continue
        after[start], after[second] = end, -1
        if end < size:
            before[end] = start
            if (r := rank(piece[start : after[end]])) is not None:
                heappush(heap, (r << wide | start) << wide | after[end])
        if (left := before[start]) >= 0 and (r := rank(piece[left:end])) is not None:
            heappush(heap, (r << wide | left) << wide | end)
    out, at = [], 0
    while at < size:
        out.append(ranks[piece[at : after[at]]])
        at = after[at]
    return out


class Encoder:
    """Texts to ids. ``pattern`` splits a text; each match is encoded by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.keys = list(ranks)
        self.values = np.array([ranks[k] for k in self.keys], dtype=np.uint32)
        self.table = PerfectHash(self.keys)
        self.any = regex.compile(spelled_out(pattern, r"\p{L}", r"\p{N}", ALL_SPACES))
        # the same pattern in the faster engine, for texts within the Latin blocks
        self.latin = re.compile(spelled_out(pattern, LETTERS, NUMBERS, SPACES))
        self.merged: dict[str, list[int]] = {}

    def split(self, text: str) -> list[str]:
        return (self.any if _BEYOND.search(text) else self.latin).findall(text)

    def _encode_distinct(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct pre-tokens in a row, and how many each has."""
        raw = [t.encode() for t in tokens]
        found = self.table.find(PerfectHash.hashes(raw))
        counts = np.ones(len(raw), dtype=np.int64)
        known = np.fromiter((self.keys[k] == r for k, r in zip(found.tolist(), raw, strict=True)), dtype=bool, count=len(raw))
        rest = {}
        for i in np.flatnonzero(~known).tolist():
            ids = self.merged.get(tokens[i])
            if ids is None:
                ids = merge(raw[i], self.ranks)
                if len(self.merged) >= REMEMBERED:
                    self.merged.clear()
                if len(raw[i]) <= 64:
                    self.merged[tokens[i]] = ids
            rest[i] = ids
            counts[i] = len(ids)
        flat = np.empty(int(counts.sum()), dtype=np.uint32)
        starts = np.cumsum(counts) - counts
        flat[starts[known]] = self.values[found[known]]
        if rest:
            at = ragged(starts[list(rest)], counts[list(rest)])
            flat[at] = np.fromiter((x for ids in rest.values() for x in ids), dtype=np.uint32, count=len(at))
        return flat, counts

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the number of ids of each text."""
        tokens: list[str] = []
        per_text = np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            own = self.split(text or "")
            per_text[i] = len(own)
            tokens += own
        if not tokens:
            return np.zeros(0, dtype=np.uint32), per_text
        return spell(tokens, per_text, self._encode_distinct)


class Decoder:
    """Ids to bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = sorted((r, t) for t, r in ranks.items())
        self.lengths = np.zeros(tokens[-1][0] + 1, dtype=np.int64)
        self.lengths[[r for r, _ in tokens]] = [len(t) for _, t in tokens]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(t for _, t in tokens), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in a row, and the number of bytes of each id."""
        lengths = self.lengths[ids]
        return self.bytes[ragged(self.starts[ids], lengths)], lengths


def _rows(batch: pa.RecordBatch, added: dict[str, pa.Array], dropped: str) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n != dropped]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *added.values()], [*kept, *added])


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens bigint, ids binary): ids of every whole text, four bytes each, little-endian.

    A null or empty text has no ids. Special tokens are ordinary text. Repeated rows stay
    repeated; an empty table gives no rows. Only doc_id and text are read.
    """
    # made once, of a fixed file of about 1 MB; a worker keeps it, and what it remembers, between tasks
    shared = docs.sparkSession.sparkContext.broadcast(Encoder(read_ranks(ranks_path), pattern))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value
        for batch in batches:
            for piece in pieces(batch, "text"):
                ids, counts = encoder.encode(piece.column("text").to_pylist())
                ends = 4 * offsets(counts)
                yield _rows(piece, {"n_tokens": pa.array(counts), "ids": cut(ids.astype("<u4"), ends)}, "text")

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded binary): the bytes that the ids of each row stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(Decoder(read_ranks(ranks_path)))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = shared.value
        for batch in batches:
            for piece in pieces(batch, "ids"):
                rows = piece.column("ids").fill_null(b"")
                sizes = np.array([len(x) // 4 for x in rows.to_pylist()], dtype=np.int64)
                data, lengths = decoder.decode(np.frombuffer(b"".join(rows.to_pylist()), dtype="<u4"))
                ends = offsets(lengths)[offsets(sizes)]
                yield _rows(piece, {"decoded": cut(data, ends)}, "")

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids binary, decoded binary")
