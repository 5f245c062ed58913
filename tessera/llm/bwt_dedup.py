"""Repeated byte strings across documents, by column-wise construction over many short strings.

Whole documents of any length can't be sorted column by column in a bounded number of
rounds, so the strings of the collection are the surroundings of anchors: the least of the
hashed 20-grams in each 50-byte string. Equal 50-byte strings have equal anchors at equal
places, so every match shows in the surroundings of one anchor, and these are a few rounds long.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.batches import cut, offsets, pieces, ragged
from tessera.session import use_checkpoint_dir

#: Bytes of an anchor, bytes of text in a piece and in a step of the work on it.
GRAM, PIECE, STEP = 20, 8 << 20, 1 << 20
_BASE = 0x9E3779B97F4A7C15
_LAST = np.iinfo(np.int64).max
_SIX = np.uint64((1 << 48) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` bytes in a row: a polynomial put together from those of half the size."""
    part, width, out, done = data.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        if size & width:
            n = len(data) - done - width + 1
            out = part if out is None else out[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + part[done : done + n]
            done += width
        if done == size:
            return _mix(out)
        n = len(data) - 2 * width + 1
        part = part[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + part[width : width + n]
        width *= 2


def _sliding(pick, values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        values, span = pick(values[:-span], values[span:]), 2 * span
    rest = width - span
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


class Anchors:
    """Anchors of the documents in ``data`` (their ends given): place, document, hash, hash of the surroundings.

    ``group`` (48 bits) is equal for equal anchors, ``kind`` (64 bits, of the surroundings and
    the anchor) for equal surroundings: ``before`` bytes ahead and ``length`` from the anchor on,
    or what the document has of them.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray, length: int):
        self.length, self.before = length, length - GRAM
        found = [self._step(data, ends, a, b) for a, b in self._steps(ends)]
        found = [x for x in found if x is not None]
        empty = [np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64)]
        self.at, self.doc, self.group, self.kind = [np.concatenate(c) for c in zip(*found, strict=True)] if found else empty

    @staticmethod
    def _steps(ends: np.ndarray) -> Iterator[tuple[int, int]]:
        first = 0
        while first < len(ends) - 1:
            last = int(np.searchsorted(ends, ends[first] + STEP, side="right")) - 1
            last = max(last, first + 1)
            yield first, last
            first = last

    def _step(self, data: np.ndarray, ends: np.ndarray, first: int, last: int):
        base = int(ends[first])
        own, edge = data[base : int(ends[last])], ends[first : last + 1] - base
        if len(own) < self.length:
            return None
        doc = np.repeat(np.arange(last - first), np.diff(edge))
        grams = _gram_hashes(own, GRAM)
        across = doc[: len(grams)] != doc[GRAM - 1 :]
        grams[across] = np.uint64(0xFFFFFFFFFFFFFFFF)
        width = self.before + 1
        least = _sliding(np.minimum, grams, width)
        # strings across documents choose nothing
        least[doc[: len(least)] != doc[self.length - 1 :]] = 0
        pad = np.zeros(width - 1, dtype=np.uint64)
        chosen = _sliding(np.maximum, np.concatenate([pad, least, pad]), width)[: len(grams)]
        at = np.flatnonzero((chosen == grams) & ~across)
        start, end = edge[:-1][doc[at]], edge[1:][doc[at]]
        low, high = np.maximum(at - self.before, start), np.minimum(at + self.length, end)
        around = np.zeros(len(at), dtype=np.uint64)
        size = self.before + self.length
        whole = high - low == size
        if whole.any():
            around[whole] = _gram_hashes(own, size)[low[whole]]
        raw = own.tobytes()
        for i in np.flatnonzero(~whole).tolist():
            around[i] = xxhash.xxh64_intdigest(raw[low[i] : high[i]], int(at[i] - low[i]) + 1)
        group = grams[at] & _SIX
        kind = (around & _SIX) << np.uint64(16) | (group & np.uint64(0xFFFF))
        return at + base, doc[at] + first, group, kind


def _thin(values: np.ndarray, rising: bool = False) -> bytes:
    """64-bit numbers, byte by byte of each and compressed; ``rising`` ones as differences."""
    values = values.astype("<u8")
    if rising:
        values = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _wide(blobs: list[bytes], rising: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all blobs in a row, and how many each has."""
    unpack = zstandard.ZstdDecompressor()
    out = []
    for blob in blobs:
        planes = np.frombuffer(unpack.decompress(blob), dtype=np.uint8).reshape(8, -1)
        values = np.ascontiguousarray(planes.T).view("<u8").ravel()
        out.append(np.cumsum(values, dtype=np.uint64) if rising else values)
    sizes = np.array([len(x) for x in out], dtype=np.int64)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64), sizes


def _arrow(types: dict[str, str], columns: list[list]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types.values(), strict=True)], list(types))


def _schema(types: dict[str, str]) -> str:
    return ", ".join(f"{k} {v}" for k, v in types.items())


_PIECES = "piece bigint, doc_ids array<bigint>, ends array<bigint>, data binary"
_KINDS = {"bucket": "bigint", "piece": "bigint", "group": "binary", "kind": "binary", "doc": "binary"}
_ANSWERS = {"piece": "bigint", "kind": "binary", "least": "binary", "open": "binary"}
_AROUND = {"bucket": "bigint", "piece": "bigint", "kind": "binary", "doc": "binary", "clipped": "binary", "bytes": "binary"}
_MASKS = {"piece": "bigint", "kind": "binary", "mask": "binary"}


def _write_pieces(docs: DataFrame, path: str) -> DataFrame:
    """Documents packed into rows of about 8 MB of text, compressed, with a number that stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, pack = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                texts = [t or b"" for t in piece.column("text").to_pylist()]
                ends = offsets(np.array([len(t) for t in texts], dtype=np.int64))
                columns = [[number], [piece.column("doc_id").to_pylist()], [ends.tolist()], [pack.compress(b"".join(texts))]]
                kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["piece", "doc_ids", "ends", "data"])
                number += 1

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows.mapInArrow(run, _PIECES).write.option("compression", "uncompressed").parquet(path)
    return docs.sparkSession.read.parquet(path)


class _Piece:
    """A piece as read back: its bytes, anchors and, for each kind of surroundings, the least document of its own."""

    def __init__(self, batch: pa.RecordBatch, row: int, length: int):
        get = lambda c: batch.column(c)[row].as_py()
        self.number, self.doc_ids = get("piece"), get("doc_ids")
        self.ends = np.array(get("ends"), dtype=np.int64)
        self.order = np.array([_LAST if d is None else d for d in self.doc_ids], dtype=np.int64)
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(get("data"), max_output_size=int(self.ends[-1]) + 1), dtype=np.uint8)
        self.anchors = a = Anchors(self.data, self.ends, length)
        self.doc = self.order[a.doc]
        by = np.lexsort((self.doc, a.kind))
        kinds = a.kind[by]
        first = np.concatenate([[True], kinds[1:] != kinds[:-1]]) if len(by) else np.zeros(0, dtype=bool)
        self.kinds, self.first = kinds[first], by[first]
        self.least = self.doc[self.first]
        self.kind_of = np.searchsorted(self.kinds, a.kind)

    def where(self, kinds: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.kinds, kinds)


def _dealt(buckets: np.ndarray, count: int) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each bucket that has any."""
    own = (buckets % np.uint64(count)).astype(np.int64)
    by = np.argsort(own, kind="stable")
    at = np.concatenate([[0], np.flatnonzero(np.diff(own[by])) + 1, [len(by)]])
    for start, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if end > start:
            yield int(own[by[start]]), by[start:end]


def _kinds(packed: DataFrame, length: int, buckets: int) -> DataFrame:
    """Each piece's kinds of surroundings, once each with the least document, dealt by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                p = _Piece(batch, row, length)
                group = p.anchors.group[p.first]
                for bucket, own in _dealt(group, buckets):
                    own = own[np.argsort(group[own], kind="stable")]
                    columns = [_thin(group[own], rising=True), _thin(p.kinds[own] >> np.uint64(16)), _thin(p.least[own])]
                    yield _arrow(_KINDS, [[bucket], [p.number], *[[c] for c in columns]])

    return packed.mapInArrow(run, _schema(_KINDS))


def _answers(kinds: DataFrame, buckets: int) -> DataFrame:
    """For each piece and kind that other pieces or other surroundings of the anchor concern: the least document, and whether the anchor is open.

    Open: it has more than one kind of surroundings, so that parts of them may still match.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        get = lambda c: rows.column(c).to_pylist()
        (group, _), (around, _), (doc, sizes) = _wide(get("group"), rising=True), _wide(get("kind")), _wide(get("doc"))
        kind = around << np.uint64(16) | (group & np.uint64(0xFFFF))
        doc = doc.view(np.int64)
        piece = np.repeat(np.array(get("piece"), dtype=np.int64), sizes)
        by = np.lexsort((doc, kind, group))
        group, kind, doc, piece = group[by], kind[by], doc[by], piece[by]
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        new_kind = new_group | np.concatenate([[True], kind[1:] != kind[:-1]])
        in_group, in_kind = np.cumsum(new_group) - 1, np.cumsum(new_kind) - 1
        least = doc[new_kind][in_kind]
        is_open = (np.bincount(in_group, weights=new_kind) > 1)[in_group]
        tell = np.flatnonzero((least < doc) | is_open)
        tell = tell[np.argsort(piece[tell], kind="stable")]
        at = np.concatenate([[0], np.flatnonzero(np.diff(piece[tell])) + 1, [len(tell)]])
        for start, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if end > start:
                own = tell[start:end]
                own = own[np.argsort(kind[own], kind="stable")]
                columns = [_thin(kind[own], rising=True), _thin(least[own]), is_open[own].astype(np.uint8).tobytes()]
                yield _arrow(_ANSWERS, [[int(piece[own[0]])], *[[c] for c in columns]])

    return kinds.repartition(buckets // 4, "bucket").mapInArrow(run, _schema(_ANSWERS))


def _around(with_answers: DataFrame, length: int, buckets: int) -> DataFrame:
    """The bytes around open anchors, from the piece that has the least document of the kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                kinds, least, is_open = _read_answers(batch, row)
                if not is_open.any():
                    continue
                p = _Piece(batch, row, length)
                at = p.where(kinds)
                own = at[is_open & (least == p.least[at])]
                a, n = p.anchors, length + p.anchors.before
                first = p.first[own]
                place, doc = a.at[first] - a.before, a.doc[first]
                left = np.maximum(p.ends[:-1][doc] - place, 0)
                right = np.maximum(place + n - p.ends[1:][doc], 0)
                wide = np.concatenate([np.zeros(a.before, dtype=np.uint8), p.data, np.zeros(length, dtype=np.uint8)])
                clipped = np.stack([left, right], axis=1).astype(np.uint8)
                for bucket, some in _dealt(a.group[first], buckets):
                    taken = wide[ragged(place[some] + a.before, np.full(len(some), n))]
                    columns = [p.kinds[own[some]].astype("<u8"), p.least[own[some]].astype("<i8"), clipped[some], taken]
                    yield _arrow(_AROUND, [[bucket], [p.number], *[[c.tobytes()] for c in columns]])

    return with_answers.mapInArrow(run, _schema(_AROUND))


def shared_windows(strings: np.ndarray, doc: np.ndarray, clipped: np.ndarray, length: int) -> np.ndarray:
    """Bit a of a string's mask: whether its ``length`` bytes from column a on are also a string's of a smaller document there.

    The order of all strings is built column by column from the last one on: each round
    inserts one symbol of every string in front and moves the strings, in their order so far,
    behind those with smaller symbols, as the rows of a Burrows-Wheeler transform do. From the
    column on where ``length`` bytes are in, neighbours whose common prefix is that long form
    an interval, and the least document in it decides. ``clipped``: columns at the left and
    right that are not the document's.
    """
    columns = np.ascontiguousarray(strings.T)
    order = np.arange(len(strings))
    masks = np.zeros(len(strings), dtype=np.uint64)
    starts = strings.shape[1] - length
    for column in reversed(range(strings.shape[1])):
        order = order[np.argsort(columns[column][order], kind="stable")]
        if column > starts:
            continue
        # the common prefix of neighbours
        window = strings[order, column : column + length]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (window[1:] != window[:-1]).any(axis=1)
        valid = (clipped[order, 0] <= column) & (clipped[order, 1] <= starts - column)
        least = np.minimum.reduceat(np.where(valid, doc[order], _LAST), np.flatnonzero(new))[np.cumsum(new) - 1]
        masks[order] |= (valid & (least < doc[order])).astype(np.uint64) << np.uint64(column)
    return masks


def _masks(around: DataFrame, length: int, buckets: int) -> DataFrame:
    """Which strings of the surroundings begin in a smaller document as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).sort_by("bucket")
        buckets_here = np.array(rows.column("bucket").to_pylist())
        for bucket in np.unique(buckets_here).tolist():
            some = rows.filter(pa.array(buckets_here == bucket))
            joined = {c: b"".join(some.column(c).to_pylist()) for c in ("kind", "doc", "clipped", "bytes")}
            kind, doc = np.frombuffer(joined["kind"], dtype="<u8"), np.frombuffer(joined["doc"], dtype="<i8")
            strings = np.frombuffer(joined["bytes"], dtype=np.uint8).reshape(len(kind), -1)
            masks = shared_windows(strings, doc, np.frombuffer(joined["clipped"], dtype=np.uint8).reshape(-1, 2), length)
            ends = offsets(np.array([len(x) // 8 for x in some.column("kind").to_pylist()], dtype=np.int64))
            for piece, start, end in zip(some.column("piece").to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                told = start + np.flatnonzero(masks[start:end])
                if len(told):
                    yield _arrow(_MASKS, [[piece], [kind[told].tobytes()], [masks[told].astype("<u8").tobytes()]])

    return around.repartition(buckets // 4, "bucket").mapInArrow(run, _schema(_MASKS))


def _read_answers(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    told = batch.column("answers")[row].as_py() or []
    kind, least = _wide([x["kind"] for x in told], rising=True)[0], _wide([x["least"] for x in told])[0]
    return kind, least.view(np.int64), np.frombuffer(b"".join(x["open"] for x in told), dtype=np.uint8).astype(bool)


def _cut(joined: DataFrame, length: int, kind: str) -> DataFrame:
    """Documents with their removed spans and what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                p = _Piece(batch, row, length)
                a = p.anchors
                kinds, least, _ = _read_answers(batch, row)
                all_least = p.least.copy()
                at = p.where(kinds)
                all_least[at] = np.minimum(all_least[at], least)
                masks = np.zeros(len(p.kinds), dtype=np.uint64)
                for told in batch.column("masks")[row].as_py() or []:
                    masks[p.where(np.frombuffer(told["kind"], dtype="<u8"))] |= np.frombuffer(told["mask"], dtype="<u8")
                # surroundings known from a smaller document go whole, others by their strings
                gone = all_least[p.kind_of] < p.doc
                step = np.zeros(len(p.data) + 1, dtype=np.int64)
                low = np.maximum(a.at[gone] - a.before, p.ends[:-1][a.doc[gone]])
                high = np.minimum(a.at[gone] + length, p.ends[1:][a.doc[gone]])
                np.add.at(step, low, 1)
                np.add.at(step, high, -1)
                rest = np.flatnonzero(~gone & (masks[p.kind_of] != 0))
                mask, place = masks[p.kind_of[rest]], a.at[rest] - a.before
                for column in range(a.before + 1):
                    own = place[(mask >> np.uint64(column) & np.uint64(1)) == 1] + column
                    np.add.at(step, own, 1)
                    np.add.at(step, own + length, -1)
                covered = np.cumsum(step[:-1]) > 0
                # runs end at the document's end
                edge = np.zeros(len(covered) + 1, dtype=bool)
                edge[p.ends] = True
                before = np.concatenate([[False], covered[:-1]]) & ~edge[:-1]
                after = np.concatenate([covered[1:], [False]]) & ~edge[1:]
                first, last = np.flatnonzero(covered & ~before), np.flatnonzero(covered & ~after) + 1
                of = np.searchsorted(p.ends, first, side="right") - 1
                spans = np.bincount(of, minlength=len(p.doc_ids))
                starts = p.ends[:-1]
                pairs = pa.StructArray.from_arrays([pa.array(first - starts[of]), pa.array(last - starts[of])], ["start", "end"])
                kept = offsets(~covered)[p.ends]
                columns = [
                    pa.array(p.doc_ids, pa.int64()),
                    pa.array(np.diff(p.ends)),
                    pa.ListArray.from_arrays(offsets(spans).astype(np.int32), pairs),
                    cut(p.data[~covered], kept),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "spans", "kept"])

    out = joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): every whole text without the bytes that an earlier document has.

    A byte goes if any ``length``-byte string of UTF-8 that covers it also starts in a document
    of a smaller doc_id; strings are judged on the input, overlaps count, matches don't cross
    documents. spans: the maximal removed runs [start, end) in bytes. kept: the other bytes.

    A null or empty text has no bytes, one of under ``length`` bytes loses none. Rows that
    share a doc_id don't count against each other; a null doc_id is larger than all others.
    An empty table gives no rows. Only doc_id (an integer) and text are read.

    Texts are packed and written to the shared folder. A piece sends each kind of anchor
    surroundings once, so a passage in a third of all documents sends a row for each piece;
    anchors with one kind are settled by hash, those with more by their bytes.
    """
    if not GRAM < length <= GRAM + 63:
        raise ValueError(f"length must be {GRAM + 1} to {GRAM + 63}")
    spark = docs.sparkSession
    folder = f"{use_checkpoint_dir(spark)}/repeats-{uuid.uuid4().hex}"
    packed = _write_pieces(docs, f"{folder}/pieces")
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = _kinds(packed, length, buckets)
    _answers(kinds, buckets).write.option("compression", "uncompressed").parquet(f"{folder}/answers")
    answers = spark.read.parquet(f"{folder}/answers")
    told = answers.groupBy("piece").agg(F.collect_list(F.struct("kind", "least", "open")).alias("answers"))
    with_answers = packed.join(told, "piece", "left")
    _masks(_around(with_answers, length, buckets), length, buckets).write.option("compression", "uncompressed").parquet(f"{folder}/masks")
    masks = spark.read.parquet(f"{folder}/masks").groupBy("piece").agg(F.collect_list(F.struct("kind", "mask")).alias("masks"))
    return _cut(with_answers.join(masks, "piece", "left"), length, docs.schema["doc_id"].dataType.simpleString())
