"""Links between the tokens of two tokenizers: sparse incidence matrices and their row products."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tessera.llm.batches import ALL_SPACES, offsets, pieces, ragged
from tessera.plans.prefix import cut_lineage

#: Bytes of text linked at a time.
STEP_BYTES = 2 << 20
#: Units encoded in one call.
TOGETHER = 2000
_SPACE = "▁"


@dataclass(frozen=True)
class Csr:
    """A sparse matrix by rows: ``columns`` and ``values`` of row i lie from ``starts[i]`` to ``starts[i + 1]``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def row_of_entry(self) -> np.ndarray:
        return np.repeat(np.arange(self.height), np.diff(self.starts))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        starts = offsets(np.bincount(self.columns, minlength=self.width))
        return Csr(starts, self.row_of_entry()[order], self.values[order], self.height)


def row_products(left: Csr, right: Csr) -> Csr:
    """``left`` times ``right`` by Gustavson: a row is the sum of the rows of ``right`` that it names."""
    lengths = np.diff(right.starts)[left.columns]
    entry = ragged(right.starts[left.columns], lengths)
    row = np.repeat(left.row_of_entry(), lengths)
    value = np.repeat(left.values, lengths) * right.values[entry]
    key = row * right.width + right.columns[entry]
    if len(key) and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), dtype=bool), key[1:] != key[:-1]]))
    value = np.add.reduceat(value, first) if len(first) else value
    row, column = np.divmod(key[first], max(right.width, 1))
    return Csr(offsets(np.bincount(row, minlength=left.height)), column, value, right.width)


def incidence(ends: np.ndarray, width: int) -> Csr:
    """Rows that cover the columns up to each of the ascending ``ends``, one behind the other."""
    return Csr(np.concatenate([[0], ends]).astype(np.int64), np.arange(width), np.ones(width, dtype=np.int64), width)


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Bytes that print in Latin-1 stand for themselves, the others follow from U+0100 on.
    """
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Spelling:
    """The bytes of each id of a vocabulary."""

    def __init__(self, names: dict[int, bytes]):
        self.size = np.zeros(max(names) + 1, dtype=np.int64)
        self.size[list(names)] = [len(name) for name in names.values()]
        self.start = offsets(self.size)[:-1]
        self.data = np.frombuffer(b"".join(names.get(i, b"") for i in range(len(self.size))), dtype=np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.start[ids], self.size[ids])]


@dataclass(frozen=True)
class Units:
    """Tokens of some units, one unit behind the other, and their links.

    ``n_*`` are numbers for each unit; ``pair`` is a * (ids of b) + b for each link, ``spelled``
    each unit's groups as text, ``whole`` whether both tokenizers spell the unit's bytes.
    """

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_overlaps: np.ndarray
    n_links: np.ndarray
    pair: np.ndarray
    spelled: pa.Array
    whole: np.ndarray


class Linker:
    """Both tokenizers, applied to units of text between which neither has a token.

    A unit ends where ink is followed by a space or a line feed: the pattern of a (byte-level
    BPE) never passes such a place, and the vocabulary of b is searched for pieces that would;
    if there are any, that character does not end units.
    """

    def __init__(self, a_definition: str, b_model: bytes):
        self.a_definition, self.b_model = a_definition, b_model

    def __getstate__(self):
        return {"a_definition": self.a_definition, "b_model": self.b_model}

    def load(self) -> None:
        if "a" in self.__dict__:
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        characters = byte_characters()
        self.a_spelling = Spelling({i: bytes(map(characters.__getitem__, t)) for t, i in json.loads(self.a_definition)["model"]["vocab"].items()})
        self.b = SentencePieceProcessor(model_proto=self.b_model)
        names = {i: self.b.id_to_piece(i).replace(_SPACE, " ") for i in range(self.b.get_piece_size())}
        self.b_spelling = Spelling({i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.encode() for i, p in names.items()})
        self.n_b = len(names)
        all_pieces = "\0".join(p for i, p in names.items() if not self.b.is_byte(i))
        ends = "".join(c for c in " \n" if not re.search(f"[^{ALL_SPACES}\\0]{c}", all_pieces))
        ink, space = f"[^{ALL_SPACES}]", f"[{ALL_SPACES}]"
        inner = f"(?![{ends}]){space}" if ends else space
        self.unit = re.compile(f"{space}*{ink}+(?:{inner}{space}*{ink}*)*|{space}+")
        self.ink_end = re.compile(f"(?s:.*){ink}\\Z").match
        self.lead = self.b.encode("a")
        self.a = Tokenizer.from_str(self.a_definition)
        self.a.encode_special_tokens = True

    def units(self, text: str) -> list[str]:
        """The units of a space and ``text``; each begins with a character that ends units, or is the first."""
        return self.unit.findall(" " + text)

    def _encode_a(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each unit): as one text, if every unit ends with ink, so that the next one begins anew."""
        if all(self.ink_end(u) for u in units):
            ids = np.array(self.a.encode_batch_fast(["".join(units)], add_special_tokens=False)[0].ids, dtype=np.int64)
            ends = np.cumsum([len(u.encode()) for u in units])
            reached = np.cumsum(self.a_spelling.size[ids])
            last = np.searchsorted(reached, ends)
            if reached[-1] == ends[-1] and (reached[last] == ends).all():
                return ids, np.diff(last, prepend=-1)
        return _flat([found.ids for found in self.a.encode_batch_fast(units, add_special_tokens=False)])

    def _encode_b(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # a space is put in front of each text; units without one follow ink, whose ids are cut off again
        spaced = [len(u) > 1 and u[0] == " " for u in units]
        found = self.b.encode([u[1:] if own else "a" + u for u, own in zip(units, spaced, strict=True)], num_threads=1)
        return _flat([ids if own else ids[len(self.lead) :] for ids, own in zip(found, spaced, strict=True)])

    def link(self, units: list[str]) -> Units:
        """Tokens, groups and links of distinct units."""
        raw = [u.encode() for u in units]
        size = np.array([len(r) for r in raw], dtype=np.int64)
        ids, counts = [], []
        for encode in (self._encode_a, self._encode_b):
            found = [encode(units[i : i + TOGETHER]) for i in range(0, len(units), TOGETHER)]
            ids.append(np.concatenate([np.zeros(0, dtype=np.int64), *[x for x, _ in found]]))
            counts.append(np.concatenate([np.zeros(0, dtype=np.int64), *[n for _, n in found]]))
        whole = np.ones(len(units), dtype=bool)
        for x, n, spelling in zip(ids, counts, (self.a_spelling, self.b_spelling), strict=True):
            unit = np.repeat(np.arange(len(units)), n)
            same = np.bincount(unit, weights=spelling.size[x], minlength=len(units)) == size
            if not same.all() or spelling.bytes_of(x).tobytes() != b"".join(raw):
                by_unit = np.split(x, np.cumsum(n)[:-1])
                same = np.array([spelling.bytes_of(y).tobytes() == r for y, r in zip(by_unit, raw, strict=True)], dtype=bool)
            whole &= same
        # units that are not spelled have no tokens
        ids = [x[np.repeat(whole, n)] for x, n in zip(ids, counts, strict=True)]
        n_a, n_b = (np.where(whole, n, 0) for n in counts)
        total = int(size[whole].sum())
        a_ends, b_ends = np.cumsum(self.a_spelling.size[ids[0]]), np.cumsum(self.b_spelling.size[ids[1]])
        ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
        by_a, by_b = incidence(a_ends, total), incidence(b_ends, total)
        a_unit = np.repeat(np.arange(len(units)), n_a)
        overlaps = row_products(by_a, by_b.transposed())
        # groups end where both have a token end; a group's row names the tokens in it
        a_of_group = incidence(np.searchsorted(a_ends, ends) + 1, len(a_ends))
        b_of_group = incidence(np.searchsorted(b_ends, ends) + 1, len(b_ends))
        links = row_products(a_of_group.transposed(), b_of_group)
        link_a = links.row_of_entry()

        def per_unit(unit: np.ndarray) -> np.ndarray:
            return np.bincount(unit, minlength=len(units))

        names = [pa.array(x).cast(pa.string()) for x in ids]
        sides = [
            pc.binary_join(pa.ListArray.from_arrays(pa.array(csr.starts, pa.int32()), own), ",")
            for csr, own in zip((a_of_group, b_of_group), names, strict=True)
        ]
        groups = pc.binary_join_element_wise(*sides, "|")
        n_groups = per_unit(a_unit[a_of_group.starts[:-1]])
        spelled = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets(n_groups), pa.int32()), groups), ";")
        return Units(
            n_a,
            n_b,
            n_groups,
            per_unit(a_unit[overlaps.row_of_entry()]),
            per_unit(a_unit[link_a]),
            ids[0][link_a] * self.n_b + ids[1][links.columns],
            spelled,
            whole,
        )


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, and how many each list has."""
    return np.array([i for own in ids for i in own], dtype=np.int64), np.array([len(own) for own in ids], dtype=np.int64)


_COUNTS = ("n_a", "n_b", "n_groups", "n_overlaps", "n_links")
_DOC = ", ".join(f"{c}: bigint" for c in _COUNTS)


def link_pieces(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(piece, docs, pairs, held, place, often): the links of all documents, some ``STEP_BYTES`` of text in a row.

    docs: (doc_id, the numbers of tokens, groups, overlaps and links, groups as text,
    n_pairs). pairs: the distinct linked id pairs of the row, held: how many of its documents
    hold each; place and often (little-endian unsigned 32-bit): the pairs of each document in
    turn, as places in ``pairs``, and how often it has them.
    """
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        shared = docs.sparkSession.sparkContext.broadcast(Linker(a.read(), b.read()))  # two fixed files of 2.5 MB
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linker, number = shared.value, 0
        linker.load()
        for batch in batches:
            for some in pieces(batch, "text", STEP_BYTES):
                yield _piece(linker, some.column("doc_id"), some.column("text").to_pylist(), number)
                number += 1

    doc = f"struct<doc_id: {kind}, {_DOC}, n_pairs: bigint, groups: string>"
    schema = f"piece bigint, docs array<{doc}>, pairs array<bigint>, held array<int>, place binary, often binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _piece(linker: Linker, doc_ids: pa.Array, texts: list[str | None], number: int) -> pa.RecordBatch:
    words: list[str] = []
    per_text = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        if text:
            own = linker.units(text)
            per_text[i] = len(own)
            words += own
    coded = pa.array(words, pa.string()).dictionary_encode()
    del words
    linked = linker.link(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
    unit = coded.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), per_text)
    # a document with a unit that is not spelled has no tokens
    lost = np.zeros(len(texts), dtype=bool)
    lost[doc[~linked.whole[unit]]] = True
    keep = ~lost[doc]
    unit, doc = unit[keep], doc[keep]
    units_of = np.bincount(doc, minlength=len(texts))

    fields = {name: np.bincount(doc, weights=getattr(linked, name)[unit], minlength=len(texts)).astype(np.int64) for name in _COUNTS}
    ends = pa.array(offsets(units_of), pa.int32())
    groups = pc.binary_join(pa.ListArray.from_arrays(ends, linked.spelled.take(pa.array(unit))), ";")

    # pairs of a document: its distinct units first, then their links
    by_unit, times = np.unique(doc * max(len(linked.whole), 1) + unit, return_counts=True)
    doc, unit = np.divmod(by_unit, max(len(linked.whole), 1))
    lengths = linked.n_links[unit]
    pairs, at = np.unique(linked.pair, return_inverse=True)
    of_link = at[ragged((np.cumsum(linked.n_links) - linked.n_links)[unit], lengths)]
    key = np.repeat(doc, lengths) * max(len(pairs), 1) + of_link
    weight = np.repeat(times, lengths)
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), dtype=bool), key[1:] != key[:-1]]))
    often = np.add.reduceat(weight, first) if len(first) else weight
    doc, place = np.divmod(key[first], max(len(pairs), 1))
    held = np.bincount(place, minlength=len(pairs))
    used = np.flatnonzero(held)
    place = (np.cumsum(held > 0) - 1)[place]

    rows = [doc_ids, *(pa.array(f) for f in fields.values()), pa.array(np.bincount(doc, minlength=len(texts))), groups]
    inside = pa.StructArray.from_arrays(rows, ["doc_id", *_COUNTS, "n_pairs", "groups"])
    one = [
        pa.array([number]),
        pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), inside),
        pa.array([pairs[used]], pa.list_(pa.int64())),
        pa.array([held[used]], pa.list_(pa.int32())),
        pa.array([place.astype("<u4").tobytes()], pa.binary()),
        pa.array([often.astype("<u4").tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(one, ["piece", "docs", "pairs", "held", "place", "often"])


def pair_counts(linked: DataFrame, n_b: int) -> DataFrame:
    """(pair, n_docs, is_best): how many documents hold each linked pair, and if none of its id of a is held by more."""
    each = linked.select(F.explode(F.arrays_zip("pairs", "held")).alias("p"))
    counts = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.held").alias("n_docs"))
    counts = cut_lineage(counts.withColumn("a", F.expr(f"pair div {n_b}")))
    best = counts.groupBy("a").agg(F.max("n_docs").alias("most"))  # a row for each id of a
    return counts.join(best, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("is_best"))


def align(docs: DataFrame, folder: str, a_path: str, b_path: str, keep_groups: bool = True) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_overlaps, n_links, n_best, count_sum, groups) of each document's tokens.

    Token-byte incidence matrices of both tokenizers (byte-level BPE at ``a_path``, pieces at
    ``b_path``) are multiplied row by row: A B' has an entry for each overlap; group-token
    matrices give the links, all pairs of tokens in one group. This is done once for each
    distinct unit of some ``STEP_BYTES`` of text. Rows of so many documents are written to
    ``folder``; each asks for the corpus-wide counts of its distinct pairs and gets them back
    by its number, so that neither documents nor the table of counts is copied around. groups:
    ``a1,a2|b1;...`` as text, or its SHA-256 unless ``keep_groups``; '' without tokens.

    Null and empty texts and those that a tokenizer does not spell byte by byte have no
    tokens: zeros. A null doc_id is kept, rows that repeat a doc_id are documents of their own.
    An empty table gives no rows. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    linked = link_pieces(docs, a_path, b_path).withColumn("part", F.spark_partition_id())
    if not keep_groups:
        digest = lambda d: d.withField("groups", F.when(d["n_a"] > 0, F.sha2(d["groups"], 256)).otherwise(""))
        linked = linked.withColumn("docs", F.transform("docs", digest))
    linked.write.option("compression", "zstd").parquet(folder)
    linked = spark.read.parquet(folder)
    n_b = SentencePieceProcessor(model_file=b_path).get_piece_size()
    asked = linked.select("part", "piece", F.explode("pairs").alias("pair"))
    got = asked.join(pair_counts(linked, n_b), "pair").groupBy("part", "piece")
    answers = got.agg(F.sort_array(F.collect_list(F.struct("pair", "n_docs", "is_best"))).alias("counts"))  # a piece's pairs
    answers = answers.select("part", "piece", F.col("counts.n_docs").alias("n_docs"), F.col("counts.is_best").alias("is_best"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                own = pa.RecordBatch.from_struct_array(row["docs"].values)
                place = np.frombuffer(row["place"].as_py(), dtype="<u4")
                often = np.frombuffer(row["often"].as_py(), dtype="<u4").astype(np.int64)
                doc = np.repeat(np.arange(own.num_rows), own.column("n_pairs").to_numpy())
                sums = []
                for name in ("is_best", "n_docs"):
                    known = row[name].values.to_numpy(zero_copy_only=False).astype(np.int64) if row[name].is_valid else np.zeros(0, dtype=np.int64)
                    total = np.zeros(own.num_rows, dtype=np.int64)
                    np.add.at(total, doc, known[place] * often)
                    sums.append(pa.array(total))
                columns = [own.column("doc_id"), *(own.column(c) for c in _COUNTS), *sums, own.column("groups")]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *_COUNTS, "n_best", "count_sum", "groups"])

    schema = f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", n_best bigint, count_sum bigint, groups string"
    joined = linked.drop("pairs", "held").join(answers, ["part", "piece"], "left")
    return joined.select("docs", "place", "often", "n_docs", "is_best").mapInArrow(run, schema)
