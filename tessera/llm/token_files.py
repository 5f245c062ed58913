"""Token ids in files: canonical length-limited Huffman codes, blocks and bit-offset checkpoints."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.batches import LETTERS, NUMBERS, SPACES, cut, offsets, pieces, ragged, spelled_out
from tessera.plans.prefix import cut_lineage, prefix

#: Longest code in bits; codes of up to 24 bits can be read from four bytes.
LONGEST = 16
#: Ids between two checkpoints.
EVERY = 256
#: Bytes of ids in a block, after which the next document begins another.
BLOCK_BYTES = 2 << 20
# Fixed value: up to here each character lower-cases to one character and nothing composes.
_SIMPLE = "\x00-\u012f"
#: Bytes of text encoded at a time.
STEP_BYTES = 4 << 20
#: Words whose ids a task remembers.
REMEMBERED = 600_000


class _Known:
    """Strings met so far, with all their ids in a row and the number of ids of each."""

    def __init__(self):
        self.numbers: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.uint32)
        self.starts, self.counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def spell(self, strings: pa.Array, learn) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``strings`` in a row and the number of ids of each; ``learn`` gives those of new ones."""
        coded = strings.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = list(map(self.numbers.get, distinct))
        new = [i for i, number in enumerate(at) if number is None]
        if new:
            ids, counts = learn([distinct[i] for i in new])
            for number, i in enumerate(new, len(self.numbers)):
                at[i] = number
            self.numbers.update((distinct[i], at[i]) for i in new)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
            self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
        own = np.array(at, dtype=np.int64)
        codes = coded.indices.to_numpy()
        lengths = self.counts[own][codes]
        return self.ids[ragged(self.starts[own][codes], lengths)], lengths


class WordEncoder:
    """A tokenizer that drops white space, applied to each distinct word of many texts once.

    Its normaliser and splitting pattern never look across white space, so the ids of a text
    are those of its words in a row. Where lower-casing changes single characters only and
    nothing composes (see ``_SIMPLE``), a word is cut by the tokenizer's own pattern before,
    which leaves fewer distinct parts to encode.
    """

    def __init__(self, definition: str):
        self.definition = definition
        self.words, self.parts = _Known(), _Known()

    def __getstate__(self):
        return {"definition": self.definition}

    def __setstate__(self, state):
        self.__init__(state["definition"])

    def _load(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(self.definition)
        parsed = json.loads(self.definition)
        suffix = parsed["model"].get("end_of_word_suffix") or ""
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.final = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.final[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        added = "|".join(re.escape(t["content"]) for t in parsed["added_tokens"])
        self.special = re.compile(f"[^{_SIMPLE}]|\\n" + f"|{added}" * bool(added))
        step = next(s for s in parsed["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split")
        pattern = spelled_out(step["pattern"]["Regex"], LETTERS, NUMBERS, SPACES)
        self.part_or_end = re.compile(f"(?:{pattern})|\n")

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], dtype=np.uint32), np.array([len(ids) for ids in found], dtype=np.int64)

    def _learn_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts that the pattern doesn't split any further, many in one go."""
        out = []
        for start in range(0, len(parts), 2000):
            own = parts[start : start + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(own)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            # each part ends with a token that ends a word
            counts = np.diff(np.flatnonzero(np.concatenate([[True], self.final[ids]])))
            out.append((ids, counts) if len(counts) == len(own) else self._each(own))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def _learn_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        special = np.array([self.special.search(w) is not None for w in words], dtype=bool)
        simple = [w for w, other in zip(words, special, strict=True) if not other]
        found = pa.array(self.part_or_end.findall("\n".join([*simple, ""]).lower()), pa.string())
        ends = pc.equal(found, "\n").to_numpy(zero_copy_only=False)
        ids, lengths = self.parts.spell(found.filter(pa.array(~ends)), self._learn_parts)
        parts = np.flatnonzero(ends) - np.arange(len(simple))  # up to each word's end
        plain = np.diff(offsets(lengths)[np.concatenate([[0], parts])])
        if not special.any():
            return ids, plain
        rest, rest_counts = self._each([words[i] for i in np.flatnonzero(special).tolist()])
        counts = np.zeros(len(words), dtype=np.int64)
        counts[~special], counts[special] = plain, rest_counts
        starts, out = np.cumsum(counts) - counts, np.zeros(int(counts.sum()), dtype=np.uint32)
        out[ragged(starts[~special], plain)], out[ragged(starts[special], rest_counts)] = ids, rest
        return out, counts

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the number of ids of each text."""
        if "tokenizer" not in self.__dict__:
            self._load()
        if len(self.words.numbers) > REMEMBERED:
            self.words = _Known()
        if len(self.parts.numbers) > REMEMBERED:
            self.parts = _Known()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if pc.any(pc.match_substring_regex(texts, "[\\x1c-\\x1f]")).as_py():
            # four control characters are white space to the split below alone
            split = pa.array([re.split("[ \t-\r]+", t or "") for t in texts.to_pylist()], pa.list_(pa.string()))
        else:
            split = pc.utf8_split_whitespace(texts)
        ids, lengths = self.words.spell(split.flatten(), self._learn_words)
        per_text = pc.list_value_length(split).fill_null(0).to_numpy()
        return ids, np.diff(offsets(lengths)[offsets(per_text)])


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    """The ids of all texts in a row, each text's followed by ``end_id``."""
    out = np.full(len(ids) + len(counts), end_id, dtype=ids.dtype)
    inside = np.ones(len(out), dtype=bool)
    inside[np.cumsum(counts + 1) - 1] = False
    out[inside] = ids
    return out


def id_width(tokenizer_path: str) -> str:
    """The type that holds all ids of a tokenizer: two bytes if they fit, else four, little-endian."""
    ids = Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True).values()
    return "<u2" if max(ids) < 1 << 16 else "<u4"


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """(doc_id, ids binary, counts binary): ids of every whole text and ``end_id``, as :func:`id_width` says.

    counts: pairs of an id and how often it occurs (four bytes each) for the rows of a piece,
    on the first of them; null on the others.
    """
    with open(tokenizer_path, encoding="utf-8") as definition:
        shared = docs.sparkSession.sparkContext.broadcast(WordEncoder(definition.read()))  # a fixed file of 2 MB
    width = id_width(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value
        for batch in batches:
            for piece in pieces(batch, "text", STEP_BYTES):
                ids, counts = encoder.encode(piece.column("text"))
                ids = with_end(ids, counts, end_id)
                often = np.bincount(ids)
                used = np.flatnonzero(often)
                total = np.stack([used, often[used]], axis=1).astype("<u4").tobytes()
                rows = cut(ids.astype(width), int(width[2:]) * offsets(counts + 1))
                columns = [piece.column("doc_id"), rows, pa.array([total] + [None] * (len(counts) - 1), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary, counts binary")


def count_ids(encoded: DataFrame) -> DataFrame:
    """(id, n): how often each id occurs in all rows; summed in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            pairs = np.frombuffer(b"".join(batch.column("counts").to_pylist()), dtype="<u4").reshape(-1, 2).astype(np.int64)
            own = np.bincount(pairs[:, 0], weights=pairs[:, 1], minlength=len(total)).astype(np.int64)
            own[: len(total)] += total
            total = own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    return encoded.select("counts").where("counts is not null").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(weights: list[int], longest: int = LONGEST) -> np.ndarray:
    """Bits of each symbol's code in an optimal prefix code of at most ``longest`` bits (package-merge)."""
    n = len(weights)
    if n > 1 << longest:
        raise ValueError(f"{n} symbols do not fit codes of {longest} bits")
    if n == 1:
        return np.ones(1, dtype=np.int64)
    order = np.argsort(weights, kind="stable")
    leaves = np.array(weights, dtype=np.float64)[order]
    packages, levels = np.zeros(0), []
    for _ in range(longest):
        merged = np.concatenate([leaves, packages])
        by_weight = np.argsort(merged, kind="stable")
        levels.append(by_weight < n)
        merged = merged[by_weight]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        own = int(is_leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, dtype=np.int64)
    out[order] = lengths
    return out


class Code:
    """The canonical code of given lengths: by length, then by id, codes count up."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, longest: int = LONGEST):
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order], lengths[order]
        self.longest = longest
        # left-aligned codes are running sums of what each code takes of all 2^longest
        taken = np.int64(1) << (longest - lengths)
        aligned = np.cumsum(taken) - taken
        size = int(ids.max()) + 1 if len(ids) else 1
        self.length, self.code = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        self.length[ids], self.code[ids] = lengths, aligned >> (longest - lengths)
        self.symbol_at = np.zeros(1 << longest, dtype=np.uint32)
        self.length_at = np.ones(1 << longest, dtype=np.int64)
        filled = int(taken.sum())
        self.symbol_at[:filled], self.length_at[:filled] = np.repeat(ids, taken), np.repeat(lengths, taken)

    def encode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all rows, the byte offset of each row's start and end, and each id's bit offset.

        Each row of ``counts`` ids begins at a byte.
        """
        length = self.length[ids]
        bits = offsets(length)
        row = offsets(counts)
        row_bytes = (np.diff(bits[row]) + 7) // 8
        ends = offsets(row_bytes)
        at = bits[:-1] + np.repeat(8 * ends[:-1] - bits[row[:-1]], counts)
        # a code touches at most two neighbouring words of 32 bits; sums stay below 2^53
        word, shift = at >> 5, 64 - length - (at & 31)
        placed = self.code[ids] << np.minimum(shift, 62)
        size = (int(ends[-1]) + 3) // 4 + 1
        high = np.bincount(word, weights=(placed >> 32).astype(np.float64), minlength=size)
        low = np.bincount(word + 1, weights=(placed & 0xFFFFFFFF).astype(np.float64), minlength=size + 1)
        words = high[:size] + low[:size]
        # a first bit makes a sum negative; what a float of that kind becomes without a sign depends on the machine
        return words.astype(np.int64).astype(">u4").view(np.uint8)[: int(ends[-1])], ends, at

    def decode(self, data: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The ids of all runs in a row: ``counts`` ids from each bit offset of ``starts`` on.

        All runs are read in step, one id of each at a time, through the table.
        """
        padded = np.concatenate([data, np.zeros(4, dtype=np.uint8)]).astype(np.uint32)
        window = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
        out = np.empty(int(counts.sum()), dtype=np.uint32)
        by_count = np.argsort(-counts, kind="stable")
        at, place, left = starts[by_count].copy(), (np.cumsum(counts) - counts)[by_count], counts[by_count]
        mask, room = (1 << self.longest) - 1, 32 - self.longest
        for step in range(int(left[0]) if len(left) else 0):
            live = int(np.searchsorted(-left, -step, side="left"))
            at, place = at[:live], place[:live]
            seen = (window[at >> 3] >> (room - (at & 7)).astype(np.uint32)) & np.uint32(mask)
            out[place + step] = self.symbol_at[seen]
            at += self.length_at[seen]
        return out


def write(encoded: DataFrame, path: str, width: str) -> None:
    """Write (doc_id, ids, counts) as token files in ascending doc_id order.

    ``path``/codebook holds (id, bits); ``path``/blocks a row for each block: the documents'
    doc_id, numbers of ids and byte offsets, the codes, and the bit offset of every
    checkpoint: each document's start and each 256th id of it. Blocks decode by themselves.
    """
    spark = encoded.sparkSession
    counts = sorted((r.id, r.n) for r in count_ids(encoded).collect())  # at most the vocabulary
    ids = np.array([i for i, _ in counts], dtype=np.int64)
    lengths = code_lengths([n for _, n in counts]) if counts else ids
    book = [(int(i), int(b)) for i, b in zip(ids, lengths, strict=True)]
    spark.createDataFrame(book, "id bigint, bits bigint").coalesce(1).write.parquet(f"{path}/codebook")
    shared = spark.sparkContext.broadcast(Code(ids, lengths))

    kind = encoded.schema["doc_id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = encoded.select("doc_id", "ids").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.length("ids"), "ids")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for piece in pieces(batch, "ids", BLOCK_BYTES):
                rows = piece.column("ids").to_pylist()
                n = np.array([len(r) // int(width[2:]) for r in rows], dtype=np.int64)
                codes, _, at = shared.value.encode(np.frombuffer(b"".join(rows), dtype=width).astype(np.int64), n)
                marks = -(-n // EVERY)
                checks = at[ragged(np.zeros(len(n), dtype=np.int64), marks) * EVERY + np.repeat(offsets(n)[:-1], marks)]
                columns = [[number], [piece.column("doc_id").to_pylist()], [n], [checks], [codes.tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
                number += 1

    names = ["block", "doc_ids", "counts", "checkpoints", "codes"]
    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    types = [pa.int64(), pa.list_(id_type), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    blocks = ordered.mapInArrow(pack, f"block bigint, doc_ids array<{kind}>, counts array<bigint>, checkpoints array<bigint>, codes binary")
    blocks.withColumn("part", F.spark_partition_id()).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, part, block, place, n_tokens, ids binary, ids_crc32) decoded from the files at ``path``."""
    book = spark.read.parquet(f"{path}/codebook").collect()  # at most the vocabulary
    shared = spark.sparkContext.broadcast(Code(np.array([r.id for r in book], dtype=np.int64), np.array([r.bits for r in book], dtype=np.int64)))
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "codes", 1):
                row = {n: piece.column(n)[0] for n in piece.schema.names}
                n = np.array(row["counts"].as_py(), dtype=np.int64)
                marks = -(-n // EVERY)
                runs = np.full(int(marks.sum()), EVERY, dtype=np.int64)
                filled = np.flatnonzero(marks)
                runs[np.cumsum(marks)[filled] - 1] = n[filled] - (marks[filled] - 1) * EVERY
                starts = np.array(row["checkpoints"].as_py(), dtype=np.int64)
                ids = shared.value.decode(np.frombuffer(row["codes"].as_py(), dtype=np.uint8), starts, runs).astype("<u4")
                ends = 4 * offsets(n)
                raw = memoryview(ids.view(np.uint8))
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                same = [pa.array([row[c].as_py()] * len(n), t) for c, t in (("part", pa.int32()), ("block", pa.int64()))]
                columns = [row["doc_ids"].values, *same, pa.array(np.arange(len(n))), pa.array(n), cut(ids, ends), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "block", "place", "n_tokens", "ids", "ids_crc32"])

    return blocks.mapInArrow(run, f"doc_id {kind}, part int, block bigint, place bigint, n_tokens bigint, ids binary, ids_crc32 bigint")


def starts(files: DataFrame) -> DataFrame:
    """Add ``start``, the number of ids of all documents before, to what :func:`read` gives (ids left out)."""
    rows = cut_lineage(files.drop("ids"))  # decoded once
    summed = prefix(rows, [], ["doc_id", "part", "block", "place"], sums={"_upto": F.col("n_tokens")}, pos=None)
    return summed.withColumn("start", (F.col("_upto") - F.col("n_tokens")).cast("bigint")).drop("_upto")


def round_trip(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> DataFrame:
    """Encode ``docs``, write the files to ``path``, read them back: (doc_id, start, n_tokens, ids_crc32, ...).

    Null and empty texts hold the end id alone. A null doc_id comes first; rows that repeat
    a doc_id follow each other, shorter ones first. An empty table gives no rows. Only
    doc_id and text are read.
    """
    spark = docs.sparkSession
    token_ids(docs, tokenizer_path, end_id).write.option("compression", "zstd").parquet(f"{path}/ids")
    write(spark.read.parquet(f"{path}/ids"), f"{path}/files", id_width(tokenizer_path))
    return starts(read(spark, f"{path}/files"))
