"""Small helpers for work on Arrow batches inside tasks."""

from __future__ import annotations

import ctypes
import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task works on at a time, whatever the size of a batch.
PIECE_BYTES = 2 << 20

# Fixed values, for brackets of a pattern: letters, numbers and white space up to U+024F, all white space.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\\t-\\r \\x85\\xa0"
ALL_SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes of ``column`` each, one row at least."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start = held = 0
    for row, size in enumerate(sizes):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over batches, after which memory that it has freed goes back to the system.

    A Python worker lives on through later jobs of other kinds, and what its allocators keep
    would add to theirs.
    """

    @functools.wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU C library
            trim(0)

    return tidied


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... for each of the given runs, one after the other."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)


def cut(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary rows cut from the bytes of ``data`` at the offsets ``ends`` (one more than rows)."""
    raw = pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))
    rows = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), raw])
    return rows.cast(pa.binary())


def offsets(counts: np.ndarray) -> np.ndarray:
    """0 and the running sums of ``counts``."""
    return np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(counts, dtype=np.int64)])


def spell(words: list[str], per_text: np.ndarray, encode_distinct) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words in a row and the number of ids of each text, of ``per_text`` words each.

    ``encode_distinct`` gets the distinct words and returns all their ids in a row and how
    many each has.
    """
    coded = pa.array(words, pa.string()).dictionary_encode()
    flat, counts = encode_distinct(coded.dictionary.to_pylist())
    codes = coded.indices.to_numpy()
    lengths = counts[codes]
    ids = flat[ragged((np.cumsum(counts) - counts)[codes], lengths)]
    return ids, np.diff(offsets(lengths)[offsets(per_text)])


def spelled_out(pattern: str, letters: str, numbers: str, spaces: str) -> str:
    r"""The pattern with its classes \p{L}, \p{N}, \s and \S spelled out, in and out of brackets."""
    classes = {r"\p{L}": letters, r"\p{N}": numbers, r"\s": spaces}

    def one(match: re.Match) -> str:
        found = match[0]
        if found.startswith("["):
            for name, chars in classes.items():
                found = found.replace(name, chars)
            return found
        return f"[^{spaces}]" if found == r"\S" else f"[{classes[found]}]"

    return re.sub(r"\[[^\]]*\]|\\p\{[LN]\}|\\[sS]", one, pattern)
