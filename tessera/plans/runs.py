"""A function per group, called for many groups at a time.

``applyInPandas`` pays for a pandas frame and an Arrow batch per group, which is more than the
work itself where groups are short. Here partitions are sorted by key, and their batches
are cut where the key changes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def _starts(keys: pa.Array) -> np.ndarray:
    """Where runs of equal keys begin; nulls are equal."""
    if len(keys) < 2:
        return np.zeros(len(keys), dtype=np.int64)
    new = pc.not_equal(keys[1:], keys[:-1]).fill_null(True).to_numpy(zero_copy_only=False)
    null = keys.is_null().to_numpy(zero_copy_only=False)
    new &= ~(null[1:] & null[:-1])
    return np.concatenate([[0], np.flatnonzero(new) + 1])


def map_runs(df: DataFrame, key: str, fn: Callable[[pa.Table, np.ndarray], pa.Table], schema: str, order: Sequence[str] = ()) -> DataFrame:
    """``fn(rows, starts)`` over whole groups of ``key``, sorted by key and ``order``.

    ``starts`` are the first rows of the groups. A null key is a group of its own. A task
    holds one Arrow batch and the group that it ends in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of one group, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            last = int(_starts(batch.column(key))[-1])
            if held and last == 0 and len(_starts(pa.concat_arrays([held[-1].column(key)[-1:], batch.column(key)[:1]]))) == 1:
                held.append(batch)
                continue
            whole = pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks()
            if whole.num_rows:
                yield from fn(whole, _starts(whole.column(key).combine_chunks())).to_batches()
            held = [batch.slice(last)]
        if held:
            whole = pa.Table.from_batches(held).combine_chunks()
            yield from fn(whole, _starts(whole.column(key).combine_chunks())).to_batches()

    return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def numbers(rows: pa.Table, column: str) -> np.ndarray:
    """A column as doubles, null as NaN."""
    return rows.column(column).combine_chunks().cast(pa.float64()).to_numpy(zero_copy_only=False)
