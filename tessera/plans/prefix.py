"""Positions, running totals and exact quantiles that never put a group in one task.

A window over a key that holds a third of all rows runs in a single task. The
operators here range-partition on (keys, order) instead, so a hot key spans many
partitions; each partition computes its own running values and a small table with
at most one row per (key, partition) carries the totals across partition borders.
Results are exact and equal to the plain window.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import use_checkpoint_dir

_PART = "_range_part"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def written(df: DataFrame, split: str | None = None) -> Iterator[DataFrame]:
    """``df`` as compressed columns in the shared checkpoint folder, deleted when the block ends.

    A checkpoint holds rows uncompressed and stays until the driver collects garbage; this is for tables that
    several passes read before all results are there. With ``split`` a task reads at most that size, opening costs included.
    """
    spark = df.sparkSession
    path = f"{use_checkpoint_dir(spark)}/{uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    try:
        df.write.parquet(path)
        session = spark
        if split:
            session = spark.newSession()
            session.conf.set("spark.sql.files.maxPartitionBytes", split)
        yield session.read.schema(df.schema).parquet(path)
    finally:
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        spark.sparkContext._jvm.System.gc()  # what made the rows leaves its shuffle files


def _order_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where a null key matches a null key; keys come from the left."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    cond = F.lit(True)
    for i, k in enumerate(keys):
        this = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = this if i == 0 else cond & this
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def prefix(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    maxs: Mapping[str, Column] | None = None,
    pos: str | None = "pos",
    totals: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Add the 1-based position and running values per key, in ``order``.

    ``sums`` become inclusive running sums, ``maxs`` running maxima, ``lasts`` the latest
    non-null value up to and including the row. With ``totals`` each sum also gets ``<name>_total`` (and the
    position ``<pos>_total``), the value over the whole key. ``order`` should end in a
    unique column: ties on it are what lets one partition grow.
    """
    keys = list(keys)
    sums, lasts, maxs = dict(sums or {}), dict(lasts or {}), dict(maxs or {})
    cols = _order_cols(order)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    inputs = {f"_s_{k}": v for k, v in sums.items()}
    inputs |= {f"_l_{k}": v for k, v in lasts.items()}
    inputs |= {f"_m_{k}": v for k, v in maxs.items()}
    work = df.withColumns(inputs) if inputs else df
    by = [*[F.col(k) for k in keys], *cols]
    ranged = work.repartitionByRange(n, *by)
    if not inputs:
        # sorted partitions number their own rows, which saves the window's shuffle
        ranged = ranged.sortWithinPartitions(*by).withColumn("_px_row", F.monotonically_increasing_id())
    # The partition number must not change when a task is run again, so it is written down.
    placed = cut_lineage(ranged.withColumn(_PART, F.spark_partition_id()))

    here = Window.partitionBy(_PART, *keys).orderBy(*cols).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = {"_in_pos": F.count(F.lit(1)).over(here)} if inputs else {}
    local |= {f"_in_{k}": F.sum(f"_s_{k}").over(here) for k in sums}
    local |= {f"_last_{k}": F.last(f"_l_{k}", ignorenulls=True).over(here) for k in lasts}
    local |= {f"_max_{k}": F.max(f"_m_{k}").over(here) for k in maxs}
    running = placed.withColumns(local) if inputs else placed

    aggs = [F.count(F.lit(1)).alias("_n")]
    if not inputs:
        aggs.append(F.min("_px_row").alias("_px_first"))
    aggs += [F.sum(f"_s_{k}").alias(f"_t_{k}") for k in sums]
    aggs += [F.max(f"_m_{k}").alias(f"_top_{k}") for k in maxs]
    if lasts:
        aggs += [F.max_by(f"_last_{k}", "_in_pos").alias(f"_tail_{k}") for k in lasts]
    parts = (running if lasts else placed).groupBy(_PART, *keys).agg(*aggs)

    # At most one row per key and range partition: this window is small for every key.
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = whole.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = {"_off_pos": F.coalesce(F.sum("_n").over(before), F.lit(0))}
    carry |= {f"_off_{k}": F.sum(f"_t_{k}").over(before) for k in sums}
    carry |= {f"_carry_{k}": F.last(f"_tail_{k}", ignorenulls=True).over(before) for k in lasts}
    carry |= {f"_peak_{k}": F.max(f"_top_{k}").over(before) for k in maxs}
    if totals:
        carry["_all_pos"] = F.sum("_n").over(whole)
        carry |= {f"_all_{k}": F.sum(f"_t_{k}").over(whole) for k in sums}
    offsets = parts.withColumns(carry).select(_PART, *keys, *carry, *([] if inputs else ["_px_first"]))

    joined = join_on_keys(running, offsets, [_PART, *keys])
    out = {}
    if pos:
        inside = F.col("_in_pos") if inputs else F.col("_px_row") - F.col("_px_first") + 1
        out[pos] = inside + F.col("_off_pos")
        if totals:
            out[f"{pos}_total"] = F.col("_all_pos")
    for k in sums:
        inside, off = F.col(f"_in_{k}"), F.col(f"_off_{k}")
        out[k] = F.when(off.isNull(), inside).otherwise(F.coalesce(inside + off, off))
        if totals:
            out[f"{k}_total"] = F.col(f"_all_{k}")
    for k in lasts:
        out[k] = F.coalesce(F.col(f"_last_{k}"), F.col(f"_carry_{k}"))
    for k in maxs:
        out[k] = F.greatest(F.col(f"_max_{k}"), F.col(f"_peak_{k}"))
    keep = [c for c in df.columns if c not in out]
    return joined.select(*[F.col(c) for c in keep], *[v.alias(k) for k, v in out.items()])


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
) -> DataFrame:
    """Exact linearly interpolated quantiles per key, one column per entry of ``probs``.

    Rows are first counted per distinct value (map-side), then ranked with
    :func:`prefix`; no task holds the values of a whole group.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_cnt"))
    )
    return quantiles_of_counts(counts, keys, value, "_cnt", probs)


def quantiles_of_counts(
    counts: DataFrame, keys: Sequence[str], value: str, count: str, probs: Mapping[str, float]
) -> DataFrame:
    """Exact quantiles where each row of ``counts`` stands for ``count`` equal values."""
    keys = list(keys)
    counts = counts.select(*keys, value, F.col(count).alias("_cnt"))
    ranked = prefix(counts, keys, [value], sums={"_cum": F.col("_cnt")}, pos=None, totals=True)
    aggs, out = [], []
    x = F.col(value).cast("double")
    for i, (name, p) in enumerate(probs.items()):
        h = F.lit(float(p)) * (F.col("_cum_total") - 1)
        first, last = F.col("_cum") - F.col("_cnt"), F.col("_cum") - 1
        lo, hi = F.floor(h), F.ceil(h)
        aggs += [
            F.max(F.when((first <= lo) & (lo <= last), x)).alias(f"_lo{i}"),
            F.max(F.when((first <= hi) & (hi <= last), x)).alias(f"_hi{i}"),
            F.max(h - lo).alias(f"_f{i}"),
        ]
        out.append(
            (F.col(f"_lo{i}") + F.col(f"_f{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(name)
        )
    grouped = ranked.groupBy(*keys).agg(*aggs) if keys else ranked.agg(*aggs)
    return grouped.select(*keys, *out)


def blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    halo: int,
    size: int = 65536,
) -> DataFrame:
    """Cut each key's ordered rows into blocks of ``size`` rows that see ``halo`` rows back.

    Adds ``pos``, ``block`` and ``own``. The last ``halo`` rows of a block are repeated in
    the next one with ``own = false``; a window over (keys, block) ordered by ``pos`` then
    gives the right result on the ``own`` rows for any frame reaching back ``halo`` rows.
    """
    if halo >= size:
        raise ValueError("halo must be smaller than the block size")
    ranked = prefix(df, keys, order)
    at = F.col("pos") - 1
    home = F.floor(at / size)
    tail = (at % size) >= (size - halo)
    copies = F.when(tail, F.array(home, home + 1)).otherwise(F.array(home))
    return ranked.withColumn("block", F.explode(copies)).withColumn("own", F.col("block") == home)
