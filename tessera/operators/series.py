"""Ordered data: lags, fills, rolling levels, ranks and splits.

Plain windows are used only where a key's rows are bounded (a series aggregated to one
row per key and day or month). Raw rows, where one key may hold a large part of the
table, go through the distributed prefix and block operators.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_order
from tessera.plans.prefix import blocks, exact_quantiles, join_on_keys, prefix


def lag_block(series: DataFrame, key: str, date: str, value: str, n: int) -> DataFrame:
    """``value_lag1..n`` of a series with one row per (key, date); one window serves all."""
    w = Window.partitionBy(key).orderBy(date)
    return series.withColumns({f"{value}_lag{i}": F.lag(value, i).over(w) for i in range(1, n + 1)})


def forward_fill(series: DataFrame, key: str, date: str, columns: Sequence[str]) -> DataFrame:
    """Last known value per key in date order (one row per key and date)."""
    w = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return series.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def forward_fill_rows(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Last known value per key over raw rows of any number."""
    return prefix(df, [key], order, lasts={c: F.col(c) for c in columns}, pos=None)


def days_since_previous(series: DataFrame, key: str, date: str, name: str = "gap") -> DataFrame:
    w = Window.partitionBy(key).orderBy(date)
    return series.withColumn(name, F.datediff(date, F.lag(date).over(w)))


def rolling(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    rows: int = 6,
    include_current: bool = True,
    block_rows: int = 65536,
) -> DataFrame:
    """Max, min and mean of the last ``rows`` rows per key."""
    cut = blocks(df, [key], order, halo=rows, size=block_rows)
    end = 0 if include_current else -1
    w = Window.partitionBy(key, "block").orderBy("pos").rowsBetween(end - rows + 1, end)
    out = {f"{value}_{fn}{rows}": getattr(F, fn)(value).over(w) for fn in ("max", "min", "mean")}
    return cut.withColumns(out).where("own").drop("block", "own", "pos")


def previous(
    df: DataFrame, key: str, order: Sequence[str], value: str, name: str, default=0.0, block_rows: int = 65536
) -> DataFrame:
    """Value of the row before per key, ``default`` on the first row."""
    cut = blocks(df, [key], order, halo=1, size=block_rows)
    w = Window.partitionBy(key, "block").orderBy("pos")
    filled = F.coalesce(F.lag(value).over(w), F.lit(default))
    return cut.withColumn(name, filled).where("own").drop("block", "own", "pos")


def standardise(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population std within each key; a zero std divides by 1."""
    stats = df.groupBy(*keys).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns]
    )
    joined = join_on_keys(df, stats, keys)
    scaled = {
        c: (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(F.lit(1.0))
        for c in columns
    }
    return joined.withColumns(scaled).select(*df.columns)


def temporal_split(df: DataFrame, key: str, date_number: str, q: float, name: str = "is_train") -> DataFrame:
    """Rows up to the exact q-quantile of each key's dates are training rows."""
    cut = exact_quantiles(df, [key], date_number, {"_cut": q})
    return join_on_keys(df, cut, [key]).withColumn(name, F.col(date_number) <= F.col("_cut")).drop("_cut")


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """Exact 1-based rank and group size; no task holds a whole group."""
    return prefix(df, keys, order, pos=name, totals=True)


def random_split(
    df: DataFrame, id_col: str, parts: Mapping[str, float], strata: Sequence[str] = (), seed: int = 0
) -> DataFrame:
    """Exact split per stratum: rows in hash order, cut at the cumulated shares."""
    shuffled = df.withColumn("_h", hash_order(F.col(id_col), seed))
    placed = prefix(shuffled, strata, ["_h", id_col], pos="_pos", totals=True)
    share, label = 0.0, None
    names = list(parts)
    for i, (part, size) in enumerate(parts.items()):
        share += size
        if i == len(names) - 1:
            label = F.lit(part) if label is None else label.otherwise(F.lit(part))
            break
        inside = F.col("_pos") <= F.round(F.col("_pos_total") * F.lit(share), 0)
        label = F.when(inside, part) if label is None else label.when(inside, part)
    return placed.withColumn("part", label).drop("_h", "_pos", "_pos_total")


def folds(df: DataFrame, id_col: str, k: int, strata: Sequence[str] = (), seed: int = 0) -> DataFrame:
    """Fold 0..k-1, balanced within each stratum."""
    shuffled = df.withColumn("_h", hash_order(F.col(id_col), seed))
    placed = prefix(shuffled, strata, ["_h", id_col], pos="_pos")
    return placed.withColumn("fold", ((F.col("_pos") - 1) % k).cast("int")).drop("_h", "_pos")


def first_crossing(df: DataFrame, keys: Sequence[str], pos: str, path: str, lower: float, upper: float) -> DataFrame:
    """First position where a running path leaves (lower, upper), strictly, on each side."""
    return df.groupBy(*keys).agg(
        F.min(F.when(F.col(path) < lower, F.col(pos))).alias("first_lower"),
        F.min(F.when(F.col(path) > upper, F.col(pos))).alias("first_upper"),
        F.count(F.lit(1)).alias("n"),
    )
