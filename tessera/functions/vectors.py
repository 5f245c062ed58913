"""Vector arithmetic on array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def l2(a: Column, b: Column) -> Column:
    square = lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))
    return F.sqrt(_sum(F.zip_with(a, b, square)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either vector has length 0 (padding)."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))


def normalised(a: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double") / norm(a))


def mean_vector(df: DataFrame, keys: Sequence[str], vector: str, name: str = "vector") -> DataFrame:
    """Mean vector per key: sums per dimension on the map side, then one array per key."""
    per_dim = (
        df.select(*keys, F.posexplode(vector).alias("_i", "_x"))
        .groupBy(*keys, "_i")
        .agg(F.avg("_x").alias("_m"))
    )
    # one entry per dimension: the collected list is as long as the vector, not as the group
    packed = F.array_sort(F.collect_list(F.struct("_i", "_m")))
    return per_dim.groupBy(*keys).agg(F.transform(packed, lambda s: s["_m"]).alias(name))
