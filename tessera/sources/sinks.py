"""Writers and report shapes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.prefix import prefix


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_features(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_items(items: DataFrame, path: str, kind: str = "item_type") -> None:
    """JSON lines, one folder per item kind."""
    items.write.mode("overwrite").partitionBy(kind).json(path)


def json_records(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """One JSON text per row with fixed column types, in the given column order."""
    rec = F.struct(*[F.col(c).cast(t).alias(c) for c, t in casts.items()])
    return df.select(*[c for c in df.columns if c not in casts], F.to_json(rec).alias("record"))


def top_fractions(df: DataFrame, id_col: str, score: str, cutoffs: Sequence[float]) -> DataFrame:
    """Ranked ids for each cutoff: of N rows with a positive score, the best floor(N*cutoff).

    One ranking serves all cutoffs; the rank is a distributed prefix count.
    """
    ranked = prefix(
        df.where(F.col(score) > 0).select(id_col, score),
        [],
        [F.col(score).desc(), F.col(id_col)],
        pos="rank",
        totals=True,
    )
    cuts = F.explode(F.array(*[F.lit(float(c)) for c in cutoffs])).alias("cutoff")
    return (
        ranked.select("*", cuts)
        .where(F.col("rank") <= F.floor(F.col("rank_total") * F.col("cutoff")))
        .drop("rank_total")
    )
