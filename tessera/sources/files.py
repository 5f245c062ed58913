"""Readers for the file shapes the analyses start from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV with a header row and a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_text_pairs(spark: SparkSession, path: str, columns: Mapping[str, str]) -> DataFrame:
    """Tab-separated, all columns read as text; broken rows and rows with a null are dropped.

    ``columns`` maps every file column, in file order, to the name it gets; an empty name
    drops the column after the null check.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = (
        spark.read.schema(schema)
        .options(header=True, sep="\t", mode="DROPMALFORMED")
        .csv(path)
        .dropna("any")
    )
    return df.select(*[F.col(c).alias(n) for c, n in columns.items() if n])


def read_json_records(spark: SparkSession, path: str, schema: str, dates: Sequence[str] = ()) -> DataFrame:
    """JSON lines with a declared schema; ``dates`` are text columns parsed to timestamps."""
    df = spark.read.schema(schema).json(path)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in dates}) if dates else df


def parse_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Expand a JSON text column to the fields of ``schema``."""
    return df.withColumn("_rec", F.from_json(column, schema)).select("*", "_rec.*").drop("_rec")


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``token v1 v2 ...`` to (token, v: array<double>)."""
    parts = F.split("value", " ")
    return spark.read.text(path).select(
        parts[0].alias("token"),
        F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: x.cast("double")).alias("v"),
    )


class TableRegistry:
    """Names for DataFrames, so that configured feature blocks can ask for a table."""

    def __init__(self, tables: Mapping[str, DataFrame] | None = None):
        self._tables = dict(tables or {})

    def register(self, name: str, table: DataFrame) -> None:
        self._tables[name] = table

    def get(self, name: str) -> DataFrame:
        if name not in self._tables:
            raise KeyError(f"no table named {name!r}; known: {sorted(self._tables)}")
        return self._tables[name]
