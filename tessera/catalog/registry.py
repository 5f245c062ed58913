"""Registered queries: a Spark callable, its result columns and the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import Tables

# result type -> (Spark type, SQL type); dates travel as text
_TYPES = {
    "bigint": ("bigint", "BIGINT"),
    "double": ("double", "DOUBLE"),
    "fixed": ("double", "DOUBLE"),
    "string": ("string", "VARCHAR"),
    "date": ("string", "VARCHAR"),
}
#: A ``double`` keeps ten significant digits whatever its size; the order of a sum does not reach them.
DIGITS = 10
#: A ``fixed`` column keeps six decimals: differences that may cancel to zero, where relative digits are noise.
DECIMALS = 6
# shifts far below the last kept digit, so that exact halves round up in both engines
_NUDGE = 1.23e-13
_FIXED_NUDGE = 1.23e-9


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    columns: tuple[tuple[str, str], ...]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.run(Tables(spark, sf_dir))
        return df.select(*[_spark_column(c, t) for c, t in self.columns])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        cols = ", ".join(_sql_column(c, t) for c, t in self.columns)
        return f"SELECT {cols} FROM ({self.sql}) AS answer"


def _spark_column(name: str, kind: str):
    spark_type, _ = _TYPES[kind]
    col = F.col(name)
    if kind == "date":
        col = col.cast("date")
    col = col.cast(spark_type)
    if kind == "double":
        shown = F.format_string(f"%.{DIGITS - 1}e", col * F.lit(1 + _NUDGE)).cast("double")
        col = F.when(col.isNotNull(), shown + F.lit(0.0))
    if kind == "fixed":
        col = F.round(col + F.lit(_FIXED_NUDGE), DECIMALS) + F.lit(0.0)
    return col.alias(name)


def _sql_column(name: str, kind: str) -> str:
    _, sql_type = _TYPES[kind]
    expr = name
    if kind == "date":
        expr = f"CAST({expr} AS DATE)"
    expr = f"CAST({expr} AS {sql_type})"
    if kind == "double":
        expr = f"CAST(printf('%.{DIGITS - 1}e', {expr} * {1 + _NUDGE!r}) AS DOUBLE) + 0.0"
        expr = f"CASE WHEN {name} IS NOT NULL THEN {expr} END"
    if kind == "fixed":
        expr = f"round({expr} + {_FIXED_NUDGE!r}, {DECIMALS}) + 0.0"
    return f"{expr} AS {name}"


QUERIES: dict[str, Query] = {}


def query(name: str, out: str, sql: str | None = None):
    """Register a query. ``out`` lists ``column type`` pairs, separated by commas."""
    columns = tuple(tuple(part.split()) for part in out.split(","))

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, fn, columns, sql.strip() if sql else None)
        return fn

    return add
