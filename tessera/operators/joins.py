"""Joins with the fill, key and precedence rules the analyses need."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import iso_year


def left_zero(left: DataFrame, right: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left join; the joined columns are 0 where nothing matched."""
    return left.join(right, list(on), "left").fillna(0, list(columns))


def week_keys(df: DataFrame, date: str, calendar_year: bool = False) -> DataFrame:
    """Add year and week_num; ISO year by default, calendar year on request."""
    year = F.year(date) if calendar_year else iso_year(date)
    return df.withColumns({"year": year.cast("int"), "week_num": F.weekofyear(date)})


def join_weekly(df: DataFrame, weekly: DataFrame, key: str, date: str, calendar_year: bool = False) -> DataFrame:
    """Left join of a (key, year, week_num) table to dated rows."""
    return week_keys(df, date, calendar_year).join(weekly, [key, "year", "week_num"], "left")


def full_outer(tables: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Full outer join of several tables that are unique on ``on``."""
    return reduce(lambda a, b: a.join(b, list(on), "full"), tables)


def prefer_existing(history: DataFrame, feedback: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Fill history from feedback where the history has no value yet."""
    new = feedback.select(*on, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = history.join(new, list(on), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_new_{c}")) for c in columns}).drop(
        *[f"_new_{c}" for c in columns]
    )


def enrich(
    rewards: DataFrame, sources: Sequence[tuple[DataFrame, Sequence[str]]], defaults: Mapping[str, object]
) -> DataFrame:
    """Left-join several sources in turn, then fill the named columns with defaults."""
    for table, on in sources:
        rewards = rewards.join(table, list(on), "left")
    return rewards.fillna(dict(defaults))


def only_in(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    return left.select(on).distinct().join(right.select(on), on, "left_anti")


def tagged_union(tables: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Union by column name with the table's name in ``tag``; missing columns become null."""
    frames = [df.withColumn(tag, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
