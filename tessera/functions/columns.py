"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def half_open(column: Column | str, begin, end) -> Column:
    """begin <= column < end, pushed down to the scan."""
    c = F.col(column) if isinstance(column, str) else column
    return (c >= F.lit(begin)) & (c < F.lit(end))


def trailing(column: str, date_to, days: int, day_numbers: bool = False) -> Column:
    """The window [date_to - days, date_to) on a date or on a day-number column."""
    if day_numbers:
        return half_open(column, date_to - days, date_to)
    end = F.lit(date_to).cast("timestamp_ntz")
    return (F.col(column) >= end - F.expr(f"INTERVAL {int(days)} DAYS")) & (F.col(column) < end)


def all_in(filters: Mapping[str, Sequence]) -> Column:
    """Every named column is in its list of values."""
    return reduce(lambda a, b: a & b, [F.col(c).isin(list(v)) for c, v in filters.items()], F.lit(True))


def members(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows whose id is in a (possibly long) id table."""
    return df.join(ids.select(on).distinct(), on, "left_semi")


def row_max(*columns: str, skip_nulls: bool = False) -> Column:
    """Largest of several columns; a null wins unless ``skip_nulls``."""
    best = F.greatest(*columns)
    if skip_nulls:
        return best
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return F.when(~any_null, best)


def row_sum(*columns: str) -> Column:
    """Sum of several columns, nulls counting as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in columns])


def scalar(df: DataFrame, column: str) -> Column:
    """The single value of a one-row DataFrame as a column (an uncorrelated subquery)."""
    return df.select(column).scalar()


def bins_equal_width(x: Column, lo: Column, hi: Column, k: int) -> Column:
    """1..k, right-closed bins of equal width; the smallest value falls in the first."""
    at = F.coalesce(F.ceil(F.try_divide(x - lo, (hi - lo) / k)), F.lit(1))
    return F.when(x.isNotNull(), F.least(F.lit(k), F.greatest(F.lit(1), at))).cast("int")


def bins_by_edges(x: Column, edges: Sequence[Column]) -> Column:
    """Right-closed bins over ascending edges; an edge equal to the one before counts once."""
    below = F.lit(0)
    for i, e in enumerate(edges):
        new = (e < x) if i == 0 else (e < x) & (e != edges[i - 1])
        below = below + new.cast("int")
    return F.greatest(F.lit(1), below)


def quantile_edges(quantiles: DataFrame, names: Sequence[str]) -> list[Column]:
    """The values of a one-row quantile table as literals (one number per edge)."""
    row = quantiles.select(*names).first()
    return [F.lit(row[n]) for n in names]


def digitize(x: Column, edges: Sequence[float]) -> Column:
    """How many of the ascending edges are <= x."""
    return reduce(lambda a, b: a + b, [(x >= F.lit(float(e))).cast("int") for e in edges])


def weekday0(d: Column | str) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(d)


def iso_year(d: Column | str) -> Column:
    d = F.col(d) if isinstance(d, str) else d
    return F.extract(F.lit("YEAROFWEEK"), d)


def epoch_micros(d: Column | str) -> Column:
    """Microseconds since 1970 for a timestamp without time zone (read as UTC)."""
    d = F.col(d) if isinstance(d, str) else d
    return F.unix_micros(F.to_utc_timestamp(d.cast("timestamp"), F.current_timezone()))
