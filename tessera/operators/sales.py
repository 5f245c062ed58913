"""Daily sales metrics and grouped summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import all_in, half_open
from tessera.operators.ranking import swapped_pairs


def calendar(spark, begin: str, end: str, name: str = "day") -> DataFrame:
    """One row per day of [begin, end)."""
    days = F.sequence(F.lit(begin).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))
    return spark.range(1).select(F.explode(days).alias(name))


def daily_sales_metrics(
    df: DataFrame,
    cost: str,
    date: str,
    sale_id: str,
    period: Mapping[str, str],
    filters: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Revenue, purchases, average check and average items per day, zero on empty days.

    Lines are first summed per (day, sale), so the distinct sale count is a plain count
    and each further step works on the already smaller table.
    """
    rows = df.where(half_open(F.col(date), period["begin"], period["end"]))
    if filters:
        rows = rows.where(all_in(filters))
    checks = rows.groupBy(F.to_date(date).alias("day"), F.col(sale_id).alias("_sale")).agg(
        F.sum(cost).alias("_check"), F.count(cost).alias("_items")
    )
    known = F.col("_sale").isNotNull()
    days = checks.groupBy("day").agg(
        F.sum("_check").alias("revenue"),
        F.count("_sale").alias("number_purchases"),
        F.avg(F.when(known, F.coalesce("_check", F.lit(0.0)))).alias("average_check"),
        F.avg(F.when(known, F.col("_items"))).alias("average_number_items"),
    )
    spine = calendar(df.sparkSession, period["begin"], period["end"])
    metrics = ["revenue", "number_purchases", "average_check", "average_number_items"]
    return spine.join(days, "day", "left").select(
        "day", *[F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(m) for m in metrics]
    )


def user_metric(
    df: DataFrame, value: str, user: str, users: DataFrame, date: str, period: Mapping[str, str], metric: str
) -> DataFrame:
    """Sum of ``value`` in the period for every listed user, 0 for users without rows."""
    ids = users.select(user).distinct()
    sums = (
        df.where(half_open(F.col(date), period["begin"], period["end"]))
        .groupBy(user)
        .agg(F.sum(value).alias(metric))
    )
    return ids.join(sums, user, "left").withColumn(metric, F.coalesce(F.col(metric), F.lit(0.0)))


def grouped(df: DataFrame, by: Sequence[str], config: Mapping[str, Sequence[str]], suffix: str = "") -> DataFrame:
    """Aggregates from ``{column: [functions]}``, named ``column_function``."""
    aggs = [getattr(F, fn)(c).alias(f"{c}_{fn}{suffix}") for c, fns in config.items() for fn in fns]
    return df.groupBy(*by).agg(*aggs)


def shares(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Row count and share of the total per value."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).select("t").scalar()
    return counts.withColumn("share", F.col("n") / total)


def mode_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Most frequent value per key, the largest one on ties.

    The first group-by combines on the map side and spreads a hot key over its values.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("_n", value)).alias(name))


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between the global min and max: (bin, lo, hi, n), empty bins kept."""
    ends = df.agg(F.min(value).cast("double").alias("a"), F.max(value).cast("double").alias("b"))
    a, b = ends.select("a").scalar(), ends.select("b").scalar()
    at = F.least(F.coalesce(F.floor(F.try_divide(F.col(value) - a, (b - a) / bins)), F.lit(0)), F.lit(bins - 1))
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    if by:
        spine = df.select(*by).distinct().select(*by, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).cast("bigint").alias("bin"))
    out = spine.join(counts, [*by, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    width = (b - a) / bins
    return out.withColumns({"lo": a + F.col("bin") * width, "hi": a + (F.col("bin") + 1) * width})


def kendall_tau_b(df: DataFrame, x: str, y: str) -> DataFrame:
    """Kendall's tau-b of two columns.

    Discordant pairs are the swapped pairs of x against y, concordant ones those against
    -y; both are counted from running sums over distinct values, never by pairing rows.
    """
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.lit(0).alias("_all"), F.col(x).alias("x"), F.col(y).cast("double").alias("y"), (-F.col(y).cast("double")).alias("back")
    )
    # five single numbers; each would otherwise be planned again wherever it is used
    number = lambda one_row: one_row.first()[0] or 0
    pairs_of = lambda n: n * (n - 1) / 2
    tied = lambda c: number(
        rows.groupBy(c).agg(F.count(F.lit(1)).cast("double").alias("n")).agg(F.sum(pairs_of(F.col("n"))))
    )
    swapped = lambda against: number(swapped_pairs(rows, "_all", "x", against).select("swapped"))
    score = float(swapped("back") - swapped("y"))
    every = pairs_of(F.count(F.lit(1)).cast("double"))
    return rows.agg((F.lit(score) / F.sqrt((every - F.lit(tied("x"))) * (every - F.lit(tied("y"))))).alias("tau"))
