"""Price levels, promotions, rivals, profiles and joined feature tables per item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import iso_year, row_max
from tessera.operators.joins import join_weekly
from tessera.operators.series import days_since_previous, lag_block, rolling


def price_summary(df: DataFrame, keys: Sequence[str], paid: str, discount: str) -> DataFrame:
    """Max, mean and min of the price before discount and of the price paid."""
    share = F.coalesce(F.col(discount), F.lit(0.0))
    levels = {"true": F.col(paid) / (1 - share), "paid": F.col(paid)}
    aggs = [getattr(F, fn)(col).alias(f"{fn}_{name}") for name, col in levels.items() for fn in ("max", "avg", "min")]
    return df.groupBy(*keys).agg(*aggs)


def promo_effect(df: DataFrame, key: str, sold: str, discount: str) -> DataFrame:
    """Mean sales per item with and without a promotion, and their difference."""
    on = F.col(discount).isNotNull()
    return df.groupBy(key).agg(
        F.avg(F.when(on, F.col(sold))).alias("with_promo"), F.avg(F.when(~on, F.col(sold))).alias("without_promo")
    ).withColumn("diff", F.col("with_promo") - F.col("without_promo"))


def competitiveness(
    own: DataFrame, rivals: DataFrame, on: Sequence[str], price: str, rival: str, by: Sequence[str]
) -> DataFrame:
    """Share of own prices at or below the cheapest rival price of the same key."""
    cheapest = rivals.groupBy(*on).agg(F.min(rival).alias("_rival"))
    below = (F.col(price) <= F.col("_rival")).cast("int")
    joined = own.join(cheapest, list(on))
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(below).alias("at_or_below"), F.sum(below).alias("n_below")]
    return joined.groupBy(*by).agg(*aggs) if by else joined.agg(*aggs)


def gap_stats(df: DataFrame, key: str, date: str) -> DataFrame:
    """Largest and median number of days between the distinct days of a key.

    A key has at most one gap per day of the calendar, so its gaps are aggregated as they are.
    """
    days = df.select(key, F.to_date(date).alias("_d")).distinct()
    gaps = days_since_previous(days, key, "_d", "_gap")
    return gaps.groupBy(key).agg(F.max("_gap").alias("max_gap"), F.percentile("_gap", F.lit(0.5)).alias("median_gap"))


def seasonal_profile(df: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Mean value per key by month of year, year-month and ISO year-week, in one pass."""
    labels = F.array(
        F.struct(F.lit("month").alias("period"), F.lpad(F.month(date).cast("string"), 2, "0").alias("label")),
        F.struct(F.lit("year_month").alias("period"), F.date_format(date, "yyyy-MM").alias("label")),
        F.struct(
            F.lit("year_week").alias("period"),
            F.concat_ws("-", iso_year(date).cast("string"), F.lpad(F.weekofyear(date).cast("string"), 2, "0")).alias("label"),
        ),
    )
    return (
        df.select(key, value, F.explode(labels).alias("p"))
        .groupBy(key, "p.period", "p.label")
        .agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
    )


def path_pivot(df: DataFrame, date: str, key: str, keys: Sequence, value: str) -> DataFrame:
    """Date x key table of mean values; the key list is given, so no extra job runs."""
    return df.groupBy(date).pivot(key, list(keys)).agg(F.avg(value))


def stacked_features(
    forecast: DataFrame, promo: DataFrame, rivals: DataFrame, key: str, date: str, rival_prices: Sequence[str]
) -> DataFrame:
    """Forecast rows with the week's promo discount and the highest rival price, 0 where absent."""
    best = rivals.select(key, "year", "week_num", row_max(*rival_prices, skip_nulls=True).alias("rival_price"))
    joined = join_weekly(forecast, promo, key, date).join(best, [key, "year", "week_num"], "left")
    return joined.fillna(0, ["discount", "rival_price"])


def user_price_level(df: DataFrame, user: str, order: Sequence[str], price: str, accepted: str, rows: int = 6) -> DataFrame:
    """Rolling price level of a user's accepted purchases."""
    return rolling(df.where(F.col(accepted) == 1), user, order, price, rows)


def price_model_features(
    requests: DataFrame,
    monthly: DataFrame,
    users: DataFrame,
    promo: DataFrame,
    rivals: DataFrame,
    key: str,
    user: str,
    month: str,
    date: str,
    lags: int,
) -> DataFrame:
    """Requests with user level, item price lags, promo and rival columns (left joins)."""
    lagged = lag_block(monthly, key, month, "price", lags).drop("price")
    return (
        join_weekly(requests, promo, key, date)
        .join(rivals, [key, "year", "week_num"], "left")
        .join(lagged, [key, month], "left")
        .join(users, user, "left")
    )
