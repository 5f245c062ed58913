"""Experiment design: sample sizes, detectable effects, power and stratified selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_order
from tessera.functions.stats import norm_cdf, z_quantile
from tessera.operators.bootstrap import power_quantiles
from tessera.plans.prefix import join_on_keys, prefix


def _floats(values: Sequence[float]) -> Column:
    return F.explode(F.array(*[F.lit(float(v)) for v in values]))


def size_column(mean: Column, std: Column, effect: Column, z: Column) -> Column:
    gap = mean - mean * effect
    return F.ceil(z * z * 2 * std * std / (gap * gap))


def sample_size(df: DataFrame, metric: str, effects: Sequence[float], alpha=0.05, beta=0.2) -> DataFrame:
    """Group size needed per relative effect (population std)."""
    stats = df.agg(F.avg(metric).alias("m"), F.stddev_pop(metric).alias("s"))
    z = F.lit(power_quantiles(alpha, beta))
    return stats.withColumn("effect", _floats(effects)).select(
        "effect", size_column(F.col("m"), F.col("s"), F.col("effect"), z).alias("sample_size")
    )


def sample_size_grid(
    df: DataFrame, metric: str, effects: Sequence[float], errors: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """One row per segment and effect, one column per error level (alpha = beta = error)."""
    aggs = [F.avg(metric).alias("m"), F.stddev_pop(metric).alias("s")]
    stats = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    grid = stats.withColumn("effect", _floats(effects))
    sizes = [
        size_column(F.col("m"), F.col("s"), F.col("effect"), F.lit(power_quantiles(e, e))).alias(f"err_{round(e * 100)}")
        for e in errors
    ]
    return grid.select(*by, "effect", *sizes)


def detectable_effect(df: DataFrame, metric: str, alpha=0.05, beta=0.2, by: Sequence[str] = ()) -> DataFrame:
    """Smallest effect two groups of the observed size can show."""
    aggs = [F.stddev_pop(metric).alias("std"), F.count(metric).alias("n")]
    stats = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    z = F.lit(power_quantiles(alpha, beta))
    return stats.withColumn("mde", z * F.sqrt(2 * F.col("std") * F.col("std")) / F.sqrt("n"))


def beta_column(alpha: float, mean: Column, std: Column, two_sided: bool) -> Column:
    bound = z_quantile(1 - (alpha / 2 if two_sided else alpha))
    beta = norm_cdf((F.lit(bound) - mean) / std)
    return beta - norm_cdf((F.lit(-bound) - mean) / std) if two_sided else beta


def power_by_segment(
    df: DataFrame, metric: str, by: Sequence[str], shifts: Sequence[float], alpha=0.05, two_sided=True
) -> DataFrame:
    """Type-II error for given absolute shifts of the segment mean, in units of its standard error."""
    stats = df.groupBy(*by).agg(F.stddev_samp(metric).alias("s"), F.count(metric).alias("n"))
    grid = stats.withColumn("shift", _floats(shifts))
    z = F.col("shift") / (F.col("s") * F.sqrt(F.lit(2.0) / F.col("n")))
    return grid.withColumn("beta", beta_column(alpha, z, F.lit(1.0), two_sided)).withColumn("power", 1 - F.col("beta"))


def stratum_weights(df: DataFrame, strata: Sequence[str], name: str = "weight_s") -> DataFrame:
    counts = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("t")).select("t").scalar()
    return counts.select(*strata, (F.col("_n") / total).alias(name))


def stratified_groups(
    df: DataFrame, id_col: str, strata: Sequence[str], group_size: int, weights: DataFrame | None = None, seed=0
) -> DataFrame:
    """Pilot and control of ``group_size`` rows with the weighted strata; observed strata only.

    Each stratum gives round-half-even(weight * group_size) rows to each group, in hash
    order; the ranking spreads a dominant stratum over all partitions.
    """
    weights = stratum_weights(df, strata) if weights is None else weights
    shuffled = df.withColumn("_h", hash_order(F.col(id_col), seed))
    ranked = prefix(shuffled, strata, ["_h", id_col], pos="_pos")
    n = F.bround(F.col("weight_s") * F.lit(float(group_size)), 0)
    group = F.when(F.col("_pos") <= n, "pilot").when(F.col("_pos") <= 2 * n, "control")
    return (
        join_on_keys(ranked, weights, strata)
        .withColumn("group", group)
        .where(F.col("group").isNotNull())
        .drop("_h", "_pos", "weight_s")
    )


def stratum_imbalance(df: DataFrame, group: str, strata: Sequence[str], weights: DataFrame) -> DataFrame:
    """Share of each stratum per group against its weight."""
    counts = df.groupBy(group, *strata).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy(group).agg(F.sum("n").alias("size"))
    joined = join_on_keys(counts.join(sizes, group), weights, strata)
    return joined.withColumn("share", F.col("n") / F.col("size")).withColumn(
        "off", F.abs(F.col("share") - F.col("weight_s"))
    )


def stratified_moments(df: DataFrame, group: str, strata: Sequence[str], value: str, weights: DataFrame) -> DataFrame:
    """Per group: n, weighted mean of stratum means and weighted mean of stratum variances."""
    per = df.groupBy(group, *strata).agg(
        F.avg(value).alias("m"), F.var_samp(value).alias("v"), F.count(value).alias("c")
    )
    w = F.col("weight_s")
    return (
        join_on_keys(per, weights, strata)
        .groupBy(group)
        .agg(F.sum("c").alias("n"), F.sum(w * F.col("m")).alias("mean"), F.sum(w * F.col("v")).alias("var"))
    )
