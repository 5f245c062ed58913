"""Two-sample tests from grouped moments: all tests of a table in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import scalar
from tessera.functions.stats import norm_two_sided, t_two_sided
from tessera.plans.prefix import prefix


def proportion_ci(df: DataFrame, value: str, by: Sequence[str] = (), z: float = 1.96) -> DataFrame:
    """Share of ones with a normal confidence interval cut to [0, 1]."""
    agg = df.groupBy(*by).agg(F.avg(value).alias("p"), F.count(value).alias("n"))
    half = F.lit(z) * F.sqrt(F.col("p") * (1 - F.col("p")) / F.col("n"))
    return agg.withColumns(
        {"lower": F.greatest(F.lit(0.0), F.col("p") - half), "upper": F.least(F.lit(1.0), F.col("p") + half)}
    )


def moments(df: DataFrame, keys: Sequence[str], group: str, value: str) -> DataFrame:
    """n, mean and sample variance per key and group."""
    return df.groupBy(*keys, group).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var")
    )


def side_by_side(m: DataFrame, keys: Sequence[str], group: str, pilot, control, columns: Sequence[str]) -> DataFrame:
    """One row per key with ``<column>_p`` and ``<column>_c``."""
    aggs = []
    for c in columns:
        aggs.append(F.max(F.when(F.col(group) == F.lit(pilot), F.col(c))).alias(f"{c}_p"))
        aggs.append(F.max(F.when(F.col(group) == F.lit(control), F.col(c))).alias(f"{c}_c"))
    return m.groupBy(*keys).agg(*aggs)


def t_columns(equal_var: bool = False) -> dict[str, Column]:
    """delta, t and dof from n_p, mean_p, var_p and their control twins."""
    n1, n2 = F.col("n_p"), F.col("n_c")
    v1, v2 = F.col("var_p"), F.col("var_c")
    delta = F.col("mean_p") - F.col("mean_c")
    if equal_var:
        pooled = F.try_divide((n1 - 1) * v1 + (n2 - 1) * v2, n1 + n2 - 2)
        return {"delta": delta, "t": F.try_divide(delta, F.sqrt(pooled * (1 / n1 + 1 / n2))), "dof": (n1 + n2 - 2).cast("double")}
    a, b = v1 / n1, v2 / n2
    dof = F.try_divide(F.pow(a + b, F.lit(2.0)), F.try_divide(a * a, n1 - 1) + F.try_divide(b * b, n2 - 1))
    return {"delta": delta, "t": F.try_divide(delta, F.sqrt(a + b)), "dof": dof}


def t_test_of(m: DataFrame, keys: Sequence[str], group: str, pilot, control, equal_var: bool = False) -> DataFrame:
    """t test from a table of n, mean and var per key and group."""
    both = side_by_side(m, keys, group, pilot, control, ["n", "mean", "var"])
    return both.withColumns(t_columns(equal_var))


def t_test(
    df: DataFrame, group: str, value: str, pilot, control, keys: Sequence[str] = (), equal_var: bool = False
) -> DataFrame:
    """Welch (default) or pooled t test per key, with a two-sided p-value."""
    out = t_test_of(moments(df, keys, group, value), keys, group, pilot, control, equal_var)
    return out.withColumn("p_value", t_two_sided(F.col("t"), F.col("dof")))


def compare_columns(df: DataFrame, group: str, columns: Sequence[str], pilot, control) -> DataFrame:
    """One t test per listed column, in a single pass over the rows."""
    long = df.select(group, *columns).unpivot([group], list(columns), "metric", "value")
    return t_test(long, group, "value", pilot, control, ["metric"])


def pad_with_zeros(sums: DataFrame, sizes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """n, mean and variance as if every missing unit had value 0.

    ``sums`` holds sum and sumsq over the units with a value, ``sizes`` the full n. No
    padding rows are made.
    """
    joined = sizes.join(sums, list(keys), "left").fillna(0.0, ["sum", "sumsq"])
    mean = F.col("sum") / F.col("n")
    return joined.withColumns(
        {"mean": mean, "var": (F.col("sumsq") - F.col("sum") * mean) / (F.col("n") - 1)}
    )


def mann_whitney(df: DataFrame, group: str, value: str, pilot, control) -> DataFrame:
    """U of the pilot, z with tie and continuity correction, two-sided normal p-value.

    Rows collapse to one per distinct value first; mid-ranks come from a distributed
    running count.
    """
    g = F.col(group)
    counts = (
        df.where(g.isin([pilot, control]) & F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.count_if(g == F.lit(pilot)).alias("a"), F.count(F.lit(1)).alias("n"))
    )
    run = prefix(counts, [], [value], sums={"upto": F.col("n")}, pos=None)
    mid = F.col("upto") - (F.col("n") - 1) / 2.0
    s = run.agg(
        F.sum(mid * F.col("a")).alias("rank_sum"),
        F.sum("a").cast("double").alias("n1"),
        F.sum("n").cast("double").alias("n"),
        F.sum(F.pow(F.col("n").cast("double"), F.lit(3.0)) - F.col("n")).alias("ties"),
    )
    n1, n, n2 = F.col("n1"), F.col("n"), F.col("n") - F.col("n1")
    u = F.col("rank_sum") - n1 * (n1 + 1) / 2
    sd = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    far = F.abs(F.col("u") - n1 * n2 / 2)
    return (
        s.withColumn("u", u)
        .withColumn("z", F.try_divide(F.greatest(far - 0.5, F.lit(0.0)), sd))
        .withColumn("p_value", norm_two_sided(F.col("z")))
        .select("u", "z", "p_value")
    )


def histogram_overlap(df: DataFrame, group: str, value: str, pilot, control, bins: int) -> DataFrame:
    """Shared area of two distributions on common equal-width bins, and by trapezoids."""
    ends = df.agg(F.min(value).alias("a"), F.max(value).alias("b"))
    a, b = scalar(ends, "a"), scalar(ends, "b")
    at = F.when(F.col(value).isNotNull(), F.least(F.coalesce(F.floor(F.try_divide(F.col(value) - a, (b - a) / bins)), F.lit(0)), F.lit(bins - 1)))
    g = F.col(group)
    counts = df.groupBy(at.alias("bin")).agg(
        F.count_if(g == F.lit(pilot)).alias("p"), F.count_if(g == F.lit(control)).alias("c")
    )
    grid = df.sparkSession.range(bins).select(F.col("id").alias("bin")).join(counts, "bin", "left").fillna(0)
    total = grid.agg(F.sum("p").alias("p"), F.sum("c").alias("c"))
    low = F.least(F.try_divide(F.col("p"), scalar(total, "p")), F.try_divide(F.col("c"), scalar(total, "c")))
    # one row per bin: this window is as small as the histogram
    w = Window.partitionBy(F.lit(0)).orderBy("bin")
    shared = grid.withColumn("low", low).withColumn("before", F.lag("low").over(w))
    return shared.agg(F.sum("low").alias("overlap"), F.sum((F.col("low") + F.col("before")) / 2).alias("trapezoid"))
