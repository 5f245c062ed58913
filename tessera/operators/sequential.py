"""Sequential tests over paired observations in time order."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import log, pi

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.stats import norm_log_density, t_two_sided
from tessera.operators.abtest import t_columns
from tessera.operators.series import first_crossing
from tessera.plans.prefix import prefix

LogDensity = Callable[[Column], Column]


def normal(mean: float, std: float) -> LogDensity:
    """Log-density of a normal distribution as a column function."""
    return lambda x: norm_log_density(x, mean, std)


def normal_array(mean: float, std: float) -> Callable[[np.ndarray], np.ndarray]:
    """:func:`normal` for arrays, as keyed streams want it."""
    return lambda x: -(((x - mean) / std) ** 2) / 2 - log(std) - log(2 * pi) / 2


def bounds(alpha: float, beta: float) -> tuple[float, float]:
    return log(beta / (1 - alpha)), log((1 - beta) / alpha)


def pairs(df: DataFrame, keys: Sequence[str], group: str, order: Sequence[str], value: str, pilot, control) -> DataFrame:
    """The i-th pilot value beside the i-th control value, up to the shorter group."""
    ranked = prefix(df.select(*keys, group, *order, value), [*keys, group], order, pos="i")
    g = F.col(group)
    return (
        ranked.groupBy(*keys, "i")
        .agg(
            F.max(F.when(g == F.lit(pilot), F.col(value))).alias("pilot"),
            F.max(F.when(g == F.lit(control), F.col(value))).alias("control"),
        )
        .where(F.col("pilot").isNotNull() & F.col("control").isNotNull())
    )


def decide(crossings: DataFrame, step: int = 1) -> DataFrame:
    """result 0, 1 or 0.5 and the number of pairs used; the earlier crossing wins."""
    lo, hi = F.col("first_lower"), F.col("first_upper")
    lower_first = lo.isNotNull() & (hi.isNull() | (lo < hi))
    result = F.when(lower_first, 0.0).when(hi.isNotNull(), 1.0).otherwise(0.5)
    length = F.when(lower_first, lo).when(hi.isNotNull(), hi).otherwise(F.col("n")) * step
    return crossings.withColumns({"result": result, "length": length}).drop("first_lower", "first_upper", "n")


def wald(
    df: DataFrame,
    keys: Sequence[str],
    group: str,
    order: Sequence[str],
    value: str,
    pilot,
    control,
    null: LogDensity,
    alternative: LogDensity,
    alpha=0.05,
    beta=0.2,
    batch_size: int = 1,
) -> DataFrame:
    """Sequential probability ratio test; batches look only after each full block of pairs."""
    paired = pairs(df, keys, group, order, value, pilot, control)
    d = F.col("pilot") - F.col("control")
    ratios = paired.select(*keys, "i", (alternative(d) - null(d)).alias("llr"))
    if batch_size > 1:
        block = F.floor((F.col("i") - 1) / batch_size) + 1
        ratios = (
            ratios.groupBy(*keys, block.alias("i"))
            .agg(F.sum("llr").alias("llr"), F.count(F.lit(1)).alias("c"))
            .where(F.col("c") == batch_size)
        )
    path = prefix(ratios, keys, ["i"], sums={"z": F.col("llr")}, pos=None)
    lower, upper = bounds(alpha, beta)
    return decide(first_crossing(path, keys, "i", "z", lower, upper), batch_size)


def peeking(
    df: DataFrame, keys: Sequence[str], group: str, order: Sequence[str], value: str, pilot, control, alpha=0.05
) -> DataFrame:
    """First number of pairs at which a repeated t test is significant, and the number tried."""
    paired = pairs(df, keys, group, order, value, pilot, control)
    a, b = F.col("pilot"), F.col("control")
    run = prefix(paired, keys, ["i"], sums={"s1": a, "q1": a * a, "s2": b, "q2": b * b}, pos=None)
    n = F.col("i").cast("double")
    var = lambda s, q: (F.col(q) - F.col(s) * F.col(s) / n) / (n - 1)
    moments = run.where("i >= 2").withColumns(
        {
            "n_p": n,
            "mean_p": F.col("s1") / n,
            "var_p": var("s1", "q1"),
            "n_c": n,
            "mean_c": F.col("s2") / n,
            "var_c": var("s2", "q2"),
        }
    )
    tested = moments.withColumns(t_columns(equal_var=True)).withColumn("p_value", t_two_sided(F.col("t"), F.col("dof")))
    return tested.groupBy(*keys).agg(
        F.min(F.when(F.col("p_value") < alpha, F.col("i"))).alias("first_hit"), F.max("i").alias("pairs")
    )
