"""Bootstrap intervals and simulated error rates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.stats import norm_two_sided, t_two_sided, z_quantile
from tessera.operators.abtest import side_by_side, t_columns
from tessera.plans.resample import interval, permuted_moments, weighted_sums


def bootstrap_statistic(
    df: DataFrame,
    unit: Sequence[str],
    keys: Sequence[str],
    sums: Mapping[str, Column],
    statistic: Column,
    iterations: int,
    seed=0,
) -> DataFrame:
    """Replicates of a statistic given over resampled sums and the resampled count ``n``.

    Any mergeable statistic works: name its sums, then express it over them.
    """
    return weighted_sums(df, unit, keys, sums, iterations, seed).withColumn("stat", statistic)


def bootstrap_mean_difference(
    df: DataFrame, unit: str, group: str, value: str, pilot, control, iterations: int, alpha=0.05, seed=0, keys: Sequence[str] = ()
) -> DataFrame:
    """Percentile interval of mean(pilot) - mean(control), and whether it excludes 0."""
    reps = bootstrap_statistic(
        df, [unit], [*keys, group], {"s": F.col(value)}, F.col("s") / F.col("n"), iterations, seed
    )
    both = side_by_side(reps, [*keys, "iter"], group, pilot, control, ["stat"])
    out = interval(both.withColumn("d", F.col("stat_p") - F.col("stat_c")), keys, "d", alpha)
    return out.withColumn("significant", ((F.col("lower") > 0) | (F.col("upper") < 0)).cast("int"))


def skew_of_sums() -> tuple[Callable[[str], Mapping[str, Column]], Column]:
    """Power sums and the population skewness they give."""
    sums = lambda value: {
        "s1": F.col(value),
        "s2": F.col(value) * F.col(value),
        "s3": F.col(value) * F.col(value) * F.col(value),
    }
    m = F.col("s1") / F.col("n")
    var = F.col("s2") / F.col("n") - m * m
    third = F.col("s3") / F.col("n") - 3 * m * F.col("s2") / F.col("n") + 2 * m * m * m
    return sums, F.try_divide(third, F.pow(var, F.lit(1.5)))


def bootstrap_skewness(df: DataFrame, unit: str, value: str, iterations: int, alpha=0.05, seed=0) -> DataFrame:
    """Point estimate with percentile and pivotal intervals."""
    sums, stat = skew_of_sums()
    reps = bootstrap_statistic(df, [unit], [], sums(value), stat, iterations, seed)
    point = df.agg(F.skewness(value).alias("p")).select("p").scalar()
    return (
        interval(reps, [], "stat", alpha)
        .withColumn("point", point)
        .withColumns({"pivot_lower": 2 * F.col("point") - F.col("upper"), "pivot_upper": 2 * F.col("point") - F.col("lower")})
    )


def resampled_moments(df: DataFrame, unit: str, group: str, value: str, iterations: int, seed=0) -> DataFrame:
    """n, mean, var per group and iteration."""
    sums = {"s1": F.col(value), "s2": F.col(value) * F.col(value)}
    n, s1 = F.col("n"), F.col("s1")
    return weighted_sums(df, [unit], [group], sums, iterations, seed).withColumns(
        {"mean": s1 / n, "var": (F.col("s2") - s1 * s1 / n) / (n - 1)}
    )


def type_one_error(
    df: DataFrame, unit: str, group: str, value: str, pilot, control, iterations: int, alpha=0.05, seed=0
) -> DataFrame:
    """Share of resampled A/A comparisons a t test calls significant."""
    m = resampled_moments(df, unit, group, value, iterations, seed)
    both = side_by_side(m, ["iter"], group, pilot, control, ["n", "mean", "var"]).withColumns(t_columns(equal_var=True))
    tested = both.withColumn("p_value", t_two_sided(F.col("t"), F.col("dof")))
    return tested.agg(
        F.avg((F.col("p_value") < alpha).cast("int")).alias("error"), F.avg("t").alias("mean_t"), F.count("t").alias("n")
    )


def type_two_error(
    df: DataFrame,
    unit: str,
    group: str,
    value: str,
    pilot,
    control,
    effects: Sequence[float],
    iterations: int,
    alpha=0.05,
    seed=0,
    additive: bool = False,
) -> DataFrame:
    """Share of missed effects per effect size.

    The effect acts on the resampled moments (a factor on the values scales mean and
    variance, an added noisy effect shifts them), so the rows are read once for all effects.
    """
    m = resampled_moments(df, unit, group, value, iterations, seed)
    both = side_by_side(m, ["iter"], group, pilot, control, ["n", "mean", "var"])
    grid = both.withColumn("effect", F.explode(F.array(*[F.lit(float(e)) for e in effects])))
    e = F.col("effect")
    if additive:
        shift = F.col("mean_p") * (e - 1)
        changed = {"mean_p": F.col("mean_p") + shift, "var_p": F.col("var_p") * (1 + F.lit(0.01))}
    else:
        changed = {"mean_p": F.col("mean_p") * e, "var_p": F.col("var_p") * e * e}
    tested = grid.withColumns(changed).withColumns(t_columns(equal_var=True)).withColumn(
        "p_value", t_two_sided(F.col("t"), F.col("dof"))
    )
    return tested.groupBy("effect").agg(
        F.avg((F.col("p_value") >= alpha).cast("int")).alias("error"), F.avg("t").alias("mean_t")
    )


def ratio_bootstrap(
    users: DataFrame, user: str, group: str, x: str, y: str, pilot, control, iterations: int, seed=0
) -> DataFrame:
    """Difference of sum(x)/sum(y) with a normal p-value from the spread over user resamples."""
    reps = bootstrap_statistic(
        users, [user], [group], {"x": F.col(x), "y": F.col(y)}, F.col("x") / F.col("y"), iterations, seed
    )
    spread = (
        side_by_side(reps, ["iter"], group, pilot, control, ["stat"])
        .agg(F.stddev_pop(F.col("stat_p") - F.col("stat_c")).alias("std"))
        .select("std")
        .scalar()
    )
    g = F.col(group)
    part = lambda who, c: F.sum(F.when(g == F.lit(who), F.col(c)))
    return (
        users.agg((part(pilot, x) / part(pilot, y) - part(control, x) / part(control, y)).alias("delta"))
        .withColumn("std", spread)
        .withColumn("p_value", norm_two_sided(F.col("delta") / F.col("std")))
    )


def stratified_bootstrap(
    df: DataFrame, unit: str, group: str, stratum: str, value: str, weights: DataFrame, pilot, control, iterations: int, alpha=0.05, seed=0
) -> DataFrame:
    """Interval of the difference of weighted stratum means; each group keeps its own strata."""
    reps = bootstrap_statistic(
        df, [unit], [group, stratum], {"s": F.col(value)}, F.col("s") / F.col("n"), iterations, seed
    )
    means = (
        reps.join(weights, stratum)
        .groupBy("iter", group)
        .agg(F.sum(F.col("weight_s") * F.col("stat")).alias("stat"))
    )
    both = side_by_side(means, ["iter"], group, pilot, control, ["stat"])
    return interval(both.withColumn("d", F.col("stat_p") - F.col("stat_c")), [], "d", alpha)


def effect_bootstrap(
    df: DataFrame, unit: str, w: str, targets: Sequence[str], iterations: int, seed=0
) -> DataFrame:
    """Mean +- 2 std of the absolute and relative effect per target."""
    long = df.select(unit, w, *[F.col(c).cast("double").alias(c) for c in targets]).unpivot(
        [unit, w], list(targets), "target", "y"
    )
    reps = bootstrap_statistic(long, [unit], ["target", w], {"s": F.col("y")}, F.col("s") / F.col("n"), iterations, seed)
    both = side_by_side(reps, ["target", "iter"], w, 1, 0, ["stat"]).withColumns(
        {"ate": F.col("stat_p") - F.col("stat_c"), "rel": F.col("stat_p") / F.col("stat_c")}
    )
    aggs = []
    for c in ("ate", "rel"):
        aggs.append((F.avg(c) - 2 * F.stddev_pop(c)).alias(f"{c}_low"))
        aggs.append((F.avg(c) + 2 * F.stddev_pop(c)).alias(f"{c}_high"))
    return both.groupBy("target").agg(*aggs)


def permutation_tests(
    df: DataFrame, id_col: str, values: Sequence[str], n_first, permutations: int, seed=0
) -> DataFrame:
    """Pooled t test of every permutation and metric: (perm, metric, delta, t, dof, p_value)."""
    m = permuted_moments(df, id_col, values, n_first, permutations, seed).withColumnsRenamed(
        {"n1": "n_p", "mean1": "mean_p", "var1": "var_p", "n2": "n_c", "mean2": "mean_c", "var2": "var_c"}
    )
    return m.withColumns(t_columns(equal_var=True)).withColumn("p_value", t_two_sided(F.col("t"), F.col("dof")))


def significant_metrics(tests: DataFrame, alpha: float = 0.05, q: float = 0.95) -> DataFrame:
    """Null distribution of the number of significant, positive metrics, with its upper bound."""
    hit = ((F.col("p_value") < alpha) & (F.col("delta") > 0)).cast("int")
    counts = tests.groupBy("perm").agg(F.sum(hit).alias("hits"))
    bound = counts.agg(F.percentile("hits", F.lit(q)).alias("b")).select("b").scalar()
    return counts.groupBy("hits").agg(F.count(F.lit(1)).alias("n")).withColumn("bound", bound)


def power_quantiles(alpha: float, beta: float) -> float:
    return z_quantile(1 - alpha / 2) + z_quantile(1 - beta)
