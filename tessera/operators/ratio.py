"""Ratio metrics: sessions per user, tested by five methods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import half_open, scalar
from tessera.functions.hashing import md5_mod
from tessera.functions.stats import norm_two_sided
from tessera.operators.abtest import side_by_side, t_test
from tessera.operators.bootstrap import ratio_bootstrap


def user_sums(df: DataFrame, user: str, value: str, extra: Sequence[str] = ()) -> DataFrame:
    """x = sum and y = count of the value per user; all further work is per user."""
    return df.groupBy(user, *extra).agg(F.sum(value).alias("x"), F.count(value).alias("y"))


def linearised_metric(
    df: DataFrame, value: str, user: str, users: DataFrame, date: str, period: Mapping[str, str], metric: str, kappa: float | None = None
) -> DataFrame:
    """x - kappa*y per listed user; kappa is the overall ratio of those users if not given."""
    ids = users.select(user).distinct()
    rows = df.where(half_open(date, period["begin"], period["end"])).join(ids, user, "left_semi")
    sums = user_sums(rows, user, value)
    k = F.lit(float(kappa)) if kappa is not None else scalar(sums.agg((F.sum("x") / F.sum("y")).alias("k")), "k")
    lin = sums.select(user, (F.col("x") - k * F.col("y")).alias(metric))
    return ids.join(lin, user, "left").fillna(0.0, [metric])


def naive_test(df: DataFrame, group: str, value: str, pilot, control) -> DataFrame:
    """t test over single sessions, ignoring that sessions of a user belong together."""
    return t_test(df, group, value, pilot, control, equal_var=True)


def average_test(users: DataFrame, group: str, pilot, control) -> DataFrame:
    """t test over the users' own averages."""
    return t_test(users.withColumn("avg", F.col("x") / F.col("y")), group, "avg", pilot, control, equal_var=True)


def delta_test(users: DataFrame, group: str, pilot, control) -> DataFrame:
    """Difference of ratios with the delta-method variance (population std, sample covariance)."""
    m = users.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("x").alias("mx"),
        F.avg("y").alias("my"),
        F.var_pop("x").alias("vx"),
        F.var_pop("y").alias("vy"),
        F.covar_samp("x", "y").alias("cov"),
    )
    mx, my = F.col("mx"), F.col("my")
    var = (
        F.col("vx") / (my * my) + mx * mx * F.col("vy") / F.pow(my, F.lit(4.0)) - 2 * mx * F.col("cov") / F.pow(my, F.lit(3.0))
    ) / F.col("n")
    both = side_by_side(m.withColumns({"ratio": mx / my, "var": var}), [], group, pilot, control, ["ratio", "var"])
    delta = F.col("ratio_p") - F.col("ratio_c")
    return (
        both.withColumn("delta", delta)
        .withColumn("z", F.col("delta") / F.sqrt(F.col("var_p") + F.col("var_c")))
        .withColumn("p_value", norm_two_sided(F.col("z")))
    )


def control_ratio(users: DataFrame, group: str, control) -> Column:
    return scalar(users.where(F.col(group) == F.lit(control)).agg((F.sum("x") / F.sum("y")).alias("k")), "k")


def linearised(users: DataFrame, group: str, control, name: str = "lin") -> DataFrame:
    """x - kappa*y with kappa from the control group."""
    return users.withColumn(name, F.col("x") - control_ratio(users, group, control) * F.col("y"))


def linearised_test(users: DataFrame, group: str, pilot, control) -> DataFrame:
    return t_test(linearised(users, group, control), group, "lin", pilot, control, equal_var=True)


def compare_methods(
    df: DataFrame, user: str, group: str, value: str, pilot, control, iterations: int = 100, seed=0
) -> DataFrame:
    """delta and p-value of each method over the same rows."""
    users = user_sums(df, user, value, [group])
    results = {
        "naive": naive_test(df, group, value, pilot, control),
        "average": average_test(users, group, pilot, control),
        "bootstrap": ratio_bootstrap(users, user, group, "x", "y", pilot, control, iterations, seed),
        "delta": delta_test(users, group, pilot, control),
        "linearised": linearised_test(users, group, pilot, control),
    }
    rows = [r.select(F.lit(name).alias("method"), "delta", "p_value") for name, r in results.items()]
    return reduce(DataFrame.unionByName, rows)


def bucket_sums(df: DataFrame, group: str, unit: str, value: str, buckets: int) -> DataFrame:
    """Sum per group and hash bucket of the units: dependent rows of a unit stay together."""
    bucket = md5_mod(F.col(unit).cast("string"), buckets)
    return df.groupBy(group, bucket.alias("bucket")).agg(F.sum(value).alias("total"))
