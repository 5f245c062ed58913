"""Variance reduction with pre-period covariates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import half_open, scalar
from tessera.operators.abtest import moments, t_test


def theta(df: DataFrame, y: str, covariate: str):
    """Sample covariance over population variance, as a subquery column."""
    t = df.agg((F.coalesce(F.try_divide(F.covar_samp(covariate, y), F.var_pop(covariate)), F.lit(0.0))).alias("theta"))
    return scalar(t, "theta")


def adjust(df: DataFrame, y: str, covariate: str, name: str) -> DataFrame:
    return df.withColumn(name, F.col(y) - theta(df, y, covariate) * F.col(covariate))


def cuped_metric(
    df: DataFrame, value: str, user: str, users: DataFrame, date: str, periods: Mapping[str, Mapping[str, str]], metric: str
) -> DataFrame:
    """Pilot-period sum, pre-period sum and adjusted metric per listed user, one scan for both."""
    ids = users.select(user).distinct()
    in_pilot = half_open(date, periods["pilot"]["begin"], periods["pilot"]["end"])
    in_before = half_open(date, periods["prepilot"]["begin"], periods["prepilot"]["end"])
    sums = (
        df.where(in_pilot | in_before)
        .groupBy(user)
        .agg(
            F.sum(F.when(in_pilot, F.col(value))).alias(metric),
            F.sum(F.when(in_before, F.col(value))).alias(f"{metric}_cov"),
        )
    )
    both = ids.join(sums, user, "left").fillna(0.0, [metric, f"{metric}_cov"])
    return adjust(both, metric, f"{metric}_cov", f"{metric}_cuped")


def cuped_test(
    df: DataFrame, group: str, y: str, covariate: str, pilot, control, keys: Sequence[str] = ()
) -> DataFrame:
    """t test before and after adjustment with theta pooled over both groups."""
    adjusted = adjust(df, y, covariate, "_adj")
    plain = t_test(adjusted, group, y, pilot, control, equal_var=True)
    better = t_test(adjusted, group, "_adj", pilot, control, equal_var=True)
    pick = lambda d, name: d.select(
        F.lit(name).alias("metric"), "delta", "t", "p_value", "var_p", "var_c"
    )
    return pick(plain, "plain").unionByName(pick(better, "cuped"))


def variance_reduction(df: DataFrame, group: str, y: str, covariate: str) -> DataFrame:
    """Variance of the metric and of the adjusted metric per group, and their ratio."""
    adjusted = adjust(df, y, covariate, "_adj")
    return adjusted.groupBy(group).agg(F.var_samp(y).alias("var_plain"), F.var_samp("_adj").alias("var_cuped")).withColumn(
        "ratio", F.try_divide(F.col("var_plain"), F.col("var_cuped"))
    )


def model_covariate(
    train: DataFrame, score: DataFrame, features: Sequence[str], y: str, name: str = "prediction", reg: float = 1.0
) -> DataFrame:
    """Ridge prediction of the metric, fitted on rows outside the test, as a covariate.

    A null feature counts as the mean over the training rows (0 if those have none), so that
    every row of ``score`` gets a prediction; training rows without the metric are left out.
    """
    means = train.agg(*[F.avg(f).alias(f) for f in features]).first().asDict()
    filled = {f: F.coalesce(F.col(f).cast("double"), F.lit(float(means[f] or 0.0))) for f in features}
    train, score = train.where(F.col(y).isNotNull()).withColumns({f"_f_{f}": c for f, c in filled.items()}), score.withColumns({f"_f_{f}": c for f, c in filled.items()})
    assembler = VectorAssembler(inputCols=[f"_f_{f}" for f in features], outputCol="_x")
    model = LinearRegression(featuresCol="_x", labelCol=y, predictionCol=name, regParam=reg, solver="normal").fit(
        assembler.transform(train)
    )
    return model.transform(assembler.transform(score)).drop("_x", *[f"_f_{f}" for f in features])
