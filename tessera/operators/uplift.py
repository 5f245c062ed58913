"""Uplift reports: effects, uplift at k, gain curves and targeting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import poisson1, uniform
from tessera.plans.prefix import exact_quantiles, prefix


def effect(y: Column, w: Column) -> Column:
    """Mean outcome of the treated minus mean outcome of the controls."""
    return F.avg(F.when(w == 1, y)) - F.avg(F.when(w == 0, y))


def effect_table(df: DataFrame, w: Column, targets: Sequence[str]) -> DataFrame:
    """Control mean, treated mean, absolute and relative effect per target."""
    long = df.select(w.alias("_w"), *[F.col(c).cast("double").alias(c) for c in targets]).unpivot(
        ["_w"], list(targets), "target", "_y"
    )
    out = long.groupBy("target").agg(
        F.avg(F.when(F.col("_w") == 0, F.col("_y"))).alias("control_mean"),
        F.avg(F.when(F.col("_w") == 1, F.col("_y"))).alias("treated_mean"),
    )
    return out.withColumns(
        {
            "effect": F.col("treated_mean") - F.col("control_mean"),
            "relative": F.col("treated_mean") / F.col("control_mean") - 1,
        }
    )


def uplift_at_k(
    df: DataFrame, id_col: str, score: str, w: str, y: str, ks: Sequence[float], rule: str = "per_arm_total"
) -> DataFrame:
    """Mean outcome of the top treated minus the top controls, for all cutoffs at once.

    ``per_arm_total`` takes the best int(k*N) of each arm, N counting both arms; ``overall``
    takes the best int(k*N) rows and splits them by arm.
    """
    order = [F.col(score).desc(), id_col]
    keep = df.select(id_col, score, w, y)
    if rule == "per_arm_total":
        ranked = prefix(keep, [w], order, pos="_rank")
    elif rule == "overall":
        ranked = prefix(keep, [], order, pos="_rank")
    else:
        raise ValueError(f"unknown rule {rule!r}")
    total = ranked.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    aggs = []
    for i, k in enumerate(ks):
        n = F.floor(total * F.lit(float(k)))
        top = F.col("_rank") <= n
        aggs.append(
            (F.avg(F.when(top & (F.col(w) == 1), F.col(y))) - F.avg(F.when(top & (F.col(w) == 0), F.col(y)))).alias(f"u{i}")
        )
    wide = ranked.agg(*aggs)
    rows = F.explode(
        F.array(*[F.struct(F.lit(float(k)).alias("k"), F.col(f"u{i}").alias("uplift")) for i, k in enumerate(ks)])
    )
    return wide.select(rows.alias("r")).select("r.k", "r.uplift")


def gain_curve(df: DataFrame, id_col: str, score: str, w: str, y: str) -> DataFrame:
    """Cumulative gain (n * difference of running means) after each row in score order."""
    run = prefix(
        df.select(id_col, score, w, y),
        [],
        [F.col(score).desc(), id_col],
        sums={
            "n_t": (F.col(w) == 1).cast("bigint"),
            "y_t": F.when(F.col(w) == 1, F.col(y)).otherwise(0).cast("double"),
            "y_all": F.col(y).cast("double"),
        },
        pos="n",
    )
    n_c = F.col("n") - F.col("n_t")
    lift = F.col("y_t") / F.col("n_t") - (F.col("y_all") - F.col("y_t")) / n_c
    return run.withColumn(
        "gain", F.when((F.col("n_t") > 0) & (n_c > 0), lift * F.col("n")).otherwise(F.lit(0.0))
    ).select(id_col, "n", "gain")


def targets_above(df: DataFrame, id_col: str, score: str, threshold: float) -> DataFrame:
    return df.where(F.col(score) > threshold).select(id_col)


def uplift_curve(
    df: DataFrame, id_col: str, score: str, w: str, y: str, ks: Sequence[float], iterations: int, seed=0
) -> DataFrame:
    """Mean and std of uplift@k over bootstrap draws, for every cutoff.

    The order by score is the same in all draws, so one distributed ranking carries the
    running resampled count of every draw; a row on the border counts with the copies that
    still fit. Scores, arms and outcomes of one draw stay together.
    """
    draws = range(iterations)
    uniforms = {f"_u{b}": uniform(F.col(id_col), seed, b) for b in draws}
    weights = {f"w{b}": poisson1(F.col(f"_u{b}")) for b in draws}
    rows = df.select(id_col, score, w, y).withColumns(uniforms).withColumns(weights).drop(*uniforms)
    ranked = prefix(
        rows, [w], [F.col(score).desc(), id_col], sums={f"c{b}": F.col(f"w{b}") for b in draws}, pos=None
    )
    sizes = rows.agg(*[F.sum(f"w{b}").alias(f"w{b}") for b in draws]).first()
    per_draw = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(b).alias("draw"),
                    F.lit(sizes[f"w{b}"]).alias("size"),
                    F.col(f"w{b}").alias("weight"),
                    F.col(f"c{b}").alias("upto"),
                )
                for b in draws
            ]
        )
    )
    long = ranked.select(w, y, per_draw.alias("d")).select(w, y, "d.*").where("weight > 0")
    aggs = []
    for i, k in enumerate(ks):
        n = F.floor(F.col("size") * F.lit(float(k)))
        used = F.greatest(F.lit(0), F.least(F.col("weight"), n - (F.col("upto") - F.col("weight"))))
        for arm in (0, 1):
            mine = F.col(w) == arm
            aggs.append(
                (F.sum(F.when(mine, used * F.col(y))) / F.nullif(F.sum(F.when(mine, used)), F.lit(0))).alias(f"m{arm}_{i}")
            )
    means = long.groupBy("draw").agg(*aggs)
    each = F.explode(
        F.array(
            *[
                F.struct(F.lit(float(k)).alias("k"), (F.col(f"m1_{i}") - F.col(f"m0_{i}")).alias("u"))
                for i, k in enumerate(ks)
            ]
        )
    )
    return means.select(each.alias("e")).groupBy("e.k").agg(F.avg("e.u").alias("mean"), F.stddev_pop("e.u").alias("std"))


def score_report(df: DataFrame, score: str, threshold: float) -> DataFrame:
    """5th and 95th percentile, mean, std and the share above a threshold."""
    q = exact_quantiles(df, [], score, {"p5": 0.05, "p95": 0.95})
    return df.agg(
        F.avg(score).alias("mean"),
        F.stddev_samp(score).alias("std"),
        F.avg((F.col(score) > threshold).cast("int")).alias("share_above"),
    ).withColumns({c: q.select(c).scalar() for c in ("p5", "p95")})
