"""Multiple testing over families of p-values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.prefix import join_on_keys, prefix


def decisions(df: DataFrame, family: str, test: str, p: str, alpha: float = 0.05) -> DataFrame:
    """0/1 columns baseline, bonferroni, holm, bh (step-up) and bh_stop (stops at the first failure)."""
    r = prefix(df, [family], [p, test], pos="_i", totals=True).withColumnRenamed("_i_total", "_m")
    a, i, m, pv = F.lit(alpha), F.col("_i"), F.col("_m"), F.col(p)
    holm, bh = pv < a / (m - i + 1), pv <= a * i / m
    cuts = r.groupBy(family).agg(
        F.min(F.when(~holm, i)).alias("_holm_fail"),
        F.min(F.when(~bh, i)).alias("_bh_fail"),
        F.max(F.when(bh, i)).alias("_bh_last"),
    )
    before = lambda c: (F.col(c).isNull() | (i < F.col(c))).cast("int")
    return (
        join_on_keys(r, cuts, [family])
        .withColumns(
            {
                "baseline": (pv < a).cast("int"),
                "bonferroni": (pv <= a / m).cast("int"),
                "holm": before("_holm_fail"),
                "bh": F.coalesce(i <= F.col("_bh_last"), F.lit(False)).cast("int"),
                "bh_stop": before("_bh_fail"),
            }
        )
        .drop("_i", "_m", "_holm_fail", "_bh_fail", "_bh_last")
    )


def adjusted(df: DataFrame, family: str, test: str, p: str) -> DataFrame:
    """Bonferroni, Holm and Benjamini-Hochberg adjusted p-values."""
    up = prefix(df, [family], [p, test], pos="_i", totals=True)
    i, m, pv = F.col("_i"), F.col("_i_total"), F.col(p)
    steps = up.withColumns({"bonferroni": F.least(F.lit(1.0), pv * m), "_holm": pv * (m - i + 1), "_bh": pv * m / i})
    holm = prefix(steps, [family], [p, test], maxs={"holm": F.col("_holm")}, pos=None)
    # a running minimum from the largest p-value down
    bh = prefix(holm, [family], [F.col(p).desc(), F.col(test).desc()], maxs={"_neg": -F.col("_bh")}, pos=None)
    return bh.withColumns({"holm": F.least(F.lit(1.0), F.col("holm")), "bh": F.least(F.lit(1.0), -F.col("_neg"))}).drop(
        "_i", "_i_total", "_holm", "_bh", "_neg"
    )


def error_rates(decided: DataFrame, family: str, truth: str, methods: Sequence[str]) -> DataFrame:
    """Per method and number of true effects: FWER, P(FN > 0) and FDR over the families."""
    long = decided.select(family, truth, *methods).unpivot([family, truth], list(methods), "method", "hit")
    yes = F.col(truth) == 1
    per = long.groupBy("method", family).agg(
        F.sum(F.when(~yes, F.col("hit")).otherwise(0)).alias("fp"),
        F.sum(F.when(yes, F.col("hit")).otherwise(0)).alias("tp"),
        F.sum(yes.cast("int")).alias("effects"),
    )
    return per.groupBy("method", "effects").agg(
        F.avg((F.col("fp") > 0).cast("int")).alias("fwer"),
        F.avg((F.col("tp") < F.col("effects")).cast("int")).alias("any_missed"),
        F.avg(F.col("fp") / F.greatest(F.lit(1), F.col("fp") + F.col("tp"))).alias("fdr"),
        F.count(F.lit(1)).alias("families"),
    )


def p_value_ecdf(tests: DataFrame, test: str, p: str) -> DataFrame:
    """Each p-value with the share of p-values up to it, and its distance from uniform."""
    counts = tests.groupBy(p).agg(F.count(F.lit(1)).alias("_n"))
    run = prefix(counts, [], [p], sums={"_upto": F.col("_n")}, pos=None, totals=True)
    return run.select(p, (F.col("_upto") / F.col("_upto_total")).alias("ecdf")).withColumn(
        "off", F.abs(F.col("ecdf") - F.col(p))
    )
