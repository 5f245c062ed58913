"""Resampling without moving rows: hash weights and hash splits.

A bootstrap draw is a Poisson(1) weight from the md5 of (unit, iteration block, seed), so
each row meets all iterations inside its own task; only per-iteration sums are shuffled.
Permutations are exact splits by hash order, found from a histogram of the hashes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import poisson1, text_key

DRAWS_PER_HASH = 4


def replicate(df: DataFrame, unit: Sequence[str], iterations: int, seed: int | str = 0) -> DataFrame:
    """Rows x iterations with ``iter`` and a positive ``weight``; one md5 serves four draws.

    Rows only pass through the task on their way into a partial aggregate: always follow
    with a ``groupBy`` that contains ``iter`` and no unit column.
    """
    hashes = ceil(iterations / DRAWS_PER_HASH)
    digest = F.md5(text_key(*[F.col(u) for u in unit], seed, F.col("_block")))
    words = {
        f"_u{i}": F.conv(F.substring("_digest", 1 + 8 * i, 8), 16, 10).cast("double") / F.lit(float(2**32))
        for i in range(DRAWS_PER_HASH)
    }
    draws = [
        F.struct((F.col("_block") * DRAWS_PER_HASH + i).alias("iter"), F.col(f"_w{i}").alias("weight"))
        for i in range(DRAWS_PER_HASH)
    ]
    # the work is rows x iterations, so even a small table of units is spread over all tasks
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        df.repartition(n, *unit)
        .withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(hashes - 1))))
        .withColumn("_digest", digest)
        .withColumns(words)
        .withColumns({f"_w{i}": poisson1(F.col(f"_u{i}")) for i in range(DRAWS_PER_HASH)})
        .withColumn("_draw", F.explode(F.array(*draws)))
        .where((F.col("_draw.weight") > 0) & (F.col("_draw.iter") < iterations))
        .withColumns({"iter": F.col("_draw.iter"), "weight": F.col("_draw.weight")})
        .drop("_block", "_digest", "_draw", *words, *[f"_w{i}" for i in range(DRAWS_PER_HASH)])
    )


def weighted_sums(
    df: DataFrame, unit: Sequence[str], keys: Sequence[str], sums: Mapping[str, Column], iterations: int, seed=0
) -> DataFrame:
    """Per (keys, iter): the resampled row count ``n`` and the resampled sums.

    Summands are computed once per row, before the iterations multiply it.
    """
    slim = df.select(*unit, *[k for k in keys if k not in unit], *[c.alias(f"_v_{n}") for n, c in sums.items()])
    drawn = replicate(slim, unit, iterations, seed)
    w = F.col("weight")
    return drawn.groupBy(*keys, "iter").agg(
        F.sum(w).cast("double").alias("n"), *[F.sum(w * F.col(f"_v_{n}")).alias(n) for n in sums]
    )


def interval(df: DataFrame, keys: Sequence[str], value: str, alpha: float = 0.05) -> DataFrame:
    """Percentile interval, mean and std over the iterations (as many rows as iterations)."""
    aggs = [
        F.percentile(value, F.lit(alpha / 2)).alias("lower"),
        F.percentile(value, F.lit(1 - alpha / 2)).alias("upper"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
    ]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def permuted_moments(
    df: DataFrame, id_col: str, values: Sequence[str], n_first: int | Column, permutations: int, seed=0, hex_digits: int = 4
) -> DataFrame:
    """Moments of both halves of exact random splits: the first ``n_first`` rows in hash order.

    Pass one counts rows per hash prefix, which fixes the prefix where the split falls; pass
    two ranks only the rows with that prefix. Rows are dealt out once by id, before the
    permutations multiply them; the multiplied rows are never shuffled. Returns
    (perm, metric, n1, mean1, var1, n2, mean2, var2).
    """
    sums = [F.sum(v).alias(f"s_{v}") for v in values] + [F.sum(F.col(v) * F.col(v)).alias(f"q_{v}") for v in values]
    names = [f"{p}_{v}" for p in ("s", "q") for v in values]
    spread = (
        df.select(id_col, *[F.col(v).cast("double").alias(v) for v in values])
        .repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), id_col)
        .withColumn("perm", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
        .withColumn("_h", F.md5(text_key(F.col(id_col), seed, F.col("perm"))))
        .withColumn("_p", F.left("_h", F.lit(hex_digits)))
    )
    table = spread.groupBy("perm", "_p").agg(F.count(F.lit(1)).alias("n"), *sums)
    # at most 16**hex_digits rows per permutation
    w = Window.partitionBy("perm").orderBy("_p")
    target = n_first if isinstance(n_first, Column) else F.lit(n_first)
    run = table.withColumns(
        {"upto": F.sum("n").over(w), "all": F.sum("n").over(Window.partitionBy("perm"))}
    ).withColumn("target", target)
    inside = F.col("upto") <= F.col("target")
    at_cut = (~inside) & (F.col("upto") - F.col("n") < F.col("target"))
    sides = run.groupBy("perm").agg(
        F.max(F.when(at_cut, F.col("_p"))).alias("_cut"),
        F.max("target").alias("target"),
        F.coalesce(F.sum(F.when(inside, F.col("n"))), F.lit(0)).alias("_full"),
        F.max("all").alias("all"),
        *[F.coalesce(F.sum(F.when(inside, F.col(c))), F.lit(0.0)).alias(f"in_{c}") for c in names],
        *[F.sum(c).alias(f"all_{c}") for c in names],
    )
    rest = (
        spread.join(F.broadcast(sides.select("perm", "_cut", (F.col("target") - F.col("_full")).alias("_need"))), "perm")
        .where(F.col("_p") == F.col("_cut"))
        .withColumn("_r", F.row_number().over(Window.partitionBy("perm").orderBy("_h", id_col)))
        .where(F.col("_r") <= F.col("_need"))
        .groupBy("perm")
        .agg(*[s.alias(f"cut_{n}") for s, n in zip(sums, names)])
    )
    both = sides.join(rest, "perm", "left")
    n1, n2 = F.col("target").cast("double"), (F.col("all") - F.col("target")).cast("double")

    def one(metric):
        s1 = F.col(f"in_s_{metric}") + F.coalesce(F.col(f"cut_s_{metric}"), F.lit(0.0))
        q1 = F.col(f"in_q_{metric}") + F.coalesce(F.col(f"cut_q_{metric}"), F.lit(0.0))
        s2, q2 = F.col(f"all_s_{metric}") - s1, F.col(f"all_q_{metric}") - q1
        return F.struct(
            F.lit(metric).alias("metric"),
            n1.alias("n1"),
            (s1 / n1).alias("mean1"),
            ((q1 - s1 * s1 / n1) / (n1 - 1)).alias("var1"),
            n2.alias("n2"),
            (s2 / n2).alias("mean2"),
            ((q2 - s2 * s2 / n2) / (n2 - 1)).alias("var2"),
        )

    return both.select("perm", F.explode(F.array(*[one(v) for v in values])).alias("m")).select("perm", "m.*")
