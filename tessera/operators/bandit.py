"""Bandit statistics from logs and choices for new decisions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import epoch_micros
from tessera.functions.hashing import md5_mod, text_key, uniform
from tessera.functions.stats import beta_bracket, beta_quantile, beta_table
from tessera.operators.joins import enrich, week_keys
from tessera.operators.series import previous
from tessera.plans.prefix import prefix


def arm_stats(log: DataFrame, arm: str, reward: str) -> DataFrame:
    """pulls, reward sum and mean per arm."""
    return log.groupBy(arm).agg(
        F.count(F.lit(1)).alias("pulls"), F.sum(reward).alias("rewards"), F.avg(reward).alias("mean")
    )


def epsilon_greedy(decisions: DataFrame, id_col: str, stats: DataFrame, arm: str, epsilon: float, seed=0) -> DataFrame:
    """Hash-random arm with probability epsilon, the best mean otherwise.

    The arms reach the decisions as one scalar inside Spark; equal means go to the first arm in order.
    """
    listed = F.array_sort(F.collect_list(F.struct(arm, "mean"))).alias("_arms")
    arms = stats.agg(listed).scalar()
    known = decisions.withColumn("_arms", arms)
    top = F.array_max(F.transform("_arms", lambda a: a["mean"]))
    best = F.filter("_arms", lambda a: a["mean"] == top)[0][arm]
    explore = uniform(F.col(id_col), seed, "explore") < epsilon
    place = md5_mod(text_key(F.col(id_col), seed, "arm"), F.size("_arms"))
    pick = F.col("_arms")[place.cast("int")][arm]
    return known.withColumn("choice", F.when(explore, pick).otherwise(best)).drop("_arms")


def ucb(stats: DataFrame, arm: str) -> DataFrame:
    """mean + sqrt(2 ln N / n) per arm; arms without pulls come first."""
    total = stats.agg(F.sum("pulls").alias("n")).select("n").scalar()
    score = F.when(F.col("pulls") > 0, F.col("mean") + F.sqrt(2 * F.ln(total) / F.col("pulls"))).otherwise(
        F.lit(float("inf"))
    )
    return stats.withColumn("score", score)


def posterior(log: DataFrame, arm: str, reward: str) -> DataFrame:
    """Beta(1 + successes, 1 + failures) per arm."""
    return log.groupBy(arm).agg(
        (1 + F.sum(reward)).cast("double").alias("a"), (1 + F.sum(1 - F.col(reward))).cast("double").alias("b")
    )


def thompson(decisions: DataFrame, id_col: str, post: DataFrame, arm: str, seed: int = 0) -> DataFrame:
    """One posterior draw per decision and arm, seeded by the decision id; the largest wins.

    A draw is the posterior's quantile at a hashed uniform of (id, arm), so an arm's draws do
    not depend on which other arms there are. The first arm in name order wins a tie. A
    null id is drawn for like any other. A table of each posterior encloses every draw; draws
    are worked out only where the best arm's enclosure does not lie above all others.
    """
    rows = post.select(arm, "a", "b").orderBy(arm).collect()  # the arms
    arms, shapes = [str(r[arm]) for r in rows], [(r["a"], r["b"]) for r in rows]

    @F.pandas_udf(T.StringType())
    def choose(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = [beta_table(a, b) for a, b in shapes]
        for uniforms in batches:
            u = np.stack(uniforms) if len(uniforms) else np.zeros((0, len(arms)))
            ends = [beta_bracket(table, u[:, i]) for i, table in enumerate(tables)]
            low, high = (np.stack([e[side] for e in ends], axis=1) for side in (0, 1))
            best = np.argmax(low, axis=1)
            others = high.copy()
            np.put_along_axis(others, best[:, None], -np.inf, axis=1)
            close = np.flatnonzero(~(low.max(axis=1) > others.max(axis=1)))
            if len(close):
                draws = [beta_quantile(a, b, u[close, i], table=tables[i]) for i, (a, b) in enumerate(shapes)]
                best[close] = np.argmax(np.stack(draws, axis=1), axis=1)
            yield pd.Series([arms[i] for i in best], dtype=object)

    decisions = decisions.repartition(int(decisions.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return decisions.withColumn("choice", choose(F.array(*[uniform(key, F.lit(name), seed) for name in arms])))


def cumulative_regret(log: DataFrame, order: Sequence[str], arm: str, means: dict[str, float]) -> DataFrame:
    """Best mean times the pull number minus the running mean of the chosen arms."""
    chosen = F.lit(None).cast("double")
    for name, p in means.items():
        chosen = F.when(F.col(arm) == name, F.lit(float(p))).otherwise(chosen)
    run = prefix(log.select(*order, arm), [], order, sums={"_got": chosen}, pos="i")
    return run.withColumn("regret", F.col("i") * F.lit(max(means.values())) - F.col("_got")).drop("_got")


def sufficient_stats(log: DataFrame, action: str, features: Sequence[str], reward: str) -> DataFrame:
    """X'X, X'y, y'y and n per action in one aggregate (an intercept is added as feature 0)."""
    x = [F.lit(1.0)] + [F.col(f).cast("double") for f in features]
    y = F.col(reward).cast("double")
    aggs = [F.sum(x[i] * x[j]).alias(f"xx_{i}_{j}") for i in range(len(x)) for j in range(i, len(x))]
    aggs += [F.sum(x[i] * y).alias(f"xy_{i}") for i in range(len(x))]
    return log.groupBy(action).agg(*aggs, F.sum(y * y).alias("yy"), F.count(F.lit(1)).alias("n"))


def linear_weights(stats: DataFrame, action: str, d: int, ridge: float = 0.25) -> dict[str, list[float]]:
    """Posterior mean weights per action: one (d+1)-sized solve per action."""
    out = {}
    for r in stats.collect():
        m = np.zeros((d + 1, d + 1))
        for i in range(d + 1):
            for j in range(i, d + 1):
                m[i, j] = m[j, i] = r[f"xx_{i}_{j}"]
        v = np.array([r[f"xy_{i}"] for i in range(d + 1)])
        out[r[action]] = [float(w) for w in np.linalg.solve(m + ridge * np.eye(d + 1), v)]
    return out


def linear_choice(df: DataFrame, features: Sequence[str], weights: dict[str, list[float]]) -> DataFrame:
    """The action with the highest expected reward, the first in name order on ties."""
    scored = []
    for name in sorted(weights):
        w = weights[name]
        value = F.lit(w[0])
        for f, c in zip(features, w[1:]):
            value = value + F.col(f).cast("double") * F.lit(c)
        scored.append(F.struct(value.alias("value"), F.lit(-len(scored)).alias("place"), F.lit(name).alias("name")))
    best = F.array_max(F.array(*scored)) if len(scored) > 1 else scored[0]
    return df.withColumn("_b", best).withColumns({"choice": F.col("_b.name"), "expected": F.col("_b.value")}).drop("_b")


def context(
    rewards: DataFrame, predictions: DataFrame, transactions: DataFrame, on: Sequence[str], user: str, date: str, amount: str
) -> DataFrame:
    """Rewards with predictions, amounts, date number, ISO year and week and the previous purchase."""
    joined = enrich(rewards, [(predictions, on), (transactions, on)], {amount: 0.0})
    dated = week_keys(joined, date).withColumn("dates_int", F.floor(epoch_micros(date) / 86400000000))
    return previous(dated, user, [date, *[c for c in on if c != date]], amount, "previous")
