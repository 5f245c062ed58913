"""Parameter search: seeded draws from declared distributions, stratified folds and a hold-out."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from math import exp, log

from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import uniform
from tessera.operators.forecast import assemble, rmse, spread
from tessera.operators.series import folds
from tessera.operators.uplift import uplift_at_k
from tessera.operators.uplift_tree import Limits, grow_forest, quantise
from tessera.plans.prefix import cut_lineage

#: A distribution: the value at a uniform draw from [0, 1).
Distribution = Callable[[float], object]


def choice(*values) -> Distribution:
    return lambda u: values[int(u * len(values))]


def between(low: float, high: float) -> Distribution:
    return lambda u: low + u * (high - low)


def log_between(low: float, high: float) -> Distribution:
    return lambda u: exp(log(low) + u * (log(high) - log(low)))


def steps(low: float, high: float, step: float) -> Distribution:
    """Multiples of ``step`` from ``low`` up to ``high``, each as likely as any other; whole numbers for a whole step."""
    count = int((high - low) / step + 1e-9) + 1
    return lambda u: low + step * int(u * count)


def sample_parameters(space: Mapping[str, Distribution], n_iter: int, seed: int = 0) -> list[dict]:
    """``n_iter`` parameter sets; a value depends on the seed, its number and its name alone."""

    def draw(i: int, name: str) -> float:
        return int(hashlib.md5(f"{seed}_{i}_{name}".encode()).hexdigest()[:13], 16) / 2**52

    return [{name: distribution(draw(i, name)) for name, distribution in space.items()} for i in range(n_iter)]


def _best(rows: Sequence[tuple[int, float | None]], largest: bool) -> int:
    """The number with the best known score, the first of equal ones; the first one if none is known."""
    known = [(score if largest else -score, -i) for i, score in rows if score is not None]
    return -max(known)[1] if known else rows[0][0]


def search_forest(
    df: DataFrame,
    id_col: str,
    features: Sequence[str],
    w: str,
    y: str,
    space: Mapping[str, Distribution],
    n_iter: int = 10,
    k_folds: int = 3,
    test_share: float = 0.3,
    k: float = 0.3,
    n_trees: int = 10,
    seed: int = 0,
) -> DataFrame:
    """Uplift forests by uplift@k: (draw, params, fold, score, mean_score, holdout_score).

    ``space`` names fields of :class:`Limits` and arguments of :func:`grow_forest`. A share of
    each arm is held out; the rest is cut at its own thresholds once, and all fits of all
    folds read that one table of bin numbers. The best mean is fitted on all of it and
    scored on the hold-out; other draws have no holdout_score. A score is null where a fold has
    no row of an arm among its best.
    """
    rows = df.select(id_col, *features, w, y)
    split = folds(rows, id_col, 20, [w], seed=seed).withColumn("_test", F.col("fold") < round(20 * test_share)).drop("fold")
    split = cut_lineage(split)
    train = cut_lineage(folds(split.where("NOT _test").drop("_test"), id_col, k_folds, [w], seed=seed + 1))
    table = quantise(train, id_col, features, w, y, n_trees, seed, keep=["fold"])

    def fit(params: Mapping, part: DataFrame):
        limits = Limits(**{name: value for name, value in params.items() if name in Limits.__dataclass_fields__})
        others = {name: value for name, value in params.items() if name not in Limits.__dataclass_fields__}
        return grow_forest(table, part, limits=limits, seed=seed, **others)

    def score(forest, part: DataFrame) -> float | None:
        return uplift_at_k(forest.predict(part), id_col, "uplift", w, y, [k]).first()["uplift"]

    draws = sample_parameters(space, n_iter, seed)
    scores = [
        [score(fit(params, table.rows.where(F.col("fold") != f)), train.where(F.col("fold") == f)) for f in range(k_folds)]
        for params in draws
    ]
    known = [[s for s in own if s is not None] for own in scores]
    means = [sum(own) / len(own) if own else None for own in known]
    best = _best(list(enumerate(means)), largest=True)
    held = score(fit(draws[best], table.rows), split.where("_test"))
    out = [
        (i, str(params), f, scores[i][f], means[i], held if i == best else None) for i, params in enumerate(draws) for f in range(k_folds)
    ]
    schema = "draw int, params string, fold int, score double, mean_score double, holdout_score double"
    return df.sparkSession.createDataFrame(out, schema)


def search_regression(
    df: DataFrame,
    id_col: str,
    features: Sequence[str],
    y: str,
    space: Mapping[str, Distribution],
    n_iter: int = 10,
    valid_share: float = 0.2,
    test_share: float = 0.2,
    seed: int = 0,
) -> DataFrame:
    """Random forests by validation RMSE: (draw, params, rmse, holdout_rmse).

    Rows are dealt to training, validation and hold-out by the hash of their id and
    assembled once. The best draw is fitted again with the validation rows and scored on the
    hold-out.
    """
    u = uniform(F.col(id_col), "search", seed)
    part = F.when(u < test_share, "test").when(u < test_share + valid_share, "valid").otherwise("train")
    rows = spread(assemble(df.withColumn("_part", part), features).select("_x", y, "_part"))
    fit = lambda params, among: RandomForestRegressor(featuresCol="_x", labelCol=y, seed=seed, **params).fit(rows.where(F.col("_part").isin(among)))
    error = lambda model, where: rmse(model.transform(rows.where(F.col("_part") == where)), y)
    draws = sample_parameters(space, n_iter, seed)
    errors = [error(fit(params, ["train"]), "valid") for params in draws]
    best = _best(list(enumerate(errors)), largest=False)
    held = error(fit(draws[best], ["train", "valid"]), "test")
    out = [(i, str(params), errors[i], held if i == best else None) for i, params in enumerate(draws)]
    return df.sparkSession.createDataFrame(out, "draw int, params string, rmse double, holdout_rmse double")
