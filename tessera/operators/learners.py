"""Meta-learners for uplift on Spark ML regressors, and their search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.series import folds
from tessera.operators.uplift import uplift_at_k
from tessera.plans.prefix import cut_lineage


def boosted_trees(**params) -> GBTRegressor:
    """The default base model; any Spark ML regressor with the same columns can replace it."""
    return GBTRegressor(**({"maxIter": 10, "maxDepth": 3, "seed": 0} | params))


def _fit(df: DataFrame, features: Sequence[str], label: str, model, weight: str | None = None):
    assembled = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep").transform(df)
    model = model.copy().setFeaturesCol("_x").setLabelCol(label)
    if weight:
        model = model.setWeightCol(weight)
    return model.fit(assembled)


def _apply(df: DataFrame, features: Sequence[str], model, name: str) -> DataFrame:
    assembled = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep").transform(df)
    return model.setPredictionCol(name).transform(assembled).drop("_x")


class SLearner:
    """One model over features and treatment; uplift is its difference between w=1 and w=0."""

    def __init__(self, features: Sequence[str], w: str, y: str, model=None):
        self.features, self.w, self.y, self.model = list(features), w, y, model or boosted_trees()

    def fit(self, df: DataFrame) -> "SLearner":
        self.fitted = _fit(df, [*self.features, self.w], self.y, self.model)
        return self

    def uplift(self, df: DataFrame, name: str = "uplift") -> DataFrame:
        kept = df.withColumn("_w_seen", F.col(self.w)) if self.w in df.columns else df
        for value in (1, 0):
            kept = _apply(kept.withColumn(self.w, F.lit(value)), [*self.features, self.w], self.fitted, f"_y{value}")
        out = kept.withColumn(name, F.col("_y1") - F.col("_y0")).drop("_y1", "_y0", self.w)
        return out.withColumnRenamed("_w_seen", self.w)


class TLearner:
    """One outcome model per arm; uplift is the difference of their predictions."""

    def __init__(self, features, w, y, model_c=None, model_t=None):
        self.features, self.w, self.y = list(features), w, y
        self.models = {0: model_c or boosted_trees(), 1: model_t or boosted_trees()}

    def fit(self, df: DataFrame) -> "TLearner":
        self.fitted = {a: _fit(df.where(F.col(self.w) == a), self.features, self.y, m) for a, m in self.models.items()}
        return self

    def arms(self, df: DataFrame) -> DataFrame:
        for a, m in self.fitted.items():
            df = _apply(df, self.features, m, f"_mu{a}")
        return df

    def uplift(self, df: DataFrame, name: str = "uplift") -> DataFrame:
        return self.arms(df).withColumn(name, F.col("_mu1") - F.col("_mu0")).drop("_mu0", "_mu1")


class XLearner:
    """Imputed effects per arm, modelled and mixed by the propensity: ``p``, or a model's if it is None."""

    def __init__(self, features, w, y, p: float | None = None, model=None, treatment_model=None):
        self.features, self.w, self.y, self.p = list(features), w, y, p
        self.model, self.treatment_model = model or boosted_trees(), treatment_model or logistic()

    def fit(self, df: DataFrame) -> "XLearner":
        if self.p is None:
            self.treated = _fit(df, self.features, self.w, self.treatment_model)
        base = TLearner(self.features, self.w, self.y, self.model, self.model).fit(df)
        imputed = base.arms(df).withColumn(
            "_d",
            F.when(F.col(self.w) == 1, F.col(self.y) - F.col("_mu0")).otherwise(F.col("_mu1") - F.col(self.y)),
        )
        self.tau = {
            a: _fit(imputed.where(F.col(self.w) == a), self.features, "_d", self.model) for a in (0, 1)
        }
        return self

    def uplift(self, df: DataFrame, name: str = "uplift") -> DataFrame:
        for a, m in self.tau.items():
            df = _apply(df, self.features, m, f"_tau{a}")
        if self.p is None:
            df = with_propensity(df, self.features, self.treated, "_p")
        else:
            df = df.withColumn("_p", F.lit(self.p))
        mixed = F.col("_p") * F.col("_tau0") + (1 - F.col("_p")) * F.col("_tau1")
        return df.withColumn(name, mixed).drop("_tau0", "_tau1", "_p")


class RLearner:
    """Weighted regression of outcome residuals on treatment residuals.

    Outcomes are predicted out of fold, and so is the propensity, unless ``p`` gives it.
    """

    def __init__(self, features, w, y, id_col: str, n_fold: int = 4, p: float | None = None, model=None, treatment_model=None):
        self.features, self.w, self.y, self.id_col = list(features), w, y, id_col
        self.n_fold, self.p, self.model, self.treatment_model = n_fold, p, model or boosted_trees(), treatment_model or logistic()

    def fit(self, df: DataFrame) -> "RLearner":
        folded = cut_lineage(folds(df, self.id_col, self.n_fold, [self.w]))
        parts = []
        for k in range(self.n_fold):
            outcome = _fit(folded.where(F.col("fold") != k), self.features, self.y, self.model)
            own = _apply(folded.where(F.col("fold") == k), self.features, outcome, "_m")
            if self.p is None:
                treated = _fit(folded.where(F.col("fold") != k), self.features, self.w, self.treatment_model)
                own = with_propensity(own, self.features, treated, "_p")
            else:
                own = own.withColumn("_p", F.lit(self.p))
            parts.append(own)
        residual = F.col(self.w) - F.col("_p")
        ready = reduce(DataFrame.unionByName, parts).withColumns(
            {"_r": (F.col(self.y) - F.col("_m")) / residual, "_weight": residual * residual}
        )
        self.fitted = _fit(cut_lineage(ready), self.features, "_r", self.model, "_weight")
        return self

    def uplift(self, df: DataFrame, name: str = "uplift") -> DataFrame:
        return _apply(df, self.features, self.fitted, name)


def logistic(**params) -> LogisticRegression:
    """The default model of who is treated; any Spark ML classifier with a probability can replace it."""
    return LogisticRegression(**({"maxIter": 50, "regParam": 1e-4} | params))


def with_propensity(df: DataFrame, features: Sequence[str], model, name: str, trim: float = 0.02) -> DataFrame:
    """Each row's probability of treatment, kept ``trim`` away from 0 and 1."""
    assembled = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep").transform(df)
    scored = model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_q").transform(assembled)
    p = vector_to_array("_q")[1]
    return scored.withColumn(name, F.least(F.greatest(p, F.lit(trim)), F.lit(1 - trim))).drop("_x", "_q")


def propensity(df: DataFrame, w: str) -> float:
    """Share of treated rows."""
    return df.agg(F.avg(w)).first()[0]


def search(
    df: DataFrame, id_col: str, features: Sequence[str], w: str, y: str, grid: Sequence[Mapping], k_folds: int = 3, k: float = 0.3
) -> DataFrame:
    """uplift@k per parameter set and fold, with the mean over folds: (params, fold, score, mean_score)."""
    folded = cut_lineage(folds(df.select(id_col, *features, w, y), id_col, k_folds, [w]))
    rows = []
    for params in grid:
        for f in range(k_folds):
            fitted = TLearner(features, w, y, boosted_trees(**params), boosted_trees(**params)).fit(
                folded.where(F.col("fold") != f)
            )
            scored = fitted.uplift(folded.where(F.col("fold") == f))
            value = uplift_at_k(scored, id_col, "uplift", w, y, [k]).first()["uplift"]
            rows.append((str(dict(params)), f, value))
    table = df.sparkSession.createDataFrame(rows, "params string, fold int, score double")
    means = table.groupBy("params").agg(F.avg("score").alias("mean_score"))
    return table.join(means, "params")


def labelled_examples(scored: DataFrame, id_col: str, train: Column, w: str, y: str, uplift: str) -> DataFrame:
    """Id, sample flag, arm, outcome and predicted uplift."""
    return scored.select(id_col, F.when(train, "train").otherwise("test").alias("sample"), w, y, uplift)
