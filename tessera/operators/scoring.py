"""Batch scoring with saved models and parameter sweeps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.forecast import assemble, rmse
from tessera.plans.prefix import cut_lineage


def fit_classifier(df: DataFrame, features: Sequence[str], label: str, path: str, trees: int = 10) -> None:
    """Fit a labelled classifier and save it whole, indexers included."""
    indexer = StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc").fit(df)
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="_x"),
        indexer,
        RandomForestClassifier(featuresCol="_x", labelCol="_y", numTrees=trees, maxDepth=4, seed=0),
        IndexToString(inputCol="prediction", outputCol="predicted_label", labels=indexer.labels),
    ]
    Pipeline(stages=stages).fit(df).write().overwrite().save(path)


def score_saved(df: DataFrame, path: str) -> DataFrame:
    """Score a table with a saved model: the class number and its label."""
    return PipelineModel.load(path).transform(df).drop("_x", "_y", "rawPrediction", "probability")


def sweep(train: DataFrame, test: DataFrame, features: Sequence[str], y: str, grid: Sequence[Mapping]) -> DataFrame:
    """MSE on the test rows per parameter set."""
    a, b = cut_lineage(assemble(train, features)), cut_lineage(assemble(test, features))
    rows = []
    for params in grid:
        model = RandomForestRegressor(featuresCol="_x", labelCol=y, seed=0, **params).fit(a)
        rows.append((str(dict(params)), rmse(model.transform(b), y) ** 2))
    return train.sparkSession.createDataFrame(rows, "params string, mse double")


def tune(df: DataFrame, features: Sequence[str], y: str, depths: Sequence[int], trees: Sequence[int], share: float = 0.7) -> DataFrame:
    """Grid search on one train/validation split: (depth, trees, rmse)."""
    model = RandomForestRegressor(featuresCol="_x", labelCol=y, seed=0)
    grid = ParamGridBuilder().addGrid(model.maxDepth, list(depths)).addGrid(model.numTrees, list(trees)).build()
    search = TrainValidationSplit(
        estimator=model,
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol=y, metricName="rmse"),
        trainRatio=share,
        seed=0,
    )
    fitted = search.fit(cut_lineage(assemble(df, features)))
    rows = [
        (int(g[model.maxDepth]), int(g[model.numTrees]), float(e)) for g, e in zip(grid, fitted.validationMetrics)
    ]
    return df.sparkSession.createDataFrame(rows, "depth int, trees int, rmse double")
