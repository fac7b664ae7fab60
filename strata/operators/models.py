"""Price models on the feature table, by MLlib."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.projection import quoted


def regressors(seed: int = 7) -> dict[str, object]:
    common = {"featuresCol": "features", "labelCol": "label"}
    return {
        "random_forest": RandomForestRegressor(numTrees=20, maxDepth=5, seed=seed, **common),
        "gradient_boosting": GBTRegressor(maxIter=10, maxDepth=4, seed=seed, **common),
        "linear": LinearRegression(**common),
        "ridge": LinearRegression(regParam=1.0, elasticNetParam=0.0, **common),
    }


def _labelled(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    return df.select(
        quoted(target).cast("double").alias("label"), *[quoted(c).cast("double").alias(c) for c in columns]
    ).dropna()


def _stages(columns: Sequence[str], model) -> Pipeline:
    assemble = VectorAssembler(inputCols=list(columns), outputCol="raw")
    scale = StandardScaler(inputCol="raw", outputCol="features", withMean=False)
    return Pipeline(stages=[assemble, scale, model])


def split(df: DataFrame, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of the row, the same on every run."""
    slot = F.pmod(F.xxhash64(*[quoted(c) for c in df.columns]), F.lit(1000))
    return df.filter(slot < int(share * 1000)), df.filter(slot >= int(share * 1000))


def compare(df: DataFrame, target: str, columns: Sequence[str], models: Mapping[str, object] | None = None) -> DataFrame:
    """(model, r2, rmse) on held-out rows."""
    train, test = split(_labelled(df, target, columns))
    train = train.persist()
    try:
        rows = []
        for name, model in (models or regressors()).items():
            scored = _stages(columns, model).fit(train).transform(test)
            r2, rmse = (RegressionEvaluator(metricName=m).evaluate(scored) for m in ("r2", "rmse"))
            rows.append((name, float(r2), float(rmse)))
    finally:
        train.unpersist()
    return df.sparkSession.createDataFrame(rows, "model string, r2 double, rmse double")


def cross_validate(df: DataFrame, target: str, columns: Sequence[str], folds: int = 3, parallelism: int = 4) -> DataFrame:
    """(reg_param, elastic_net, r2): grid search of a linear model over folds."""
    data = _labelled(df, target, columns)
    # Folds by the row itself: the same ones however rows are spread.
    data = data.withColumn("_fold", F.pmod(F.xxhash64(*[quoted(c) for c in data.columns]), F.lit(folds)).cast("int"))
    model = LinearRegression(featuresCol="features", labelCol="label")
    grid = (
        ParamGridBuilder().addGrid(model.regParam, [0.0, 0.1, 1.0]).addGrid(model.elasticNetParam, [0.0, 0.5]).build()
    )
    search = CrossValidator(
        estimator=_stages(columns, model), estimatorParamMaps=grid, numFolds=folds, foldCol="_fold",
        evaluator=RegressionEvaluator(metricName="r2"), parallelism=parallelism,
    ).fit(data)
    rows = [
        (float(p[model.regParam]), float(p[model.elasticNetParam]), float(score))
        for p, score in zip(grid, search.avgMetrics)
    ]
    return df.sparkSession.createDataFrame(rows, "reg_param double, elastic_net double, r2 double")
