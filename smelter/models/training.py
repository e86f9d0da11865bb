"""Model fitting, evaluation and promotion with Spark ML (no driver-side
training data)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.functions.columns import round_half_up
from smelter.models import forests

REGRESSORS = {
    "linear": lambda label: LinearRegression(featuresCol="features", labelCol=label),
    "gbt": lambda label: forests.BinnedGBTRegressor(featuresCol="features", labelCol=label, maxIter=30, seed=42,
                                                    cacheNodeIds=True),
    # the reference's random-forest challenger settings (150 trees, depth 10,
    # seed 42); a larger node-statistics budget means fewer passes per level
    "random_forest": lambda label: forests.BinnedForestRegressor(featuresCol="features", labelCol=label,
                                                                 numTrees=150, maxDepth=10, seed=42,
                                                                 maxMemoryInMB=1024, cacheNodeIds=True),
}


def fit_regressor(train: DataFrame, kind: str, features: Sequence[str], label: str) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return Pipeline(stages=[assembler, REGRESSORS[kind](label)]).fit(train)


def linear_coefficients(model: PipelineModel, features: Sequence[str], digits: int = 4) -> DataFrame:
    """Fitted coefficients as a (term, coefficient) table."""
    lr = model.stages[-1]
    spark = SparkSession.getActiveSession()
    rows = [(f, float(c)) for f, c in zip(features, lr.coefficients.toArray())]
    rows.append(("intercept", float(lr.intercept)))
    df = spark.createDataFrame(rows, "term string, coefficient double")
    return df.withColumn("coefficient", round_half_up("coefficient", digits))


def predictions_long(models: dict[str, PipelineModel], test: DataFrame, key: str, label: str) -> DataFrame:
    """(model, key, label, prediction) for every model on the same test set."""
    out = None
    for name, model in models.items():
        part = model.transform(test).select(F.lit(name).alias("model"), F.col(key),
                                            F.col(label).cast("double").alias("label"),
                                            F.col("prediction").cast("double").alias("prediction"))
        out = part if out is None else out.unionByName(part)
    return out


def regression_metrics(long: DataFrame, digits: int = 4) -> DataFrame:
    """RMSE, MAE and R^2 per model in one aggregation pass (R^2 against the
    mean label of the evaluated rows, as the usual evaluators define it)."""
    err = F.col("label") - F.col("prediction")
    agg = long.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.lit(1) - F.try_divide(F.sum(err * err), F.var_pop("label") * F.count(F.lit(1)))).alias("r2"))
    return agg.select("model", "n", *[round_half_up(c, digits).alias(c) for c in ("rmse", "mae", "r2")])


def best_model(metrics: DataFrame, metric: str = "rmse", higher_is_better: bool = False) -> DataFrame:
    order = F.desc(metric) if higher_is_better else F.asc(metric)
    return metrics.orderBy(order, "model").limit(1)


def promotion(metrics: DataFrame, champion: str, challenger: str, metric: str = "rmse",
              higher_is_better: bool = False) -> DataFrame:
    """Promote the challenger only when it is strictly better; ties keep the champion."""
    pair = metrics.filter(F.col("model").isin(champion, challenger))
    m = pair.agg(
        F.max(F.when(F.col("model") == champion, F.col(metric))).alias("champion_metric"),
        F.max(F.when(F.col("model") == challenger, F.col(metric))).alias("challenger_metric"))
    better = (F.col("challenger_metric") > F.col("champion_metric")) if higher_is_better \
        else (F.col("challenger_metric") < F.col("champion_metric"))
    return m.select(F.lit(champion).alias("champion"), F.lit(challenger).alias("challenger"),
                    "champion_metric", "challenger_metric",
                    F.when(better, F.lit(challenger)).otherwise(F.lit(champion)).alias("winner"))


# ---- classification ---------------------------------------------------------

def _classifier_grid(label: str):
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=50)
    rf = forests.BinnedForestClassifier(featuresCol="features", labelCol=label, seed=42)
    gbt = forests.BinnedGBTClassifier(featuresCol="features", labelCol=label, seed=42, maxIter=10, stepSize=0.3)
    return {
        "logistic": (lr, ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.01]).build()),
        "random_forest": (rf, ParamGridBuilder().addGrid(rf.numTrees, [50]).addGrid(rf.maxDepth, [5, 8]).build()),
        "gbt": (gbt, ParamGridBuilder().addGrid(gbt.maxDepth, [3]).build()),
    }


def positive_f1(label: str) -> MulticlassClassificationEvaluator:
    """F1 of the positive class (label 1), not Spark's weighted default."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                             metricName="fMeasureByLabel", metricLabel=1.0)


def _prepared(df: DataFrame, label: str, features: Sequence[str]):
    imputed = [f"{c}__imp" for c in features]
    imputer = Imputer(inputCols=list(features), outputCols=imputed, strategy="mean")
    assembler = VectorAssembler(inputCols=imputed, outputCol="features")
    data = df.withColumn(label, F.col(label).cast("double"))
    prep = Pipeline(stages=[imputer, assembler]).fit(data)
    return prep, data


def fit_classifier(train: DataFrame, family: str, label: str, features: Sequence[str]) -> PipelineModel:
    """One model of a family with its first grid point (no search)."""
    prep, data = _prepared(train, label, features)
    est, params = _classifier_grid(label)[family]
    model = est.fit(prep.transform(data), params[0])
    return PipelineModel(stages=[prep, model])


def classifier_search(df: DataFrame, label: str, features: Sequence[str], folds: int = 3,
                      families: Sequence[str] = ("logistic", "random_forest", "gbt")):
    """Cross-validated search over model families; returns the fitted best
    pipeline per family and their mean CV positive-class F1.

    NULL features are imputed with the column mean inside the pipeline.
    """
    prep, data = _prepared(df, label, features)
    # the folds are cached: only what the fits read
    prepared = prep.transform(data).select(label, "features")
    results = {}
    grid = _classifier_grid(label)
    for family in families:
        est, params = grid[family]
        cv = CrossValidator(estimator=est, estimatorParamMaps=params, evaluator=positive_f1(label),
                            numFolds=folds, seed=42, parallelism=4)
        model = cv.fit(prepared)
        results[family] = (PipelineModel(stages=[prep, model.bestModel]), max(model.avgMetrics))
    return results
