"""Calibrated class probabilities: isotonic regression on out-of-fold scores.

The scores that the calibration is fitted on come from models that have not
seen their rows, so they are as optimistic as scores of new rows.  Isotonic
regression pools adjacent violators within partitions and then across them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.models import scoring, training

RAW = "raw_probability"


@dataclass(frozen=True)
class CalibratedClassifier:
    model: PipelineModel
    calibration: IsotonicRegressionModel

    def score(self, df: DataFrame, output: str) -> DataFrame:
        """``df`` with the calibrated probability of class 1."""
        raw = self.model.transform(df).withColumn(RAW, scoring.probability_of("probability", 1))
        return self.calibration.transform(raw).select(*df.columns, F.col("calibrated").alias(output))


def out_of_fold(train: DataFrame, family: str, label: str, features: Sequence[str], key: str, folds: int = 3) -> DataFrame:
    """(label, raw probability) of every row by the model of the other folds;
    folds follow the hash of the key."""
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col(key)), F.lit(folds))
    parts = []
    for i in range(folds):
        model = training.fit_classifier(train.where(fold != i), family, label, features)
        scored = model.transform(train.where(fold == i))
        parts.append(scored.select(F.col(label).cast("double").alias(label), scoring.probability_of("probability", 1).alias(RAW)))
    return reduce(DataFrame.unionAll, parts)


def fit_calibrated(train: DataFrame, family: str, label: str, features: Sequence[str], key: str, folds: int = 3) -> CalibratedClassifier:
    """A model of the whole training split, and the calibration of its family."""
    scores = out_of_fold(train, family, label, features, key, folds)
    iso = IsotonicRegression(labelCol=label, featuresCol=RAW, predictionCol="calibrated")
    return CalibratedClassifier(training.fit_classifier(train, family, label, features), iso.fit(scores))


def reliability(scored: DataFrame, label: str, p: str, bins: int = 10) -> DataFrame:
    """One row per bin of predicted probability: bin, n, mean_p, rate, and
    weighted_gap, whose sum over the bins is the expected calibration error."""
    at = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    per_bin = scored.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.avg(label).alias("rate"))
    total = per_bin.agg(F.sum("n")).scalar()
    return per_bin.withColumn("weighted_gap", F.abs(F.col("mean_p") - F.col("rate")) * F.col("n") / total)
