"""Batch scoring, SQL-visible scored views, alerts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def score(model: PipelineModel, df: DataFrame, output: str = "predicted_energy_kwh_ton") -> DataFrame:
    """Apply a fitted pipeline on the executors; keep the input columns."""
    return model.transform(df).withColumnRenamed("prediction", output).drop("features")


def register_scored_view(spark: SparkSession, scored: DataFrame, name: str) -> None:
    """Expose scored rows to SQL users (``SELECT ... FROM <name>``)."""
    scored.createOrReplaceTempView(name)


def linear_scorer(coefficients: Sequence[float], intercept: float):
    """Vectorised scorer for an externally trained linear model.

    The coefficient vector (one number per feature) is closed over; Arrow
    batches of feature columns are scored with one matrix product each.
    """
    w = np.asarray(coefficients, dtype="float64")

    @F.pandas_udf(T.DoubleType())
    def predict(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype="float64") for c in cols])
        return pd.Series(x @ w + intercept)

    return predict


def deviation_alerts(scored: DataFrame, actual: str, predicted: str, threshold: float = 300.0,
                     k: int = 20, columns: Sequence[str] = ("reading_id", "furnace_id", "ts"),
                     tie_break: Sequence[str] = ("reading_id",)) -> DataFrame:
    """Rows whose actual exceeds the prediction by strictly more than
    ``threshold``, largest deviation first, top ``k`` (a top-k report)."""
    dev = F.col(actual) - F.col(predicted)
    return (scored.withColumn("deviation", dev).filter(F.col("deviation") > threshold)
            .select(*columns, actual, predicted, "deviation")
            .orderBy(F.desc("deviation"), *tie_break).limit(k))


def probability_of(column: str = "probability", index: int = 1) -> Column:
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(column))[index]
