"""Tree ensembles on binned rows against Spark's own on single rows."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.ml.wrapper import JavaEstimator
from pyspark.sql import functions as F

from smelter.models import forests


@pytest.fixture(scope="module")
def points(spark):
    """More rows than Spark samples for its splits; a feature with zeros and
    negative values, one of two values, one constant."""
    rows = (spark.range(24_000, numPartitions=3)
            .selectExpr("rand(1) * 200 - 80 AS a", "CAST(id % 41 AS DOUBLE) AS b", "CAST(rand(2) > 0.6 AS DOUBLE) AS c", "7D AS d", "rand(3) AS noise")
            .selectExpr("*", "35 * a + 2 * b + 120 * c + 40 * noise AS y", "CAST(a / 100 + c + noise > 1.4 AS DOUBLE) AS k"))
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(rows).localCheckpoint()


def _apart(first, second, rows):
    both = second.transform(first.transform(rows).withColumnRenamed("prediction", "p").drop("probability", "rawPrediction"))
    return both.agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0]


@pytest.fixture
def fitted_rows(monkeypatch):
    """How many rows each fit of Spark's own was given."""
    given, fit = [], JavaEstimator._fit

    def counted(self, dataset):
        given.append(dataset.count())
        return fit(self, dataset)

    monkeypatch.setattr(JavaEstimator, "_fit", counted)
    return given


def test_boosted_regression_is_that_of_the_single_rows(points, monkeypatch, fitted_rows):
    monkeypatch.setattr(forests, "SPARK_ROWS", 0)
    kind = dict(labelCol="y", maxIter=6, seed=42)
    own, binned = GBTRegressor(**kind).fit(points), forests.BinnedGBTRegressor(**kind).fit(points)
    assert _apart(own, binned, points) < 1e-6
    # bins of a and b, and two values of c
    assert fitted_rows[0] == 24_000 and fitted_rows[1] <= 33 * 33 * 2


def test_boosted_classifier_is_that_of_the_single_rows(points, monkeypatch, fitted_rows):
    monkeypatch.setattr(forests, "SPARK_ROWS", 0)
    kind = dict(labelCol="k", maxIter=4, maxDepth=3, stepSize=0.3, seed=42)
    own, binned = GBTClassifier(**kind).fit(points), forests.BinnedGBTClassifier(**kind).fit(points)
    assert _apart(own, binned, points) == 0
    p = [m.transform(points).select(F.avg(vector_to_array("probability")[1])).first()[0] for m in (own, binned)]
    assert p[0] == pytest.approx(p[1], rel=1e-9)
    assert fitted_rows[1] <= 33 * 33 * 2 * 2


@pytest.mark.parametrize("label", ["y", "k"])
def test_tree_of_every_row_is_sparks_tree(points, monkeypatch, label):
    monkeypatch.setattr(forests, "SPARK_ROWS", 0)
    monkeypatch.setattr(forests, "CHUNK_ROWS", 1 << 11)
    monkeypatch.setattr(forests, "SUM_BYTES", 1)
    kind = dict(labelCol=label, maxDepth=5, seed=42)
    own, ours = ((DecisionTreeRegressor, forests.BinnedForestRegressor) if label == "y"
                 else (DecisionTreeClassifier, forests.BinnedForestClassifier))
    tree, forest = own(**kind).fit(points), ours(**kind, numTrees=1, bootstrap=False).fit(points)
    assert _apart(tree, forest, points) < 1e-6
    assert forest.featureImportances.toArray() == pytest.approx(tree.featureImportances.toArray(), abs=1e-9)


def test_forest_beyond_the_bound(points, monkeypatch, fitted_rows):
    kind = dict(labelCol="y", numTrees=30, maxDepth=6, seed=42)
    forests.BinnedForestRegressor(**kind).fit(points)
    assert fitted_rows == [24_000]  # within it: Spark's
    monkeypatch.setattr(forests, "SPARK_ROWS", 10_000)
    forest, again = (forests.BinnedForestRegressor(**kind).fit(points) for _ in range(2))
    assert max(fitted_rows[1:]) == 2  # Spark sees no training row
    assert len(forest.trees) == 30 and max(t.depth for t in forest.trees) == 6
    assert forest.getMaxDepth() == 6 and _apart(forest, again, points) < 1e-9
    own = RandomForestRegressor(**kind).fit(points)
    rmse = [m.transform(points).agg(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0] for m in (own, forest)]
    assert rmse[1] == pytest.approx(rmse[0], rel=0.25)
    # every tree has its own draw of about as many rows as there are
    drawn = [t._call_java("rootNode").impurityStats().count() for t in forest.trees]
    assert len(set(drawn)) > 20 and np.mean(drawn) == pytest.approx(24_000, rel=0.01)


def test_draws_are_poisson():
    table = forests._poisson_table()
    single = np.concatenate([forests._draw(42, t, 3, None, 100_000, table) for t in range(4)])
    assert single.mean() == pytest.approx(1, abs=0.01) and single.var() == pytest.approx(1, abs=0.02)
    several = forests._draw(42, 0, 3, np.full(100_000, 9), 100_000, table)
    assert several.mean() == pytest.approx(9, rel=0.01) and several.var() == pytest.approx(9, rel=0.02)
    assert (forests._draw(42, 1, 3, None, 50, table) != forests._draw(42, 0, 3, None, 50, table)).any()


def test_values_that_are_not_finite_are_refused(spark, monkeypatch):
    monkeypatch.setattr(forests, "SPARK_ROWS", 0)
    df = VectorAssembler(inputCols=["x"], outputCol="features", handleInvalid="keep").transform(
        spark.createDataFrame([(1.0, 1.0), (float("inf"), 2.0)], "x double, y double"))
    with pytest.raises(Exception, match="NaN or infinite"):
        forests.BinnedGBTRegressor(labelCol="y").fit(df)


def test_a_row_without_label_is_refused(spark, monkeypatch):
    monkeypatch.setattr(forests, "SPARK_ROWS", 0)
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(1.0, 1.0), (2.0, None)], "x double, y double"))
    for kind in (forests.BinnedGBTRegressor, forests.BinnedForestRegressor):
        with pytest.raises(Exception, match="(?i)null"):
            kind(labelCol="y").fit(df)
