"""ML19 searches all families, ML20 scores all inspections."""

from pyspark.sql import functions as F

from smelter.models import training
from smelter.plans import modeling


def test_every_inspection_is_scored(spark, sf_small, monkeypatch):
    rows = [(f"i{i}", i % 5, float(i % 2), "train" if i % 5 else "test", *(float(i * k % 7) for k in range(len(modeling.DEFECT_FEATURES))))
            for i in range(60)]
    schema = "inspection_id string, furnace_id int, is_defect double, split string, " + ", ".join(f"{c} double" for c in modeling.DEFECT_FEATURES)
    monkeypatch.setattr(modeling, "defect_data", lambda t: spark.createDataFrame(rows, schema))
    monkeypatch.setattr(modeling.scoring, "probability_of", lambda *_: F.lit(0.9))
    found = modeling.q_high_defect_probability(spark, sf_small)
    assert {r.inspection_id for r in found.collect()} == {r[0] for r in rows}


def test_failures_are_searched_in_three_families(spark, sf_small, monkeypatch):
    columns = [*modeling.FEATS, "vibration_mm_s", "is_failure"]
    frame = spark.createDataFrame([tuple(float(i) for i in range(len(columns)))], columns)
    monkeypatch.setattr(modeling, "silver", lambda t: frame)
    monkeypatch.setattr(modeling, "materialize", lambda df: df)
    monkeypatch.setattr(training, "classifier_search", lambda *_, families=("logistic", "random_forest", "gbt"): dict.fromkeys(families, (None, 0.5)))
    found = {r.model for r in modeling.q_failure_classifier(spark, sf_small).collect()}
    assert found == {"logistic", "random_forest", "gbt"}
