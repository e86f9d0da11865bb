"""Calibrated probabilities and the energy gap, on planted relations."""

import random

import pytest
from pyspark.sql import functions as F

from smelter.models import attribution, calibration
from smelter.plans import modeling


def _inspections(spark, rate_of, n=3000):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        score = rng.uniform(0, 10)
        defect = int(rng.random() < rate_of(score))
        rows.append((f"i{i}", i % 7, defect, "test" if i % 5 == 0 else "train", score,
                     *(rng.random() for _ in modeling.DEFECT_FEATURES[1:])))
    schema = "inspection_id string, furnace_id int, is_defect int, split string, " + ", ".join(
        f"{c} double" for c in modeling.DEFECT_FEATURES)
    return spark.createDataFrame(rows, schema).coalesce(2).cache()


def test_planted_defects_are_found(spark, sf_small, monkeypatch):
    """Defects are the inspections with a score under 3, none between 2.7 and 3.3."""
    data = _inspections(spark, lambda s: float(s < 3)).where("surface_quality_score NOT BETWEEN 2.7 AND 3.3")
    monkeypatch.setattr(modeling, "defect_data", lambda t: data)
    data.createOrReplaceTempView("planted_inspections")
    want = {r[0] for r in spark.sql("SELECT inspection_id FROM planted_inspections WHERE surface_quality_score < 3").collect()}
    assert {r[0] for r in modeling.q_high_defect_probability(spark, sf_small).select("inspection_id").collect()} == want
    assert {r[0] for r in modeling.q_elevated_defect_probability(spark, sf_small).select("inspection_id").collect()} == want


def test_rare_defects_are_calibrated(spark, sf_small, monkeypatch):
    """A rate of 30 % under a score of 3 and 2 % above: nothing passes one half,
    yet the calibrated probabilities single the low scores out."""
    data = _inspections(spark, lambda s: 0.3 if s < 3 else 0.02)
    monkeypatch.setattr(modeling, "defect_data", lambda t: data)
    error = modeling.q_defect_calibration(spark, sf_small).agg(F.sum("weighted_gap"), F.sum("n")).first()
    assert error[0] < 0.06 and error[1] == 600
    found = modeling.q_elevated_defect_probability(spark, sf_small)
    joined = found.join(data.select("inspection_id", "surface_quality_score"), "inspection_id")
    low, all_found = joined.where("surface_quality_score < 3").count(), joined.count()
    planted = data.where("surface_quality_score < 3").count()
    assert low >= 0.9 * planted and low >= 0.75 * all_found


def test_reliability_of_known_rates(spark):
    rows = [(0.05, 0.0)] * 19 + [(0.05, 1.0)] + [(0.95, 1.0)] * 3 + [(1.0, 0.0)]
    got = {r.bin: (r.n, round(r.rate, 6), round(r.weighted_gap, 6)) for r in
           calibration.reliability(spark.createDataFrame(rows, "p double, y double"), "y", "p").collect()}
    assert got == {0: (20, 0.05, 0.0), 9: (4, 0.75, round((3.85 / 4 - 0.75) * 4 / 24, 6))}


def test_contributions_add_up_to_the_gap(spark):
    rows = [("a", 1.0, 4.0, 100.0), ("a", 3.0, 6.0, 140.0), ("b", 5.0, 1.0, 90.0), ("c", None, None, None)]
    means = attribution.group_means(spark.createDataFrame(rows, "f string, x double, y double, e double"), "f", ["x", "y", "e"])
    pairs = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "a"), ("a", "none")], "f string, g string")
    got = attribution.gap_contributions(means, pairs, "f", "g", {"x": 2.0, "y": 10.0}, "e").collect()
    parts = {(r.f, r.g, r.term): r.contribution for r in got}
    assert len(got) == 9 and parts["a", "b", "x"] == -6.0 and parts["a", "b", "y"] == 40.0
    for f, g in (("a", "b"), ("b", "a"), ("a", "a")):
        total = sum(c for (a, b, _), c in parts.items() if (a, b) == (f, g))
        gap = next(r.gap for r in got if (r.f, r.g) == (f, g))
        assert total == pytest.approx(gap)
