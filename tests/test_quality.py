"""Expectations: warn / drop / fail, report counts."""

import pytest
from pyspark.errors import PySparkException

from smelter.operators.datasets import Expectation, enforce, rule_report


def _df(spark):
    return spark.createDataFrame([(1, 900.0, 1.0), (2, 700.0, None), (3, None, 2.0)],
                                 "furnace_id int, temperature_c double, vibration_mm_s double")


RULES = [Expectation("temp", "temperature_c BETWEEN 800 AND 1100", "drop"),
         Expectation("vib", "vibration_mm_s IS NOT NULL", "warn"),
         Expectation("furnace", "furnace_id IS NOT NULL", "fail")]


def test_drop_removes_violations_and_null_counts_as_violation(spark):
    assert [r.furnace_id for r in enforce(_df(spark), RULES).collect()] == [1]


def test_report_counts(spark):
    rep = {r.rule: r for r in rule_report(_df(spark), RULES).collect()}
    assert (rep["temp"].violated, rep["temp"].passed, rep["temp"].rows_checked) == (2, 1, 3)
    assert rep["vib"].violated == 1 and rep["furnace"].violated == 0
    assert rep["temp"].violated_pct == pytest.approx(66.6667)


def test_fail_rule_aborts(spark):
    bad = spark.createDataFrame([(None, 900.0, 1.0)], "furnace_id int, temperature_c double, vibration_mm_s double")
    with pytest.raises(PySparkException):
        enforce(bad, RULES).collect()


def test_impossible_rule_fails_with_message(spark):
    rule = [Expectation("never", "1 = 0", "fail")]
    with pytest.raises(Exception, match="never"):
        enforce(_df(spark), rule).count()
