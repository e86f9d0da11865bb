"""Table functions (case C9) and column helpers."""

import pytest
from pyspark.sql import functions as F

from smelter.functions import columns
from smelter.functions.table_functions import register_furnace_functions


def test_unknown_furnace_gives_zero_and_nulls(spark):
    insp = spark.createDataFrame([(1, 1, 0.5), (1, 0, 0.7)], "furnace_id int, is_defect int, surface_quality_score double")
    register_furnace_functions(spark, inspections=insp)
    r = spark.sql("SELECT * FROM get_furnace_quality(99)").first()
    assert (r.n_inspections, r.defect_rate_pct, r.avg_surface_quality) == (0, None, None)
    r = spark.sql("SELECT * FROM get_furnace_quality(1)").first()
    assert (r.n_inspections, r.defect_rate_pct, r.avg_surface_quality) == (2, 50.0, 0.6)


def test_round_half_up_is_tie_safe(spark):
    df = spark.createDataFrame([(1222.745,), (-2.5,), (0.125,), (None,)], "x double")
    got = [r.y for r in df.select(columns.round_half_up("x", 2).alias("y")).collect()]
    assert got == [1222.75, -2.5, 0.13, None]
    got0 = [r.y for r in df.select(columns.round_half_up("x", 0).alias("y")).collect()]
    assert got0[1] == -3.0


def test_safe_ratio_and_nan(spark):
    df = spark.createDataFrame([(1.0, 0.0), (float("nan"), 2.0)], "a double, b double")
    r = df.select(columns.safe_ratio("a", "b").alias("q"), columns.nan_to_null("a").alias("n")).collect()
    assert r[0].q is None and r[1].n is None


def test_market_class_and_key(spark):
    df = spark.createDataFrame([("Exterior",), ("Sul",)], "region string")
    assert [r.m for r in df.select(columns.market_class("region").alias("m")).collect()] == ["Externo", "Interno"]
    ts = spark.sql("SELECT 7 AS furnace_id, TIMESTAMP '2024-01-01 00:00:00' AS ts")
    assert ts.select(columns.reading_key().alias("k")).first().k == "7_1704067200"
    assert F is not None and pytest is not None


def test_rounding_keeps_large_values_and_values_below_a_tie(spark):
    df = spark.createDataFrame([(1e16,), (2.3e15,), (1.2344999995,), (0.12344999999999999,), (-0.00000001,)], "x double")
    got = [r.y for r in df.select(columns.round_half_up("x", 4).alias("y")).collect()]
    assert got == [1e16, 2.3e15, 1.2345, 0.1235, 0.0]
    assert [r.y for r in df.select(columns.round_half_up("x", 3).alias("y")).collect()][2] == 1.234
    sql = columns.round_half_up_sql("x", 3)
    assert [r.y for r in df.selectExpr(f"{sql} AS y").collect()][:3] == [1e16, 2.3e15, 1.234]


def test_statistics_of_constant_and_empty_tables(spark):
    from smelter.models import training
    from smelter.operators import stats

    same = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    assert [(r.bin, r.n) for r in stats.histogram(same, "v").collect()] == [(1, 2)]
    empty = same.limit(0)
    assert [tuple(r)[1:] for r in stats.null_profile(empty).collect()] == [(0, 0, None)]
    constant = spark.createDataFrame([("m", 1.0, 1.0), ("m", 1.0, 2.0)], "model string, label double, prediction double")
    assert training.regression_metrics(constant).first().r2 is None
