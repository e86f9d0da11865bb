"""Semantic layer: measures re-aggregate from source rows; TRAP1/TRAP2/TRAP3 cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from smelter.operators import margin
from smelter.plans import semantic

D = dt.date


def test_ratio_measure_is_ratio_of_sums_at_any_grain(spark, sf_small):
    import __spark_entry__ as entry  # noqa: F401  (session config)
    from smelter.sources.tables import TableSet

    t = TableSet(spark, sf_small)
    view = semantic.production_view(t.role("production"), t.role("plants"), t.role("alloys"))
    by_month = view.query(["month"], ["total_energy_kwh", "total_tons"]).agg(
        F.sum("total_energy_kwh").alias("e"), F.sum("total_tons").alias("t")).first()
    overall = view.query([], ["energy_cost_per_ton", "total_tons"]).first()
    assert overall.energy_cost_per_ton == pytest.approx(by_month.e / 1000 * 320 / by_month.t, rel=1e-12)
    assert overall.total_tons == pytest.approx(by_month.t, rel=1e-12)


def _frames(spark, seed):
    rnd = random.Random(seed)
    alloys = spark.createDataFrame([("A1", "Al-Mg-Si"), ("A2", "Al-Mg-Si"), ("A3", "Pure")],
                                   "alloy_id string, alloy_name string")
    sales = spark.createDataFrame(
        [(D(2024, rnd.randint(1, 3), rnd.randint(1, 28)), rnd.choice(["A1", "A2", "A3"]),
          float(rnd.randint(1, 50)), float(rnd.randint(100, 5000))) for _ in range(60)],
        "date date, alloy_id string, tons_sold double, revenue_brl double")
    prod = spark.createDataFrame(
        [(D(2024, rnd.randint(1, 2), rnd.randint(1, 28)), rnd.choice(["A1", "A2"]),
          float(rnd.randint(1, 40)), float(rnd.randint(1000, 90000))) for _ in range(40)],
        "date date, alloy_id string, tons_produced double, energy_kwh double")
    return sales, prod, alloys


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_literal_margin_equals_raw_many_to_many_join(spark, seed):
    sales, prod, alloys = _frames(spark, seed)
    fast = semantic.margin_source(sales, prod, alloys, literal=True)
    s, p = sales.alias("s"), prod.alias("p")
    raw = (s.join(alloys.alias("li"), F.col("s.alloy_id") == F.col("li.alloy_id"))
           .join(p, (F.col("p.alloy_id") == F.col("s.alloy_id"))
                 & (F.trunc("p.date", "MM") == F.trunc("s.date", "MM")), "left")
           .groupBy(F.trunc("s.date", "MM").alias("month"), "li.alloy_name")
           .agg(F.sum("s.revenue_brl").alias("revenue_brl"), F.sum("s.tons_sold").alias("tons_sold"),
                (F.sum("p.energy_kwh") / 1000 * 320).alias("energy_cost_brl"),
                F.sum("p.tons_produced").alias("tons_produced")))
    a = {(r.month, r.alloy_name): r for r in fast.collect()}
    b = {(r.month, r.alloy_name): r for r in raw.collect()}
    assert a.keys() == b.keys()
    for k in a:
        for c in ("revenue_brl", "tons_sold", "energy_cost_brl", "tons_produced"):
            x, y = a[k][c], b[k][c]
            assert (x is None and y is None) or x == pytest.approx(y, rel=1e-12)


def test_corrected_and_literal_differ_when_counts_differ(spark):
    sales, prod, alloys = _frames(spark, 7)
    c = semantic.margin_view(sales, prod, alloys).query(["month"], ["price_brl_ton"]).orderBy("month").collect()
    lit = semantic.margin_view(sales, prod, alloys, literal=True).query(["month"], ["price_brl_ton"]) \
        .orderBy("month").collect()
    assert any(abs(x.price_brl_ton - y.price_brl_ton) > 1e-9 for x, y in zip(c, lit))


def test_month_without_production_has_null_cost(spark):
    sales, prod, alloys = _frames(spark, 3)
    rows = semantic.margin_view(sales, prod, alloys).query(["month"], ["cost_brl_ton", "margin_brl_ton"]) \
        .filter(F.col("month") == D(2024, 3, 1)).collect()
    assert rows and rows[0].cost_brl_ton is None and rows[0].margin_brl_ton is None


def test_quality_oee_can_go_negative(spark):
    prod = spark.createDataFrame([(D(2024, 1, 1), 1, "A1", 1.0, 10.0, 5)],
                                 "date date, plant_id int, alloy_id string, tons_produced double, energy_kwh double, defects int")
    plants = spark.createDataFrame([(1, "P", "S")], "plant_id int, plant_name string, state string")
    alloys = spark.createDataFrame([("A1", "X")], "alloy_id string, alloy_name string")
    v = semantic.production_view(prod, plants, alloys).query([], ["oee_quality_pct"]).first()
    assert v.oee_quality_pct == pytest.approx(-400.0)


def test_zero_tons_gives_null_cost_not_error(spark):
    prod = spark.createDataFrame([(D(2024, 1, 2), 1, 1, 1, 0.0, 10.0)],
                                 "date date, plant_id int, furnace_id int, product_id int, tons_produced double, energy_cost_brl double")
    lme = spark.createDataFrame([(D(2024, 1, 2), 2000.0)], "date date, lme_price_usd_ton double")
    fx = spark.createDataFrame([(D(2024, 1, 2), 5.0)], "date date, usd_brl double")
    r = margin.margin_rows(prod, lme, fx).first()
    assert r.energy_cost_brl_ton is None and r.price_brl_ton == 10000.0 and r.margin_brl_ton is None


def test_unknown_measure_is_rejected(spark):
    sales, prod, alloys = _frames(spark, 1)
    with pytest.raises(KeyError):
        semantic.margin_view(sales, prod, alloys).query(["month"], ["no_such_measure"])
