"""Plan shape checks: pruning, pushdown, no cartesian products."""

import re

import pytest

import __spark_entry__ as entry
from smelter import plans

# queries that run streams, writes or model fits at definition time
SIDE_EFFECTS = {"stream_bronze", "stream_schema_evolution", "similarity_index_sync", "stream_file_counts", "stream_silver_keys", "stream_gold", "stream_quality", "csv_roundtrip", "parquet_or_csv",
                "gold_load", "snapshot_history", "snapshot_as_of", "snapshot_changes", "snapshot_restore",
                "energy_trees", "defect_classifier", "defect_confusion", "defect_importance",
                "high_defect_probability", "failure_classifier"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - SIDE_EFFECTS))
def test_no_cartesian_product(spark, sf_small, name):
    plan = _plan(entry.queries()[name](spark, sf_small))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_needed_columns(spark, sf_small):
    df = entry.queries()["hottest_furnaces"](spark, sf_small)
    plan = _plan(df)
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_date_range_reaches_the_scan(spark, sf_small):
    plan = _plan(entry.queries()["market_range"](spark, sf_small))
    assert "PushedFilters" in plan and "o_orderdate" in plan.split("PushedFilters")[1].split("]")[0]


def test_dimensions_broadcast_after_size_check(spark, sf_small):
    plan = _plan(entry.queries()["gold_enriched"](spark, sf_small))
    assert "BroadcastHashJoin" in plan


def test_median_fill_moves_no_raw_row(spark, sf_small):
    """Without automatic broadcasts, raw telemetry is shuffled for the dedup
    alone, never by the furnace (few values, some of them hot)."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = _plan(entry.queries()["silver_clean"](spark, sf_small))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "hashpartitioning(furnace_id" in plan and not re.search(r"hashpartitioning\(furnace_id#\d+, \d+\)", plan)


@pytest.mark.parametrize("name, joins", [("metric_production_plant", 1), ("metric_sales_market", 0), ("dashboard_sales", 0)])
def test_views_join_only_named_dimensions(spark, sf_small, name, joins):
    from smelter.plans import semantic
    from smelter.sources.tables import TableSet

    t = TableSet(spark, sf_small)
    view = semantic._prod(t) if "production" in name else semantic._sales(t)
    base = _plan(view.source).count("Join ")
    query = {"metric_production_plant": (["plant_name"], ["total_tons"]), "metric_sales_market": (["market"], ["revenue_brl"]),
             "dashboard_sales": (["month"], ["revenue_brl"])}[name]
    assert _plan(view.query(*query)).count("Join ") == base + joins + (joins and _plan(view.joins[0].frame).count("Join "))


def test_relative_period_reaches_the_scan(spark, sf_small):
    plan = _plan(entry.queries()["metric_sales_ytd"](spark, sf_small))
    assert "GreaterThanOrEqual(o_orderdate" in plan
