"""Every registered query with an oracle equals its DuckDB SQL at sf0.001."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from smelter import plans
from smelter.sources.tables import BASE_TABLES

HEAVY = {"energy_trees", "defect_classifier", "defect_importance", "defect_confusion",
         "high_defect_probability", "failure_classifier", "defect_calibration"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_query_matches_oracle(spark, sf_small, duck, name):
    df = entry.queries()[name](spark, sf_small)
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, df.collect()) == _rows(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLES) - HEAVY))
def test_rows_only_query_runs(spark, sf_small, name):
    df = entry.queries()[name](spark, sf_small)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["plant_name", "state", "energy_kwh_ton", "failure_rate_pct"]
