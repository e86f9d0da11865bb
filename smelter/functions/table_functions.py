"""Per-furnace lookup functions as SQL table functions.

``register_furnace_functions`` binds the functions to the given frames
(registered as session views) and creates them as temporary SQL table
functions, callable as ``SELECT * FROM get_furnace_quality(7)`` or for many
furnaces at once with ``LATERAL``.  Spark decorrelates the lateral call into
one aggregate and a join, so calling a function for every furnace costs one
pass over the fact table, not one query per furnace.  An unknown id returns
the empty-input aggregate: count 0 and NULL means.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from smelter.functions.columns import round_half_up_sql as r


def _view_name(base: str, df: DataFrame) -> str:
    digest = hashlib.md5(str(id(df)).encode()).hexdigest()[:8]
    return f"{base}_{digest}"


FUNCTION_SQL = {
    "get_furnace_quality": lambda src: f"""
CREATE OR REPLACE TEMPORARY FUNCTION get_furnace_quality(furnace_id_in INT)
RETURNS TABLE (n_inspections BIGINT, defect_rate_pct DOUBLE, avg_surface_quality DOUBLE)
RETURN SELECT count(*), {r('avg(is_defect) * 100', 2)}, {r('avg(surface_quality_score)', 3)}
FROM {src['inspections']} WHERE furnace_id = furnace_id_in""",
    "get_furnace_failure_rate": lambda src: f"""
CREATE OR REPLACE TEMPORARY FUNCTION get_furnace_failure_rate(furnace_id_in INT)
RETURNS TABLE (n_readings BIGINT, failure_rate_pct DOUBLE)
RETURN SELECT count(*), {r('avg(is_failure) * 100', 3)}
FROM {src['telemetry']} WHERE furnace_id = furnace_id_in""",
    "get_furnace_telemetry_stats": lambda src: f"""
CREATE OR REPLACE TEMPORARY FUNCTION get_furnace_telemetry_stats(furnace_id_in INT)
RETURNS TABLE (avg_temperature_c DOUBLE, avg_amperage_ka DOUBLE, avg_anode_effect DOUBLE,
               avg_vibration_mm_s DOUBLE, avg_energy_kwh_ton DOUBLE)
RETURN SELECT {r('avg(temperature_c)', 2)}, {r('avg(amperage_ka)', 2)}, {r('avg(anode_effect)', 4)},
              {r('avg(vibration_mm_s)', 3)}, {r('avg(energy_kwh_ton)', 1)}
FROM {src['telemetry']} WHERE furnace_id = furnace_id_in""",
    "get_furnace_location": lambda src: f"""
CREATE OR REPLACE TEMPORARY FUNCTION get_furnace_location(furnace_id_in INT)
RETURNS TABLE (model STRING, plant_name STRING, state STRING)
RETURN SELECT f.model, p.plant_name, p.state
FROM {src['furnaces']} f LEFT JOIN {src['plants']} p ON f.plant_id = p.plant_id
WHERE f.furnace_id = furnace_id_in""",
}


def register_furnace_functions(spark: SparkSession, **frames: DataFrame) -> dict[str, str]:
    """Register ``frames`` (inspections, telemetry, furnaces, plants) as views
    and (re)create the lookup functions over them; returns the view names."""
    names = {}
    for role, df in frames.items():
        names[role] = _view_name(f"smelter_{role}", df)
        df.createOrReplaceTempView(names[role])
    for fn, make in FUNCTION_SQL.items():
        needed = {"get_furnace_quality": ["inspections"],
                  "get_furnace_failure_rate": ["telemetry"],
                  "get_furnace_telemetry_stats": ["telemetry"],
                  "get_furnace_location": ["furnaces", "plants"]}[fn]
        if all(n in names for n in needed):
            spark.sql(make(names))
    return names
