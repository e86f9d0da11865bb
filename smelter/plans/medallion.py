"""Telemetry medallion: silver cleaning, furnace-day gold, location joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from smelter.functions.columns import logistic, round_half_up, round_half_up_sql as r
from smelter.operators import cleaning, datasets, rollups
from smelter.operators.sizing import broadcast_if_small
from smelter.plans.registry import register
from smelter.session import materialize
from smelter.sources.standins import duckdb_ctes, duckdb_with

#: Width of a temperature band of the failure risk model, in degrees.
RISK_BIN = 10

# ---- shared oracle fragments ------------------------------------------------

SILVER_SQL = duckdb_with("telemetry") + """,
medians AS (
  SELECT furnace_id, quantile_disc(vibration_mm_s, 0.5) AS m FROM telemetry GROUP BY furnace_id),
filled AS (
  SELECT t.reading_seq, t.furnace_id, t.ts, t.temperature_c, t.amperage_ka, t.bath_ratio, t.anode_effect,
         t.alumina_feed_rate, t.energy_kwh_ton, t.pressure_pa,
         coalesce(t.vibration_mm_s, md.m) AS vibration_mm_s, t.is_failure,
         t.vibration_mm_s IS NULL AS vibration_imputed
  FROM telemetry t LEFT JOIN medians md ON t.furnace_id = md.furnace_id
  WHERE t.temperature_c BETWEEN 800 AND 1100),
silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY furnace_id, ts ORDER BY reading_seq) AS rn FROM filled)
  WHERE rn = 1)"""

GOLD_SQL = SILVER_SQL + f""",
gold AS (
  SELECT furnace_id, CAST(ts AS DATE) AS day,
         {r('avg(energy_kwh_ton)', 1)} AS avg_energy_kwh_ton,
         {r('avg(temperature_c)', 2)} AS avg_temperature_c,
         {r('avg(vibration_mm_s)', 3)} AS avg_vibration_mm_s,
         CAST(sum(anode_effect) AS BIGINT) AS anode_effects,
         count(*) AS readings,
         {r('avg(is_failure)', 4)} AS failure_rate
  FROM silver GROUP BY furnace_id, CAST(ts AS DATE)),
gold_oee AS (
  SELECT *, {r('(1 - failure_rate) * 100', 2)} AS oee_availability_pct FROM gold)"""

ENRICHED_SQL = GOLD_SQL + ",\n" + duckdb_ctes("furnaces", "plants") + """,
enriched AS (
  SELECT g.furnace_id, g.day, p.plant_name, p.state, f.model, f.capacity_ton_day,
         g.avg_energy_kwh_ton, g.avg_temperature_c, g.failure_rate, g.oee_availability_pct
  FROM gold_oee g LEFT JOIN furnaces f ON g.furnace_id = f.furnace_id
  LEFT JOIN plants p ON f.plant_id = p.plant_id)"""


def silver(t):
    return cleaning.clean_telemetry(t.role("telemetry"))


def gold(t):
    return rollups.furnace_day(silver(t))


@register("silver_clean", ("PRJ1", "PRJ2", "PRJ9", "FLT1", "FN19", "WIN1", "WIN2", "DQ5", "AGG22", "SRC13", "FN8", "FN9", "FN10", "TRAP5"),
          SILVER_SQL + "\nSELECT * FROM silver")
def q_silver_clean(t):
    """Typed telemetry, per-furnace median fill with audit flag, range filter, dedup."""
    return silver(t)


@register("silver_audit", ("AGG11", "DQ6"), SILVER_SQL + """
SELECT count(*) AS total,
       count(*) FILTER (WHERE vibration_imputed) AS imputed,
       count(*) FILTER (WHERE vibration_mm_s IS NULL) AS nulls_left
FROM silver""")
def q_silver_audit(t):
    return cleaning.imputation_audit(silver(t))


@register("gold_furnace_day", ("AGG2", "PRJ12", "FN1", "FN2", "TRAP4", "TRAP6"), GOLD_SQL + "\nSELECT * FROM gold_oee")
def q_gold_furnace_day(t):
    return gold(t)


@register("gold_furnace_day_lite", ("AGG3", "STR5", "TRAP9"), duckdb_with("telemetry") + f""",
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY furnace_id, ts ORDER BY reading_seq) AS rn FROM telemetry)
  WHERE rn = 1),
lite AS (SELECT * FROM deduped WHERE temperature_c BETWEEN 800 AND 1100)
SELECT furnace_id, CAST(ts AS DATE) AS day,
       {r('avg(energy_kwh_ton)', 1)} AS avg_energy_kwh_ton,
       {r('avg(temperature_c)', 2)} AS avg_temperature_c,
       CAST(sum(anode_effect) AS BIGINT) AS anode_effects,
       count(*) AS readings,
       {r('avg(is_failure)', 4)} AS failure_rate,
       {r('(1 - ' + r('avg(is_failure)', 4) + ') * 100', 2)} AS oee_availability_pct
FROM lite GROUP BY furnace_id, CAST(ts AS DATE)""")
def q_gold_furnace_day_lite(t):
    """Declarative-dataset gold: no vibration mean, over the non-imputed silver."""
    return rollups.furnace_day(datasets.declared_silver(t.role("telemetry")), with_vibration=False)


@register("gold_enriched", ("JN1", "PRJ1"), ENRICHED_SQL + "\nSELECT * FROM enriched")
def q_gold_enriched(t):
    return rollups.enrich_with_location(gold(t), t.role("furnaces"), t.role("plants"))


@register("plant_ranking", ("AGG4", "TOP2", "TRAP7"), ENRICHED_SQL + f"""
SELECT plant_name, state,
       {r('avg(avg_energy_kwh_ton)', 1)} AS energy_kwh_ton,
       {r('avg(failure_rate) * 100', 2)} AS failure_rate_pct
FROM enriched GROUP BY plant_name, state""")
def q_plant_ranking(t):
    return rollups.plant_ranking(
        rollups.enrich_with_location(gold(t), t.role("furnaces"), t.role("plants")))


@register("gold_plant_day", ("AGG26",), SILVER_SQL + ",\n" + duckdb_ctes("furnaces", "plants") + f"""
SELECT f.plant_id, p.plant_name, CAST(s.ts AS DATE) AS day,
       {r('avg(s.energy_kwh_ton)', 1)} AS avg_energy_kwh_ton,
       {r('avg(s.temperature_c)', 2)} AS avg_temperature_c,
       CAST(sum(s.anode_effect) AS BIGINT) AS anode_effects,
       count(*) AS readings,
       {r('avg(s.is_failure)', 4)} AS failure_rate
FROM silver s LEFT JOIN furnaces f ON s.furnace_id = f.furnace_id
LEFT JOIN plants p ON f.plant_id = p.plant_id
GROUP BY f.plant_id, p.plant_name, CAST(s.ts AS DATE)""")
def q_gold_plant_day(t):
    return rollups.plant_day(silver(t), t.role("furnaces"), t.role("plants"))


@register("worst_furnace", ("AGG24", "TOP1"), GOLD_SQL + f"""
SELECT furnace_id, {r('avg(failure_rate)', 6)} AS mean_failure_rate
FROM gold_oee GROUP BY furnace_id
ORDER BY mean_failure_rate DESC, furnace_id LIMIT 1""")
def q_worst_furnace(t):
    return rollups.worst_furnace(gold(t))


@register("hottest_furnaces", ("AGG1", "TOP1"), duckdb_with("telemetry") + f"""
SELECT furnace_id,
       {r('avg(temperature_c)', 2)} AS avg_temperature_c,
       {r('avg(energy_kwh_ton)', 1)} AS avg_energy_kwh_ton,
       count(*) AS readings
FROM telemetry GROUP BY furnace_id
ORDER BY avg_temperature_c DESC, furnace_id LIMIT 5""")
def q_hottest_furnaces(t):
    return rollups.hottest_furnaces(t.role("telemetry"))


@register("top_failure_days", ("TOP1",), GOLD_SQL + """
SELECT * FROM gold_oee ORDER BY failure_rate DESC, furnace_id, day LIMIT 10""")
def q_top_failure_days(t):
    return gold(t).orderBy(F.desc("failure_rate"), "furnace_id", "day").limit(10)


@register("failure_risk", ("FN14", "FN13", "PRJ10"), SILVER_SQL + f""",
conditions AS (
  SELECT *, floor(temperature_c / {RISK_BIN}) AS temperature_bin FROM silver),
odds AS (
  SELECT anode_effect, temperature_bin,
         ln((sum(is_failure) + 1.0) / (count(is_failure) - sum(is_failure) + 1.0)) AS log_odds
  FROM conditions GROUP BY anode_effect, temperature_bin)
SELECT c.furnace_id, CAST(c.ts AS DATE) AS day,
       {r('avg(1 / (1 + exp(-o.log_odds)))', 6)} AS expected_failure_rate,
       {r('avg(c.is_failure)', 4)} AS observed_failure_rate
FROM conditions c JOIN odds o ON c.anode_effect IS NOT DISTINCT FROM o.anode_effect
  AND c.temperature_bin IS NOT DISTINCT FROM o.temperature_bin
GROUP BY c.furnace_id, CAST(c.ts AS DATE)""")
def q_failure_risk(t):
    """Expected failure rate per furnace-day, next to the observed one: a
    logistic model with one parameter per operating condition (anode effect
    and temperature band), fitted on all readings by their smoothed odds."""
    rows = silver(t).withColumn("temperature_bin", F.floor(F.col("temperature_c") / RISK_BIN))
    failed, seen = F.sum("is_failure"), F.count("is_failure")
    odds = broadcast_if_small(materialize(rows.groupBy("anode_effect", "temperature_bin").agg(
        F.log((failed + 1.0) / (seen - failed + 1.0)).alias("log_odds")), "odds").withColumnsRenamed(
        {"anode_effect": "_anode", "temperature_bin": "_bin"}))
    fitted = rows.join(odds, F.col("anode_effect").eqNullSafe(F.col("_anode")) & F.col("temperature_bin").eqNullSafe(F.col("_bin")))
    return (fitted.groupBy("furnace_id", F.to_date("ts").alias("day"))
            .agg(round_half_up(F.avg(logistic("log_odds")), 6).alias("expected_failure_rate"),
                 round_half_up(F.avg("is_failure"), 4).alias("observed_failure_rate")))
