"""Data quality rules, row counts, statistics profile."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from smelter.functions.columns import hash_bucket_sql, reading_key, round_half_up_sql as r
from smelter.operators import datasets, selection, stats
from smelter.plans.medallion import SILVER_SQL, silver
from smelter.plans.registry import register
from smelter.sources.standins import duckdb_with
from smelter.sources.tables import BASE_TABLES

DEDUP_SQL = duckdb_with("telemetry") + """,
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY furnace_id, ts ORDER BY reading_seq) AS rn FROM telemetry)
  WHERE rn = 1)"""


def _rule_sql(name, action, predicate, violated):
    pct = r(f"({violated}) * 100.0 / count(*)", 4)
    return (f"SELECT '{name}' AS rule, '{action}' AS action, '{predicate}' AS predicate, count(*) AS rows_checked, "
            f"count(*) - ({violated}) AS passed, {violated} AS violated, {pct} AS violated_pct FROM deduped")


@register("quality_report", ("DQ1", "DQ2", "DQ3", "DQ4", "STR7"), DEDUP_SQL + "\n" + "\nUNION ALL\n".join([
    _rule_sql("plausible_temperature", "drop", "temperature_c BETWEEN 800 AND 1100",
              "count(*) FILTER (WHERE NOT coalesce(temperature_c BETWEEN 800 AND 1100, false))"),
    _rule_sql("furnace_identified", "fail", "furnace_id IS NOT NULL",
              "count(*) FILTER (WHERE furnace_id IS NULL)"),
    _rule_sql("vibration_present", "warn", "vibration_mm_s IS NOT NULL",
              "count(*) FILTER (WHERE vibration_mm_s IS NULL)"),
]))
def q_quality_report(t):
    """Per-rule counters of the declared silver dataset, all rules in one pass."""
    unchecked = datasets.declared_silver_unchecked(t.role("telemetry"))
    return datasets.rule_report(unchecked, datasets.SILVER_RULES)


@register("quality_drop", ("DQ2", "SRC12", "STR3"), DEDUP_SQL + """
SELECT * FROM deduped WHERE temperature_c BETWEEN 800 AND 1100""")
def q_quality_drop(t):
    """Declared silver rows after the drop rule (fail rule checked in-plan)."""
    return datasets.declared_silver(t.role("telemetry"))


@register("row_counts", ("AGG29", "SNK5", "DQ7"), "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, count(*) AS rows FROM {name}" for name in BASE_TABLES))
def q_row_counts(t):
    """Row count of every table; one union of per-table count aggregates
    (Parquet answers the counts from footers)."""
    out = None
    for name in BASE_TABLES:
        part = t.table(name).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


TELEMETRY_COLUMNS = ["furnace_id", "ts", "temperature_c", "amperage_ka", "bath_ratio", "anode_effect",
                     "alumina_feed_rate", "energy_kwh_ton", "pressure_pa", "vibration_mm_s", "is_failure"]


@register("null_profile", ("AGG12", "AGG13"), duckdb_with("telemetry") + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"{r(f'count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100', 4)} AS null_pct FROM telemetry"
    for c in TELEMETRY_COLUMNS))
def q_null_profile(t):
    return stats.null_profile(t.role("telemetry"), TELEMETRY_COLUMNS)


DESCRIBE_COLUMNS = ["temperature_c", "amperage_ka", "bath_ratio", "anode_effect", "alumina_feed_rate",
                    "energy_kwh_ton", "pressure_pa", "vibration_mm_s", "is_failure"]


@register("describe_long", ("AGG15",), duckdb_with("telemetry") + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, {r(f'avg({c})', 6)} AS mean, "
    f"{r(f'stddev_samp({c})', 6)} AS stddev, {r(f'CAST(min({c}) AS DOUBLE)', 6)} AS min, "
    f"{r(f'CAST(max({c}) AS DOUBLE)', 6)} AS max FROM telemetry" for c in DESCRIBE_COLUMNS))
def q_describe_long(t):
    return stats.describe_long(t.role("telemetry"), DESCRIBE_COLUMNS)


CORR_COLUMNS = ["temperature_c", "amperage_ka", "bath_ratio", "anode_effect", "alumina_feed_rate",
                "energy_kwh_ton", "vibration_mm_s"]


@register("correlation_long", ("AGG18",), duckdb_with("telemetry") + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, {r(f'corr({a}, {b})', 6)} AS corr FROM telemetry"
    for a, b in combinations(CORR_COLUMNS, 2)))
def q_correlation_long(t):
    """Pearson matrix over the full table (no driver-side sample)."""
    return stats.correlation_long(t.role("telemetry"), CORR_COLUMNS)


@register("histogram_energy", ("AGG20",), duckdb_with("telemetry") + f""",
b AS (SELECT min(energy_kwh_ton) AS lo, max(energy_kwh_ton) AS hi FROM telemetry),
h AS (SELECT CAST(least(floor((energy_kwh_ton - lo) / ((hi - lo) / 20)) + 1, 20) AS INTEGER) AS bin, count(*) AS n
      FROM telemetry, b WHERE energy_kwh_ton IS NOT NULL GROUP BY 1)
SELECT bin, {r('lo + (bin - 1) * ((hi - lo) / 20)', 4)} AS bin_start, {r('lo + bin * ((hi - lo) / 20)', 4)} AS bin_end, n
FROM h, b""")
def q_histogram_energy(t):
    return stats.histogram(t.role("telemetry"), "energy_kwh_ton", 20)


@register("trend_energy_temperature", ("AGG21",), duckdb_with("telemetry") + f"""
SELECT count(*) FILTER (WHERE temperature_c IS NOT NULL AND energy_kwh_ton IS NOT NULL) AS n,
       {r('regr_slope(energy_kwh_ton, temperature_c)', 6)} AS slope,
       {r('regr_intercept(energy_kwh_ton, temperature_c)', 6)} AS intercept,
       {r('regr_r2(energy_kwh_ton, temperature_c)', 6)} AS r2
FROM telemetry""")
def q_trend_energy_temperature(t):
    return stats.trend_line(t.role("telemetry"), "energy_kwh_ton", "temperature_c")


@register("hash_sample", ("ML22",), SILVER_SQL + f"""
SELECT * FROM silver
WHERE {hash_bucket_sql("CAST(furnace_id AS VARCHAR) || '_' || CAST(epoch(ts) AS BIGINT)")} < 50""")
def q_hash_sample(t):
    """Half of the cleaned readings, chosen by a hash of the reading key."""
    return stats.hash_sample(silver(t), reading_key(), 50)


QUANTILES = (0.1, 0.5, 0.99)


@register("exact_quantiles", ("AGG22", "WIN1", "DQ5"), duckdb_with("telemetry") + ",\n" + "all_values AS (" + " UNION ALL ".join(
    f"SELECT 'furnace ' || furnace_id AS series, {c} AS v FROM telemetry UNION ALL SELECT 'fleet {c}', {c} FROM telemetry"
    for c in ("vibration_mm_s",)) + """
  UNION ALL SELECT 'price ' || l_returnflag, l_extendedprice FROM lineitem)
""" + " UNION ALL ".join(f"SELECT series, CAST({q} AS DOUBLE) AS q, quantile_disc(v, {q}) AS value FROM all_values WHERE v IS NOT NULL GROUP BY series"
                         for q in QUANTILES))
def q_exact_quantiles(t):
    """Exact quantiles of vibration per furnace and over the fleet (one group
    of all rows), and of line prices per return flag."""
    tel = t.role("telemetry")
    parts = [tel.select(F.concat(F.lit("furnace "), F.col("furnace_id").cast("string")).alias("series"), F.col("vibration_mm_s").alias("v")),
             tel.select(F.lit("fleet vibration_mm_s"), "vibration_mm_s"),
             t.table("lineitem").select(F.concat(F.lit("price "), "l_returnflag"), F.col("l_extendedprice").cast("double"))]
    rows = parts[0].union(parts[1]).union(parts[2])
    found = selection.exact_quantiles(rows, "v", "series", QUANTILES)
    return found.select(F.col("group").alias("series"), "q", "value")
