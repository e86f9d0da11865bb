"""Exploration and fact rollups: key checks, production, sales, quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from smelter.functions.columns import round_half_up_sql as r
from smelter.operators import explore, joins, rollups
from smelter.plans.medallion import GOLD_SQL, gold
from smelter.plans.registry import register
from smelter.sources.standins import duckdb_ctes, duckdb_with

MONTH = "CAST(date_trunc('month', date) AS DATE)"
COST = "(sum(energy_kwh) / 1000 * 320)"


@register("orphan_furnaces", ("JN3", "JN2"), GOLD_SQL + ",\n" + duckdb_ctes("furnaces") + """
SELECT furnace_id, count(*) AS rows FROM gold_oee g
WHERE NOT EXISTS (SELECT 1 FROM furnaces f WHERE f.furnace_id = g.furnace_id)
GROUP BY furnace_id""")
def q_orphan_furnaces(t):
    """Furnace ids in the furnace-day gold that the furnace dimension lacks."""
    return joins.orphans(gold(t), t.role("furnaces"), "furnace_id")


@register("join_counts", ("JN2", "JN3"), GOLD_SQL + ",\n" + duckdb_ctes("furnaces") + """
SELECT (SELECT count(*) FROM gold_oee g JOIN furnaces f ON g.furnace_id = f.furnace_id) AS inner_rows,
       (SELECT count(*) FROM gold_oee g LEFT JOIN furnaces f ON g.furnace_id = f.furnace_id) AS left_rows,
       (SELECT count(*) FROM gold_oee g LEFT JOIN furnaces f ON g.furnace_id = f.furnace_id)
     - (SELECT count(*) FROM gold_oee g JOIN furnaces f ON g.furnace_id = f.furnace_id) AS orphan_rows""")
def q_join_counts(t):
    return joins.join_counts(gold(t), t.role("furnaces"), "furnace_id")


def _key_sql(role, key):
    return f"""SELECT '{role}' AS table_name, '{key}' AS key_column, CAST(sum(n) AS BIGINT) AS rows,
  count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS duplicated_keys,
  count(*) FILTER (WHERE {key} IS NULL) AS null_keys,
  (count(*) FILTER (WHERE n > 1) = 0 AND count(*) FILTER (WHERE {key} IS NULL) = 0) AS is_unique
FROM (SELECT {key}, count(*) AS n FROM {role} GROUP BY {key})"""


DIM_KEYS = [("furnaces", "furnace_id"), ("plants", "plant_id"), ("alloys", "alloy_id"),
            ("products", "product_id")]


@register("dimension_key_check", ("JN4",),
          duckdb_with(*[d for d, _ in DIM_KEYS]) + "\nUNION ALL\n".join(_key_sql(d, k) for d, k in DIM_KEYS))
def q_dimension_key_check(t):
    out = None
    for role, key in DIM_KEYS:
        part = joins.key_profile(t.role(role), key, role)
        out = part if out is None else out.unionByName(part)
    return out


@register("failure_summary", ("AGG27", "FLT10"), duckdb_with("telemetry") + f"""
SELECT count(*) AS readings, count(*) FILTER (WHERE is_failure = 1) AS failures,
       {r('avg(vibration_mm_s)', 4)} AS avg_vibration_mm_s,
       count(*) FILTER (WHERE vibration_mm_s IS NULL) AS null_vibration,
       count(*) FILTER (WHERE energy_kwh_ton < 0) AS negative_energy
FROM telemetry""")
def q_failure_summary(t):
    return explore.failure_summary(t.role("telemetry"))


@register("first_readings", ("TOP3", "TOP6"), duckdb_with("telemetry") + """
SELECT * FROM telemetry ORDER BY ts, furnace_id, reading_seq LIMIT 20""")
def q_first_readings(t):
    return t.role("telemetry").orderBy("ts", "furnace_id", "reading_seq").limit(20)


@register("production_by_plant", ("AGG5", "JN6"), duckdb_with("production", "plants") + f"""
SELECT p.plant_name, p.state, {r('sum(f.tons_produced)', 1)} AS total_tons
FROM production f JOIN plants p ON f.plant_id = p.plant_id
GROUP BY p.plant_name, p.state""")
def q_production_by_plant(t):
    return explore.production_by_plant(t.role("production"), t.role("plants"))


@register("production_by_month", ("AGG6", "FN3", "TOP2"), duckdb_with("production") + f"""
SELECT {MONTH} AS month, {r('sum(tons_produced)', 1)} AS total_tons
FROM production GROUP BY {MONTH}""")
def q_production_by_month(t):
    return explore.production_by_month(t.role("production"))


@register("energy_cost_by_plant", ("AGG7", "FN11", "PRJ6"), duckdb_with("production", "plants") + f"""
SELECT p.plant_name, {r(COST, 0)} AS energy_cost_brl, {r('sum(tons_produced)', 1)} AS total_tons,
       {r(COST + ' / NULLIF(sum(tons_produced), 0)', 2)} AS cost_per_ton
FROM production f JOIN plants p ON f.plant_id = p.plant_id GROUP BY p.plant_name""")
def q_energy_cost_by_plant(t):
    return explore.energy_cost_by_plant(t.role("production"), t.role("plants"))


@register("cost_vs_mean", ("AGG30",), duckdb_with("production", "plants") + f""",
per_plant AS (
  SELECT p.plant_name, {COST} / NULLIF(sum(tons_produced), 0) AS cpt
  FROM production f JOIN plants p ON f.plant_id = p.plant_id GROUP BY p.plant_name)
SELECT plant_name, {r('cpt', 2)} AS cost_per_ton,
       {r('(SELECT avg(cpt) FROM per_plant)', 2)} AS mean_cost_per_ton,
       {r('(cpt / (SELECT avg(cpt) FROM per_plant) - 1) * 100', 2)} AS pct_vs_mean
FROM per_plant""")
def q_cost_vs_mean(t):
    return explore.cost_vs_mean(t.role("production"), t.role("plants"))


@register("sales_by_market", ("AGG8",), duckdb_with("sales") + f"""
SELECT market, {r('sum(tons_sold)', 1)} AS total_tons_sold, {r('sum(revenue_brl)', 0)} AS revenue_brl,
       {r('sum(revenue_brl) / NULLIF(sum(tons_sold), 0)', 2)} AS revenue_per_ton
FROM sales GROUP BY market""")
def q_sales_by_market(t):
    return explore.sales_by_market(t.role("sales"))


@register("external_by_region", ("AGG28",), duckdb_with("sales") + f"""
SELECT region, {r('sum(revenue_brl)', 2)} AS revenue_brl, {r('sum(tons_sold)', 1)} AS total_tons_sold
FROM sales WHERE market = 'Externo' GROUP BY region""")
def q_external_by_region(t):
    return explore.external_by_region(t.role("sales"))


@register("price_fx_by_month", ("AGG9", "FN20", "TRAP8"), duckdb_with("sales") + f"""
SELECT {MONTH} AS month, {r('avg(lme_price_usd_ton)', 2)} AS avg_lme_usd_ton,
       {r('avg(usd_brl)', 4)} AS avg_usd_brl, {r('avg(lme_price_usd_ton * usd_brl)', 2)} AS avg_price_brl_ton
FROM sales GROUP BY {MONTH}""")
def q_price_fx_by_month(t):
    return explore.price_fx_by_month(t.role("sales"))


@register("quarter_change", ("AGG31", "WIN5"), duckdb_with("sales") + f""",
q AS (SELECT CAST(date_trunc('quarter', date) AS DATE) AS quarter, sum(revenue_brl) AS rev
      FROM sales GROUP BY 1),
l AS (SELECT quarter, rev, lag(rev) OVER (ORDER BY quarter) AS prev FROM q)
SELECT quarter, {r('rev', 2)} AS revenue_brl, {r('prev', 2)} AS prev_revenue_brl,
       {r('rev - prev', 2)} AS delta_brl, {r('(rev - prev) / NULLIF(prev, 0) * 100', 2)} AS delta_pct
FROM l""")
def q_quarter_change(t):
    return explore.quarter_change(t.role("sales"))


@register("margin_month_join", ("JN14",), duckdb_with("sales", "production") + f""",
price AS (SELECT {MONTH} AS month, sum(revenue_brl) / NULLIF(sum(tons_sold), 0) AS p FROM sales GROUP BY 1),
cost AS (SELECT {MONTH} AS month, {COST} / NULLIF(sum(tons_produced), 0) AS c FROM production GROUP BY 1)
SELECT price.month, {r('p', 2)} AS price_brl_ton, {r('c', 2)} AS cost_brl_ton, {r('p - c', 2)} AS margin_brl_ton
FROM price LEFT JOIN cost ON price.month = cost.month""")
def q_margin_month_join(t):
    return explore.monthly_margin(t.role("sales"), t.role("production"))


@register("defect_by_alloy", ("JN12", "AGG23"), duckdb_with("inspections", "alloys") + f"""
SELECT a.alloy_name, count(*) AS inspections, {r('avg(i.is_defect) * 100', 2)} AS defect_rate_pct
FROM inspections i LEFT JOIN alloys a ON i.alloy_id = a.alloy_id GROUP BY a.alloy_name""")
def q_defect_by_alloy(t):
    return explore.defect_by_alloy(t.role("inspections"), t.role("alloys"))


@register("defect_pareto", ("AGG19", "WIN4"), duckdb_with("inspections") + f""",
c AS (SELECT defect_type, count(*) AS n FROM inspections GROUP BY defect_type)
SELECT defect_type, n, {r('n / (SELECT sum(n) FROM c) * 100', 2)} AS pct,
       {r('sum(n) OVER (ORDER BY n DESC, defect_type ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / (SELECT sum(n) FROM c) * 100', 2)} AS cumulative_pct
FROM c""")
def q_defect_pareto(t):
    return explore.category_shares(t.role("inspections"), "defect_type")


@register("label_balance", ("AGG14", "WIN3"), duckdb_with("inspections") + f""",
c AS (SELECT is_defect, count(*) AS n FROM inspections GROUP BY is_defect)
SELECT is_defect, n, {r('n / (SELECT sum(n) FROM c) * 100', 2)} AS pct FROM c""")
def q_label_balance(t):
    return explore.label_balance(t.role("inspections"), "is_defect")


@register("running_total", ("FN15",), duckdb_with("production") + f""",
d AS (SELECT date, sum(tons_produced) AS v FROM production GROUP BY date)
SELECT date, {r('v', 2)} AS daily_total,
       {r('sum(v) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 2)} AS running_total
FROM d""")
def q_running_total(t):
    return explore.running_total(t.role("production"), "date", "tons_produced")


@register("union_parts", ("SET1",), duckdb_with("production", "sales") + f"""
SELECT 'production' AS source, date, {r('sum(tons_produced)', 2)} AS tons FROM production GROUP BY date
UNION ALL
SELECT 'sales' AS source, date, {r('sum(tons_sold)', 2)} AS tons FROM sales GROUP BY date""")
def q_union_parts(t):
    """Bag union of two daily tonnage series (by column name)."""
    prod = (t.role("production").groupBy("date").agg(F.sum("tons_produced").alias("_t"))
            .select(F.lit("production").alias("source"), "date",
                    explore.round_half_up(F.col("_t"), 2).alias("tons")))
    sold = (t.role("sales").groupBy("date").agg(F.sum("tons_sold").alias("_t"))
            .select(F.lit("sales").alias("source"), "date",
                    explore.round_half_up(F.col("_t"), 2).alias("tons")))
    return prod.unionByName(sold)
