"""Role views over the driver's test tables.

The library's jobs are written against role tables (telemetry, furnaces,
plants, alloys, production, sales, market series, inspections, manuals).
The test data is a TPC-H-like schema, so each role is a view over it.
One SQL text per view serves both engines: Spark runs it with the base
tables passed as DataFrame arguments (``{lineitem}`` placeholders), DuckDB
runs it as a CTE over its pre-registered views.
"""

from __future__ import annotations

import re

from smelter.functions.columns import round_half_up_sql

# Fixed stand-in definitions (documented in FIXTURES.md, part B).  The only
# change from that text: ``round(x, 2)`` is written as the tie-safe rounding of
# ``functions.columns`` (``{ROUND2:x}``), because Spark and DuckDB round exact
# decimal ties of doubles differently (116 of 60,000 revenue values at sf0.01).
_STANDIN_TEMPLATES = {
    "v_telemetry": """
SELECT event_id AS reading_seq, CAST(user_id AS INT) AS furnace_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts,
  CAST(950 AS DOUBLE) + value AS temperature_c,
  CAST(300 AS DOUBLE) + CAST(event_id % 41 AS DOUBLE) AS amperage_ka,
  CAST(1 AS DOUBLE) + CAST(event_id % 31 AS DOUBLE) / 100 AS bath_ratio,
  CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS anode_effect,
  CAST(2 AS DOUBLE) + CAST(event_id % 7 AS DOUBLE) / 10 AS alumina_feed_rate,
  CAST(13000 AS DOUBLE) + value * 35 + CAST(event_id % 41 AS DOUBLE) * 2 + CASE WHEN event_type = 'view' THEN 120 ELSE 0 END AS energy_kwh_ton,
  CAST(101325 AS DOUBLE) AS pressure_pa,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE value / 25 END AS vibration_mm_s,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_failure
FROM {events}""",
    "v_dim_fornos": """
SELECT CAST(s_suppkey AS INT) AS furnace_id, s_nationkey AS plant_id, s_name AS model, s_acctbal AS capacity_ton_day FROM {supplier}""",
    "v_dim_plantas": """
SELECT n_nationkey AS plant_id, n_name AS plant_name, r_name AS state FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "v_dim_ligas": """
SELECT DISTINCT p_type AS alloy_id, CASE WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'MEDIUM-LARGE' ELSE p_type END AS alloy_name FROM {part}""",
    "v_dim_produtos": """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS alloy_id, p_brand AS unit FROM {part}""",
    "v_fact_production": """
SELECT CAST(l_shipdate AS DATE) AS date, s_nationkey AS plant_id, CAST(l_suppkey AS INT) AS furnace_id, p_type AS alloy_id, l_partkey AS product_id,
  l_quantity AS tons_produced, l_extendedprice AS energy_kwh, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS defects,
  {ROUND2:l_extendedprice / 1000 * 320} AS energy_cost_brl
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey""",
    "v_fact_sales": """
SELECT CAST(o_orderdate AS DATE) AS date, l_partkey AS product_id, p_type AS alloy_id, r_name AS region,
  CASE WHEN r_name = 'EUROPE' THEN 'Externo' ELSE 'Interno' END AS market, c_mktsegment AS customer_segment,
  l_quantity AS tons_sold, p_retailprice AS lme_price_usd_ton,
  CAST(5 AS DOUBLE) + CAST(extract(day FROM o_orderdate) AS DOUBLE) / 100 AS usd_brl,
  {ROUND2:l_extendedprice * (1 - l_discount)} AS revenue_brl
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
  JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "v_lme": """
SELECT CAST(o_orderdate AS DATE) AS date, {ROUND2:avg(o_totalprice) / 50} AS lme_price_usd_ton FROM {orders} GROUP BY CAST(o_orderdate AS DATE)""",
    "v_fx": """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, CAST(5 AS DOUBLE) + CAST(extract(day FROM o_orderdate) AS DOUBLE) / 100 AS usd_brl
FROM {orders} WHERE extract(day FROM o_orderdate) <> 15""",
    "v_inspections": """
SELECT doc_id AS inspection_id, CAST(doc_id % 150 AS INT) AS furnace_id, DATE '2024-01-01' + CAST(doc_id % 30 AS INT) AS date,
  CASE doc_id % 6 WHEN 0 THEN 'ECONOMY' WHEN 1 THEN 'LARGE' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'PROMO' WHEN 4 THEN 'SMALL' ELSE 'STANDARD' END AS alloy_id,
  CASE WHEN quality = 1 AND toxic = 0 THEN 'ok' WHEN toxic = 1 THEN 'trinca' ELSE lang END AS defect_type,
  CAST(n_chars AS DOUBLE) / CAST(n_chars + 1000 AS DOUBLE) AS surface_quality_score,
  CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END AS is_defect
FROM {documents} JOIN {labels} USING (doc_id)""",
    "v_manuals": """
SELECT doc_id AS id, source AS titulo, text AS conteudo FROM {documents}""",
}

_ROUND2 = re.compile(r"\{ROUND2:([^}]*)\}")
STANDIN_SQL = {name: _ROUND2.sub(lambda m: round_half_up_sql(m.group(1), 2), body)
               for name, body in _STANDIN_TEMPLATES.items()}

# Role name used by the library -> stand-in view.
ROLES = {
    "telemetry": "v_telemetry",
    "furnaces": "v_dim_fornos",
    "plants": "v_dim_plantas",
    "alloys": "v_dim_ligas",
    "products": "v_dim_produtos",
    "production": "v_fact_production",
    "sales": "v_fact_sales",
    "lme": "v_lme",
    "fx": "v_fx",
    "inspections": "v_inspections",
    "manuals": "v_manuals",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def base_tables(view: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(STANDIN_SQL[view])))


def duckdb_body(view: str) -> str:
    return _PLACEHOLDER.sub(r"\1", STANDIN_SQL[view]).strip()


def duckdb_ctes(*roles: str) -> str:
    """CTE list ``role AS (...), ...`` defining the given roles for DuckDB."""
    return ",\n".join(f"{role} AS ({duckdb_body(ROLES.get(role, role))})" for role in roles)


def duckdb_with(*roles: str) -> str:
    """``WITH`` clause defining the given roles for a DuckDB oracle query."""
    return "WITH " + duckdb_ctes(*roles) + "\n"
