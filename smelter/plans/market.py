"""Market series ingest and price x FX x cost margin."""

from __future__ import annotations

from pyspark.sql import functions as F

from smelter.functions.columns import round_half_up_sql as r
from smelter.operators import margin
from smelter.plans.registry import register
from smelter.sources import market
from smelter.sources.standins import duckdb_with

MARGIN_SQL = duckdb_with("production", "lme", "fx") + f""",
margins AS (
  SELECT p.date, p.plant_id, p.furnace_id, p.product_id, p.tons_produced, l.lme_price_usd_ton, x.usd_brl,
         {r('l.lme_price_usd_ton * x.usd_brl', 2)} AS price_brl_ton,
         {r('p.energy_cost_brl / NULLIF(p.tons_produced, 0)', 2)} AS energy_cost_brl_ton
  FROM production p JOIN lme l ON p.date = l.date JOIN fx x ON p.date = x.date),
margins2 AS (SELECT *, {r('price_brl_ton - energy_cost_brl_ton', 2)} AS margin_brl_ton FROM margins)"""


def _margins(t):
    return margin.margin_rows(t.role("production"), t.role("lme"), t.role("fx"))


@register("api_payload", ("SRC7", "FN18", "FN2", "FN12"), duckdb_with("lme") + """
SELECT date, lme_price_usd_ton FROM lme""")
def q_api_payload(t):
    """LME series rendered as monthly API envelopes, then decoded back to rows."""
    bodies = market.landed_bodies(t.role("lme"), "lme_price_usd_ton", "LME", unit="USD/ton")
    return market.parse_bodies(bodies, "lme_price_usd_ton")


@register("market_range", ("SRC8", "JN9"), duckdb_with("lme", "fx") + """
SELECT l.date, l.lme_price_usd_ton, x.usd_brl FROM lme l JOIN fx x ON l.date = x.date
WHERE l.date >= DATE '1995-01-01' AND l.date <= DATE '1996-06-30'""")
def q_market_range(t):
    """Both series selected on an inclusive date range, joined on date."""
    lme = market.select_range(t.role("lme"), "1995-01-01", "1996-06-30")
    fx = market.select_range(t.role("fx"), "1995-01-01", "1996-06-30")
    return lme.join(fx, "date", "inner")


@register("margin_rows", ("JN5", "PRJ5", "FN11", "FN20", "TRAP13", "TRAP6"), MARGIN_SQL + "\nSELECT * FROM margins2")
def q_margin_rows(t):
    return _margins(t)


@register("margin_by_day", ("AGG10", "TOP2"), MARGIN_SQL + f"""
SELECT date, {r('avg(price_brl_ton)', 2)} AS avg_price_brl_ton, {r('avg(margin_brl_ton)', 2)} AS avg_margin_brl_ton,
       max(usd_brl) AS usd_brl
FROM margins2 GROUP BY date""")
def q_margin_by_day(t):
    return margin.margin_by_day(_margins(t))


@register("worst_margin_day", ("AGG25",), MARGIN_SQL + f""",
d AS (SELECT date, avg(margin_brl_ton) AS m, max(usd_brl) AS usd_brl FROM margins2 GROUP BY date)
SELECT date, {r('m', 2)} AS avg_margin_brl_ton, usd_brl FROM d ORDER BY m, date LIMIT 1""")
def q_worst_margin_day(t):
    return margin.worst_margin_day(_margins(t))


PRICING_SQL = f"""
SELECT l_orderkey, l_linenumber, l_quantity AS tons_sold,
       {r(r('p_retailprice * (1.05 + l_tax)', 2) + ' * (CAST(5 AS DOUBLE) + CAST(extract(day FROM o_orderdate) AS DOUBLE) / 100)', 2)} AS price_brl_ton,
       {r('p_retailprice * (1.05 + l_tax)', 2)} AS price_usd_ton,
       {r('l_quantity * ' + r(r('p_retailprice * (1.05 + l_tax)', 2) + ' * (CAST(5 AS DOUBLE) + CAST(extract(day FROM o_orderdate) AS DOUBLE) / 100)', 2), 2)} AS revenue_brl,
       CASE WHEN r_name = 'EUROPE' THEN 'Externo' ELSE 'Interno' END AS market
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


@register("sales_pricing", ("PRJ7", "PRJ8"), PRICING_SQL)
def q_sales_pricing(t):
    """Sale pricing on order lines: premium over LME is 1.05 + line tax, FX is
    the order-day rate, destination 'Exterior' for European customers."""
    li, o, p = t.table("lineitem"), t.table("orders"), t.table("part")
    c, n, rg = t.table("customer"), t.table("nation"), t.table("region")
    base = (li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
            .join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .join(rg, n.n_regionkey == rg.r_regionkey))
    fx = F.lit(5.0) + F.dayofmonth("o_orderdate").cast("double") / 100
    region = F.when(F.col("r_name") == "EUROPE", F.lit("Exterior")).otherwise(F.col("r_name"))
    priced = margin.price_sales(base, F.col("p_retailprice"), F.lit(1.05) + F.col("l_tax"), fx,
                                F.col("l_quantity"), region)
    return priced.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("tons_sold"),
                         "price_usd_ton", "price_brl_ton", "revenue_brl", "market")


@register("json_props", ("FN18",), """
SELECT event_type, count(*) AS events, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total
FROM events GROUP BY event_type""")
def q_json_props(t):
    """Decode the JSON ``props`` column with a declared schema and aggregate it."""
    ev = t.table("events").select("event_type", F.from_json("props", "k long").alias("p"))
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"),
                                        F.sum("p.k").cast("long").alias("k_total"))

