"""Metric views (production, sales, margin, quality) and the dashboard /
question queries built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smelter.functions.columns import month_start, round_half_up, round_half_up_sql as r
from smelter.operators import explore
from smelter.operators.sizing import bounded_broadcasts, broadcast_if_small
from smelter.operators.states import Grain, MeasureStates
from smelter.plans.metrics import MetricView, ViewJoin, between, last_day, month_begin
from smelter.plans.registry import ORACLES, register
from smelter.session import materialize, scratch_dir
from smelter.sources.standins import duckdb_with

TARIFF = explore.ENERGY_PRICE_BRL_PER_MWH
PRICE = "SUM(revenue_brl) / NULLIF(SUM(tons_sold), 0)"
COST = "SUM(energy_cost_brl) / NULLIF(SUM(tons_produced), 0)"


def production_view(production: DataFrame, plants: DataFrame, alloys: DataFrame) -> MetricView:
    return MetricView(
        source=production,
        joins=[ViewJoin("plants", plants, "source.plant_id = plants.plant_id"),
               ViewJoin("alloys", alloys, "source.alloy_id = alloys.alloy_id")],
        dimensions={"plant_name": "plants.plant_name", "state": "plants.state",
                    "alloy_name": "alloys.alloy_name",
                    "month": "trunc(source.date, 'MM')"},
        measures={
            "total_tons": "SUM(tons_produced)",
            "total_energy_kwh": "SUM(energy_kwh)",
            "energy_cost_brl": f"SUM(energy_kwh) / 1000 * {TARIFF}",
            "energy_cost_per_ton": f"(SUM(energy_kwh) / 1000 * {TARIFF}) / NULLIF(SUM(tons_produced), 0)",
            "total_defects": "SUM(defects)",
            "oee_quality_pct": "(1 - SUM(defects) / NULLIF(SUM(tons_produced), 0)) * 100",
        })


def sales_view(sales: DataFrame, alloys: DataFrame) -> MetricView:
    return MetricView(
        source=sales,
        joins=[ViewJoin("alloys", alloys, "source.alloy_id = alloys.alloy_id")],
        dimensions={"month": "trunc(source.date, 'MM')", "market": "source.market",
                    "region": "source.region", "customer_segment": "source.customer_segment",
                    "alloy_name": "alloys.alloy_name"},
        measures={
            "total_tons_sold": "SUM(tons_sold)",
            "revenue_brl": "SUM(revenue_brl)",
            "avg_price_brl_ton": PRICE,
            "avg_lme_usd_ton": "AVG(lme_price_usd_ton)",
            "avg_usd_brl": "AVG(usd_brl)",
            # average ticket: revenue per sale line
            "avg_ticket_brl": "SUM(revenue_brl) / NULLIF(COUNT(1), 0)",
        })


def margin_source(sales: DataFrame, production: DataFrame, alloys: DataFrame,
                  literal: bool = False) -> DataFrame:
    """(month, alloy_name) rows with revenue, tons sold, energy cost, tons produced.

    Each side is aggregated to (month, alloy_id) before the join, so the join
    sees one row per key on each side.  ``literal=True`` reproduces the
    row-level many-to-many join's sums exactly (each sales sum weighted by the
    production row count of its key and vice versa, a key without production
    counting once) without materialising the product.  Both sides may be
    stored states instead of rows, each the sum of ``rows`` rows.
    """
    def count(side):
        return F.sum("rows") if "rows" in side.columns else F.count(F.lit(1))

    s = (sales.join(broadcast_if_small(alloys), "alloy_id", "inner")
         .groupBy(month_start("date").alias("month"), "alloy_id", "alloy_name")
         .agg(F.sum("revenue_brl").alias("rev"), F.sum("tons_sold").alias("ts"),
              count(sales).alias("ns")))
    p = (production.groupBy(month_start("date").alias("month"), "alloy_id")
         .agg(F.sum("energy_kwh").alias("kwh"), F.sum("tons_produced").alias("tp"),
              count(production).alias("np")))
    j = s.join(p, ["month", "alloy_id"], "left")
    if literal:
        w_s = F.coalesce(F.col("np"), F.lit(1))
        cols = [(F.col("rev") * w_s).alias("rev"), (F.col("ts") * w_s).alias("ts"),
                (F.col("kwh") * F.col("ns")).alias("kwh"), (F.col("tp") * F.col("ns")).alias("tp")]
        j = j.select("month", "alloy_name", *cols)
    return (j.groupBy("month", "alloy_name")
            .agg(F.sum("rev").alias("revenue_brl"), F.sum("ts").alias("tons_sold"),
                 (F.sum("kwh") / 1000 * TARIFF).alias("energy_cost_brl"),
                 F.sum("tp").alias("tons_produced")))


def margin_view(sales: DataFrame, production: DataFrame, alloys: DataFrame,
                literal: bool = False) -> MetricView:
    return MetricView(
        source=margin_source(sales, production, alloys, literal),
        dimensions={"month": "source.month", "alloy_name": "source.alloy_name"},
        measures={
            "price_brl_ton": PRICE,
            "cost_brl_ton": COST,
            "margin_brl_ton": f"({PRICE}) - ({COST})",
            "margin_pct": f"(({PRICE}) - ({COST})) / NULLIF({PRICE}, 0) * 100",
        })


def quality_view(inspections: DataFrame) -> MetricView:
    return MetricView(
        source=inspections,
        dimensions={"defect_type": "source.defect_type", "month": "trunc(source.date, 'MM')"},
        measures={"defect_rate_pct": "AVG(is_defect) * 100",
                  "avg_surface_quality": "AVG(surface_quality_score)",
                  "inspections": "COUNT(1)"})


def _prod(t):
    return production_view(t.role("production"), t.role("plants"), t.role("alloys"))


def _sales(t):
    return sales_view(t.role("sales"), t.role("alloys"))


def _margin(t, literal=False):
    return margin_view(t.role("sales"), t.role("production"), t.role("alloys"), literal)


# ---- oracles ----------------------------------------------------------------

MONTH = "CAST(date_trunc('month', {}) AS DATE)"
PROD_ROWS = duckdb_with("production", "plants", "alloys") + f""",
prod_rows AS (
  SELECT pl.plant_name, pl.state, al.alloy_name, {MONTH.format('f.date')} AS month, f.*
  FROM production f LEFT JOIN plants pl ON f.plant_id = pl.plant_id
  LEFT JOIN alloys al ON f.alloy_id = al.alloy_id)"""
SALES_ROWS = duckdb_with("sales", "alloys") + f""",
sales_rows AS (
  SELECT {MONTH.format('s.date')} AS month, al.alloy_name, s.*
  FROM sales s LEFT JOIN alloys al ON s.alloy_id = al.alloy_id)"""
# corrected source: aggregate each side per (month, alloy id), then join
MARGIN_ROWS = duckdb_with("sales", "production", "alloys") + f""",
s AS (SELECT {MONTH.format('s.date')} AS month, s.alloy_id, al.alloy_name,
             sum(revenue_brl) AS rev, sum(tons_sold) AS ts
      FROM sales s JOIN alloys al ON s.alloy_id = al.alloy_id GROUP BY 1, 2, 3),
p AS (SELECT {MONTH.format('date')} AS month, alloy_id, sum(energy_kwh) AS kwh, sum(tons_produced) AS tp
      FROM production GROUP BY 1, 2),
margin_src AS (
  SELECT s.month, s.alloy_name, sum(rev) AS revenue_brl, sum(ts) AS tons_sold,
         sum(kwh) / 1000 * 320 AS energy_cost_brl, sum(tp) AS tons_produced
  FROM s LEFT JOIN p ON s.month = p.month AND s.alloy_id = p.alloy_id GROUP BY 1, 2)"""
# literal source: the row-level many-to-many join of the original definition
MARGIN_LITERAL_ROWS = duckdb_with("sales", "production", "alloys") + f""",
margin_src AS (
  SELECT {MONTH.format('s.date')} AS month, li.alloy_name,
         sum(s.revenue_brl) AS revenue_brl, sum(s.tons_sold) AS tons_sold,
         sum(p.energy_kwh) / 1000 * 320 AS energy_cost_brl, sum(p.tons_produced) AS tons_produced
  FROM sales s JOIN alloys li ON s.alloy_id = li.alloy_id
  LEFT JOIN production p ON p.alloy_id = s.alloy_id
   AND date_trunc('month', p.date) = date_trunc('month', s.date)
  GROUP BY 1, 2)"""

P_SQL = "sum(revenue_brl) / NULLIF(sum(tons_sold), 0)"
C_SQL = "sum(energy_cost_brl) / NULLIF(sum(tons_produced), 0)"


def _margin_measures(d=4):
    return (f"{r(P_SQL, d)} AS price_brl_ton, {r(C_SQL, d)} AS cost_brl_ton, "
            f"{r(f'({P_SQL}) - ({C_SQL})', d)} AS margin_brl_ton, "
            f"{r(f'(({P_SQL}) - ({C_SQL})) / NULLIF({P_SQL}, 0) * 100', d)} AS margin_pct")


MARGIN_MEASURES = ["price_brl_ton", "cost_brl_ton", "margin_brl_ton", "margin_pct"]


@register("metric_production_plant", ("MET0", "MET1", "JN7", "DSH3", "DSH6", "TRAP3", "TRAP4"), PROD_ROWS + f"""
SELECT plant_name, {r('sum(tons_produced)', 4)} AS total_tons,
       {r('(sum(energy_kwh) / 1000 * 320) / NULLIF(sum(tons_produced), 0)', 4)} AS energy_cost_per_ton,
       {r('(1 - sum(defects) / NULLIF(sum(tons_produced), 0)) * 100', 4)} AS oee_quality_pct
FROM prod_rows GROUP BY plant_name""")
def q_metric_production_plant(t):
    return _prod(t).query(["plant_name"], ["total_tons", "energy_cost_per_ton", "oee_quality_pct"], digits=4)


@register("metric_production_plant_month", ("MET1", "QRY2"), PROD_ROWS + f"""
SELECT month, plant_name, {r('(sum(energy_kwh) / 1000 * 320) / NULLIF(sum(tons_produced), 0)', 4)} AS energy_cost_per_ton,
       {r('sum(energy_kwh)', 4)} AS total_energy_kwh, {r('sum(energy_kwh) / 1000 * 320', 4)} AS energy_cost_brl,
       CAST(sum(defects) AS BIGINT) AS total_defects
FROM prod_rows GROUP BY month, plant_name""")
def q_metric_production_plant_month(t):
    return _prod(t).query(["month", "plant_name"], ["energy_cost_per_ton", "total_energy_kwh",
                                                    "energy_cost_brl", "total_defects"], digits=4)


@register("metric_production_alloy_state", ("MET1",), PROD_ROWS + f"""
SELECT alloy_name, state, {r('sum(tons_produced)', 4)} AS total_tons,
       {r('(1 - sum(defects) / NULLIF(sum(tons_produced), 0)) * 100', 4)} AS oee_quality_pct
FROM prod_rows GROUP BY alloy_name, state""")
def q_metric_production_alloy_state(t):
    return _prod(t).query(["alloy_name", "state"], ["total_tons", "oee_quality_pct"], digits=4)


@register("metric_sales_market", ("MET2", "DSH4", "DSH6"), SALES_ROWS + f"""
SELECT market, {r('sum(tons_sold)', 4)} AS total_tons_sold, {r('sum(revenue_brl)', 4)} AS revenue_brl,
       {r('sum(revenue_brl) / NULLIF(sum(tons_sold), 0)', 4)} AS avg_price_brl_ton,
       {r('avg(lme_price_usd_ton)', 4)} AS avg_lme_usd_ton, {r('avg(usd_brl)', 4)} AS avg_usd_brl
FROM sales_rows GROUP BY market""")
def q_metric_sales_market(t):
    return _sales(t).query(["market"], ["total_tons_sold", "revenue_brl", "avg_price_brl_ton",
                                        "avg_lme_usd_ton", "avg_usd_brl"], digits=4)


@register("metric_sales_ticket_region", ("MET5",), SALES_ROWS + f"""
SELECT region, customer_segment, {r('sum(revenue_brl) / NULLIF(count(*), 0)', 4)} AS avg_ticket_brl
FROM sales_rows GROUP BY region, customer_segment""")
def q_metric_sales_ticket_region(t):
    return _sales(t).query(["region", "customer_segment"], ["avg_ticket_brl"], digits=4)


@register("metric_margin_month", ("MET3", "JN8", "DSH1", "DSH6", "TRAP1", "TRAP2"),
          MARGIN_ROWS + f"\nSELECT month, {_margin_measures()} FROM margin_src GROUP BY month")
def q_metric_margin_month(t):
    return _margin(t).query(["month"], MARGIN_MEASURES, digits=4)


@register("metric_margin_alloy", ("MET3", "DSH5"),
          MARGIN_ROWS + f"\nSELECT alloy_name, {_margin_measures()} FROM margin_src GROUP BY alloy_name")
def q_metric_margin_alloy(t):
    return _margin(t).query(["alloy_name"], MARGIN_MEASURES, digits=4)


@register("metric_margin_month_literal", ("MET3", "JN8", "TRAP1"),
          MARGIN_LITERAL_ROWS + f"\nSELECT month, {_margin_measures()} FROM margin_src GROUP BY month")
def q_metric_margin_month_literal(t):
    """The original many-to-many definition, computed from per-key aggregates."""
    return _margin(t, literal=True).query(["month"], MARGIN_MEASURES, digits=4)


@register("metric_margin_latest", ("DSH2", "FLT6", "TRAP2"), MARGIN_ROWS + f"""
SELECT {r(f'({P_SQL}) - ({C_SQL})', 4)} AS margin_brl_ton,
       {r(f'(({P_SQL}) - ({C_SQL})) / NULLIF({P_SQL}, 0) * 100', 4)} AS margin_pct
FROM margin_src WHERE month = (SELECT max(month) FROM margin_src)""")
def q_metric_margin_latest(t):
    """KPI of the latest month of the view."""
    return _margin(t).query(["month"], ["margin_brl_ton", "margin_pct"], digits=4,
                            order_by=[F.desc("month")], limit=1).drop("month")


@register("metric_margin_latest_complete", ("DSH2", "TRAP2"), MARGIN_ROWS + f"""
SELECT {r(f'({P_SQL}) - ({C_SQL})', 4)} AS margin_brl_ton
FROM margin_src WHERE month = (SELECT max(month) FROM margin_src WHERE tons_produced IS NOT NULL)""")
def q_metric_margin_latest_complete(t):
    """Latest month that has both sales and production."""
    return _margin(t).query(["month"], ["margin_brl_ton"], where="tons_produced IS NOT NULL", digits=4,
                            order_by=[F.desc("month")], limit=1).drop("month")


@register("metric_margin_12m", ("QRY1", "FLT7", "FN4", "TRAP10"), MARGIN_ROWS + f"""
SELECT alloy_name, {r(f'({P_SQL}) - ({C_SQL})', 4)} AS margin_brl_ton
FROM margin_src
WHERE month >= CAST(date_trunc('month', (SELECT max(date) FROM sales) - INTERVAL 12 MONTH) AS DATE)
GROUP BY alloy_name""")
def q_metric_margin_12m(t):
    """Trailing 12 months relative to the last sales date."""
    return margin_since(t.role("sales"), t.role("production"), t.role("alloys"))


def margin_since(sales: DataFrame, production: DataFrame, alloys: DataFrame, as_of=None, months: int = 12) -> DataFrame:
    """Margin per alloy from ``months`` months before ``as_of``'s month on
    (default: the last sale).  Both facts are cut by date before they are
    aggregated, as a month is in the period exactly if its days are."""
    first = month_begin(as_of or last_day(sales), months)
    view = margin_view(between(sales, first), between(production, first), alloys)
    return view.query(["alloy_name"], ["margin_brl_ton"], digits=4)


@register("metric_sales_ytd", ("QRY3", "FLT8", "FLT9"), SALES_ROWS + f"""
SELECT market, {r('sum(tons_sold)', 4)} AS total_tons_sold, {r('sum(revenue_brl)', 4)} AS revenue_brl
FROM sales_rows
WHERE month >= CAST(date_trunc('year', (SELECT max(date) FROM sales)) AS DATE)
  AND alloy_name IN ('ECONOMY', 'MEDIUM-LARGE', 'PROMO', 'SMALL')
GROUP BY market""")
def q_metric_sales_ytd(t):
    """Year to date per market, with a multi-select alloy filter."""
    sales = t.role("sales")
    this_year = between(sales, last_day(sales).replace(month=1, day=1))
    return sales_view(this_year, t.role("alloys")).query(
        ["market"], ["total_tons_sold", "revenue_brl"], digits=4,
        where=F.col("alloy_name").isin("ECONOMY", "MEDIUM-LARGE", "PROMO", "SMALL"))


@register("dashboard_sales", ("FLT9",), SALES_ROWS + f"""
SELECT month, region, {r('sum(revenue_brl)', 4)} AS revenue_brl, {r('sum(tons_sold)', 4)} AS total_tons_sold
FROM sales_rows WHERE date BETWEEN DATE '1995-03-01' AND DATE '1995-08-31' AND market = 'Externo'
GROUP BY month, region""")
def q_dashboard_sales(t):
    """Sales by month and region under the dashboard's two filters, a date
    range and a market; the range reaches the scan, no dimension is joined."""
    import datetime as dt

    sales = between(t.role("sales"), dt.date(1995, 3, 1), dt.date(1995, 8, 31))
    return sales_view(sales, t.role("alloys")).query(
        ["month", "region"], ["revenue_brl", "total_tons_sold"], where="market = 'Externo'", digits=4,
        order_by=["month", "region"])


@register("quotes_12m", ("QRY4", "FLT7"), duckdb_with("lme", "fx") + f""",
q AS (SELECT {MONTH.format('l.date')} AS month, l.lme_price_usd_ton, x.usd_brl FROM lme l JOIN fx x ON l.date = x.date
      WHERE l.date >= CAST(date_trunc('month', (SELECT max(date) FROM lme) - INTERVAL 12 MONTH) AS DATE))
SELECT month, {r('avg(lme_price_usd_ton)', 4)} AS avg_lme_usd_ton, {r('avg(usd_brl)', 4)} AS avg_usd_brl
FROM q GROUP BY month""")
def q_quotes_12m(t):
    """Metal price and exchange rate over the trailing 12 months, by month."""
    lme = t.role("lme")
    quotes = between(lme, month_begin(last_day(lme), 12)).join(t.role("fx"), "date")
    view = MetricView(quotes, {"month": "trunc(source.date, 'MM')"},
                      {"avg_lme_usd_ton": "AVG(lme_price_usd_ton)", "avg_usd_brl": "AVG(usd_brl)"})
    return view.query(["month"], ["avg_lme_usd_ton", "avg_usd_brl"], digits=4, order_by=["month"])


@register("margin_against_cost", ("QRY4",), MARGIN_ROWS + f""",
m AS (SELECT month, {C_SQL} AS cost, ({P_SQL}) - ({C_SQL}) AS margin FROM margin_src GROUP BY month)
SELECT month, {r('margin', 4)} AS margin_brl_ton, {r('cost', 4)} AS cost_brl_ton,
       {r('margin - lag(margin) OVER (ORDER BY month)', 4)} AS margin_change,
       {r('cost - lag(cost) OVER (ORDER BY month)', 4)} AS cost_change
FROM m""")
def q_margin_against_cost(t):
    """Month-on-month movement of the margin next to that of the cost."""
    months = _margin(t).query(["month"], ["margin_brl_ton", "cost_brl_ton"])
    by_month = Window.orderBy("month")  # one row per month
    change = {f"{m}_change": F.col(f"{m}_brl_ton") - F.lag(f"{m}_brl_ton").over(by_month) for m in ("margin", "cost")}
    moved = months.withColumns(change)
    return moved.select("month", *(round_half_up(c, 4).alias(c) for c in moved.columns if c != "month"))


@register("metric_quality", ("MET4", "QRY4"), duckdb_with("inspections") + f"""
SELECT defect_type, {MONTH.format('date')} AS month, {r('avg(is_defect) * 100', 4)} AS defect_rate_pct,
       {r('avg(surface_quality_score)', 4)} AS avg_surface_quality, count(*) AS inspections
FROM inspections GROUP BY 1, 2""")
def q_metric_quality(t):
    return quality_view(t.role("inspections")).query(
        ["defect_type", "month"], ["defect_rate_pct", "avg_surface_quality", "inspections"], digits=4)


# ---- the same from stored states ---------------------------------------------

#: Fact roles, their grains and the values that measures take from them.
STATES = {
    "production": ([Grain("by_day", ("plant_id", "alloy_id")), Grain("plant_month", ("plant_id",), "month"),
                    Grain("alloy_month", ("alloy_id",), "month"), Grain("month", ("plant_id", "alloy_id"), "month")],
                   ["tons_produced", "energy_kwh", "defects"]),
    "sales": ([Grain("by_day", ("alloy_id", "market", "region", "customer_segment")), Grain("alloy_month", ("alloy_id",), "month"),
               Grain("market_month", ("market", "region", "customer_segment"), "month")],
              ["tons_sold", "revenue_brl", "lme_price_usd_ton", "usd_brl"]),
    "inspections": ([Grain("by_day", ("defect_type",)), Grain("month", ("defect_type",), "month")],
                    ["is_defect", "surface_quality_score"]),
}
_KEPT: dict[tuple, MeasureStates] = {}


def states_of(t, role: str) -> MeasureStates:
    """Stored states of a fact role, kept per table set.  They are first built
    from a fact that lacks its last day and has its first day twice; the change
    feed of those two days then puts them right.

    The fact's joins run once: its rows, in the columns that the states need,
    are stored, as the five passes over them would each join anew."""
    if (id(t), role) not in _KEPT:
        grains, values = STATES[role]
        states = MeasureStates(t.spark, scratch_dir(t.spark, f"states-{role}"), grains, values)
        with bounded_broadcasts(t.spark):
            fact = materialize(t.role(role).select("date", *grains[0].keys, *values), f"fact-{role}")
        first, last = fact.agg(F.to_date(F.min("date")), F.to_date(F.max("date"))).first()
        wrong = fact.where(F.to_date("date") != F.lit(last)).unionAll(fact.where(F.to_date("date") == F.lit(first)))
        states.refresh(wrong)
        states.refresh_from(fact, fact.where(F.to_date("date").isin(first, last)))
        _KEPT[id(t), role] = states
    return _KEPT[id(t), role]


def _from_states(t, view: MetricView, role: str, dimensions: list[str], measures: list[str]) -> DataFrame:
    return view.over(states_of(t, role), dimensions, measures).query(dimensions, measures, digits=4)


def _margin_from_states(t, literal: bool = False) -> MetricView:
    sides = [states_of(t, role).as_fact(["alloy_id"]) for role in ("sales", "production")]
    return margin_view(*sides, t.role("alloys"), literal)


_ANSWERS = {
    "production_plant": (_prod, "production", ["plant_name"], ["total_tons", "energy_cost_per_ton", "oee_quality_pct"]),
    "production_plant_month": (_prod, "production", ["month", "plant_name"], ["energy_cost_per_ton", "total_energy_kwh", "energy_cost_brl", "total_defects"]),
    "production_alloy_state": (_prod, "production", ["alloy_name", "state"], ["total_tons", "oee_quality_pct"]),
    "sales_market": (_sales, "sales", ["market"], ["total_tons_sold", "revenue_brl", "avg_price_brl_ton", "avg_lme_usd_ton", "avg_usd_brl"]),
    "sales_ticket_region": (_sales, "sales", ["region", "customer_segment"], ["avg_ticket_brl"]),
    "quality": (lambda t: quality_view(t.role("inspections")), "inspections", ["defect_type", "month"],
                ["defect_rate_pct", "avg_surface_quality", "inspections"]),
}


def _register_states():
    for name, (view, role, dimensions, measures) in _ANSWERS.items():
        def q_states(t, view=view, role=role, dimensions=dimensions, measures=measures):
            return _from_states(t, view(t), role, dimensions, measures)

        q_states.__doc__ = f"``metric_{name}`` answered from stored states."
        register(f"states_{name}", ("MET0", "STR5"), ORACLES[f"metric_{name}"])(q_states)


_register_states()


@register("states_margin_month", ("MET0", "STR5"), ORACLES["metric_margin_month"])
def q_states_margin_month(t):
    return _margin_from_states(t).query(["month"], MARGIN_MEASURES, digits=4)


@register("states_margin_alloy", ("MET0", "STR5"), ORACLES["metric_margin_alloy"])
def q_states_margin_alloy(t):
    return _margin_from_states(t).query(["alloy_name"], MARGIN_MEASURES, digits=4)


@register("states_margin_month_literal", ("MET0", "STR5"), ORACLES["metric_margin_month_literal"])
def q_states_margin_month_literal(t):
    """Row-weighted products from the stored row counts."""
    return _margin_from_states(t, literal=True).query(["month"], MARGIN_MEASURES, digits=4)


@register("states_sales_ytd", ("MET0", "STR5"), ORACLES["metric_sales_ytd"])
def q_states_sales_ytd(t):
    """Year to date per market for some alloys: the finest states, as no
    smaller grain has both markets and alloys."""
    states = states_of(t, "sales")
    facts = states.as_fact(["alloy_id", "market"])
    this_year = between(facts, last_day(facts).replace(month=1, day=1))
    return sales_view(this_year, t.role("alloys")).query(
        ["market"], ["total_tons_sold", "revenue_brl"], digits=4,
        where=F.col("alloy_name").isin("ECONOMY", "MEDIUM-LARGE", "PROMO", "SMALL"))


@register("states_margin_12m", ("MET0", "STR5"), ORACLES["metric_margin_12m"])
def q_states_margin_12m(t):
    sides = [states_of(t, role).as_fact(["alloy_id"]) for role in ("sales", "production")]
    return margin_since(*sides, t.role("alloys"))
