"""Business rollups over production and sales facts.

All are hash aggregates with map-side partial aggregation; dimension sides
are broadcast only behind a bounded count.  Shares of a total use a scalar
subquery for the total rather than an un-partitioned window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smelter.functions.columns import month_start, round_half_up, safe_ratio, with_scalars
from smelter.operators.sizing import broadcast_if_small

ENERGY_PRICE_BRL_PER_MWH = 320.0  # fixed reference tariff


def energy_cost(kwh_col) -> F.Column:
    return kwh_col / 1000 * ENERGY_PRICE_BRL_PER_MWH


def production_by_plant(production: DataFrame, plants: DataFrame) -> DataFrame:
    return (production.join(broadcast_if_small(plants), "plant_id", "inner")
            .groupBy("plant_name", "state")
            .agg(round_half_up(F.sum("tons_produced"), 1).alias("total_tons"))
            .orderBy(F.desc("total_tons"), "plant_name"))


def production_by_month(production: DataFrame) -> DataFrame:
    return (production.groupBy(month_start("date").alias("month"))
            .agg(round_half_up(F.sum("tons_produced"), 1).alias("total_tons"))
            .orderBy("month"))


def energy_cost_by_plant(production: DataFrame, plants: DataFrame) -> DataFrame:
    joined = production.join(broadcast_if_small(plants), "plant_id", "inner")
    agg = joined.groupBy("plant_name").agg(
        F.sum("energy_kwh").alias("_kwh"), F.sum("tons_produced").alias("_tons"))
    return agg.select(
        "plant_name",
        round_half_up(energy_cost(F.col("_kwh")), 0).alias("energy_cost_brl"),
        round_half_up(F.col("_tons"), 1).alias("total_tons"),
        round_half_up(safe_ratio(energy_cost(F.col("_kwh")), F.col("_tons")), 2).alias("cost_per_ton"),
    ).orderBy(F.desc("cost_per_ton"), "plant_name")


def cost_vs_mean(production: DataFrame, plants: DataFrame) -> DataFrame:
    """Each plant's energy cost per ton against the mean over plants (percent
    above/below).  The fleet mean is a scalar subquery."""
    joined = production.join(broadcast_if_small(plants), "plant_id", "inner")
    per_plant = joined.groupBy("plant_name").agg(
        safe_ratio(energy_cost(F.sum("energy_kwh")), F.sum("tons_produced")).alias("_cpt"))
    mean = F.col("_mean")
    return with_scalars(per_plant, _mean=per_plant.agg(F.avg("_cpt")).scalar()).select(
        "plant_name",
        round_half_up(F.col("_cpt"), 2).alias("cost_per_ton"),
        round_half_up(mean, 2).alias("mean_cost_per_ton"),
        round_half_up((F.try_divide(F.col("_cpt"), mean) - 1) * 100, 2).alias("pct_vs_mean"),
    )


def sales_by_market(sales: DataFrame) -> DataFrame:
    return (sales.groupBy("market").agg(
        round_half_up(F.sum("tons_sold"), 1).alias("total_tons_sold"),
        round_half_up(F.sum("revenue_brl"), 0).alias("revenue_brl"),
        round_half_up(safe_ratio(F.sum("revenue_brl"), F.sum("tons_sold")), 2).alias("revenue_per_ton"))
        .orderBy(F.desc("revenue_brl"), "market"))


def external_by_region(sales: DataFrame, market: str = "Externo") -> DataFrame:
    return (sales.filter(F.col("market") == market).groupBy("region").agg(
        round_half_up(F.sum("revenue_brl"), 2).alias("revenue_brl"),
        round_half_up(F.sum("tons_sold"), 1).alias("total_tons_sold"))
        .orderBy(F.desc("revenue_brl"), "region"))


def price_fx_by_month(sales: DataFrame) -> DataFrame:
    """Monthly mean LME, mean FX and mean of the product (not product of means)."""
    return (sales.groupBy(month_start("date").alias("month")).agg(
        round_half_up(F.avg("lme_price_usd_ton"), 2).alias("avg_lme_usd_ton"),
        round_half_up(F.avg("usd_brl"), 4).alias("avg_usd_brl"),
        round_half_up(F.avg(F.col("lme_price_usd_ton") * F.col("usd_brl")), 2).alias("avg_price_brl_ton"))
        .orderBy("month"))


def quarter_change(sales: DataFrame) -> DataFrame:
    """Quarterly revenue and the change versus the previous quarter.  The
    window runs over the (small, one row per quarter) aggregate."""
    q = sales.groupBy(F.trunc("date", "quarter").alias("quarter")).agg(
        F.sum("revenue_brl").alias("_rev"))
    w = Window.orderBy("quarter")
    prev = F.lag("_rev").over(w)
    return q.select(
        "quarter",
        round_half_up(F.col("_rev"), 2).alias("revenue_brl"),
        round_half_up(prev, 2).alias("prev_revenue_brl"),
        round_half_up(F.col("_rev") - prev, 2).alias("delta_brl"),
        round_half_up(safe_ratio(F.col("_rev") - prev, prev) * 100, 2).alias("delta_pct"),
    )


def monthly_margin(sales: DataFrame, production: DataFrame) -> DataFrame:
    """Monthly price per ton (sales) against monthly energy cost per ton
    (production), each aggregated first and joined on month."""
    price = sales.groupBy(month_start("date").alias("month")).agg(
        safe_ratio(F.sum("revenue_brl"), F.sum("tons_sold")).alias("_price"))
    cost = production.groupBy(month_start("date").alias("month")).agg(
        safe_ratio(energy_cost(F.sum("energy_kwh")), F.sum("tons_produced")).alias("_cost"))
    j = price.join(cost, "month", "left")
    return j.select(
        "month",
        round_half_up(F.col("_price"), 2).alias("price_brl_ton"),
        round_half_up(F.col("_cost"), 2).alias("cost_brl_ton"),
        round_half_up(F.col("_price") - F.col("_cost"), 2).alias("margin_brl_ton"),
    ).orderBy("month")


def defect_by_alloy(inspections: DataFrame, alloys: DataFrame) -> DataFrame:
    joined = inspections.join(broadcast_if_small(alloys), "alloy_id", "left")
    return (joined.groupBy("alloy_name").agg(
        F.count(F.lit(1)).alias("inspections"),
        round_half_up(F.avg("is_defect") * 100, 2).alias("defect_rate_pct"))
        .orderBy(F.desc("defect_rate_pct"), "alloy_name"))


def category_shares(df: DataFrame, column: str) -> DataFrame:
    """Count per category, percent of total and cumulative percent (Pareto).

    The total is a scalar subquery; the cumulative sum runs over the grouped
    result (one row per category).
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    counts = with_scalars(counts, _total=counts.agg(F.sum("n")).scalar())
    total = F.col("_total")
    w = Window.orderBy(F.desc("n"), F.col(column)).rowsBetween(Window.unboundedPreceding, 0)
    return counts.select(
        column, "n",
        round_half_up(F.col("n") / total * 100, 2).alias("pct"),
        round_half_up(F.sum("n").over(w) / total * 100, 2).alias("cumulative_pct"),
    )


def label_balance(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    counts = with_scalars(counts, _total=counts.agg(F.sum("n")).scalar())
    return counts.select(label, "n", round_half_up(F.col("n") / F.col("_total") * 100, 2).alias("pct"))


def running_total(df: DataFrame, date_col: str, value: str) -> DataFrame:
    """Daily sum and its running total over dates (window over the daily
    aggregate: one row per day)."""
    daily = df.groupBy(F.col(date_col).alias("date")).agg(F.sum(value).alias("_v"))
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("date", round_half_up(F.col("_v"), 2).alias("daily_total"),
                        round_half_up(F.sum("_v").over(w), 2).alias("running_total"))


def failure_summary(telemetry: DataFrame) -> DataFrame:
    return telemetry.agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if(F.col("is_failure") == 1).alias("failures"),
        round_half_up(F.avg("vibration_mm_s"), 4).alias("avg_vibration_mm_s"),
        F.count_if(F.col("vibration_mm_s").isNull()).alias("null_vibration"),
        F.count_if(F.col("energy_kwh_ton") < 0).alias("negative_energy"),
    )
