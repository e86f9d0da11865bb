"""Price x exchange rate x production cost -> margin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.columns import market_class, round_half_up

#: What identifies a production row, and its output.
PRODUCED = ("date", "plant_id", "furnace_id", "product_id", "tons_produced")


def daily_quotes(lme: DataFrame, fx: DataFrame) -> DataFrame:
    """One row per day with both quotes: the metal price in both currencies."""
    quotes = lme.join(fx, "date")
    return quotes.withColumn("price_brl_ton", round_half_up(F.col("lme_price_usd_ton") * F.col("usd_brl"), 2))


def margin_rows(production: DataFrame, lme: DataFrame, fx: DataFrame) -> DataFrame:
    """Every production row of a quoted day with price, energy cost and margin
    per ton (days without a quote drop).  Price and cost are rounded before the
    margin is taken; zero tons give a null cost, not an error.

    The quotes of a day are joined to each other first, so production, the
    large side, meets one narrow frame once."""
    cost = round_half_up(F.try_divide("energy_cost_brl", "tons_produced"), 2)
    priced = production.select(*PRODUCED, cost.alias("energy_cost_brl_ton"))
    quoted = priced.join(daily_quotes(lme, fx), "date")
    return quoted.withColumn("margin_brl_ton", round_half_up(F.col("price_brl_ton") - F.col("energy_cost_brl_ton"), 2))


def margin_by_day(margins: DataFrame) -> DataFrame:
    return (margins.groupBy("date").agg(
        round_half_up(F.avg("price_brl_ton"), 2).alias("avg_price_brl_ton"),
        round_half_up(F.avg("margin_brl_ton"), 2).alias("avg_margin_brl_ton"),
        F.max("usd_brl").alias("usd_brl"))
        .orderBy("date"))


def worst_margin_day(margins: DataFrame) -> DataFrame:
    """The day with the lowest mean margin and its exchange rate (``min_by``
    over the per-day aggregate; ties go to the earliest day)."""
    daily = margins.groupBy("date").agg(F.avg("margin_brl_ton").alias("_m"),
                                        F.max("usd_brl").alias("usd_brl"))
    ranked = F.struct(F.col("_m"), F.col("date"))
    return daily.agg(
        F.min_by("date", ranked).alias("date"),
        round_half_up(F.min("_m"), 2).alias("avg_margin_brl_ton"),
        F.min_by("usd_brl", ranked).alias("usd_brl"))


def price_sales(sales: DataFrame, lme: Column, premium: Column, fx: Column, tons: Column,
                region: Column) -> DataFrame:
    """Sale pricing: USD price with the premium over LME, BRL price, revenue,
    each rounded to 2 places from the rounded previous step; market class
    from the region."""
    price_usd = round_half_up(lme * premium, 2)
    return (sales.withColumn("price_usd_ton", price_usd)
            .withColumn("price_brl_ton", round_half_up(F.col("price_usd_ton") * fx, 2))
            .withColumn("revenue_brl", round_half_up(tons * F.col("price_brl_ton"), 2))
            .withColumn("market", market_class(region)))
