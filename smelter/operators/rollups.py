"""Gold-layer aggregates over cleaned telemetry and their dimension joins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.columns import round_half_up
from smelter.operators.sizing import broadcast_if_small


@dataclass(frozen=True)
class Indicator:
    """A daily indicator of readings: how it is aggregated, and rounded."""

    name: str
    reading: str
    digits: int | None = None  # None: a count or sum, kept whole

    def column(self) -> Column:
        if self.digits is None:
            return F.sum(self.reading).cast("long").alias(self.name)
        return round_half_up(F.avg(self.reading), self.digits).alias(self.name)


#: Names and precision of the published daily indicators.
INDICATORS = {i.name: i for i in (
    Indicator("anode_effects", "anode_effect"),
    Indicator("avg_energy_kwh_ton", "energy_kwh_ton", 1),
    Indicator("avg_temperature_c", "temperature_c", 2),
    Indicator("avg_vibration_mm_s", "vibration_mm_s", 3),
    Indicator("failure_rate", "is_failure", 4),
)}


def daily(silver: DataFrame, *by: str, without: tuple[str, ...] = ()) -> DataFrame:
    """All indicators but ``without`` per day and ``by``, and the readings."""
    chosen = [i.column() for name, i in INDICATORS.items() if name not in without]
    return silver.groupBy(*by, F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("readings"), *chosen)


def furnace_day(silver: DataFrame, with_vibration: bool = True) -> DataFrame:
    """Daily indicators per furnace.  The availability OEE is computed from
    the already rounded failure rate, as the source definition does."""
    days = daily(silver, "furnace_id", without=() if with_vibration else ("avg_vibration_mm_s",))
    return days.withColumn("oee_availability_pct", round_half_up((F.lit(1) - F.col("failure_rate")) * 100, 2))


#: What a furnace and its plant add to a fact row, and which indicators a
#: located furnace-day carries.
FURNACE_ATTRIBUTES, PLANT_ATTRIBUTES = ("model", "capacity_ton_day"), ("plant_name", "state")
LOCATED_INDICATORS = ("avg_energy_kwh_ton", "avg_temperature_c", "failure_rate", "oee_availability_pct")


def located(fact: DataFrame, furnaces: DataFrame, plants: DataFrame, furnace_attributes=(), plant_attributes=()) -> DataFrame:
    """``fact`` with the attributes of its furnace and the furnace's plant; a
    fact without one keeps nulls.  The two dimensions meet first, so each
    fact row is joined once."""
    of_furnace = furnaces.join(broadcast_if_small(plants.select("plant_id", *plant_attributes)), "plant_id", "left")
    place = of_furnace.select("furnace_id", "plant_id", *furnace_attributes, *plant_attributes)
    return fact.join(broadcast_if_small(place), "furnace_id", "left")


def enrich_with_location(gold: DataFrame, furnaces: DataFrame, plants: DataFrame) -> DataFrame:
    rows = located(gold.select("furnace_id", "day", *LOCATED_INDICATORS), furnaces, plants, FURNACE_ATTRIBUTES, PLANT_ATTRIBUTES)
    return rows.drop("plant_id")


def plant_ranking(enriched: DataFrame) -> DataFrame:
    """Mean of daily means per plant, highest energy first."""
    return (
        enriched.groupBy("plant_name", "state")
        .agg(round_half_up(F.avg("avg_energy_kwh_ton"), 1).alias("energy_kwh_ton"),
             round_half_up(F.avg("failure_rate") * 100, 2).alias("failure_rate_pct"))
        .orderBy(F.desc("energy_kwh_ton"), "plant_name", "state")
    )


def plant_day(silver: DataFrame, furnaces: DataFrame, plants: DataFrame) -> DataFrame:
    """Daily indicators per plant, from readings (not from furnace-day means)."""
    rows = located(silver, furnaces, plants, plant_attributes=("plant_name",))
    return daily(rows, "plant_id", "plant_name", without=("avg_vibration_mm_s",))


def worst_furnace(gold: DataFrame, k: int = 1) -> DataFrame:
    """Furnace(s) with the highest mean daily failure rate (top-k with key tie-break)."""
    return (
        gold.groupBy("furnace_id")
        .agg(round_half_up(F.avg("failure_rate"), 6).alias("mean_failure_rate"))
        .orderBy(F.desc("mean_failure_rate"), "furnace_id")
        .limit(k)
    )


def hottest_furnaces(telemetry: DataFrame, k: int = 5) -> DataFrame:
    """Mean temperature, mean energy and reading count per furnace, hottest k."""
    return (
        telemetry.groupBy("furnace_id")
        .agg(round_half_up(F.avg("temperature_c"), 2).alias("avg_temperature_c"),
             round_half_up(F.avg("energy_kwh_ton"), 1).alias("avg_energy_kwh_ton"),
             F.count(F.lit(1)).alias("readings"))
        .orderBy(F.desc("avg_temperature_c"), "furnace_id")
        .limit(k)
    )
