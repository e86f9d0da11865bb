"""Feature tables for the energy regression and the defect classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.functions.columns import hash_bucket, reading_key
from smelter.operators.joins import key_profile, sliding_means

ENERGY_FEATURES = ["temperature_c", "amperage_ka", "anode_effect", "bath_ratio", "alumina_feed_rate"]
ENERGY_TARGET = "energy_kwh_ton"
STATE_COLUMNS = ["temperature_c", "amperage_ka", "anode_effect", "vibration_mm_s"]


def regression_set(telemetry: DataFrame) -> DataFrame:
    """Key, furnace, time, five features and the target; rows with a NULL in
    any of them are dropped."""
    return (telemetry.select(reading_key().alias("reading_id"), "furnace_id", "ts",
                             *ENERGY_FEATURES, ENERGY_TARGET)
            .na.drop(subset=ENERGY_FEATURES + [ENERGY_TARGET]))


def with_temperature_deviation(df: DataFrame, setpoint: float = 960.0) -> DataFrame:
    return df.withColumn("temperature_deviation", F.abs(F.col("temperature_c") - setpoint))


def key_check(features: DataFrame, key: str = "reading_id") -> DataFrame:
    """Primary-key contract of a feature table: unique and non-null."""
    return key_profile(features, key, "energy_features")


def split_label(key_col: str = "reading_id", train_percent: int = 80):
    """'train' / 'test' from a hash of the key: stable under any partitioning,
    retry or engine (unlike ``randomSplit``)."""
    return F.when(hash_bucket(key_col) < train_percent, F.lit("train")).otherwise(F.lit("test"))


def hash_split(df: DataFrame, key_col: str = "reading_id", train_percent: int = 80) -> DataFrame:
    return df.withColumn("split", split_label(key_col, train_percent))


def furnace_state_means(telemetry: DataFrame) -> DataFrame:
    """All-time mean operating state per furnace."""
    return telemetry.groupBy("furnace_id").agg(
        *[F.avg(c).alias(f"avg_{c}") for c in STATE_COLUMNS])


def defect_dataset(inspections: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Inspections enriched with their furnace's mean operating state (left
    join: a furnace without readings keeps NULL features)."""
    return inspections.join(furnace_state_means(telemetry), "furnace_id", "left")


def defect_recent_state(inspections: DataFrame, telemetry: DataFrame, lookback_hours: int = 24) -> DataFrame:
    """Inspections enriched with the furnace state in the ``lookback_hours``
    before the inspection (point in time: no reading after it leaks in)."""
    events = inspections.select("inspection_id", "furnace_id",
                                F.col("date").cast("timestamp").alias("inspected_at"))
    recent = sliding_means(events, telemetry, "furnace_id", "inspected_at", "ts",
                           f"{lookback_hours} HOURS", STATE_COLUMNS, "inspection_id")
    return inspections.join(recent, "inspection_id", "left")


def model_inputs(df: DataFrame, drop: tuple[str, ...] = ("inspection_id", "furnace_id")) -> DataFrame:
    """Identifiers are not features."""
    return df.drop(*drop)
