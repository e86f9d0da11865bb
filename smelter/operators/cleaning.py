"""Silver-layer cleaning: typing, imputation with audit flag, sanity range,
deterministic deduplication.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.columns import nan_to_null
from smelter.operators.selection import exact_quantiles
from smelter.operators.sizing import broadcast_if_small
from smelter.session import materialize

# Declared telemetry schema (column -> Spark SQL type).
TELEMETRY_TYPES: dict[str, str] = {
    "furnace_id": "int",
    "ts": "timestamp",
    "temperature_c": "double",
    "amperage_ka": "double",
    "bath_ratio": "double",
    "anode_effect": "int",
    "alumina_feed_rate": "double",
    "energy_kwh_ton": "double",
    "pressure_pa": "double",
    "vibration_mm_s": "double",
    "is_failure": "int",
}

# The lighter typing of the declarative silver dataset (7 columns, no imputation).
PIPELINE_TYPES: dict[str, str] = {
    "furnace_id": "int",
    "ts": "timestamp",
    "temperature_c": "double",
    "energy_kwh_ton": "double",
    "vibration_mm_s": "double",
    "anode_effect": "int",
    "is_failure": "int",
}

TEMPERATURE_RANGE = (800, 1100)


def typed(df: DataFrame, types: dict[str, str] = TELEMETRY_TYPES) -> DataFrame:
    """Cast the declared columns with ``try_cast`` (bad text -> NULL, never an
    ANSI error); other columns pass through in place."""
    out = []
    for name in df.columns:
        if name in types:
            c = F.col(name).try_cast(types[name])
            if types[name] == "double":
                c = nan_to_null(c)  # "NaN" text or NaN doubles mean missing
            out.append(c.alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def group_median(df: DataFrame, value: str, group: str, alias: str = "group_median") -> DataFrame:
    """Per-group median (``percentile_approx`` 0.5).  Partial aggregation
    merges digests map-side, so a group holding a third of all rows is
    pre-aggregated before the shuffle."""
    return df.groupBy(group).agg(F.percentile_approx(value, 0.5).alias(alias))


def exact_group_median(df: DataFrame, value: str, group: str, alias: str = "group_median") -> DataFrame:
    """Per-group median, the exact lower one, whatever the group's size."""
    found = exact_quantiles(df, value, group)
    return found.select(F.col("group").alias(group), F.col("value").alias(alias))


def impute_group_median(df: DataFrame, value: str, group: str, flag: str,
                        global_fallback: bool = False, exact: bool = False) -> DataFrame:
    """Flag NULLs, then fill them with the group's median.

    The flag is taken before filling; the median is computed over all rows of
    the input (before any later filter).  A group with only NULLs stays NULL
    unless ``global_fallback`` adds the median of all rows as a last resort
    (a scalar subquery, no join).

    The medians, one row per group, are computed and stored right away: their
    size is then known, and while it is small the rows are filled where they
    are.  Joining them as part of one plan would first shuffle every raw row
    by the group, most of them to a few hot ones.

    ``exact`` takes exact medians; the sketch of the default is exact too up
    to some ten thousand distinct values in a group.
    """
    median = exact_group_median if exact else group_median
    medians = broadcast_if_small(materialize(median(df, value, group, "_median"), "medians"))
    fill: list[Column] = [F.col(value), F.col("_median")]
    if global_fallback:
        fill.append(df.agg(F.percentile_approx(value, 0.5)).scalar())
    joined = df.withColumn(flag, F.col(value).isNull()).join(medians, group, "left")
    cols = [F.coalesce(*fill).alias(value) if c == value else F.col(c) for c in df.columns]
    return joined.select(*cols, F.col(flag))


def in_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Closed-range sanity filter; NULL fails."""
    return df.filter(F.col(column).between(low, high))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple.

    Expressed as a ``min_by`` aggregate rather than a ``row_number`` window:
    the aggregate combines map-side (a partial aggregate per input
    partition), so a hot key reaches the shuffle as one row per partition
    instead of landing whole in one sorting task.  The struct buffer makes
    Spark pick a sort-based aggregate; the map-side combine is the same.
    """
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), ordering).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c)
                           for c in df.columns])


def clean_telemetry(raw: DataFrame, order: Sequence[str] = ("reading_seq",),
                    global_fallback: bool = False, exact: bool = False) -> DataFrame:
    """Typed -> flag + per-furnace median fill -> temperature range -> dedup.

    The order matters and is kept: the median sees rows the range filter and
    dedup later remove.
    """
    df = typed(raw)
    df = impute_group_median(df, "vibration_mm_s", "furnace_id", "vibration_imputed",
                             global_fallback=global_fallback, exact=exact)
    df = in_range(df, "temperature_c", *TEMPERATURE_RANGE)
    return keep_first(df, ["furnace_id", "ts"], list(order))


def imputation_audit(silver: DataFrame) -> DataFrame:
    """Rows, imputed rows and NULLs left, in one pass."""
    return silver.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("vibration_imputed")).alias("imputed"),
        F.count_if(F.col("vibration_mm_s").isNull()).alias("nulls_left"),
    )
