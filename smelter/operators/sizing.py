"""Checked broadcasts.

A side is broadcast only after its size is proven small, in rows and in bytes:
``limit(bound + 1)`` reads at most ``bound + 1`` rows, whose width is measured.
Beyond the bound the join is left to the planner (sort-merge, or AQE's runtime
broadcast when the materialised shuffle turns out small).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bounds for dimension-like sides (furnaces, plants, alloys, per-key summaries).
DIMENSION_ROW_BOUND = 200_000
DIMENSION_BYTE_BOUND = 32 << 20

# The planner goes by the size of compressed files, a fraction of what the rows take.
PLANNED_BYTE_BOUND = 1 << 20

_CHECKED: dict[tuple, bool] = {}


def _source_key(df: DataFrame) -> tuple:
    """Plan, its planned size and its files: a rewritten table has other files,
    and so another key, even under the same path."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return df.semanticHash(), str(plan.stats().sizeInBytes()), tuple(sorted(df.inputFiles()))


def is_bounded(df: DataFrame, bound: int = DIMENSION_ROW_BOUND, bytes_bound: int = DIMENSION_BYTE_BOUND) -> bool:
    """``True`` when ``df`` is within both bounds.  The answer is kept for the
    same plan over the same files, so a dimension is checked once, not once
    per query."""
    key = (*_source_key(df), bound, bytes_bound)
    if key not in _CHECKED:
        width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns), F.lit(8))
        seen = df.limit(bound + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
        _CHECKED[key] = seen[0] <= bound and seen[1] <= bytes_bound
    return _CHECKED[key]


def broadcast_if_small(df: DataFrame, bound: int = DIMENSION_ROW_BOUND) -> DataFrame:
    """Hint a broadcast only when the side is proven small.

    Meant for stored tables, where the bounded check is a cheap scan.  A side
    that is itself an aggregate of a fact table should be stored first
    (``session.materialize``), or left unhinted for AQE.
    """
    return F.broadcast(df) if is_bounded(df, bound) else df


@contextmanager
def bounded_broadcasts(spark: SparkSession, bound: int = PLANNED_BYTE_BOUND):
    """Within it, the planner's own broadcasts take sides of ``bound`` bytes at
    most, so joins with tables that grow do not pass them through the driver.
    They are shuffled instead, and hashed without a sort where every shuffled
    part is proven small.

    Meant around an action (``session.materialize``): a frame that runs later
    is planned with the session's own settings."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": bound,
                "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": DIMENSION_BYTE_BOUND}
    old = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
