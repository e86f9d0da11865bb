"""Versioned silver table: history, read as of a version, update, restore,
row changes between versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from smelter.operators.snapshots import SnapshotTable, changes
from smelter.plans.medallion import SILVER_SQL, silver
from smelter.plans.registry import register
from smelter.session import scratch_dir


def versioned_silver(t) -> SnapshotTable:
    """v0 = cleaned silver; v1 = imputation flags cleared; v2 = restore of v0."""
    table = SnapshotTable(t.spark, scratch_dir(t.spark, "silver_versions"))
    table.write(silver(t))
    table.update("vibration_imputed", F.lit(False), F.col("vibration_imputed"))
    table.restore(0)
    return table


@register("snapshot_history", ("VER1", "VER2", "VER4", "VER5", "AGG17"), SILVER_SQL + """
SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, count(*) AS rows FROM silver
UNION ALL SELECT 1, 'UPDATE vibration_imputed', count(*) FROM silver
UNION ALL SELECT 2, 'RESTORE 0', count(*) FROM silver""")
def q_snapshot_history(t):
    return versioned_silver(t).history().select("version", "operation", "rows")


@register("snapshot_as_of", ("VER3", "SRC11", "FLT5"), SILVER_SQL + """
SELECT count(*) FILTER (WHERE vibration_imputed) AS imputed_v0,
       CAST(0 AS BIGINT) AS imputed_v1,
       count(*) FILTER (WHERE vibration_imputed) AS imputed_current
FROM silver""")
def q_snapshot_as_of(t):
    """Imputed-row counts read as of versions 0 and 1 and at the current version."""
    table = versioned_silver(t)
    tags = ((0, "imputed_v0"), (1, "imputed_v1"), (None, "imputed_current"))
    tagged = None
    for v, name in tags:
        part = table.read(v).select(F.lit(name).alias("_v"), "vibration_imputed")
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.agg(*[F.count_if((F.col("_v") == name) & F.col("vibration_imputed")).alias(name)
                        for _, name in tags])


@register("snapshot_changes", ("VER6",), SILVER_SQL + """
SELECT furnace_id, ts, 'update' AS change_type FROM silver WHERE vibration_imputed""")
def q_snapshot_changes(t):
    """Rows that changed between version 0 and version 1 (the update)."""
    table = versioned_silver(t)
    return changes(table.read(0), table.read(1), ["furnace_id", "ts"])


@register("snapshot_restore", ("VER5",), SILVER_SQL + "\nSELECT * FROM silver")
def q_snapshot_restore(t):
    """The current (restored) version equals version 0."""
    return versioned_silver(t).read()
