"""Stored measure states: sums, counts and row counts of a fact table that can
be merged further, kept by day and at coarser grains.

The finest grain has one row per day and combination of key columns, in one
partition per month.  A refresh computes the days that a change feed names from
the fact's rows of those days; their months' other states are carried over, all
other months are left alone.  A coarser grain has
fewer keys, months for days, or both; the months that a refresh touches are
merged from the finest states, never from the fact.

``covering`` picks the stored grain with the fewest rows that has the columns
and the time unit a question needs.  Sums of sums, means as ratios of sums and
row-weighted products then give what the fact itself would.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.session import materialize



def _month(column: str):
    return F.trunc(column, "MM").cast("date")


#: Aggregates of one column that states can answer, and COUNT(1).
_CALL = re.compile(r"\b(SUM|AVG|COUNT)\(\s*(\w+)\s*\)", re.IGNORECASE)


@dataclass(frozen=True)
class Grain:
    name: str
    keys: tuple[str, ...]
    unit: str = "day"  # or "month"


class MeasureStates:
    """States of one fact table below ``root``; the first grain is the finest
    and has days."""

    def __init__(self, spark: SparkSession, root: str, grains: Sequence[Grain], values: Sequence[str], date: str = "date"):
        if grains[0].unit != "day" or any(set(g.keys) - set(grains[0].keys) for g in grains):
            raise ValueError("the first grain must have days and all keys")
        self.spark, self.root, self.date = spark, root.rstrip("/"), date
        self.grains, self.values = list(grains), list(values)
        self._sizes: dict[str, int] = {}
        self._schemas: dict = {}  # of grains written here; others are read from their files

    def _path(self, grain: Grain) -> str:
        return f"{self.root}/{grain.name}"

    def _parts(self) -> list[str]:
        return ["rows", *(f"{v}_{k}" for v in self.values for k in ("sum", "n"))]

    def _write(self, states: DataFrame, grain: Grain, periods: Sequence | None) -> None:
        self._schemas[grain.name] = states.schema
        # a period's states are few: one file each, not one from every task
        writer = states.repartition("period").write.mode("overwrite").option("partitionOverwriteMode", "static" if periods is None else "dynamic")
        writer.partitionBy("period").parquet(self._path(grain))
        if periods:  # periods that have no row any more
            left = {r.period for r in states.select("period").distinct().collect()}
            for period in set(periods) - left:
                name = "__HIVE_DEFAULT_PARTITION__" if period is None else period
                jvm = self.spark.sparkContext._jvm
                p = jvm.org.apache.hadoop.fs.Path(f"{self._path(grain)}/period={name}")
                p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        self._sizes.pop(grain.name, None)

    def _in(self, frame: DataFrame, column: str, periods: Iterable) -> DataFrame:
        some = [p for p in periods if p is not None]
        keep = F.col(column).isin(some) if some else F.lit(False)
        return frame.where(keep | F.col(column).isNull() if None in periods else keep)

    def refresh(self, fact: DataFrame, days: Sequence | None = None) -> None:
        """Compute the states of ``days`` anew (all days if not given).  Only
        these days of the fact are read; the other states of their months are
        carried over as they stand."""
        finest = self.grains[0]
        rows = fact.withColumn("day", F.to_date(self.date))
        if days is not None:
            rows = self._in(rows, "day", days)
        sums = [F.sum(v).alias(f"{v}_sum") for v in self.values]
        counts = [F.count(v).alias(f"{v}_n") for v in self.values]
        fresh = rows.groupBy("day", *finest.keys).agg(F.count(F.lit(1)).alias("rows"), *sums, *counts)
        months = None if days is None else list({None if d is None else d.replace(day=1) for d in days})
        self._replace(fresh, finest, days, months)
        for grain in self.grains[1:]:
            fine, time = self.read(finest), F.col("period")
            if grain.unit == "month":
                fine, time = self.read(finest, months), _month("period")
            elif days is not None:
                fine = self._in(fine, "period", days)
            merged = fine.groupBy(time.alias("day"), *grain.keys).agg(*(F.sum(c).alias(c) for c in self._parts()))
            self._replace(merged, grain, months if grain.unit == "month" else days, months)

    def _replace(self, fresh: DataFrame, grain: Grain, times: Sequence | None, months: Sequence | None) -> None:
        """``fresh`` for the states of ``times``, in the partitions of ``months``."""
        if times is not None:
            there = self.read(grain, months).withColumnRenamed("period", "day")
            gone = F.coalesce(F.col("day").isin([t for t in times if t is not None]), F.lit(None in times))
            fresh = fresh.unionByName(there.where(~gone))
        self._write(materialize(fresh.withColumn("period", _month("day")), "states"), grain, months)

    def refresh_from(self, fact: DataFrame, changed: DataFrame) -> list:
        """Refresh from a change feed, a frame with the fact's date column
        (old and new dates of a row that moved); the days are returned."""
        days = [r[0] for r in changed.select(F.to_date(self.date)).distinct().collect()]
        if days:
            self.refresh(fact, days)
        return days

    def read(self, grain: Grain, months: Sequence | None = None) -> DataFrame:
        """All states of a grain, or those in the partitions of ``months``."""
        reader = self.spark.read
        if grain.name in self._schemas:
            reader = reader.schema(self._schemas[grain.name])
        states = reader.parquet(self._path(grain)).withColumn("period", F.col("period").cast("date"))
        states = states if months is None else self._in(states, "period", months)
        return states.drop("period").withColumnRenamed("day", "period")

    def size(self, grain: Grain) -> int:
        """Stored rows, from the files' footers."""
        if grain.name not in self._sizes:
            self._sizes[grain.name] = self.read(grain).count()
        return self._sizes[grain.name]

    def covering(self, columns: Iterable[str], unit: str) -> Grain:
        """The smallest grain with the key ``columns`` and the time ``unit``."""
        need = set(columns)
        fits = [g for g in self.grains if need <= set(g.keys) and (unit == "month" or g.unit == "day")]
        if not fits:
            raise KeyError(f"no stored grain has {sorted(need)}")
        return min(fits, key=self.size)

    def as_fact(self, columns: Iterable[str] = (), unit: str = "month") -> DataFrame:
        """States of the covering grain in the fact's column names: each value
        is the sum of ``rows`` rows."""
        grain = self.covering(columns, unit)
        named = [F.col(f"{v}_sum").alias(v) for v in self.values]
        return self.read(grain).select(F.col("period").alias(self.date), *grain.keys, "rows", *named)


def over_states(measure: str) -> str:
    """A measure over fact rows as one over their states."""
    def call(m):
        name, column = m[1].upper(), m[2]
        if name == "COUNT":
            return "SUM(rows)" if column == "1" else f"SUM({column}_n)"
        total = f"SUM({column}_sum)"
        return total if name == "SUM" else f"({total} / NULLIF(SUM({column}_n), 0))"

    return _CALL.sub(call, measure)

