"""Access to a directory of Parquet tables and the role views over it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from smelter.sources.standins import ROLES, STANDIN_SQL, base_tables

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class TableSet:
    """Lazy, per-directory table access.

    ``table(name)`` reads ``<dir>/<name>.parquet`` (column pruning and filter
    pushdown happen when the plan runs); ``role(name)`` builds the stand-in
    view for a library role from the base tables.  Nothing is read until an
    action runs.
    """

    _shared: dict[tuple[int, str], "TableSet"] = {}

    @classmethod
    def shared(cls, spark: SparkSession, directory: str) -> "TableSet":
        """One table set per (session, directory): source frames and role
        views are resolved once and reused by every query of the session."""
        key = (id(spark), directory)
        if key not in cls._shared:
            cls._shared[key] = cls(spark, directory)
        return cls._shared[key]

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return os.path.join(self.directory, f"{name}.parquet")

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(self.path(name))
        return self._frames[name]

    def role(self, name: str) -> DataFrame:
        view = ROLES.get(name, name)
        key = "role:" + view
        if key not in self._frames:
            args = {t: self.table(t) for t in base_tables(view)}
            self._frames[key] = self.spark.sql(STANDIN_SQL[view], **args)
        return self._frames[key]
