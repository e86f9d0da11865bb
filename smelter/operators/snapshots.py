"""Versioned snapshot tables (history, read-as-of, update, restore, changes).

Layout under one root path:

* ``<root>/version=<N>/`` – the full table as written by version N;
* ``<root>/_history/``    – one Parquet row per committed version
  (version, operation, rows, written_at).

A version becomes visible only when its history row is written, after its
data directory is complete; a crashed write leaves an orphan directory that
no reader sees and the next write replaces.  Concurrent writers are not
coordinated (no transaction log): one writer per table.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HISTORY_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("operation", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("written_at", T.TimestampType()),
])


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._version: int | None = None  # last version this writer committed or read

    @property
    def _history_path(self) -> str:
        return os.path.join(self.root, "_history")

    def _version_path(self, version: int) -> str:
        return os.path.join(self.root, f"version={version}")

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def history(self) -> DataFrame:
        """Committed versions; empty only if the history folder is not there.
        A failure to list or read it is raised, never taken for emptiness."""
        if not self._exists(self._history_path):
            return self.spark.createDataFrame([], HISTORY_SCHEMA)
        return self.spark.read.schema(HISTORY_SCHEMA).parquet(self._history_path)

    def current_version(self) -> int | None:
        """Latest committed version (a one-row aggregate of the history, read
        once; afterwards this writer tracks the versions it commits)."""
        if self._version is None:
            self._version = self.history().agg(F.max("version")).first()[0]
        return self._version

    def write(self, df: DataFrame, operation: str = "WRITE") -> int:
        self._version = self.history().agg(F.max("version")).first()[0]  # another writer may have committed
        version = 0 if self._version is None else self._version + 1
        path = self._version_path(version)
        # a folder without a history row is what a crashed write left behind;
        # a committed one cannot be met here, as versions only count up
        df.write.mode("overwrite").parquet(path)
        rows = self.spark.read.parquet(path).count()  # footer metadata only
        entry = self.spark.createDataFrame(
            [(version, operation, rows, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))],
            HISTORY_SCHEMA)
        entry.coalesce(1).write.mode("append").parquet(self._history_path)
        self._version = version
        return version

    def read(self, version: int | None = None) -> DataFrame:
        if version is None:
            version = self.current_version()
            if version is None:
                raise FileNotFoundError(f"no committed version under {self.root}")
        return self.spark.read.parquet(self._version_path(version))

    def update(self, column: str, value: Column, condition: Column) -> int:
        """``UPDATE t SET column = value WHERE condition`` as a new version."""
        cur = self.read()
        new = cur.withColumn(column, F.when(condition, value).otherwise(F.col(column)))
        return self.write(new, operation=f"UPDATE {column}")

    def restore(self, version: int) -> int:
        """Make ``version`` current again (a new version with its content)."""
        return self.write(self.read(version), operation=f"RESTORE {version}")


def changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Row-level changes between two versions: insert / delete / update.

    Full outer join on the keys (null keys meet null keys); a row is updated
    when any column of either version differs, a column that one version lacks
    counting as null there.  Values are compared as they are, null by null;
    both sides are shuffled once on the keys.
    """
    values = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]

    def side(df: DataFrame, tag: str) -> DataFrame:
        cols = [F.col(c) if c in df.columns else F.lit(None).alias(c) for c in values]
        return df.select(*(F.col(k).alias(f"_{tag}_{k}") for k in keys), *(c.alias(f"_{tag}_{n}") for n, c in zip(values, cols, strict=True)),
                         F.lit(True).alias(f"_in_{tag}"))

    a, b = side(old, "old"), side(new, "new")
    same_key = [a[f"_old_{k}"].eqNullSafe(b[f"_new_{k}"]) for k in keys]
    differs = F.lit(False)
    for c in values:
        differs = differs | ~F.col(f"_old_{c}").eqNullSafe(F.col(f"_new_{c}"))
    change = (F.when(F.col("_in_old").isNull(), F.lit("insert"))
              .when(F.col("_in_new").isNull(), F.lit("delete"))
              .when(differs, F.lit("update")))
    key = [F.when(F.col("_in_old").isNull(), F.col(f"_new_{k}")).otherwise(F.col(f"_old_{k}")).alias(k) for k in keys]
    return a.join(b, same_key, "full_outer").select(*key, change.alias("change_type")).filter(F.col("change_type").isNotNull())
