"""File sources and sinks: declared-schema CSV, Parquet-or-CSV, landing
inventory, bulk table load, exports."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared schema of landed telemetry CSV.  Declaring it avoids an inference
# pass over the files and the classic hazard of codes such as "1050" being
# inferred as integers.
TELEMETRY_CSV_SCHEMA = T.StructType([
    T.StructField("reading_seq", T.LongType()),
    T.StructField("furnace_id", T.IntegerType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("temperature_c", T.DoubleType()),
    T.StructField("amperage_ka", T.DoubleType()),
    T.StructField("bath_ratio", T.DoubleType()),
    T.StructField("anode_effect", T.IntegerType()),
    T.StructField("alumina_feed_rate", T.DoubleType()),
    T.StructField("energy_kwh_ton", T.DoubleType()),
    T.StructField("pressure_pa", T.DoubleType()),
    T.StructField("vibration_mm_s", T.DoubleType()),
    T.StructField("is_failure", T.IntegerType()),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             infer: bool = False) -> DataFrame:
    """Header CSV with a declared schema (or, opt-in, inferred types)."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet_or_csv(spark: SparkSession, base: str, schema: T.StructType | None = None) -> DataFrame:
    """``<base>.parquet`` when present, else ``<base>.csv``."""
    parquet = base + ".parquet"
    if _exists(spark, parquet):
        return spark.read.parquet(parquet)
    return read_csv(spark, base + ".csv", schema=schema, infer=schema is None)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm  # Hadoop FileSystem: works for any cluster filesystem
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def landing_inventory(spark: SparkSession, directory: str) -> DataFrame:
    """Files under a directory (recursive): relative path and size, sorted.
    Only file metadata is read (the ``content`` column is pruned)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(directory).select("path", "length"))
    root = directory.rstrip("/") + "/"
    rel = F.regexp_replace("path", r"^.*?" + _regex_escape(root), "")
    return files.select(rel.alias("relative_path"), F.col("length").alias("bytes")).orderBy("relative_path")


def _regex_escape(s: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?{}[]|()\\" else ch for ch in s)


def missing_inputs(inventory: DataFrame, required: DataFrame) -> DataFrame:
    """Required file names (column ``name``) absent from an inventory."""
    present = inventory.select(F.regexp_extract("relative_path", r"([^/]+)$", 1).alias("name"))
    return required.join(present, "name", "left_anti")


def export(df: DataFrame, directory: str, name: str, parquet: bool = True, csv: bool = True) -> None:
    """CSV (with header) and/or Parquet export of one table."""
    if csv:
        df.write.mode("overwrite").option("header", True).csv(os.path.join(directory, name + ".csv"))
    if parquet:
        df.write.mode("overwrite").parquet(os.path.join(directory, name + ".parquet"))


def load_tables(frames: dict[str, DataFrame], directory: str) -> DataFrame:
    """Bulk load: write each frame as a Parquet table under ``directory`` and
    return the loaded row counts, read back in one union of count aggregates."""
    spark = next(iter(frames.values())).sparkSession
    out = None
    for name, frame in frames.items():
        path = os.path.join(directory, name)
        frame.write.mode("overwrite").parquet(path)
        part = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


def publish(df: DataFrame, name: str, path: str, comment: str, properties: dict[str, str]) -> DataFrame:
    """Named dataset: an external Parquet table at ``path`` registered in the
    session catalog, with a comment and table properties (e.g. its layer).
    Returns the table read back by name."""
    spark = df.sparkSession
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    spark.sql(f"COMMENT ON TABLE {name} IS '{comment.replace(chr(39), chr(39) * 2)}'")
    props = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({props})")
    return spark.table(name)
