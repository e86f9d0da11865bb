"""Ingest, streaming and file sinks, driven by telemetry that Spark lands
from the role views into the shared scratch folder."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.operators import cleaning
from smelter.plans.medallion import GOLD_SQL, gold
from smelter.plans.registry import ORACLES, register
from smelter.session import scratch_dir
from smelter.sources import files
from smelter.sources.standins import duckdb_with
from smelter.streaming import dedup, ingest

TELEMETRY_COLS = [f.name for f in files.TELEMETRY_CSV_SCHEMA.fields]


#: Two waves of landed files: readings from the cutoff on come first, older
#: ones a wave later, as late files do.
WAVE_CUTOFF = "2024-01-15 00:00:00"


def waves(t) -> list:
    tel = t.role("telemetry")
    late = F.col("ts") < F.lit(WAVE_CUTOFF).cast("timestamp")
    return [tel.filter(~F.coalesce(late, F.lit(False))), tel.filter(late)]


def ingested(t, first_without: str | None = None, after_wave=None) -> tuple[str, str]:
    """Land the telemetry role as header CSV in two waves and ingest after
    each; ingest once more at the end (no new files -> nothing appended).
    Returns the bronze table's path and checkpoint."""
    base = scratch_dir(t.spark, "bronze")
    landing, target, ckpt = (os.path.join(base, d) for d in ("landing", "table", "_checkpoint"))
    declared = T.StructType([f for f in files.TELEMETRY_CSV_SCHEMA.fields if f.name != first_without])
    for i, wave in enumerate(waves(t)):
        wave = wave.drop(first_without) if first_without and i == 0 else wave
        if i:  # the second wave's files name their columns in another order
            wave = wave.select(*reversed(wave.columns))
        wave.write.mode("append").option("header", True).csv(landing)
        ingest.ingest_bronze(t.spark, landing, target, ckpt, declared)
        if after_wave:
            after_wave(target, ckpt)
    ingest.ingest_bronze(t.spark, landing, target, ckpt, declared)
    return target, ckpt


@register("stream_bronze", ("SRC4", "SRC5", "SNK2", "STR1", "STR2", "FN5"),
          duckdb_with("telemetry") + "SELECT * FROM telemetry")
def q_stream_bronze(t):
    """Incremental CSV ingest in two waves and a rerun; the bronze table holds
    each reading once."""
    return ingest.read_bronze(t.spark, *ingested(t)).select(*TELEMETRY_COLS)


@register("stream_schema_evolution", ("SRC4", "SNK2"), duckdb_with("telemetry") + f"""
SELECT * REPLACE (CASE WHEN ts >= TIMESTAMP '{WAVE_CUTOFF}' THEN NULL ELSE is_failure END AS is_failure)
FROM telemetry""")
def q_stream_schema_evolution(t):
    """The first wave lacks the ``is_failure`` column, the second has it, in
    another column order.  The stored schema widens by a text column, typed
    with ``try_cast`` on the way out."""
    bronze = ingest.read_bronze(t.spark, *ingested(t, first_without="is_failure"))
    return ingest.cleaning.typed(bronze).select(*TELEMETRY_COLS)


@register("stream_typed_discovery", ("SRC4", "SRC1"), duckdb_with("telemetry") + f"""
SELECT reading_seq, furnace_id, ts, temperature_c, energy_kwh_ton,
       CAST(CASE WHEN ts < TIMESTAMP '{WAVE_CUTOFF}' THEN anode_effect + 0.5 ELSE anode_effect END AS DOUBLE) AS anode_effect,
       CAST(reading_seq + 3000000000 AS BIGINT) AS long_code,
       CASE WHEN ts < TIMESTAMP '{WAVE_CUTOFF}' THEN ts + INTERVAL 1 HOUR END AS checked_at,
       CASE WHEN ts < TIMESTAMP '{WAVE_CUTOFF}' THEN CAST(ts AS DATE) END AS checked_on,
       CASE WHEN ts < TIMESTAMP '{WAVE_CUTOFF}' THEN concat('0', CAST(furnace_id AS VARCHAR)) ELSE CAST(furnace_id AS VARCHAR) END AS plant_code
FROM telemetry""")
def q_stream_typed_discovery(t):
    """Two columns are declared, all others discovered.  The first wave's whole
    numbers turn into doubles in the second, whole codes into text, and the
    second wave brings a timestamp and a date column."""
    base = scratch_dir(t.spark, "discovery")
    landing, target, ckpt = (os.path.join(base, d) for d in ("landing", "table", "_checkpoint"))
    declared = T.StructType([f for f in files.TELEMETRY_CSV_SCHEMA.fields if f.name in ("reading_seq", "ts")])
    columns = ["reading_seq", "furnace_id", "ts", "temperature_c", "energy_kwh_ton", "anode_effect", "long_code", "plant_code"]
    for i, wave in enumerate(waves(t)):
        wave = wave.withColumns({"long_code": F.col("reading_seq") + 3_000_000_000, "plant_code": F.col("furnace_id").cast("string")})
        wave = wave.select(*columns)
        if i:
            wave = wave.withColumns({"anode_effect": F.col("anode_effect") + 0.5, "plant_code": F.concat(F.lit("0"), "plant_code"),
                                     "checked_at": F.col("ts") + F.expr("INTERVAL 1 HOUR"), "checked_on": F.to_date("ts")})
            wave = wave.select(*reversed(wave.columns))
        wave.write.mode("append").option("header", True).csv(landing)
        ingest.ingest_bronze(t.spark, landing, target, ckpt, declared, discover=True)
    return ingest.read_bronze(t.spark, target, ckpt).select(*columns, "checked_at", "checked_on")


@register("stream_file_counts", ("AGG16", "SRC6"), duckdb_with("telemetry") + """
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS missing_file, CAST(0 AS BIGINT) AS missing_ingest_time,
       true AS several_files FROM telemetry""")
def q_stream_file_counts(t):
    """Rows of the bronze table and its provenance columns."""
    return ingest.read_bronze(t.spark, *ingested(t)).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.coalesce(F.col("source_file").endswith(".csv"), F.lit(False))).alias("missing_file"),
        F.count_if(F.col("ingested_at").isNull()).alias("missing_ingest_time"),
        (F.countDistinct("source_file") > 1).alias("several_files"))


def silver_gold_stream(t) -> dict[str, str]:
    """Bronze in two waves, the silver stream run after each."""
    base = scratch_dir(t.spark, "silver")
    paths = {name: os.path.join(base, name) for name in ("seen", "silver", "gold", "rules")}

    def refresh(target, ckpt):
        bronze = ingest.bronze_stream(t.spark, target, ckpt)
        ingest.run_silver_gold(bronze, *paths.values(), os.path.join(base, "_checkpoint"))

    ingested(t, after_wave=refresh)
    return paths


@register("stream_silver_keys", ("STR3", "STR4", "SRC12"), duckdb_with("telemetry") + """
SELECT DISTINCT furnace_id, ts FROM telemetry""")
def q_stream_silver_keys(t):
    """Natural keys after the streaming dedup (before rules), the second wave
    arriving after later days were processed."""
    return t.spark.read.parquet(silver_gold_stream(t)["seen"]).select("furnace_id", "ts")


@register("stream_event_dedup", ("STR4",), duckdb_with("telemetry") + """
SELECT reading_seq, furnace_id, ts, temperature_c, energy_kwh_ton, vibration_mm_s, anode_effect, is_failure FROM telemetry
QUALIFY row_number() OVER (PARTITION BY furnace_id, ts ORDER BY reading_seq) = 1""")
def q_stream_event_dedup(t):
    """First reading of every natural key through a watermarked state store,
    in three waves.  The second delivers the first one's last hours once more;
    the third is older than the watermark and contradicts nothing."""
    base = scratch_dir(t.spark, "event-dedup")
    source = os.path.join(base, "source")
    rows = t.role("telemetry").select("reading_seq", *cleaning.PIPELINE_TYPES)
    start, middle = (F.lit(x).cast("timestamp") for x in ("2024-01-08 00:00:00", WAVE_CUTOFF))
    ts = F.col("ts")
    first = rows.where((ts >= start) & (ts < middle))
    again = first.where(ts >= middle - F.expr("INTERVAL 6 HOURS"))
    table = dedup.EventTimeDedup(t.spark, os.path.join(base, "table"), ingest.NATURAL_KEY, "ts", ["reading_seq"], "12 hours")
    for wave in (first, rows.where(ts >= middle).union(again), rows.where((ts < start) | ts.isNull()).union(again)):
        wave.write.mode("append").parquet(source)
        stream = t.spark.readStream.schema(rows.schema).parquet(source)
        table.run(stream, os.path.join(base, "_checkpoint"))
    return table.read()


@register("stream_quality", ("STR7", "DQ4"), duckdb_with("telemetry") + f""",
waved AS (SELECT *, CAST(CASE WHEN ts < TIMESTAMP '{WAVE_CUTOFF}' THEN 1 ELSE 0 END AS BIGINT) AS batch_id FROM telemetry),
firsts AS (SELECT * FROM waved QUALIFY row_number() OVER (PARTITION BY furnace_id, ts ORDER BY reading_seq) = 1)
SELECT batch_id, count(*) AS rows,
       count(*) FILTER (WHERE coalesce(temperature_c NOT BETWEEN 800 AND 1100, true)) AS plausible_temperature,
       count(*) FILTER (WHERE furnace_id IS NULL) AS furnace_identified,
       count(*) FILTER (WHERE vibration_mm_s IS NULL) AS vibration_present
FROM firsts GROUP BY batch_id""")
def q_stream_quality(t):
    """Rule counters of the streaming silver, stored per micro-batch (rows
    seen and violations per rule)."""
    counts = t.spark.read.parquet(silver_gold_stream(t)["rules"])
    return counts.where("rows > 0").withColumn("batch_id", F.col("batch_id").cast("long"))


@register("stream_gold", ("STR5", "SRC12"), ORACLES["gold_furnace_day_lite"])
def q_stream_gold(t):
    """Stream silver (dedup + rules) -> gold recomputed for touched days only;
    equal to the batch result."""
    return t.spark.read.parquet(silver_gold_stream(t)["gold"])


@register("parquet_or_csv", ("SRC2",), GOLD_SQL + "\nSELECT * FROM gold_oee")
def q_parquet_or_csv(t):
    """The furnace-day gold exported and read back: Parquet where it exists."""
    out = scratch_dir(t.spark, "export")
    g = gold(t)
    files.export(g, out, "gold_furnace_day")
    return files.read_parquet_or_csv(t.spark, os.path.join(out, "gold_furnace_day"))


@register("csv_roundtrip", ("SNK4", "SRC1", "SNK1"), GOLD_SQL + "\nSELECT * FROM gold_oee")
def q_csv_roundtrip(t):
    """Export the furnace-day gold as CSV and Parquet; read the CSV back with
    its declared schema."""
    out = scratch_dir(t.spark, "export")
    g = gold(t)
    files.export(g, out, "gold_furnace_day", parquet=False)
    return files.read_csv(t.spark, os.path.join(out, "gold_furnace_day.csv"), schema=g.schema)


@register("published_gold", ("SNK3", "SRC3", "SNK1"), GOLD_SQL + "\nSELECT * FROM gold_oee")
def q_published_gold(t):
    """Furnace-day gold published as a named table with comment and layer
    property, then scanned by name."""
    path = os.path.join(scratch_dir(t.spark, "published"), "telemetry_gold_furnace_day")
    return files.publish(gold(t), "telemetry_gold_furnace_day", path,
                         "Daily indicators per furnace: energy, failure rate, availability.",
                         {"quality": "gold"})


GOLD_LOAD_ROLES = ["plants", "alloys", "products", "furnaces", "lme", "fx", "production", "sales",
                   "inspections", "telemetry"]


@register("gold_load", ("SNK1", "SNK5", "AGG29", "TRAP12"), duckdb_with(*GOLD_LOAD_ROLES) + "\nUNION ALL\n".join(
    f"SELECT '{role}' AS table_name, count(*) AS rows FROM {role}" for role in GOLD_LOAD_ROLES))
def q_gold_load(t):
    """Bulk load of the ten role tables; loaded row counts read back."""
    out = scratch_dir(t.spark, "gold_load")
    return files.load_tables({role: t.role(role) for role in GOLD_LOAD_ROLES}, out)

