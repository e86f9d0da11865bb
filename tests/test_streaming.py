"""File stream ingest by header, rerun idempotence, late rows, dedup independent of arrival."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import types as T

from smelter.streaming import ingest

SCHEMA = T.StructType([T.StructField("furnace_id", T.IntegerType()), T.StructField("ts", T.TimestampType()),
                       T.StructField("temperature_c", T.DoubleType())])


def _write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(header + "\n")
        for r in rows:
            fh.write(",".join(map(str, r)) + "\n")


def test_rerun_adds_nothing_and_columns_bind_by_name(spark):
    base = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    landing, target, ckpt = (os.path.join(base, d) for d in ("landing", "bronze", "ckpt"))
    _write_csv(os.path.join(landing, "a.csv"), "furnace_id,ts,temperature_c",
               [(1, "2024-01-01T00:00:00Z", 950.0), (2, "2024-01-01T00:05:00Z", 960.0)])
    for _ in range(2):
        ingest.ingest_bronze(spark, landing, target, ckpt, SCHEMA)
    assert ingest.read_bronze(spark, target, ckpt).count() == 2
    # new columns in the middle and at the end, another order, and a header
    # that begins with another column; "n/a" fits no guessed type
    _write_csv(os.path.join(landing, "b.csv"), "furnace_id,ts,pressure_pa,temperature_c", [(3, "2024-01-01T00:10:00Z", 101325.0, 970.0)])
    _write_csv(os.path.join(landing, "c.csv"), "ts,furnace_id,temperature_c,zz", [("2024-01-01T00:15:00Z", 4, 980.0, "n/a")])
    for i in range(120):
        _write_csv(os.path.join(landing, f"d{i}.csv"), "ts,furnace_id,temperature_c,zz", [("2024-01-02T00:15:00Z", 100 + i, 981.0, i)])
    ingest.ingest_bronze(spark, landing, target, ckpt, SCHEMA)
    rows = {r.furnace_id: r for r in ingest.read_bronze(spark, target, ckpt).collect()}
    assert len(rows) == 124
    assert (rows[3].temperature_c, rows[3].pressure_pa, rows[3].zz) == (970.0, "101325.0", None)
    assert (rows[4].temperature_c, rows[4].zz, rows[1].zz) == (980.0, "n/a", None)
    assert all(rows[100 + i].zz == str(i) and rows[100 + i].source_file == f"d{i}.csv" for i in range(120))
    assert set(ingest.stored_schema(spark, ckpt).fieldNames()) == {"furnace_id", "ts", "temperature_c", "pressure_pa", "zz"}


def test_late_rows_are_kept_and_arrival_order_does_not_matter(spark):
    schema = "reading_seq long, furnace_id int, ts timestamp, temperature_c double, energy_kwh_ton double, " \
             "vibration_mm_s double, anode_effect int, is_failure int"
    t0 = dt.datetime(2024, 1, 10)
    late = t0 - dt.timedelta(days=9)
    waves = [[(5, 1, t0, 950.0, 1.0, None, 0, 0), (6, 2, t0, 950.0, 1.0, None, 0, 0)],
             [(1, 1, late, 960.0, 2.0, 1.0, 0, 0), (2, 1, late, 970.0, 3.0, 1.0, 0, 0), (9, 2, late, 700.0, 3.0, 1.0, 0, 0)],
             # an earlier reading of a key already seen, which breaks a rule and empties its day for furnace 1
             [(3, 1, t0, 500.0, 9.0, None, 0, 0), (4, 2, t0, 955.0, 1.5, None, 1, 0), (10, 2, late, 960.0, 1.0, 1.0, 0, 0)]]

    def run(order):
        base = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
        src = os.path.join(base, "src")
        paths = [os.path.join(base, p) for p in ("seen", "silver", "gold", "rules")]
        for i in order:
            spark.createDataFrame(waves[i], schema).coalesce(1).write.mode("append").parquet(src)
            ingest.run_silver_gold(spark.readStream.schema(schema).parquet(src), *paths, os.path.join(base, "ckpt"))
        silver = spark.read.parquet(paths[1])
        return sorted((r.reading_seq, r.furnace_id, r.temperature_c) for r in silver.collect()), spark.read.parquet(paths[3]).count(), \
            sorted((r.furnace_id, str(r.day), r.readings) for r in spark.read.parquet(paths[2]).collect())

    want = [(1, 1, 960.0), (4, 2, 955.0)]
    for order in ((0, 1, 2), (2, 0, 1)):
        silver, batches, gold = run(order)
        assert silver == want and batches == 3
        assert gold == [(1, "2024-01-01", 1), (2, "2024-01-10", 1)]


def test_checkpoint_cannot_be_shared(spark):
    ckpt = os.path.join(tempfile.mkdtemp(prefix="ckpt-", dir="/tmp"), "c")
    ingest.claim_checkpoint(spark, ckpt, "a")
    ingest.claim_checkpoint(spark, ckpt, "a")
    with pytest.raises(ValueError):
        ingest.claim_checkpoint(spark, ckpt, "b")
