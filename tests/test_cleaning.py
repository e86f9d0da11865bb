"""Hand-made cases for the silver cleaning (FIXTURES.md part C, 1-3, 10)."""

import datetime as dt

from pyspark.sql import functions as F

from smelter.operators import cleaning

T0 = dt.datetime(2024, 1, 1, 0, 0)


def _raw(spark, rows):
    cols = ["reading_seq", "furnace_id", "ts", "temperature_c", "amperage_ka", "bath_ratio", "anode_effect",
            "alumina_feed_rate", "energy_kwh_ton", "pressure_pa", "vibration_mm_s", "is_failure"]
    return spark.createDataFrame(rows, cols)


def _row(seq, furnace, minute, temp, vib, energy=13000.0):
    return (seq, str(furnace), T0 + dt.timedelta(minutes=minute), str(temp), "300", "1", "0", "2", str(energy),
            "101325", None if vib is None else str(vib), "0")


def test_all_null_furnace_stays_null_without_fallback(spark):
    df = _raw(spark, [_row(1, 1, 0, 950, 1.0), _row(2, 1, 5, 950, 3.0), _row(3, 2, 0, 950, None),
                      _row(4, 1, 10, 950, None)])
    out = {r.reading_seq: (r.vibration_mm_s, r.vibration_imputed) for r in cleaning.clean_telemetry(df).collect()}
    assert out[3] == (None, True)
    assert out[4] == (1.0, True)  # percentile_approx 0.5 of {1, 3}
    fb = {r.reading_seq: r.vibration_mm_s for r in cleaning.clean_telemetry(df, global_fallback=True).collect()}
    assert fb[3] == 1.0  # global median


def test_duplicate_key_keeps_earliest_ingest(spark):
    df = _raw(spark, [_row(7, 1, 0, 990, 1.0), _row(5, 1, 0, 960, 2.0), _row(9, 1, 0, 900, 3.0)])
    rows = cleaning.clean_telemetry(df).collect()
    assert len(rows) == 1 and rows[0].reading_seq == 5 and rows[0].temperature_c == 960.0


def test_temperature_range_is_closed_and_null_fails(spark):
    temps = [800, 1100, 799.99, 1100.01, None]
    df = _raw(spark, [_row(i, 1, i, t, 1.0) for i, t in enumerate(temps)])
    kept = sorted(r.temperature_c for r in cleaning.clean_telemetry(df).collect())
    assert kept == [800.0, 1100.0]


def test_median_uses_rows_removed_later(spark):
    # the out-of-range row's vibration still counts in the furnace median
    df = _raw(spark, [_row(1, 1, 0, 500, 10.0), _row(2, 1, 5, 950, 10.0), _row(3, 1, 10, 950, None),
                      _row(4, 1, 15, 950, 1.0)])
    out = {r.reading_seq: r.vibration_mm_s for r in cleaning.clean_telemetry(df).collect()}
    assert out[3] == 10.0


def test_bad_text_becomes_null(spark):
    df = _raw(spark, [_row(1, 1, 0, "abc", 1.0)])
    typed = cleaning.typed(df)
    assert typed.first().temperature_c is None
    assert dict(typed.dtypes)["temperature_c"] == "double"


def test_dedup_plan_aggregates_instead_of_sorting(spark):
    df = _raw(spark, [_row(1, 1, 0, 950, 1.0)])
    plan = cleaning.keep_first(df, ["furnace_id", "ts"], ["reading_seq"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan


def test_audit_counts(spark):
    df = _raw(spark, [_row(1, 1, 0, 950, None), _row(2, 1, 5, 950, 2.0)])
    a = cleaning.imputation_audit(cleaning.clean_telemetry(df)).first()
    assert (a.total, a.imputed, a.nulls_left) == (2, 1, 0)
    assert F is not None
