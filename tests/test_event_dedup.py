"""Watermarked dedup: no row is lost, whatever comes late, and state is bounded."""

import datetime as dt
import os
import random
import tempfile

import pytest

from smelter.streaming import dedup

SCHEMA = "reading_seq long, furnace_id int, ts timestamp, temperature_c double"
T0 = dt.datetime(2024, 1, 10)


def table_of(spark, delay="2 hours"):
    base = tempfile.mkdtemp(prefix="dedup-", dir="/tmp")
    return base, dedup.EventTimeDedup(spark, os.path.join(base, "t"), ["furnace_id", "ts"], "ts", ["reading_seq"], delay)


def feed(spark, base, table, wave):
    source = os.path.join(base, "source")
    spark.createDataFrame(wave, SCHEMA).repartition(2).write.mode("append").parquet(source)
    table.run(spark.readStream.schema(SCHEMA).parquet(source), os.path.join(base, "ckpt"))


def plain(rows):
    best = {}
    for r in rows:
        if (r[1], r[2]) not in best or r[0] < best[r[1], r[2]][0]:
            best[r[1], r[2]] = r
    return sorted(best.values(), key=str)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def test_late_rows_are_merged_exactly(spark):
    base, table = table_of(spark)
    waves = [
        [(10, 1, at(0), 1.0), (11, 1, at(1), 1.1), (12, 2, at(9), 1.2), (13, 2, at(10), 1.3), (14, 2, at(10), 1.4)],
        # on time: an earlier reading of an open key, and a new one
        [(5, 2, at(10), 2.0), (20, 2, at(11), 2.1), (21, None, at(11), 2.2), (22, None, at(11), 2.3)],
        # late beyond the watermark: a new key, one that loses, one that wins, an old day, no event time
        [(30, 3, at(0), 3.0), (31, 1, at(0), 3.1), (2, 1, at(1), 3.2), (32, 1, at(-90), 3.3), (33, 1, at(-90), 3.4), (34, 7, None, 3.5),
         (35, 7, None, 3.6), (36, 1, dt.datetime(1969, 1, 1), 3.7)],
        # the same again, one better each, and far ahead
        [(1, 1, at(1), 4.0), (40, 3, at(0), 4.1), (3, 7, None, 4.2), (41, 9, at(500), 4.3)]]
    rows = []
    for wave in waves:
        feed(spark, base, table, wave)
        rows += wave
        assert sorted((tuple(r) for r in table.read().select("reading_seq", "furnace_id", "ts", "temperature_c").collect()), key=str) == plain(rows)
    progress = table.progress().collect()
    assert all(r.dropped == 0 for r in progress) and sum(r.input_rows for r in progress) == len(rows)


def test_state_is_bounded_and_closed_days_are_left_alone(spark):
    base, table = table_of(spark, "3 hours")
    rng, rows, sizes = random.Random(1), [], []
    for wave in range(3):
        now = [(1000 * wave + i, rng.randrange(5), at(24 * wave + i / 20), 1.0) for i in range(400)]
        feed(spark, base, table, now + now[-20:])
        rows += now
        sizes.append(table.progress().agg({"state_rows": "max"}).first()[0])
        files = {f: os.path.getmtime(f) for d, _, names in os.walk(table.closed) for f in (os.path.join(d, x) for x in names) if f.endswith(".parquet")}
        if wave:
            assert all(files.get(f) == m for f, m in before.items())
        before = files
    assert sorted((tuple(r) for r in table.read().select("reading_seq", "furnace_id", "ts", "temperature_c").collect()), key=str) == plain(rows)
    # the rows within the delay stay in the state store, not history
    last = table.progress().orderBy("batch_id").collect()[-1]
    assert last.state_rows < 100 and max(sizes) <= 500
    assert spark.read.parquet(table.frontier()["open"]).count() < 100


def test_unfinished_batch_is_repeated(spark, monkeypatch):
    base, table = table_of(spark)
    first = [(10, 1, at(0), 1.0), (11, 1, at(5), 1.1), (12, 1, at(30), 1.2)]
    second = [(1, 1, at(5), 2.0), (20, 2, at(5), 2.1), (30, 1, at(0), 2.2), (31, 4, at(60), 2.3)]
    feed(spark, base, table, first)
    real = dedup._write_text

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(dedup, "_write_text", broken)
    with pytest.raises(Exception, match="lost"):
        feed(spark, base, table, second)
    monkeypatch.setattr(dedup, "_write_text", real)
    feed(spark, base, table, [(50, 5, at(61), 5.0)])
    rows = first + second + [(50, 5, at(61), 5.0)]
    assert sorted((tuple(r) for r in table.read().select("reading_seq", "furnace_id", "ts", "temperature_c").collect()), key=str) == plain(rows)
