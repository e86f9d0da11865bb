"""Point-in-time window bounds and dedup equivalence on random data."""

import datetime as dt
import random

import pytest

from smelter.operators.cleaning import keep_first
from smelter.operators.joins import join_counts, orphans, point_in_time_means, sliding_means

T0 = dt.datetime(2024, 1, 10)


def test_point_in_time_bounds(spark):
    events = spark.createDataFrame([(1, 7, T0)], "eid int, furnace_id int, t0 timestamp")
    readings = spark.createDataFrame([
        (7, T0 - dt.timedelta(hours=24), 100.0),                     # exactly 24 h before: excluded
        (7, T0 - dt.timedelta(hours=23, minutes=59), 1.0),           # inside
        (7, T0, 3.0),                                                 # at the inspection: included
        (7, T0 + dt.timedelta(seconds=1), 1000.0),                    # after: excluded (no leakage)
        (8, T0 - dt.timedelta(hours=1), 500.0),                       # other furnace
    ], "furnace_id int, ts timestamp, v double")
    r = point_in_time_means(events, readings, "furnace_id", "t0", "ts", 24, ["v"], "eid").first()
    assert r.window_readings == 2 and r.recent_v == pytest.approx(2.0)


def test_sliding_means_equal_the_range_join(spark):
    rnd = random.Random(6)
    when = lambda hours: T0 + dt.timedelta(minutes=30 * rnd.randrange(-2 * hours, 2 * hours))
    readings = [(rnd.choice([1, 2, 3, None]), rnd.choice([when(300), when(300), None]), rnd.choice([None, rnd.uniform(900, 1000)]), rnd.random())
                for _ in range(3000)] + [(5, T0, 1.5, 2.5)] * 50
    events = [(i, rnd.choice([1, 2, 3, 4, 5, None]), rnd.choice([when(330), T0, None])) for i in range(200)]
    r = spark.createDataFrame(readings, "k int, ts timestamp, a double, b double")
    e = spark.createDataFrame(events, "eid int, k int, t0 timestamp")
    for hours in (1, 24, 240):
        got = {x.eid: x for x in sliding_means(e, r, "k", "t0", "ts", f"{hours} HOURS", ["a", "b"], "eid").collect()}
        want = {x.eid: x for x in point_in_time_means(e, r, "k", "t0", "ts", hours, ["a", "b"], "eid").collect()}
        assert got.keys() == want.keys() and want
        for i, w in want.items():
            assert got[i].window_readings == w.window_readings
            assert got[i].recent_a == (None if w.recent_a is None else pytest.approx(w.recent_a, rel=1e-9)) and got[i].recent_b == pytest.approx(w.recent_b, rel=1e-9)


def test_sliding_means_cost_the_same_for_any_window(spark):
    """The rows that stand in windows are readings and look-ups, however long
    the window is."""
    readings = spark.range(2000).selectExpr("cast(id % 4 AS int) AS k", "timestamp '2024-01-01' + make_interval(0, 0, 0, 0, 0, id) AS ts", "id * 1.0 AS v")
    events = spark.range(50).selectExpr("id AS eid", "cast(id % 4 AS int) AS k", "timestamp '2024-01-02' + make_interval(0, 0, 0, 0, 0, id) AS t0")
    sizes = []
    for window in ("1 HOURS", "2000 HOURS"):
        out = sliding_means(events, readings, "k", "t0", "ts", window, ["v"], "eid")
        assert out.count() == 50
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan
        sizes.append(plan.count("Join"))
    assert sizes[0] == sizes[1]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_keep_first_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randint(1, 5), rnd.randint(0, 6), rnd.randint(0, 1000), rnd.random()) for _ in range(300)]
    df = spark.createDataFrame(rows, "k1 int, k2 int, seq int, v double")
    got = {(r.k1, r.k2): (r.seq, r.v) for r in keep_first(df, ["k1", "k2"], ["seq", "v"]).collect()}
    want = {}
    for k1, k2, seq, v in rows:
        if (k1, k2) not in want or (seq, v) < want[(k1, k2)]:
            want[(k1, k2)] = (seq, v)
    assert got == want


def test_orphans_and_join_counts(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (9,)], "k int")
    dim = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    assert {(r.k, r.rows) for r in orphans(fact, dim, "k").collect()} == {(9, 1)}
    c = join_counts(fact, dim, "k").first()
    # inner: 1,1 match once each, 2 matches twice -> 4; left adds the orphan -> 5
    assert (c.inner_rows, c.left_rows, c.orphan_rows) == (4, 5, 1)
