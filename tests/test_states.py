"""Stored measure states: merging, change feed, covering grain."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from smelter.operators.states import Grain, MeasureStates, over_states
from smelter.plans.metrics import MetricView

GRAINS = [Grain("fine", ("a", "b")), Grain("a_month", ("a",), "month"), Grain("b_day", ("b",))]


def _rows(seed, n=400):
    rng = random.Random(seed)
    return [(rng.choice([dt.date(2024, m, d) for m in (1, 2, 3) for d in range(1, 6)] + [None]), rng.choice("xyz"),
             rng.choice([1, 2, None]), rng.choice([None, 1.5, 2.25, 4.0]), rng.randrange(9)) for _ in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "date date, a string, b int, v double, w long")


def _files(root):
    return {f: os.path.getmtime(f) for d, _, names in os.walk(root) for f in (os.path.join(d, x) for x in names) if f.endswith(".parquet")}


VIEW = {"a": "source.a", "b": "source.b", "day": "source.date", "month": "trunc(source.date, 'MM')"}
MEASURES = {"total": "SUM(v)", "mean": "AVG(v) * 2", "ratio": "SUM(v) / NULLIF(SUM(w), 0)", "rows": "COUNT(1)", "some": "COUNT(v)"}


def _answers(view, dims):
    out = view.query(dims, list(MEASURES))
    return sorted((tuple(None if x is None else round(x, 9) if isinstance(x, float) else x for x in r) for r in out.collect()), key=str)


def test_answers_follow_the_change_feed_and_touch_its_days_only(spark):
    root = tempfile.mkdtemp(prefix="states-", dir="/tmp")
    states = MeasureStates(spark, root, GRAINS, ["v", "w"])
    rows = _rows(1)
    states.refresh(_frame(spark, rows))
    day = dt.date(2024, 2, 3)
    for now in ([r for r in rows if r[0] != day] + [(day, "x", 1, 100.0, 1)], [r for r in rows if r[0] != day]):
        before = _files(root)
        fact = _frame(spark, now)
        # rows of other days are not even looked at
        assert states.refresh_from(fact.where(F.to_date("date") == day), _frame(spark, [(day, "x", 1, 0.0, 0)])) == [day]
        changed = {f for f, m in _files(root).items() if before.get(f) != m} | (before.keys() - _files(root).keys())
        assert changed and all("period=2024-02-01" in f for f in changed)
        view = MetricView(fact, VIEW, MEASURES)
        for dims, grain in ((["a", "month"], "a_month"), (["a"], "a_month"), (["b", "day"], "b_day"), (["a", "b"], "fine"), (["a", "day"], "fine")):
            over = view.over(states, dims, list(MEASURES))
            assert any(f"/{grain}/" in f for f in over.source.inputFiles())
            assert _answers(over, dims) == _answers(view, dims)


def test_rewriting():
    assert over_states("(1 - SUM(d) / NULLIF(sum(t), 0)) * COUNT(1)") == "(1 - SUM(d_sum) / NULLIF(SUM(t_sum), 0)) * SUM(rows)"
    assert over_states("AVG(x)") == "(SUM(x_sum) / NULLIF(SUM(x_n), 0))"


def test_unknown_grain(spark):
    states = MeasureStates(spark, tempfile.mkdtemp(prefix="states-", dir="/tmp"), GRAINS[:1], ["v"])
    with pytest.raises(KeyError):
        states.covering(["c"], "day")
    states.refresh(_frame(spark, []).where(F.lit(False)))
    assert states.read(GRAINS[0]).count() == 0
